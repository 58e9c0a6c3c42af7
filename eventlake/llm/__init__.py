"""Operators of a training-data pipeline: near-duplicate removal, quality and
license rules, decontamination, token counts, text extraction, mixing,
language identification and URL filtering.

Nothing else in the library imports this package. Its functions are sent to
the Python workers by value, so executors need no copy of it on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
