"""Output form for comparison with a SQL oracle.

Library functions keep ``TIMESTAMP`` instants and ``ARRAY<STRING>``; for a
value-by-value comparison, instants become UTC wall clock (``TIMESTAMP_NTZ``)
and string arrays a sorted comma-joined text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, TimestampType

from ..functions.timecols import instant_to_utc_ntz


def comparable(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, TimestampType):
            c = instant_to_utc_ntz(c)
        elif isinstance(f.dataType, ArrayType) and isinstance(f.dataType.elementType, StringType):
            c = F.array_join(F.array_sort(c), ",")
        cols.append(c.alias(f.name))
    return df.select(*cols)
