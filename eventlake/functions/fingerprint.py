"""Order-free content fingerprints that aggregate partially (no collect)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def id_hash(col: Column | str) -> Column:
    """60-bit hash of a value's text: the first 15 hex digits of its MD5.

    Summed per group (as DECIMAL(38,0), no overflow) it gives a set
    fingerprint that map-side aggregation can combine, so a feed of any size
    never has to be gathered into one task.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.conv(F.substring(F.md5(c.cast("string")), 1, 15), 16, 10).cast("decimal(38,0)")
