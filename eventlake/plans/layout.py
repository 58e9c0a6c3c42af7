"""Input layout: deal rows out to more tasks than a scan has splits."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, partitions: int | None) -> DataFrame:
    """``df`` dealt out round-robin to ``partitions`` tasks (``None``: as it is).

    For tables of few row groups, whose per-row work (JSON writing and parsing)
    would run in as few tasks; a table with many splits needs none. Round-robin
    spreads even a group of identical copies evenly; Spark sorts each input
    partition first, so a retried task sends every row to the same place. Works
    on streams as well, inside each micro-batch.
    """
    return df if partitions is None else df.repartition(partitions)
