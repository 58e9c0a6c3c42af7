"""File sources and stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..schemas import TOPIC_RECORD_SCHEMA


def read_record_files(
    spark: SparkSession,
    path: str,
    schema: StructType = TOPIC_RECORD_SCHEMA,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
    glob: str | None = None,
) -> DataFrame:
    """Stream topic records replayed from files (stands in for a live topic).

    ``max_files_per_trigger`` is the file twin of the offsets-per-batch cap.
    A single file cannot be streamed: give its folder and a ``glob``.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", merge_schema: bool = False) -> DataFrame:
    """Batch read of a stored table; columns and filters reach the scan."""
    reader = spark.read.format(fmt)
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    return reader.load(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "append", partition_by=None) -> str:
    """Batch write; returns the path so callers can read it back."""
    writer = df.write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path
