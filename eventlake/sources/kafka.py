"""Topic source and the record decoder.

The Kafka connector jar is not on this image's classpath, so
``read_kafka_stream`` is exercised for its options only; ``decode_records`` is
the same code for a live topic and for a file replay of its records.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import StreamConfig, kafka_source_options

log = logging.getLogger(__name__)


def read_kafka_stream(spark: SparkSession, cfg: StreamConfig) -> DataFrame:
    """Streaming DataFrame of raw topic records.

    Start position, per-batch offset cap and tolerance of offsets lost to
    retention come from ``cfg``; login options only when a user name is set.
    """
    if not cfg.fail_on_data_loss:
        log.warning(
            "topic %s: failOnDataLoss=false, offsets lost to retention are skipped without failing the query",
            cfg.topic,
        )
    return spark.readStream.format("kafka").options(**kafka_source_options(cfg)).load()


def decode_records(records: DataFrame) -> DataFrame:
    """Topic record → ``raw_json, topic, partition, offset, kafka_ingest_ts``.

    Value bytes are read as UTF-8 text; the broker timestamp becomes the ingest
    time. Narrow projection: no shuffle, pruned to five columns.
    """
    return records.select(
        F.col("value").cast("string").alias("raw_json"),
        F.col("topic"),
        F.col("partition"),
        F.col("offset"),
        F.col("timestamp").alias("kafka_ingest_ts"),
    )
