"""Change-log topics, as a stream or as one bounded read.

Both give ``(value, src_partition, src_offset)``, the frame ``parse_events`` takes. One
stream feeds all tables; its checkpoint holds the offsets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def topic_options(servers: str, topic: str, **extra: str) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "includeHeaders": "false",
        **extra,
    }


def _messages(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("value").cast("string").alias("value"),
        F.col("partition").alias("src_partition"),
        F.col("offset").alias("src_offset"),
    )


def stream_topic(spark: SparkSession, servers: str, topic: str, **extra: str) -> DataFrame:
    options = topic_options(servers, topic, **extra)
    return _messages(spark.readStream.format("kafka").options(**options).load())


def read_topic(spark: SparkSession, servers: str, topic: str, **extra: str) -> DataFrame:
    """The topic up to its present end, as a batch frame."""
    options = topic_options(servers, topic, endingOffsets="latest", **extra)
    return _messages(spark.read.format("kafka").options(**options).load())


def stream_files(spark: SparkSession, path: str, **extra: str) -> DataFrame:
    """Event files, one JSON event per line, in place of a topic."""
    return spark.readStream.options(**extra).text(path).select("value")
