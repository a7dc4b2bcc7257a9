"""Kafka topics.  The session needs Spark's Kafka connector on its classpath."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

# --- fixed values: delivery settings of the feed ---
PRODUCER_OPTIONS = {
    "kafka.acks": "all",
    "kafka.retries": "5",
    "kafka.linger.ms": "100",
    "kafka.compression.type": "gzip",
}


def source_options(
    servers: str, topic: str, starting_offsets: str = "earliest", fail_on_data_loss: bool = True
) -> dict[str, str]:
    if starting_offsets not in ("earliest", "latest"):
        raise ValueError(f"starting_offsets must be earliest or latest, not {starting_offsets!r}")
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }


def read_topic(
    spark: SparkSession, servers: str, topic: str, starting_offsets: str = "earliest", fail_on_data_loss: bool = True,
    **options: str,
) -> DataFrame:
    """Stream of the topic's messages; the payload is in ``value``.

    ``options`` are passed on, such as ``maxOffsetsPerTrigger`` to bound a batch or
    ``minPartitions`` to read a topic with more tasks than it has partitions.
    """
    reader = spark.readStream.format("kafka").options(**source_options(servers, topic, starting_offsets, fail_on_data_loss))
    return reader.options(**options).load()


def as_messages(df: DataFrame, key_col: str | None = None) -> DataFrame:
    """Each row as JSON in ``value``, keyed by ``key_col`` if given; null fields are left out."""
    value = F.to_json(F.struct("*")).alias("value")
    return df.select(value) if key_col is None else df.select(F.col(key_col).cast("string").alias("key"), value)


def write_topic(
    df: DataFrame, servers: str, topic: str, checkpoint: str, key_col: str | None = None
) -> StreamingQuery:
    return (
        as_messages(df, key_col)
        .writeStream.format("kafka")
        .options(**{"kafka.bootstrap.servers": servers, "topic": topic, **PRODUCER_OPTIONS})
        .option("checkpointLocation", checkpoint)
        .start()
    )
