"""Counting the messages of a stream on the way, and keeping the counts of every micro-batch."""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from .payload import CORRUPT, identified

COUNTERS = "messages"
NAMES = ("messages", "valid", "broken", "blank_id")


def message_counts() -> list[Column]:
    """Parsed messages, and how many of them are valid, unreadable, and readable but without an id."""
    broken, named = F.col(CORRUPT).isNotNull(), identified("video_id")
    conditions = (F.lit(True), named & ~broken, broken, ~named & ~broken)
    return [F.count_if(condition).alias(name) for name, condition in zip(NAMES, conditions)]


def with_counters(parsed: DataFrame) -> DataFrame:
    """The same messages; what passes is counted per micro-batch, for :class:`BatchCounters` to keep."""
    return parsed.observe(COUNTERS, *message_counts())


class BatchCounters(StreamingQueryListener):
    """Stores the counts of every micro-batch of the session's streams below ``path``.

    A batch that is replayed overwrites its counts.  Streams tell apart by the id that they keep for the life of their
    checkpoint.  Spark calls listeners on a thread of their own, so wait for :meth:`settled` before reading the counts of
    a stream that has ended.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._ended = threading.Event()

    def onQueryStarted(self, event) -> None:
        self._ended.clear()

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        row = progress.observedMetrics.get(COUNTERS)
        if row is not None:
            table = self.spark.createDataFrame([tuple(row[name] for name in NAMES)], ", ".join(f"{n} bigint" for n in NAMES))
            folder = f"{self.path}/run_id={progress.id}/batch_id={progress.batchId}"
            table.coalesce(1).write.mode("overwrite").parquet(folder)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ended.set()

    def settled(self, seconds: float = 60.0) -> bool:
        """Wait until the end of a stream has been reported, which is after all its batches."""
        return self._ended.wait(seconds)


def read_counters(spark: SparkSession, path: str) -> DataFrame:
    """One row per stream and micro-batch."""
    return spark.read.parquet(path)
