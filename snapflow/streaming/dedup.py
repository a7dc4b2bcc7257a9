"""Sending every id once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_repeats(
    df: DataFrame,
    keys: Sequence[str] = ("video_id",),
    event_time_col: str | None = None,
    delay: str | None = None,
    salts: int = 1,
) -> DataFrame:
    """First row per key over the life of a stream.

    Without a delay the state remembers every key, spread over the executors: exact for ever.
    With ``event_time_col`` and ``delay`` a key is forgotten once the watermark has passed it by
    ``delay``, which bounds the state; rows later than that are dropped by Spark.

    Every row is shuffled by its key, and the state has one entry per key.  Where a key holds much of a batch, ``salts``
    deals it over so many tasks; at most one row of each goes on to a second, exact stage.  That costs a second
    shuffle of what is new and up to ``salts`` more state entries per key.  The salt is the number of the input split, so it is
    the same when a lost task is run again.
    """
    if (event_time_col is None) != (delay is None):
        raise ValueError("event_time_col and delay go together")
    salted = df if salts <= 1 else df.withColumn("_salt", F.spark_partition_id() % salts)
    passes = [list(keys)] if salts <= 1 else [[*keys, "_salt"], list(keys)]
    if delay is not None:
        salted = salted.withWatermark(event_time_col, delay)
    for columns in passes:
        salted = salted.dropDuplicates(columns) if delay is None else salted.dropDuplicatesWithinWatermark(columns)
    return salted.drop("_salt")
