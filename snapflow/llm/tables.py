"""Helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..workspace import new_run_dir

BROADCAST_ROWS = 10_000
SMALL_IDS = 500_000


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder: later steps read it, whichever executors are lost meanwhile."""
    path = new_run_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lookup(df: DataFrame, name: str, most: int = BROADCAST_ROWS, size: Column | None = None) -> DataFrame:
    """A table to join with: broadcast if it is small, which is counted; else Spark shuffles both sides.

    Small is a table of up to ``most`` rows, or whose rows' ``size`` adds up to no more.
    """
    stored = written(df, name)
    if size is None:
        small = stored.limit(most + 1).count() <= most
    else:
        small = (stored.agg(F.sum(size.cast("long"))).first()[0] or 0) <= most
    return F.broadcast(stored) if small else stored


def schema_text(df: DataFrame, columns) -> str:
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in columns)


def without(df: DataFrame, ids: DataFrame, keys: list[str], name: str) -> DataFrame:
    """The rows of df whose keys (null equals null) are not among the ids, which have the same columns.

    Up to SMALL_IDS ids, which are counted, are broadcast, so that whole rows are not shuffled; more are joined by shuffle.
    """
    listed = lookup(ids.select(*[F.col(k).alias(f"__{i}") for i, k in enumerate(keys)]).distinct(), name, SMALL_IDS)
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & df[k].eqNullSafe(listed[f"__{i}"])
    return df.join(listed, same, "left_anti")
