"""Row checks and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import COUNT_COLUMNS


def sane_counts(df: DataFrame) -> DataFrame:
    """Counts known and not negative, and no more likes than views.

    Run it before episodes are formed: a rejected day splits an episode.
    """
    keep = F.col("likes") <= F.col("view_count")
    for name in COUNT_COLUMNS:
        keep = keep & (F.col(name) >= 0)
    return df.filter(keep)


def row_counts(df: DataFrame, **conditions: Column) -> DataFrame:
    """One row with one count per condition, all from a single pass."""
    return df.agg(*[F.count_if(condition).alias(name) for name, condition in conditions.items()])


def is_empty(df: DataFrame) -> bool:
    return df.isEmpty()


def require_rows(df: DataFrame, message: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(message)
    return df
