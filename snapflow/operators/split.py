"""Training and test rows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import CATEGORICAL_FEATURES, DATE_COLUMN, LABEL_COLUMN, NUMERIC_FEATURES, TARGET_COLUMN

# --- fixed value: first test day unless told otherwise ---
DEFAULT_CUTOFF = date(2026, 1, 1)


def temporal_split(
    df: DataFrame, cutoff: date = DEFAULT_CUTOFF, date_col: str = DATE_COLUMN,
    purge: bool = False, end_col: str = "episode_end_date",
) -> tuple[DataFrame, DataFrame]:
    """Rows before ``cutoff`` and rows from it on.

    ``purge`` drops training episodes that run into the test period, whose length was not yet
    known at the cutoff.  The comparison is with a date, so it reaches the parquet scan.
    """
    day = F.lit(cutoff)
    train, test = df.filter(F.col(date_col) < day), df.filter(F.col(date_col) >= day)
    return (train.filter(F.col(end_col) < day) if purge else train), test


def training_projection(df: DataFrame) -> DataFrame:
    """Only what training reads: date, label, target, features; absent ones are left out."""
    wanted = [DATE_COLUMN, *CATEGORICAL_FEATURES, LABEL_COLUMN, TARGET_COLUMN, *NUMERIC_FEATURES]
    return df.select(*[name for name in dict.fromkeys(wanted) if name in df.columns])
