"""Episodes that had not ended when the data did, and weights that make up for leaving them out."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..schemas import LABEL_COLUMN


def still_open(last_day: Column, end_col: str = "episode_end_date", max_gap_days: int = 1) -> Column:
    """Could a day after the last one of the data still continue the episode?"""
    return F.datediff(last_day, F.col(end_col)) < max_gap_days


def with_censoring_weights(
    episodes: DataFrame, last_day: date | None = None, max_gap_days: int = 1, label: str = LABEL_COLUMN,
    end_col: str = "episode_end_date",
) -> DataFrame:
    """Episodes with ``censored`` and ``weight``: 0 if the episode was still open, else one over the chance to be seen whole.

    That chance is the Kaplan-Meier estimate of not having been cut off before the episode's own length, from the lengths of the
    open episodes; where lengths tie, ends count before cuts.  ``last_day`` is the last day of the data, by default that of the
    latest episode.  Lengths are whole days, so the table of chances has at most a row per day of the calendar.
    """
    last = episodes.agg(F.max(end_col)).scalar() if last_day is None else F.lit(last_day)
    marked = episodes.withColumn("censored", still_open(last, end_col, max_gap_days))
    lengths = marked.groupBy(label).agg(F.count("*").alias("n"), F.count_if("censored").alias("cut"))
    later = Window.orderBy(label).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    before = Window.orderBy(label).rowsBetween(Window.unboundedPreceding, -1)
    at_risk = lengths.withColumn("at_risk", F.sum("n").over(later) - (F.col("n") - F.col("cut")))
    stays = at_risk.withColumn("stays", F.when(F.col("at_risk") > 0, 1 - F.col("cut") / F.col("at_risk")).otherwise(1.0))
    chances = stays.select(F.col(label).alias("_length"), F.coalesce(F.product("stays").over(before), F.lit(1.0)).alias("_chance"))
    weight = F.when(F.col("censored"), 0.0).otherwise(1 / F.col("_chance"))
    return marked.join(chances, F.col(label) == F.col("_length"), "left").withColumn("weight", weight).drop("_length", "_chance")
