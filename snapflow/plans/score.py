"""Scoring an episode table."""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.features import back_transform
from ..schemas import SCORED_COLUMNS
from .learn import RAW_PREDICTION


def score_table(model: Model, episodes: DataFrame) -> DataFrame:
    """Rows of ``episodes`` with the predicted length in days, to two places."""
    scored = model.transform(episodes)
    return scored.withColumn("predicted_trending_days", back_transform(F.col(RAW_PREDICTION), digits=2)).select(
        *SCORED_COLUMNS
    )
