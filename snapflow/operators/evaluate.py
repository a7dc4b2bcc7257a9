"""Scores of predictions and the comparison of models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import LABEL_COLUMN, MEAN_BASELINE


def regression_metrics(
    df: DataFrame, label: str = LABEL_COLUMN, prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """RMSE, MAE and R2 per group, all in one aggregation.

    The label's total sum of squares is ``n * var_pop(label)``, so no second pass for the mean is
    needed.  R2 is null for a constant label.
    """
    error = F.col(label) - F.col(prediction)
    scored = error.isNotNull()
    total = F.var_pop(F.when(scored, F.col(label))) * F.count(error)
    return df.groupBy(*by).agg(
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        F.when(total > 0, F.lit(1.0) - F.sum(error * error) / total).alias("r2"),
    )


def mean_label(df: DataFrame, label: str = LABEL_COLUMN) -> DataFrame:
    """The mean label as a one-row table; 0 if there is none."""
    return df.agg(F.coalesce(F.avg(label), F.lit(0.0)).alias("mean_label"))


def constant_baseline(train: DataFrame, test: DataFrame, label: str = LABEL_COLUMN) -> DataFrame:
    """Test rows with the training mean as ``prediction`` (a scalar subquery, so one job)."""
    return test.withColumn("prediction", mean_label(train, label).scalar())


def tag_family(scores: DataFrame, family: str) -> DataFrame:
    return scores.select("model_name", "rmse", "mae", "r2", F.lit(family).alias("model_family"))


def union_families(families: dict[str, DataFrame]) -> DataFrame:
    """Scores of several families of models, one below the other."""
    tagged = [tag_family(scores, family) for family, scores in families.items()]
    result = tagged[0]
    for other in tagged[1:]:
        result = result.unionByName(other)
    return result


def model_table(scores: DataFrame) -> DataFrame:
    """Models from the lowest RMSE up; equal ones by name."""
    return scores.orderBy(F.col("rmse").asc_nulls_last(), "model_name")


def best_model(scores: DataFrame, baseline: str = MEAN_BASELINE) -> DataFrame:
    """One row: the model with the lowest RMSE beside the baseline's scores.

    The baseline itself wins only when nothing else was scored.
    """
    is_baseline = F.col("model_name") == baseline
    # A score that is missing or not a number never wins over one that is a number.
    order = F.struct(
        is_baseline.alias("last_resort"),
        (F.col("rmse").isNull() | F.isnan("rmse")).alias("unscored"),
        F.col("rmse"),
        F.col("model_name"),
    )
    winner = F.min_by(F.struct("model_name", "rmse", "mae", "r2"), order)
    return scores.agg(
        winner.alias("best"),
        *[F.max(F.when(is_baseline, F.col(m))).alias(f"baseline_{m}") for m in ("rmse", "mae", "r2")],
        F.count("*").alias("n_models"),
    ).select(
        F.col("best.model_name").alias("best_model"), "best.rmse", "best.mae", "best.r2",
        "baseline_rmse", "baseline_mae", "baseline_r2", "n_models",
    )
