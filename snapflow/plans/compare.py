"""Comparison of models that were trained in separate runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.evaluate import best_model, tag_family
from ..sources.metrics import read_metrics
from ..sources.models import load_model, model_path, save_model


def aggregate_metrics(spark: SparkSession, model_dir: str) -> DataFrame:
    """One row: the best saved model, the baseline's scores and the table of all models."""
    scores = tag_family(read_metrics(spark, model_dir), "spark")
    if scores.isEmpty():
        raise RuntimeError(f"No metrics of models found in {model_dir}")
    # One entry per trained model, so the list is as short as the list of models.
    rows = scores.agg(F.array_sort(F.collect_list(F.struct("*"))).alias("model_comparison"))
    best = best_model(scores).drop("n_models")
    return best.withColumns(
        {
            "best_overall_model": F.col("best_model"),
            "model_comparison": rows.scalar(),
            "aggregated_models": rows.select("model_comparison.model_name").scalar(),
            "best_model_dir": F.concat(F.lit(f"{model_dir.rstrip('/')}/"), "best_model"),
        }
    )


def promote_best(spark: SparkSession, model_dir: str, target: str) -> str:
    """Save the best model under a fixed path for the jobs that serve it; return its name."""
    name = best_model(read_metrics(spark, model_dir)).first()["best_model"]
    save_model(load_model(model_path(model_dir, name)), target)
    return name
