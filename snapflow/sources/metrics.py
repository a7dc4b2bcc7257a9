"""Scores of trained models as JSON, one place per model."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from ..schemas import METRICS_SCHEMA, SAVED_METRICS_SCHEMA
from .models import artifact_name

SUFFIX = "_metrics.json"


def write_metrics(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_model_metrics(spark: SparkSession, scores: dict, base_dir: str) -> str:
    path = f"{base_dir.rstrip('/')}/{artifact_name(scores['model_name'])}{SUFFIX}"
    row = [tuple(scores[name] for name in METRICS_SCHEMA.names) + (scores.get("measured_on"),)]
    write_metrics(spark.createDataFrame(row, SAVED_METRICS_SCHEMA), path)
    return path


def read_metrics(spark: SparkSession, base_dir: str, with_origin: bool = False) -> DataFrame:
    """Scores of all models that have any, with what they were measured on if asked for; no rows if none has."""
    schema = SAVED_METRICS_SCHEMA if with_origin else METRICS_SCHEMA
    try:
        return spark.read.schema(schema).json(f"{base_dir.rstrip('/')}/*{SUFFIX}", multiLine=True)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
