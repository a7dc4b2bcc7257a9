"""Fitted pipelines on disk."""

from __future__ import annotations

from pyspark.ml import PipelineModel


def artifact_name(model_name: str) -> str:
    return model_name.replace(" ", "_").replace("/", "_")


def model_path(base_dir: str, model_name: str) -> str:
    return f"{base_dir.rstrip('/')}/{artifact_name(model_name)}"


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
