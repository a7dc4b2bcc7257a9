"""The model in use, by version: a new one takes over between two micro-batches."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from .commits import CommitLog
from .models import load_model, save_model


class ModelRegistry:
    """Versions of a fitted pipeline below one folder, and which of them is in use.

    A version is saved first and then named by a commit, so a reader never meets half a model.  Earlier versions stay, for
    streams that are scoring with them and for going back.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.log = CommitLog(spark, path, "version bigint")
        self._loaded: tuple[int, PipelineModel] | None = None

    def _model_path(self, version: int) -> str:
        return f"{self.path}/versions/{version:06d}"

    def current_version(self) -> int:
        """0 before the first model."""
        _, rows = self.log.latest()
        return rows[0].version if rows else 0

    def publish(self, model: PipelineModel) -> int:
        """Save a model as the next version and put it into use."""
        number, _ = self.log.latest()
        version = number + 1
        save_model(model, self._model_path(version))
        self.log.commit(version, [(version,)])
        return version

    def use(self, version: int) -> None:
        """Go back to an earlier version."""
        number, _ = self.log.latest()
        self.log.commit(number + 1, [(version,)])

    def current(self) -> tuple[int, PipelineModel]:
        """Version and model in use; the model is loaded when the version changes."""
        version = self.current_version()
        if not version:
            raise ValueError(f"No model has been published to {self.path} yet")
        if self._loaded is None or self._loaded[0] != version:
            self._loaded = version, load_model(self._model_path(version))
        return self._loaded
