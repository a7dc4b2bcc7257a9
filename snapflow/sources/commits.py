"""Numbered commits of a folder: what a table consists of, visible whole or not at all."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Row, SparkSession

from ..workspace import remove


class CommitLog:
    """A few rows per commit, in one small file that appears by a rename.

    Readers take the highest number; work that a lost driver left without its commit is never seen.  One writer at a
    time: the log orders commits, it does not settle races between drivers.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, kept: int = 2):
        self.spark, self.path, self.kept = spark, f"{path.rstrip('/')}/commits", kept
        self.schema = f"commit bigint, {schema}"

    def latest(self) -> tuple[int, list[Row]]:
        """Number and rows of the last commit; 0 and none before the first."""
        try:
            rows = self.spark.read.schema(self.schema).json(f"{self.path}/*").collect()  # of at most `kept` + 1 commits
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = []
        number = max((r.commit for r in rows), default=0)
        return number, [r for r in rows if r.commit == number]

    def commit(self, number: int, rows: list[tuple]) -> None:
        if not rows:
            raise ValueError("A commit needs at least one row")
        table = self.spark.createDataFrame([(number, *row) for row in rows], self.schema)
        table.coalesce(1).write.mode("overwrite").json(f"{self.path}/{number:012d}")
        if number > self.kept:
            remove(self.spark, f"{self.path}/{number - self.kept:012d}")
