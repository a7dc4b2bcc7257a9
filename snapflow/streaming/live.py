"""A table of live predictions for the reports to read, and aggregates of it that are kept up to date."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import Future

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.partials import PARTIALS, histogram_of, merged, partials, summary_of
from ..sources.commits import CommitLog
from ..workspace import remove

KEPT_STATES = 2


def write_live_table(
    df: DataFrame, path: str, checkpoint: str, available_now: bool = False, aggregates: Sequence[str] = ()
) -> StreamingQuery:
    """Append every micro-batch to ``path`` under the stream's ``run_id`` and its own ``batch_id``.

    A batch that is replayed after a failure overwrites what it wrote before, so no row is
    counted twice.  A stream keeps its id for the life of its checkpoint; one that starts from a
    new checkpoint numbers its batches from 0 again, but under another id.  For the columns named in
    ``aggregates``, :func:`live_aggregates` and :func:`live_histogram` are kept up to date with every batch.
    """
    path = path.rstrip("/")
    started: Future[str] = Future()

    def append(batch: DataFrame, batch_id: int) -> None:
        run = started.result()  # the first batch may be ready before start() has returned
        folder = f"{path}/run_id={run}/batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(folder)
        if aggregates:
            rows = batch.sparkSession.read.schema(batch.schema).parquet(folder)
            _add_to_aggregates(rows, path, run, batch_id, aggregates)

    writer = df.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    query = writer.start()
    started.set_result(query.id)
    return query


def _states(spark: SparkSession, path: str) -> DataFrame | None:
    """Aggregates of every run after its last few batches; None if there are none."""
    try:
        return spark.read.schema(f"{PARTIALS}, run_id string, batch_id bigint").parquet(f"{path.rstrip('/')}_aggregates")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _add_to_aggregates(rows: DataFrame, path: str, run: str, batch_id: int, metrics: Sequence[str]) -> None:
    """The state after this batch: that after the batch before it, merged with the batch's own partials.

    It is a function of the two, so a batch that is run again writes the same state again.
    """
    spark, parts = rows.sparkSession, partials(rows, metrics)
    states = _states(spark, path)
    if states is not None:
        before = states.filter((F.col("run_id") == run) & (F.col("batch_id") == batch_id - 1)).drop("run_id", "batch_id")
        parts = parts.unionByName(before)
    folder = f"{path}_aggregates/run_id={run}"
    merged(parts).coalesce(1).write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")
    remove(spark, f"{folder}/batch_id={batch_id - KEPT_STATES}")


def _current_partials(spark: SparkSession, path: str) -> DataFrame:
    states = _states(spark, path)
    if states is None:
        return spark.createDataFrame([], PARTIALS)
    newest = states.groupBy("run_id").agg(F.max("batch_id").alias("batch_id"))
    return states.join(F.broadcast(newest), ["run_id", "batch_id"]).drop("run_id", "batch_id")  # a row per stream


def live_aggregates(spark: SparkSession, path: str) -> DataFrame:
    """Mean, max, min, standard deviation and number of values per metric of all rows so far.

    Reads a small file per stream, however many batches there were.
    """
    return summary_of(_current_partials(spark, path))


def live_histogram(spark: SparkSession, path: str) -> DataFrame:
    """Bins of all rows so far, from the same files."""
    return histogram_of(_current_partials(spark, path))


def _compactions(spark: SparkSession, path: str) -> CommitLog:
    return CommitLog(spark, f"{path.rstrip('/')}_compacted", "run_id string, last_batch bigint")


def _batches(spark: SparkSession, path: str, schema: T.StructType | None) -> DataFrame | None:
    """The batch folders; None if there are none."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        rows = reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    return rows.withColumns({"run_id": F.col("run_id").cast("string"), "batch_id": F.col("batch_id").cast("bigint")}) if "run_id" in rows.columns else None


def _beyond(done: dict[str, int]):
    """Batches that are not in the compacted part.  A condition on partition columns: other folders are not opened."""
    inside = F.lit(False)
    for run, last in done.items():  # an entry per stream
        inside = inside | ((F.col("run_id") == run) & (F.col("batch_id") <= last))
    return ~inside


def read_live_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """All batches so far, compacted or not; with ``schema`` no file is opened to learn the columns."""
    path = path.rstrip("/")
    number, rows = _compactions(spark, path).latest()
    loose = _batches(spark, path, schema)
    if not rows:
        if loose is None:
            raise ValueError(f"No batch has been written to {path} yet")
        return loose
    compacted = spark.read.parquet(f"{path}_compacted/data").filter(F.col("version") <= number).drop("version")
    if loose is None:
        return compacted
    return compacted.unionByName(loose.filter(_beyond({r.run_id: r.last_batch for r in rows})))


def compact_live_table(spark: SparkSession, path: str) -> int:
    """Rewrite the batches so far, but for the newest of each stream, as few large files; returns how many batches.

    The newest batch may still be replayed, so it stays.  Readers see the batches or the rewritten rows, never both and
    never neither: the change is one commit.  Folders are deleted when the next compaction is done, when no reader
    that started before this one needs them any more.  Run one compaction at a time; streams may go on meanwhile.
    """
    path = path.rstrip("/")
    log = _compactions(spark, path)
    number, rows = log.latest()
    done = {r.run_id: r.last_batch for r in rows}
    loose = _batches(spark, path, None)
    if loose is None:
        return 0
    seen = loose.select("run_id", "batch_id").distinct().collect()  # a row per batch since the last compaction but one
    newest: dict[str, int] = {}
    for r in seen:
        newest[r.run_id] = max(newest.get(r.run_id, -1), r.batch_id)
    chosen = [r for r in seen if done.get(r.run_id, -1) < r.batch_id < newest[r.run_id]]
    if not chosen:
        return 0
    upto = done | {run: max(r.batch_id for r in chosen if r.run_id == run) for run in {r.run_id for r in chosen}}
    fresh = loose.filter(_beyond(done) & ~_beyond(upto)).hint("rebalance")
    fresh.write.mode("overwrite").parquet(f"{path}_compacted/data/version={number + 1}")
    log.commit(number + 1, list(upto.items()))
    for r in seen:
        if r.batch_id <= done.get(r.run_id, -1):
            remove(spark, f"{path}/run_id={r.run_id}/batch_id={r.batch_id}")
    return len(chosen)
