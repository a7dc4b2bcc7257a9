"""Landed pages of a listing API as a stream: every item of a fetch is taken in once."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import Future

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..sources.pages import flatten_pages


def intake_pages(
    pages: DataFrame, path: str, checkpoint: str, *, fetch_keys: Sequence[str], available_now: bool = False, **options
) -> StreamingQuery:
    """Append the items of every micro-batch of pages that no earlier batch has listed in the same fetch.

    Within a batch :func:`snapflow.sources.pages.flatten_pages`, which takes the ``options``, keeps an item's first listing;
    of several batches the first that lists it wins, so pages of a fetch have to land in their order.  What has been taken in is
    read from the table itself, for the batch's own fetches only.  A replayed batch looks at the batches before it and
    overwrites its own folder, so every item is in the table exactly once.  One stream writes to a path.
    """
    path = path.rstrip("/")
    started: Future[str] = Future()
    keys = [*fetch_keys, "video_id"]

    def append(batch: DataFrame, batch_id: int) -> None:
        spark, run = batch.sparkSession, started.result()
        rows = flatten_pages(batch, fetch_keys=fetch_keys, **options)
        try:
            columns = T.StructType([rows.schema[k] for k in keys]).add("batch_id", "long")
            known = spark.read.schema(columns).parquet(f"{path}/run_id={run}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
        else:
            known = known.filter(known["batch_id"] < batch_id).select(*keys)
            known = known.join(batch.select(*fetch_keys).distinct(), list(fetch_keys), "left_semi")
            rows = rows.join(known, keys, "left_anti")
        rows.write.mode("overwrite").parquet(f"{path}/run_id={run}/batch_id={batch_id}")

    writer = pages.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    query = writer.start()
    started.set_result(query.id)
    return query
