"""Live scoring: message -> features -> prediction -> message."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import Future

from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.features import add_shared_features, back_transform
from ..functions.parse import parse_publish_time
from ..sources.registry import ModelRegistry
from .payload import parse_messages, valid_messages

SNAPSHOT = "snapshot_time"

# --- fixed values: what a published prediction says of an unknown text ---
OUTPUT_DEFAULTS = {"title": "Unknown Title", "description": "", "country": "Unknown"}


def stream_features(
    messages: DataFrame,
    value_col: str = "value",
    event_time_col: str | None = None,
    country_names: Mapping[str, str] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Valid messages with the features the model was trained on.

    The snapshot time is the micro-batch's, or the message's own if ``event_time_col`` is given.
    ``country_names`` maps the feed's country codes to the names used in training; ``keep`` names
    columns of the feed to carry along.
    """
    carried = list(dict.fromkeys([*keep, *([] if event_time_col is None else [event_time_col])]))
    rows = valid_messages(parse_messages(messages, value_col=value_col, keep=carried))
    snapshot = F.current_timestamp() if event_time_col is None else F.col(event_time_col).cast("timestamp")
    added = {
        SNAPSHOT: snapshot,
        "publish_timestamp": parse_publish_time(F.col("publish_time")),
    }
    if country_names:
        names = F.create_map(*[F.lit(text) for pair in country_names.items() for text in pair])
        added["country"] = F.coalesce(names[F.col("country")], F.col("country"))
    return add_shared_features(rows.withColumns(added), snapshot_ts_col=SNAPSHOT)


def prediction_output(scored: DataFrame) -> DataFrame:
    """What is published of a scored row."""
    return scored.select(
        "video_id",
        *[F.coalesce(name, F.lit(text)).alias(name) for name, text in OUTPUT_DEFAULTS.items()],
        F.col("views_normalized").alias("views"),
        "likes",
        "comment_count",
        back_transform(F.col("raw_prediction"), digits=2).alias("predicted_trending_days"),
        F.current_timestamp().alias("prediction_time"),
    )


def score_stream(
    messages: DataFrame,
    model: Model,
    value_col: str = "value",
    event_time_col: str | None = None,
    country_names: Mapping[str, str] | None = None,
) -> DataFrame:
    """Predictions for a stream (or batch) of messages: projections only, nothing is shuffled."""
    return prediction_output(model.transform(stream_features(messages, value_col, event_time_col, country_names)))


def score_with_current(
    messages: DataFrame, registry: ModelRegistry, path: str, checkpoint: str, available_now: bool = False, **options
) -> StreamingQuery:
    """Append predictions to ``path``, each micro-batch scored by the model that is in use when it starts.

    A running stream takes a newly published model with its next batch.  The rows say which version scored them.  A batch that
    is replayed is scored by the model in use then and overwrites what it wrote before.  ``options`` go to
    :func:`score_stream`.
    """
    path = path.rstrip("/")
    started: Future[str] = Future()

    def append(batch: DataFrame, batch_id: int) -> None:
        version, model = registry.current()
        scored = score_stream(batch, model, **options).withColumn("model_version", F.lit(version).cast("bigint"))
        scored.write.mode("overwrite").parquet(f"{path}/run_id={started.result()}/batch_id={batch_id}")

    writer = messages.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    query = writer.start()
    started.set_result(query.id)
    return query
