"""Queries on what arrives in batches: stores, live tables and streams over several files.  And the SQL they must agree with."""

from __future__ import annotations

from datetime import date

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from ..operators import report as rp
from ..operators.censoring import with_censoring_weights
from ..operators.frequency import frequency_index
from ..operators.standardize import standardize_files
from ..plans.episode_store import EpisodeStore
from ..schemas import PREDICTION_SCHEMA
from ..sources.registry import ModelRegistry
from ..sources.tables import write_parquet
from ..streaming.checkpoint import POLICIES, resolve_checkpoint_dir
from ..streaming.counters import BatchCounters, read_counters, with_counters
from ..streaming.dedup import drop_repeats
from ..streaming.live import compact_live_table, live_aggregates, live_histogram, read_live_table, write_live_table
from ..streaming.pages import intake_pages
from ..streaming.payload import parse_messages, valid_messages
from ..streaming.scoring import score_with_current
from ..workspace import new_run_dir
from . import inputs
from .inputs import arriving, file_by_file, table
from .oracles import API, API_COLUMNS, EPISODES, FEED, PREDICTIONS, SNAP, STANDARD, event_episodes
from .queries import (
    API_COLUMNS as ITEM_COLUMNS, EVENT_KEYS, QUERIES, STANDARD_COLUMNS, _episode_columns, _episodes, _event_days, _sized_session, query, rounded,
)

ORACLES: dict[str, str] = {}


def _between(rows, first: int, last: int, column: str = "ts"):
    """Rows of these days of January 2024."""
    day = F.to_date(column)
    return rows.filter(day.between(F.lit(date(2024, 1, first)), F.lit(date(2024, 1, last))))


# ---------------------------------------------------------------- episodes kept up to date

BATCH_DAYS = ((1, 4), (5, 11), (12, 12), (13, 22), (23, 31))


@query
def episodes_incremental(spark, sf_dir):
    """Episodes of events that are added a few days at a time."""
    store = EpisodeStore(spark, new_run_dir(spark, "store"), keys=EVENT_KEYS, date_col="day", buckets=8)
    found = _event_days(spark, sf_dir)
    for first, last in BATCH_DAYS:
        store.append(_between(found, first, last, "day"))
    return _episode_columns(store.episodes())


ORACLES["episodes_incremental"] = EPISODES


@query
def late_dedup(spark, sf_dir):
    """Snapshots in files, their texts fetched after the duplicates are gone."""
    path = new_run_dir(spark, "raw")
    write_parquet(inputs.snapshots(spark, sf_dir), path)
    return standardize_files(spark.read.parquet(path), prefer=inputs.preference()).select(*STANDARD_COLUMNS)


ORACLES["late_dedup"] = f"WITH {SNAP} SELECT {STANDARD} FROM standard"


@query
def episode_weights(spark, sf_dir):
    """Weights of episodes by the chance to have been seen to their end."""
    weighted = with_censoring_weights(_episodes(spark, sf_dir))
    return rounded(weighted.select(*EVENT_KEYS, "episode_id", "trending_days", "censored", "weight"), 9, "weight")


WEIGHTED = """
marked AS (
  SELECT *, (SELECT max(episode_end_date) FROM episodes) - episode_end_date < 1 AS censored FROM episodes),
lengths AS (
  SELECT trending_days AS length, count(*) AS n, count(*) FILTER (censored) AS cut FROM marked GROUP BY trending_days),
risks AS (
  SELECT length, cut, sum(n) OVER (ORDER BY length ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) - (n - cut) AS at_risk
  FROM lengths),
chances AS (
  SELECT length, coalesce(product(CASE WHEN at_risk > 0 THEN 1 - cut / at_risk ELSE 1 END)
    OVER (ORDER BY length ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1) AS chance FROM risks),
weighted AS (
  SELECT marked.*, CASE WHEN censored THEN 0.0 ELSE 1 / chance END AS weight FROM marked JOIN chances ON trending_days = length)"""
ORACLES["episode_weights"] = f"""WITH {event_episodes()},{WEIGHTED}
SELECT user_id, event_type, episode_id, trending_days, censored, round(weight, 9) AS weight FROM weighted"""


@query
def category_index_wide(spark, sf_dir):
    """Orders by the number of their lines: as many categories as orders."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("category"))
    return frequency_index(lines, "category", partitions=8)


ORACLES["category_index_wide"] = """
SELECT category, n, row_number() OVER (ORDER BY n DESC, category) - 1 AS index
FROM (SELECT CAST(l_orderkey AS VARCHAR) AS category, count(*) AS n FROM lineitem GROUP BY 1)"""


# ---------------------------------------------------------------- live table


def _live(spark, sf_dir, compact: bool = False) -> str:
    """A live table that predictions of four stretches of days have been written to, one batch each."""
    path = new_run_dir(spark, "live")
    sent = inputs.prediction_messages(table(spark, sf_dir, "events"))
    for first, last in ((1, 3), (4, 10), (11, 20), (21, 31)):
        arriving(spark, [_between(sent, first, last)], f"{path}/in")
        parsed = valid_messages(parse_messages(file_by_file(spark, f"{path}/in"), PREDICTION_SCHEMA, keep=["ts"]))
        points = rp.metric_points(parsed, "ts")
        write_live_table(points, f"{path}/out", f"{path}/checkpoint", available_now=True, aggregates=rp.METRICS).awaitTermination()
        if compact:
            compact_live_table(spark, f"{path}/out")
    return f"{path}/out"


@query
def live_summary(spark, sf_dir):
    """Kept up to date batch by batch, read from one small file."""
    return rounded(live_aggregates(spark, _live(spark, sf_dir)), 3, "mean", "max", "min", "stddev")


@query
def live_bins(spark, sf_dir):
    return live_histogram(spark, _live(spark, sf_dir)).drop("bin")


@query
def live_compacted(spark, sf_dir):
    """The rows of a live table that was compacted after every batch."""
    rows = read_live_table(spark, _live(spark, sf_dir, compact=True))
    return rows.select("video_id", "timestamp", "views", "likes", "comments", "predicted_trending_days")


POINT_METRICS = ("views", "likes", "comments", "predicted_trending_days")
_LONG = " UNION ALL ".join(f"SELECT '{m}' AS metric, CAST({m} AS DOUBLE) AS v FROM points" for m in POINT_METRICS)
ORACLES["live_summary"] = f"""{PREDICTIONS}, long AS ({_LONG})
SELECT metric, round(avg(v), 3) AS mean, round(max(v), 3) AS max, round(min(v), 3) AS min, round(stddev_samp(v), 3) AS stddev,
  count(*) AS n FROM long GROUP BY metric"""
ORACLES["live_bins"] = f"""{PREDICTIONS}, long AS ({_LONG}),
ends AS (SELECT metric, min(v) AS lo, max(v) AS hi FROM long GROUP BY metric),
levels AS (
  SELECT metric, min(k) AS level FROM ends, range(-20, 60) AS t(k)
  WHERE floor(hi / pow(2.0, k)) - floor(lo / pow(2.0, k)) < 64 GROUP BY metric),
placed AS (SELECT metric, pow(2.0, level) AS width, floor(v / pow(2.0, level)) AS bin FROM long JOIN levels USING (metric))
SELECT metric, bin * width AS bin_start, (bin + 1) * width AS bin_end, count(*) AS n FROM placed GROUP BY metric, bin, width"""
ORACLES["live_compacted"] = f"""{PREDICTIONS}
SELECT video_id, ts AS timestamp, views, likes, comments, predicted_trending_days FROM points"""


# ---------------------------------------------------------------- streams over several files

DEDUP_DAYS = (2, 16, 19, 22)
FORGET_AFTER = "6 days"


def _forgetting(spark, sf_dir):
    """Four days of events, a batch each, sent once per id while it is remembered; and the state after each batch.

    Ids of the first day are forgotten at the end of the third batch: the newest event of the batch before it, less the delay, is
    then past them.  Those of the second and third day are still known on the fourth.
    """
    session = _sized_session(spark)
    path = new_run_dir(spark, "stream-forgets")
    events = table(spark, sf_dir, "events").select(*EVENT_KEYS, F.col("ts").cast("timestamp").alias("ts"))
    arriving(spark, [_between(events, day, day) for day in DEDUP_DAYS], f"{path}/in")
    rows = drop_repeats(file_by_file(session, f"{path}/in"), EVENT_KEYS, event_time_col="ts", delay=FORGET_AFTER)
    sink = rows.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/checkpoint")
    run = sink.trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{path}/out"), run.recentProgress


@query
def stream_dedup_forgets(spark, sf_dir):
    """An id that returns after the delay is sent again, one that returns before it is not."""
    rows, _ = _forgetting(spark, sf_dir)
    return rows.select(F.dayofmonth("ts").alias("day"), *EVENT_KEYS)


@query
def stream_dedup_state(spark, sf_dir):
    """How many ids the state holds after each batch."""
    _, progress = _forgetting(spark, sf_dir)
    rows = [(p.batchId, p.stateOperators[0].numRowsTotal) for p in progress if p.numInputRows]  # one row per batch
    return spark.createDataFrame(rows, "batch bigint, remembered bigint")


_SENT = """WITH days AS (
  SELECT DISTINCT CAST(day(ts) AS INT) AS day, user_id, event_type FROM events WHERE day(ts) IN (2, 16, 19, 22)),
a AS (FROM days WHERE day = 2),
b AS (FROM days d WHERE day = 16 AND NOT EXISTS (FROM a WHERE a.user_id = d.user_id AND a.event_type = d.event_type)),
c AS (FROM days d WHERE day = 19
  AND NOT EXISTS (FROM (FROM a UNION ALL FROM b) k WHERE k.user_id = d.user_id AND k.event_type = d.event_type)),
d AS (FROM days d WHERE day = 22
  AND NOT EXISTS (FROM (FROM b UNION ALL FROM c) k WHERE k.user_id = d.user_id AND k.event_type = d.event_type))"""
ORACLES["stream_dedup_forgets"] = f"{_SENT} FROM a UNION ALL FROM b UNION ALL FROM c UNION ALL FROM d"
ORACLES["stream_dedup_state"] = f"""{_SENT},
n AS (SELECT (SELECT count(*) FROM a) AS a, (SELECT count(*) FROM b) AS b, (SELECT count(*) FROM c) AS c, (SELECT count(*) FROM d) AS d)
SELECT CAST(0 AS BIGINT) AS batch, a AS remembered FROM n UNION ALL SELECT 1, a + b FROM n
UNION ALL SELECT 2, b + c FROM n UNION ALL SELECT 3, b + c + d FROM n"""


@query
def stream_pages(spark, sf_dir):
    """Pages that land in three files; later ones list some of the same items again."""
    path = new_run_dir(spark, "stream-pages")
    pages = inputs.api_pages(spark, sf_dir)
    ends = [F.col("conv_id") % 1000 < 0, F.col("conv_id") < 7, F.col("conv_id") < 30]
    arriving(spark, [pages.filter(b & ~a) for a, b in zip(ends, [*ends[1:], F.lit(True)])], f"{path}/in")
    run = intake_pages(
        file_by_file(spark, f"{path}/in"), f"{path}/out", f"{path}/checkpoint", fetch_keys=["region_code"],
        page_order=["conv_id", "turn"], available_now=True,
    )
    run.awaitTermination()
    return spark.read.parquet(f"{path}/out").select(*ITEM_COLUMNS)


ORACLES["stream_pages"] = f"{API} SELECT {API_COLUMNS} FROM items"


@query
def stream_counters(spark, sf_dir):
    """Counts of messages by kind, kept per batch while the stream runs."""
    path = new_run_dir(spark, "stream-counters")
    sent = inputs.messages(table(spark, sf_dir, "events"))
    arriving(spark, [_between(sent, a, b) for a, b in ((1, 5), (6, 20), (21, 31))], f"{path}/in")
    counters = BatchCounters(spark, f"{path}/counters")
    spark.streams.addListener(counters)
    try:
        rows = valid_messages(with_counters(parse_messages(file_by_file(spark, f"{path}/in"))))
        sink = rows.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/checkpoint")
        sink.trigger(availableNow=True).start().awaitTermination()
        counters.settled()
    finally:
        spark.streams.removeListener(counters)
    kept = read_counters(spark, f"{path}/counters").filter("messages > 0")
    return kept.agg(F.count("*").alias("batches"), *[F.sum(c).alias(c) for c in ("messages", "valid", "broken", "blank_id")])


ORACLES["stream_counters"] = """SELECT CAST(3 AS BIGINT) AS batches, count(*) AS messages,
  count(*) FILTER (event_id % 97 <> 5 AND event_id % 503 <> 0) AS valid,
  count(*) FILTER (event_id % 97 = 5) AS broken,
  count(*) FILTER (event_id % 97 <> 5 AND event_id % 503 = 0) AS blank_id FROM events"""


def _scorer(expression: str) -> PipelineModel:
    return PipelineModel([SQLTransformer(statement=f"SELECT *, {expression} AS raw_prediction FROM __THIS__")])


@query
def stream_model_switch(spark, sf_dir):
    """A second model is published between two batches of the same stream."""
    path = new_run_dir(spark, "stream-switch")
    sent = inputs.messages(table(spark, sf_dir, "events"))
    registry = ModelRegistry(spark, f"{path}/models")
    for part, scorer in ((_between(sent, 1, 15), "log_views / 10 + like_ratio"), (_between(sent, 16, 31), "log_likes / 5")):
        registry.publish(_scorer(scorer))
        arriving(spark, [part], f"{path}/in")
        stream = file_by_file(spark, f"{path}/in")
        score_with_current(stream, registry, f"{path}/out", f"{path}/checkpoint", available_now=True, event_time_col="ts").awaitTermination()
    scored = spark.read.parquet(f"{path}/out")
    return scored.select("video_id", "country", "views", "model_version", "predicted_trending_days")


ORACLES["stream_model_switch"] = f"""{FEED}
SELECT video_id, country, views_normalized AS views, CAST(CASE WHEN day(ts) < 16 THEN 1 ELSE 2 END AS BIGINT) AS model_version,
  round(exp(CASE WHEN day(ts) < 16 THEN ln(1 + views_normalized) / 10 + like_ratio
    ELSE ln(1 + greatest(coalesce(likes, 0), 0)) / 5 END) - 1, 2) AS predicted_trending_days FROM featured"""


@query
def checkpoint_policies(spark, sf_dir):
    """Rows that a second run of a stream over the same table adds, by policy: none if it goes on, all if it starts anew."""
    rows = []
    for policy in POLICIES:
        path = new_run_dir(spark, f"policy-{policy}")
        counts = []
        for _ in range(2):
            events = inputs.stream_of(spark, sf_dir, "events").select("event_id")
            checkpoint = resolve_checkpoint_dir(spark, f"{path}/checkpoint", policy)
            sink = events.writeStream.format("parquet").option("path", f"{path}/out{len(counts)}").option("checkpointLocation", checkpoint)
            run = sink.trigger(availableNow=True).start()
            run.awaitTermination()
            counts.append(sum(p.numInputRows for p in run.recentProgress))
        rows.append((policy, *counts))
    return spark.createDataFrame(rows, "policy string, first_run bigint, second_run bigint")  # a row per policy


ORACLES["checkpoint_policies"] = """SELECT policy, (SELECT count(*) FROM events) AS first_run,
  CASE WHEN policy = 'keep' THEN 0 ELSE (SELECT count(*) FROM events) END AS second_run
FROM (VALUES ('keep'), ('unique'), ('reset')) AS p(policy)"""

__all__ = ["ORACLES", "QUERIES"]
