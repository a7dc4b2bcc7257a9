"""Queries over the test tables, one or more per operator."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.ml.feature import SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.features import add_shared_features, hotness_tier, join_tags
from ..functions.parse import normalize_country
from ..operators import episodes as ep
from ..operators import evaluate as ev
from ..operators import report as rp
from ..operators.quality import row_counts, sane_counts
from ..operators.regions import extraction_report, filter_regions
from ..operators.split import temporal_split, training_projection
from ..operators.standardize import deduplicate, identified, rename_aliases, standardize, type_columns
from ..plans import learn
from ..plans.score import score_table
from ..plans.training_frame import build_training_frame
from ..schemas import ALIASES, DATE_COLUMN, LABEL_COLUMN, NUMERIC_FEATURES, OPTIONAL_DEFAULTS, PREDICTION_SCHEMA
from ..sources.metrics import read_metrics, write_model_metrics
from ..sources.pages import cap_results, flatten_pages
from ..sources.tables import csv_to_parquet, read_snapshot_csv, write_csv
from ..streaming.dedup import drop_repeats
from ..streaming.live import read_live_table, write_live_table
from ..streaming.payload import CORRUPT, parse_messages, rejected_messages, valid_messages
from ..streaming.scoring import score_stream, stream_features as live_features
from ..workspace import new_run_dir
from . import inputs
from .inputs import CUTOFF, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register under the function's name; a trailing underscore only avoids a clash."""
    QUERIES[fn.__name__.rstrip("_")] = fn
    return fn


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, digits) for name in names})


# ---------------------------------------------------------------- episodes

EVENT_KEYS = ("user_id", "event_type")


def _event_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One event per user, type and day: the one of the highest value."""
    return deduplicate(
        inputs.days(spark, sf_dir), [*EVENT_KEYS, "day"], prefer=[F.col("value").desc_nulls_last(), F.col("event_id")]
    )


def _episodes(spark: SparkSession, sf_dir: str, max_gap_days: int = 1) -> DataFrame:
    return ep.collapse_episodes(_event_days(spark, sf_dir), max_gap_days, EVENT_KEYS, "day")


def _episode_columns(df: DataFrame) -> DataFrame:
    return df.select(
        *EVENT_KEYS, "episode_id", "episode_start_date", "episode_end_date", LABEL_COLUMN,
        F.round("log_trending_days", 6).alias("log_trending_days"), "reappear_count",
        F.col("value").alias("first_value"),
    )


@query
def episodes(spark, sf_dir):
    return _episode_columns(_episodes(spark, sf_dir))


@query
def episodes_gap3(spark, sf_dir):
    return _episode_columns(_episodes(spark, sf_dir, max_gap_days=3))


@query
def episode_rows(spark, sf_dir):
    labelled = ep.assign_episodes(_event_days(spark, sf_dir), 1, EVENT_KEYS, "day")
    return labelled.select(*EVENT_KEYS, "day", "prev_date", "date_gap", "episode_start_flag", "episode_id")


@query
def episode_targets(spark, sf_dir):
    return rounded(ep.episode_targets(_event_days(spark, sf_dir), 1, EVENT_KEYS, "day"), 6, "log_trending_days")


@query
def episode_join(spark, sf_dir):
    found = _event_days(spark, sf_dir)
    first = ep.first_snapshots(ep.assign_episodes(found, 1, EVENT_KEYS, "day"))
    joined = ep.attach_episode_targets(first, ep.episode_targets(found, 1, EVENT_KEYS, "day"), EVENT_KEYS)
    return _episode_columns(joined.withColumn("reappear_count", (F.col("episode_id") - 1).cast("double")))


# ---------------------------------------------------------------- cleaning

STANDARD_COLUMNS = (
    "event_id", "video_id", "country", "categoryId", DATE_COLUMN, "publish_timestamp",
    "view_count", "likes", "comment_count", "title", "description", "tags",
)


def _standardized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standardize(inputs.snapshots(spark, sf_dir), prefer=inputs.preference())


@query
def typed_snapshots(spark, sf_dir):
    return type_columns(rename_aliases(inputs.snapshots(spark, sf_dir))).select(*STANDARD_COLUMNS)


@query
def standardize_(spark, sf_dir):
    return _standardized(spark, sf_dir).select(*STANDARD_COLUMNS)


@query
def default_dedup(spark, sf_dir):
    """The choice that the jobs make; of rows with the same counts any may stay."""
    chosen = standardize(inputs.snapshots(spark, sf_dir))
    return chosen.select("video_id", "country", DATE_COLUMN, "view_count", "likes", "comment_count")


@query
def optional_defaults(spark, sf_dir):
    """Snapshots without any of the optional columns."""
    raw = inputs.snapshots(spark, sf_dir)
    absent = [s for name in OPTIONAL_DEFAULTS for s in ALIASES[name]]
    typed = type_columns(rename_aliases(raw.drop(*absent)))
    return typed.select("event_id", "video_id", *OPTIONAL_DEFAULTS, "view_count")


@query
def sane_snapshots(spark, sf_dir):
    return sane_counts(_standardized(spark, sf_dir)).select(*STANDARD_COLUMNS)


@query
def clean_counts(spark, sf_dir):
    typed = type_columns(rename_aliases(inputs.snapshots(spark, sf_dir)))
    placed = (
        F.col("video_id").isNotNull() & F.col("publish_timestamp").isNotNull() & F.col(DATE_COLUMN).isNotNull()
    )
    return row_counts(
        typed,
        raw_rows=F.lit(True),
        placed_rows=placed,
        no_id=F.col("video_id").isNull(),
        no_publish_time=F.col("publish_timestamp").isNull(),
        no_date=F.col(DATE_COLUMN).isNull(),
        liked_beyond_views=F.col("likes") > F.col("view_count"),
        negative_comments=F.col("comment_count") < 0,
    )


def _training_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_training_frame(inputs.snapshots(spark, sf_dir), prefer=inputs.preference())


LOG_COLUMNS = ("log_views", "log_likes", "log_comment_count", "log_hours_to_trending", "log_trending_days")


@query
def training_frame(spark, sf_dir):
    return rounded(_training_frame(spark, sf_dir), 6, *LOG_COLUMNS)


@query
def training_columns(spark, sf_dir):
    return rounded(training_projection(_training_frame(spark, sf_dir)), 6, *LOG_COLUMNS)


@query
def split_counts(spark, sf_dir):
    day = F.col("day")
    return row_counts(
        inputs.days(spark, sf_dir), all_rows=F.lit(True), train_rows=day < F.lit(CUTOFF), test_rows=day >= F.lit(CUTOFF)
    )


@query
def split_train(spark, sf_dir):
    return temporal_split(_episode_columns(_episodes(spark, sf_dir)), CUTOFF, "episode_start_date")[0]


@query
def split_test(spark, sf_dir):
    return temporal_split(_episode_columns(_episodes(spark, sf_dir)), CUTOFF, "episode_start_date")[1]


@query
def split_train_purged(spark, sf_dir):
    return temporal_split(_episode_columns(_episodes(spark, sf_dir)), CUTOFF, "episode_start_date", purge=True)[0]


# ---------------------------------------------------------------- features


def _featured(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = identified(type_columns(rename_aliases(inputs.snapshots(spark, sf_dir))))
    return add_shared_features(typed, snapshot_ts_col=DATE_COLUMN)


@query
def features_numeric(spark, sf_dir):
    logs = ("log_views", "log_likes", "log_comment_count")
    return rounded(_featured(spark, sf_dir).select("event_id", "views_normalized", *logs), 6, *logs)


@query
def features_time(spark, sf_dir):
    picked = _featured(spark, sf_dir).select(
        "event_id", "hours_to_trending", "log_hours_to_trending", "publish_hour", "publish_day_of_week", "publish_dow"
    )
    return rounded(picked, 6, "log_hours_to_trending")


@query
def features_ratio(spark, sf_dir):
    return _featured(spark, sf_dir).select(
        "event_id", "like_ratio", "comment_ratio", "engagement_rate",
        "views_per_hour", "likes_per_hour", "comments_per_hour",
    )


@query
def features_text(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    k = F.col("doc_id") % 5
    tags = (
        F.when(k == 1, F.array().cast("array<string>"))
        .when(k == 2, F.array("lang"))
        .when(k == 3, F.array("lang", "source"))
        .when(k == 4, F.array(F.col("lang"), F.lit(""), F.col("source")))
    )
    texts = docs.select(
        "doc_id", F.concat_ws(" ", "source", "lang").alias("title"), F.col("text").alias("description"),
        join_tags(tags).alias("tags"),
    )
    return add_shared_features(texts, snapshot_ts_col="seen").select(
        "doc_id", "tags", "title_length", "description_length", "tag_count"
    )


# ---------------------------------------------------------------- evaluation and models


def _model_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    found = _episodes(spark, sf_dir).select(*EVENT_KEYS, "episode_start_date", LABEL_COLUMN)
    return temporal_split(found, CUTOFF, "episode_start_date")


def _model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three simple predictors of the episode length: mean per type, overall mean, always one day."""
    train, test = _model_inputs(spark, sf_dir)
    per_type = train.groupBy("event_type").agg(F.avg(LABEL_COLUMN).alias("type_mean"))
    guesses = ev.constant_baseline(train, test).withColumnRenamed("prediction", ev.MEAN_BASELINE)
    # a type that training has not seen gets the overall mean
    guesses = guesses.join(per_type, "event_type", "left").select(
        LABEL_COLUMN, ev.MEAN_BASELINE, F.coalesce("type_mean", ev.MEAN_BASELINE).alias("type_mean"), F.lit(1.0).alias("one_day")
    )
    long = guesses.unpivot([LABEL_COLUMN], [ev.MEAN_BASELINE, "type_mean", "one_day"], "model_name", "prediction")
    return ev.regression_metrics(long, by=["model_name"])


def _round_scores(df: DataFrame) -> DataFrame:
    return rounded(df, 6, *[c for c in df.columns if c.split("_")[-1] in ("rmse", "mae", "r2")])


@query
def mean_baseline(spark, sf_dir):
    train, test = _model_inputs(spark, sf_dir)
    scored = ev.constant_baseline(train, test)
    return _round_scores(ev.regression_metrics(scored).withColumn("model_name", F.lit(ev.MEAN_BASELINE)))


@query
def metrics_by_type(spark, sf_dir):
    train, test = _model_inputs(spark, sf_dir)
    return _round_scores(ev.regression_metrics(ev.constant_baseline(train, test), by=["event_type"]))


@query
def model_table(spark, sf_dir):
    return _round_scores(ev.model_table(_model_scores(spark, sf_dir)))


@query
def model_best(spark, sf_dir):
    return _round_scores(ev.best_model(_model_scores(spark, sf_dir)))


@query
def model_union(spark, sf_dir):
    scores = _model_scores(spark, sf_dir)
    simple = F.col("model_name").isin("one_day", ev.MEAN_BASELINE)
    return _round_scores(ev.union_families({"spark": scores.filter(~simple), "optional": scores.filter(simple)}))


@query
def metrics_roundtrip(spark, sf_dir):
    base = new_run_dir(spark, "metrics")
    for row in _model_scores(spark, sf_dir).collect():  # one row per model
        write_model_metrics(spark, row.asDict(), base)
    return _round_scores(ev.model_table(read_metrics(spark, base)))


@query
def category_index(spark, sf_dir):
    events = table(spark, sf_dir, "events").select((F.col("user_id") % 15).cast("string").alias("category"))
    prepared = learn.preprocessing(["n"], ["category"]).fit(events)
    counts = events.groupBy("category").agg(F.count("*").alias("n"))
    return prepared.transform(counts).select("category", "n", "category_idx")


@query
def one_hot_slots(spark, sf_dir):
    """Categories of the events; ``error`` is kept out of the fit, so it lands in the extra slot."""
    events = table(spark, sf_dir, "events").select("event_type")
    prepared = learn.preprocessing(["n"], ["event_type"]).fit(events.filter(F.col("event_type") != "error"))
    counts = events.groupBy("event_type").agg(F.count("*").alias("n"))
    slots = vector_to_array("event_type_vec")
    return prepared.transform(counts).select(
        "event_type", "n", F.col("event_type_idx").alias("idx"), F.size(slots).alias("slots"),
        (F.array_position(slots, 1.0) - 1).alias("slot"),
    )


# ---------------------------------------------------------------- scoring by a rule


def _rule() -> SQLTransformer:
    """A stand-in for a fitted model whose predictions SQL can repeat."""
    return SQLTransformer(statement="SELECT *, log_views / 10 + like_ratio AS raw_prediction FROM __THIS__")


@query
def score_rule(spark, sf_dir):
    return rounded(score_table(_rule(), _training_frame(spark, sf_dir)), 6, "log_views", "log_likes", "log_comment_count")


# ---------------------------------------------------------------- regions and API pages


@query
def region_filter(spark, sf_dir):
    return filter_regions(inputs.located_customers(spark, sf_dir))


@query
def region_semi_join(spark, sf_dir):
    """The set of countries given as a table: those with a customer of more than 9900."""
    people = inputs.located_customers(spark, sf_dir)
    rich = people.filter(F.col("c_acctbal") > 9900).select(normalize_country(F.col("Trending_Country")))
    return filter_regions(people, rich, "Trending_Country")


@query
def extract_report(spark, sf_dir):
    report = extraction_report(inputs.located_customers(spark, sf_dir))
    return report.withColumn("kept_countries", F.array_join("kept_countries", ","))


API_COLUMNS = (
    "video_id", "title", "description", "publish_time", "tags", "views", "view_count", "likes", "comment_count",
    "country", "categoryId",
)


@query
def api_flatten(spark, sf_dir):
    return flatten_pages(inputs.api_pages(spark, sf_dir), fetch_keys=["region_code"], page_order=["conv_id", "turn"]).select(*API_COLUMNS)


@query
def api_category(spark, sf_dir):
    pages = inputs.api_pages(spark, sf_dir)
    rows = flatten_pages(pages, fetch_keys=["region_code"], page_order=["conv_id", "turn"], region="VN", category_id="3")
    return rows.select(*API_COLUMNS)


@query
def api_capped(spark, sf_dir):
    """Every listed item, and whether a limit of 500 results keeps it."""
    rows = flatten_pages(inputs.api_pages(spark, sf_dir), fetch_keys=["region_code"], page_order=["conv_id", "turn"])
    order = ["conv_id", "turn", "place"]
    last = cap_results(rows, 500, order).agg(F.max(F.struct(*order))).scalar()
    return rows.select(*API_COLUMNS, (F.struct(*order) <= last).alias("within_limit"))


# ---------------------------------------------------------------- JSON


@query
def events_props_json(spark, sf_dir):
    props = F.from_json("props", "k int")
    return table(spark, sf_dir, "events").select("event_id", props["k"].alias("k"))


@query
def to_json_roundtrip(spark, sf_dir):
    columns = "event_id bigint, user_id bigint, event_type string, value double, props string"
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "props")
    text = events.select(F.to_json(F.struct("*")).alias("value"))
    return text.select(F.from_json("value", columns).alias("data")).select("data.*")


@query
def message_checks(spark, sf_dir):
    parsed = parse_messages(inputs.messages(table(spark, sf_dir, "events")))
    named = F.length(F.trim(F.coalesce("video_id", F.lit("")))) > 0
    return row_counts(
        parsed, messages=F.lit(True), valid=named, broken=F.col(CORRUPT).isNotNull(),
        blank_id=~named & F.col(CORRUPT).isNull(),
    )


@query
def messages_rejected(spark, sf_dir):
    parsed = parse_messages(inputs.messages(table(spark, sf_dir, "events")), keep=["event_id"])
    return rejected_messages(parsed, keep=["event_id"]).withColumnRenamed(CORRUPT, "message")


# ---------------------------------------------------------------- reports

LINE_METRICS = ("l_extendedprice", "l_quantity", "l_discount", "l_tax")


@query
def metric_summary(spark, sf_dir):
    summary = rp.metric_summary(table(spark, sf_dir, "lineitem"), LINE_METRICS)
    return rounded(summary, 3, "mean", "max", "min", "stddev")


@query
def kpi_row(spark, sf_dir):
    row = rp.kpi_row(table(spark, sf_dir, "lineitem"), LINE_METRICS)
    return rounded(row, 3, *[f"avg_{m}" for m in LINE_METRICS])


@query
def histogram20(spark, sf_dir):
    return rounded(rp.histogram(table(spark, sf_dir, "lineitem"), LINE_METRICS), 4, "bin_start", "bin_end")


@query
def engagement_norm(spark, sf_dir):
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    lines = table(spark, sf_dir, "lineitem").select(*keys, *LINE_METRICS[:3])
    return rp.engagement_percent(lines, LINE_METRICS[:3])


def _predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = inputs.prediction_messages(table(spark, sf_dir, "events"))
    return valid_messages(parse_messages(sent, PREDICTION_SCHEMA, keep=["event_id", "ts"]))


@query
def prediction_fields(spark, sf_dir):
    return rp.prediction_fields(_predictions(spark, sf_dir)).select(
        "event_id", "video_id", "views", "predicted_trending_days"
    )


@query
def metric_points(spark, sf_dir):
    points = rp.metric_points(_predictions(spark, sf_dir), "ts")
    return points.groupBy("video_id").agg(
        F.count("*").alias("points"), F.max("timestamp").alias("last_seen"),
        F.sum("views").alias("views"), F.sum("likes").alias("likes"), F.sum("comments").alias("comments"),
        F.max("predicted_trending_days").alias("most_days"),
    )


@query
def latest_n(spark, sf_dir):
    feed = rp.latest_feed(_predictions(spark, sf_dir), 10, "ts", ["event_id"])
    return feed.select("event_id", "video_id", "tier", "days")


@query
def keep_last_n(spark, sf_dir):
    newest = rp.latest(table(spark, sf_dir, "events"), 500, "ts", ["event_id"])
    return newest.select("event_id", "ts", "user_id", "event_type", "value")


@query
def timeline(spark, sf_dir):
    return rp.timeline(table(spark, sf_dir, "events").select("event_id", "ts", "value"), "ts", ["event_id"])


@query
def hotness(spark, sf_dir):
    settled = rp.prediction_fields(_predictions(spark, sf_dir))
    days = F.col("predicted_trending_days")
    return settled.select(
        "event_id", hotness_tier(days).alias("console_tier"), hotness_tier(days, hot=7.0).alias("dashboard_tier")
    )


# ---------------------------------------------------------------- files


@query
def csv_roundtrip(spark, sf_dir):
    path = new_run_dir(spark, "csv")
    write_csv(table(spark, sf_dir, "documents"), path)
    back = read_snapshot_csv(spark, path)
    return back.select(F.col("doc_id").cast("bigint"), "text", "lang", "source", F.col("n_chars").cast("bigint"))


@query
def region_csv(spark, sf_dir):
    path = new_run_dir(spark, "region-csv")
    write_csv(filter_regions(inputs.located_customers(spark, sf_dir)), path)
    return read_snapshot_csv(spark, path, multi_line=False)


@query
def parquet_roundtrip(spark, sf_dir):
    path = new_run_dir(spark, "convert")
    write_csv(table(spark, sf_dir, "documents"), f"{path}/in")
    csv_to_parquet(spark, f"{path}/in", f"{path}/out")
    back = spark.read.parquet(f"{path}/out")
    return back.select(
        "doc_id", "lang", "source", F.length("text").cast("bigint").alias("characters"), F.md5("text").alias("digest")
    )


# ---------------------------------------------------------------- streaming


def _landed(spark: SparkSession, rows: DataFrame, name: str) -> DataFrame:
    """Run a stream over what has arrived so far into a fresh table and read the table."""
    path = new_run_dir(spark, name)
    (
        rows.writeStream.format("parquet")
        .option("path", f"{path}/out")
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.schema(rows.schema).parquet(f"{path}/out")


STREAM_FEATURES = ("event_id", "video_id", "country", "categoryId", "hours_to_trending", *NUMERIC_FEATURES)


@query
def stream_features(spark, sf_dir):
    sent = inputs.messages(inputs.stream_of(spark, sf_dir, "events"))
    # The message's own time is the snapshot time, so the result can be checked.
    rows = live_features(sent, event_time_col="ts", keep=["event_id"])
    logs = [name for name in LOG_COLUMNS if name in NUMERIC_FEATURES]
    return rounded(_landed(spark, rows.select(*STREAM_FEATURES), "stream-features"), 6, *logs)


@query
def stream_batch_time(spark, sf_dir):
    """Without a time of the message's own, all rows of a micro-batch carry the batch's time."""
    began = datetime.now(timezone.utc)
    sent = inputs.messages(inputs.stream_of(spark, sf_dir, "events"))
    rows = _landed(spark, live_features(sent).select("video_id", "snapshot_time"), "stream-batch-time")
    seen = F.col("snapshot_time")
    # the file stream takes one table, so there is one batch
    return rows.agg(
        F.count("*").alias("valid_rows"), F.count_distinct(seen).alias("batch_times"),
        F.coalesce(F.min(seen) >= F.lit(began), F.lit(True)).alias("after_start"),
    )


def _sized_session(spark: SparkSession) -> SparkSession:
    """A stateful stream keeps the number of partitions it starts with; size it to the cluster."""
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    return session


@query
def stream_dedup(spark, sf_dir):
    session = _sized_session(spark)
    events = inputs.stream_of(session, sf_dir, "events").select(*EVENT_KEYS)
    return _landed(session, drop_repeats(events, EVENT_KEYS), "stream-dedup")


@query
def stream_dedup_bounded(spark, sf_dir):
    """As above, but an id is forgotten 40 days after it was seen."""
    session = _sized_session(spark)
    events = inputs.stream_of(session, sf_dir, "events").select(*EVENT_KEYS, F.col("ts").cast("timestamp").alias("ts"))
    rows = drop_repeats(events, EVENT_KEYS, event_time_col="ts", delay="40 days")
    return _landed(session, rows.select(*EVENT_KEYS), "stream-dedup-bounded")


@query
def stream_score_rule(spark, sf_dir):
    sent = inputs.messages(inputs.stream_of(spark, sf_dir, "events"))
    return _landed(spark, score_stream(sent, _rule()).drop("prediction_time"), "stream-score-rule")


@query
def stream_report(spark, sf_dir):
    """Predictions arrive, are appended to a table, and the table is summed up."""
    path = new_run_dir(spark, "live")
    sent = inputs.prediction_messages(inputs.stream_of(spark, sf_dir, "events"))
    parsed = valid_messages(parse_messages(sent, PREDICTION_SCHEMA, keep=["ts"]))
    points = rp.metric_points(parsed, "ts")
    write_live_table(points, f"{path}/out", f"{path}/checkpoint", available_now=True).awaitTermination()
    return rounded(rp.metric_summary(read_live_table(spark, f"{path}/out", points.schema)), 3, "mean", "max", "min", "stddev")
