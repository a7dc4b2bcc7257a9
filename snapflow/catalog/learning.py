"""Training and scoring queries.  What SQL can know of a fitted model is returned for it to check: rows, baselines, names, and every
value of models that have a closed form."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.censoring import with_censoring_weights
from ..operators.quality import is_empty, require_rows
from ..operators.split import temporal_split
from ..operators.standardize import rename_aliases
from ..plans import learn
from ..plans.score import score_table
from ..plans.search import FOLD, Ledger, fold_of, search_forest
from ..plans.training_frame import clean_snapshots
from ..schemas import ALIASES, CATEGORICAL_FEATURES, LABEL_COLUMN, MEAN_BASELINE, NUMERIC_FEATURES, REQUIRED_COLUMNS, TARGET_COLUMN
from ..sources.models import load_model, save_model
from ..sources.tables import read_episode_table, write_parquet
from ..streaming.scoring import score_stream
from ..workspace import new_run_dir
from . import inputs
from .batches import WEIGHTED
from .inputs import CUTOFF, table
from .oracles import DAY, FEED, METRICS, TRAINING
from .queries import QUERIES, _landed, _round_scores, _training_frame, query, rounded

ORACLES: dict[str, str] = {}


def _episode_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned table as the training job finds it: on shared storage."""
    path = new_run_dir(spark, "episodes")
    write_parquet(_training_frame(spark, sf_dir), path)
    return read_episode_table(spark, path)


def _trained(spark: SparkSession, sf_dir: str, *tries: learn.Candidate, **options) -> learn.TrainingRun:
    return learn.train_models(_episode_table(spark, sf_dir), tries, CUTOFF, **options)


def _scores_of(spark: SparkSession, run: learn.TrainingRun) -> DataFrame:
    return _round_scores(spark.createDataFrame(
        run.scores, "model_name string, rmse double, mae double, r2 double, model_family string"
    ))


def _checked_scores(spark: SparkSession, run: learn.TrainingRun) -> DataFrame:
    """A row per model: its name, the rows it saw, the baseline's scores, and whether its own are near those.

    The events say nothing about the length of an episode, so no model can be much better than the mean, nor much worse.
    """
    base = next(s for s in run.scores if s["model_name"] == MEAN_BASELINE)
    rows = [
        (s["model_name"], run.train_rows, run.test_rows, base["rmse"], base["mae"], base["r2"], 0.8 < s["rmse"] / base["rmse"] < 1.25, len(run.failures))
        for s in run.scores
    ]
    ddl = "model_name string, train_rows bigint, test_rows bigint, baseline_rmse double, baseline_mae double, baseline_r2 double, near_baseline boolean, failures int"
    return _round_scores(spark.createDataFrame(rows, ddl))


TRAIN_SPLIT = f"""{TRAINING},
known AS (
  SELECT *, ln(1 + trending_days) AS y, ln(1 + greatest(coalesce(likes, 0), 0)) AS x,
    publish_day_of_week IN (1, 7) AS weekend FROM training),
train AS (SELECT * FROM known WHERE trending_date_parsed < {DAY}),
test AS (SELECT * FROM known WHERE trending_date_parsed >= {DAY}),
baseline AS (SELECT *, (SELECT coalesce(avg(trending_days), 0) FROM train) AS prediction FROM test),
base AS (SELECT {METRICS} FROM baseline),
sizes AS (SELECT (SELECT count(*) FROM train) AS train_rows, (SELECT count(*) FROM test) AS test_rows)"""


def _checked(*names: str) -> str:
    models = ", ".join(f"('{name}')" for name in (*names, MEAN_BASELINE))
    return f"""{TRAIN_SPLIT}
SELECT model_name, train_rows, test_rows, round(rmse, 6) AS baseline_rmse, round(mae, 6) AS baseline_mae, round(r2, 6) AS baseline_r2,
  true AS near_baseline, CAST(0 AS INT) AS failures FROM (VALUES {models}) AS m(model_name), base, sizes"""


# ---------------------------------------------------------------- the candidates


@query
def train_lr(spark, sf_dir):
    return _checked_scores(spark, _trained(spark, sf_dir, learn.linear_regression()))


@query
def train_gbt(spark, sf_dir):
    return _checked_scores(spark, _trained(spark, sf_dir, learn.gradient_boosting()))


@query
def train_rf(spark, sf_dir):
    return _checked_scores(spark, _trained(spark, sf_dir, learn.random_forest()))


@query
def train_rf_tuned(spark, sf_dir):
    """Every point of the whole grid, with its error relative to the spread of the target."""
    episodes = _episode_table(spark, sf_dir)
    run = learn.train_models(episodes, [learn.random_forest_tuned()], CUTOFF)
    train = temporal_split(episodes, CUTOFF)[0]
    error = F.col("rmse") / train.agg(F.stddev_pop(TARGET_COLUMN)).scalar()
    settings = {"num_trees": "numTrees", "max_depth": "maxDepth", "min_instances": "minInstancesPerNode", "max_bins": "maxBins"}
    return run.search_points().select(
        "model_name", *[F.col("settings")[name].alias(alias) for alias, name in settings.items()], "folds",
        error.between(0.8, 1.25).alias("near_spread"), F.lit(run.train_rows).cast("bigint").alias("train_rows"),
    )


ORACLES["train_lr"] = _checked("linear_regression")
ORACLES["train_gbt"] = _checked("gradient_boosting")
ORACLES["train_rf"] = _checked("random_forest")
ORACLES["train_rf_tuned"] = f"""{TRAIN_SPLIT}
SELECT 'random_forest_tuned' AS model_name, num_trees, max_depth, min_instances, max_bins, CAST(3 AS INT) AS folds, true AS near_spread, train_rows
FROM (SELECT unnest([80, 100, 120]) AS num_trees), (SELECT unnest([10, 12, 14]) AS max_depth),
  (SELECT unnest([1, 2]) AS min_instances), (SELECT unnest([32, 64]) AS max_bins), sizes"""


@query
def train_summary(spark, sf_dir):
    """A whole run with models saved, continued by a second run that finds the first model done."""
    base = new_run_dir(spark, "models")
    episodes = _episode_table(spark, sf_dir)
    learn.train_models(episodes, [learn.linear_regression()], CUTOFF, model_dir=base)
    run = learn.train_models(episodes, [learn.linear_regression(), learn.gradient_boosting()], CUTOFF, model_dir=base, resume=True)
    models = F.col("model_comparison")
    trained = F.filter(models, lambda m: m["model_name"] != MEAN_BASELINE)
    summary = run.summary().select(
        F.lit(",".join(run.resumed)).alias("resumed"), F.array_join(F.array_sort(models["model_name"]), ",").alias("models"),
        (F.col("rmse") == F.array_min(trained["rmse"])).alias("best_is_lowest"),
        (F.col("best_model") == F.col("best_overall_model")).alias("one_best"), "train_rows", "test_rows",
        "baseline_rmse", "baseline_mae", "baseline_r2", F.array_join("feature_columns", ",").alias("features"),
        F.array_join("categorical_columns", ",").alias("categories"), F.size("feature_importance").alias("importances"),
        F.size("training_failures").alias("failures"), (F.col("runtime_seconds") > 0).alias("timed"),
        (F.col("saved_model_dir") == F.concat(F.lit(f"{base}/"), "best_model")).alias("saved"),
    )
    return _round_scores(summary)


ORACLES["train_summary"] = f"""{TRAIN_SPLIT}
SELECT 'linear_regression' AS resumed, 'gradient_boosting,linear_regression,mean_baseline' AS models, true AS best_is_lowest,
  true AS one_best, train_rows, test_rows, round(rmse, 6) AS baseline_rmse, round(mae, 6) AS baseline_mae, round(r2, 6) AS baseline_r2,
  '{",".join(NUMERIC_FEATURES)}' AS features, '{",".join(CATEGORICAL_FEATURES)}' AS categories,
  CAST({len(NUMERIC_FEATURES) + len(CATEGORICAL_FEATURES)} AS INT) AS importances, CAST(0 AS INT) AS failures, true AS timed, true AS saved
FROM base, sizes"""


@query
def importance_top15(spark, sf_dir):
    """The fifteen most important of the input columns of a boosted model, in falling order."""
    run = _trained(spark, sf_dir, learn.gradient_boosting())
    top = run.importance.orderBy(F.col("importance").desc(), "feature").limit(15).collect()  # a row per column
    known = {*NUMERIC_FEATURES, *CATEGORICAL_FEATURES}
    rows = [
        (i + 1, r.feature in known, r.importance >= 0 and (i == 0 or r.importance <= top[i - 1].importance), len({t.feature for t in top}))
        for i, r in enumerate(top)
    ]
    return spark.createDataFrame(rows, "rank int, is_input boolean, falls boolean, distinct_inputs int")


ORACLES["importance_top15"] = """SELECT CAST(rank AS INT) AS rank, true AS is_input, true AS falls, CAST(15 AS INT) AS distinct_inputs
FROM range(1, 16) AS t(rank)"""


# ---------------------------------------------------------------- models with a closed form


def _line() -> learn.Candidate:
    """Ordinary least squares: with one input column, the regression line."""
    return learn.Candidate("line", LinearRegression(**learn._columns(), regParam=0.0, solver="normal"))


def _line_run(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, learn.TrainingRun]:
    episodes = _episode_table(spark, sf_dir)
    return episodes, learn.train_models(episodes, [_line()], CUTOFF, numeric=["log_likes"], categorical=[])


@query
def train_line(spark, sf_dir):
    """The scores of the regression line of the log target on one column, through the training job."""
    return _scores_of(spark, _line_run(spark, sf_dir)[1])


def _scored_rows(predicted: str, name: str) -> str:
    return f"""{TRAIN_SPLIT}, guesses AS (
  SELECT '{name}' AS model_name, trending_days, {predicted} AS prediction FROM test, fitted
  UNION ALL SELECT 'mean_baseline', trending_days, prediction FROM baseline)
SELECT model_name, round(rmse, 6) AS rmse, round(mae, 6) AS mae, round(r2, 6) AS r2, 'spark' AS model_family
FROM (SELECT model_name, {METRICS} FROM guesses GROUP BY model_name)"""


LINE = "fitted AS (SELECT regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept FROM train)"
ORACLES["train_line"] = _scored_rows("exp(intercept + slope * x) - 1", "line").replace(", guesses AS", f", {LINE}, guesses AS")


@query
def train_line_weighted(spark, sf_dir):
    """The same line, with episodes weighted by the chance to have been seen whole and open ones left out."""
    episodes = _episode_table(spark, sf_dir)
    weighted = with_censoring_weights(episodes)
    return _scores_of(spark, learn.train_models(weighted, [_line()], CUTOFF, numeric=["log_likes"], categorical=[], weight_col="weight"))


ORACLES["train_line_weighted"] = (
    _scored_rows("exp(intercept + slope * x) - 1", "line")
    .replace("train AS (SELECT * FROM known", "episodes AS (SELECT * FROM known)," + WEIGHTED + ",\ntrain AS (SELECT * FROM weighted")
    .replace(", guesses AS", """,
means AS (SELECT sum(weight * x) / sum(weight) AS mx, sum(weight * y) / sum(weight) AS my FROM train),
slopes AS (
  SELECT sum(weight * (x - mx) * (y - my)) / sum(weight * (x - mx) * (x - mx)) AS slope, any_value(mx) AS mx, any_value(my) AS my
  FROM train, means),
fitted AS (SELECT slope, my - slope * mx AS intercept FROM slopes), guesses AS""")
)


def _stump_run(spark: SparkSession, sf_dir: str) -> learn.TrainingRun:
    """One tree with one split on all training rows: with a yes-or-no column, the means of the two groups."""
    weekend = F.col("publish_day_of_week").isin(1.0, 7.0).cast("double")
    episodes = _episode_table(spark, sf_dir).withColumns({"weekend": weekend, "nothing": F.lit(0.0)})
    tree = RandomForestRegressor(**learn._columns(), seed=learn.SEED, numTrees=1, maxDepth=1, bootstrap=False, featureSubsetStrategy="all")
    return learn.train_models(episodes, [learn.Candidate("stump", tree)], CUTOFF, numeric=["nothing", "weekend"], categorical=[])


@query
def train_stump(spark, sf_dir):
    return _scores_of(spark, _stump_run(spark, sf_dir))


ORACLES["train_stump"] = _scored_rows("exp(CASE WHEN weekend THEN of_weekend ELSE of_week END) - 1", "stump").replace(
    ", guesses AS", ", fitted AS (SELECT avg(y) FILTER (weekend) AS of_weekend, avg(y) FILTER (NOT weekend) AS of_week FROM train), guesses AS"
)


@query
def importance_stump(spark, sf_dir):
    """All importance is that of the column that the tree splits on."""
    return _stump_run(spark, sf_dir).importance


ORACLES["importance_stump"] = "SELECT * FROM (VALUES ('weekend', 1.0::DOUBLE), ('nothing', 0.0::DOUBLE)) AS t(feature, importance)"


@query
def score_batch(spark, sf_dir):
    """The line saved, loaded, and asked for the length of every episode."""
    episodes, run = _line_run(spark, sf_dir)
    scored = score_table(load_model(save_model(run.best, new_run_dir(spark, "model"))), episodes)
    return rounded(scored, 6, "log_views", "log_likes", "log_comment_count")


ORACLES["score_batch"] = f"""{TRAIN_SPLIT}, {LINE}
SELECT video_id, country, trending_date_parsed, views_normalized, log_views, log_likes, log_comment_count,
  engagement_rate, like_ratio, comment_ratio, round(exp(intercept + slope * x) - 1, 2) AS predicted_trending_days FROM known, fitted"""


@query
def stream_score(spark, sf_dir):
    """The line over a stream of messages."""
    _, run = _line_run(spark, sf_dir)
    sent = inputs.messages(inputs.stream_of(spark, sf_dir, "events"))
    return _landed(spark, score_stream(sent, run.best).drop("prediction_time"), "stream-score")


ORACLES["stream_score"] = f"""{FEED}
SELECT video_id, coalesce(title, '') AS title, coalesce(description, '') AS description, country,
  views_normalized AS views, likes, comment_count,
  round(exp(intercept + slope * ln(1 + greatest(coalesce(likes, 0), 0))) - 1, 2) AS predicted_trending_days
FROM featured, ({TRAIN_SPLIT}, {LINE} SELECT * FROM fitted) AS line"""


# ---------------------------------------------------------------- how a run behaves


@query
def assembled_vector(spark, sf_dir):
    """The slots of the assembled features: numbers first, null as not a number, then a slot per category and one for the rest."""
    events = table(spark, sf_dir, "events").select(
        "event_id", "event_type", "value", F.when(F.col("event_id") % 5 > 0, F.col("user_id").cast("double")).alias("user")
    )
    prepared = learn.preprocessing(["value", "user"], ["event_type"]).fit(events.filter(F.col("event_type") != "error"))
    slots = vector_to_array("features")
    named = prepared.transform(events).withColumn("slots", slots)
    number = F.col("slots")[1]
    return named.select(
        "event_id", F.size("slots").alias("size"), F.col("slots")[0].alias("value"), F.when(~F.isnan(number), number).alias("user"),
        (F.array_position(F.slice("slots", 3, 100), 1.0) - 1).alias("category_slot"),
    )


ORACLES["assembled_vector"] = """WITH counts AS (SELECT event_type, count(*) AS n FROM events WHERE event_type <> 'error' GROUP BY event_type),
places AS (SELECT event_type, row_number() OVER (ORDER BY n DESC, event_type) - 1 AS place FROM counts)
SELECT event_id, CAST(3 + (SELECT count(*) FROM counts) AS INT) AS size, value,
  CASE WHEN event_id % 5 > 0 THEN CAST(user_id AS DOUBLE) END AS user,
  CAST(coalesce(place, (SELECT count(*) FROM counts)) AS BIGINT) AS category_slot
FROM events LEFT JOIN places USING (event_type)"""


@query
def training_modes(spark, sf_dir):
    """What each mode tries, with and without tuning, on how many training rows."""
    train = temporal_split(_episode_table(spark, sf_dir), CUTOFF)[0]
    rows = [(m, tune, ",".join(c.name for c in learn.candidates(m, tune=tune)), train.count()) for m in learn.MODES for tune in (True, False)]
    return spark.createDataFrame(rows, "mode string, tune boolean, tries string, train_rows bigint")


ORACLES["training_modes"] = f"""{TRAIN_SPLIT},
forests AS (SELECT * FROM (VALUES (true, 'random_forest_tuned'), (false, 'random_forest')) AS t(tune, forest))
SELECT mode, tune, CASE mode WHEN 'all' THEN 'linear_regression,gradient_boosting,' || forest WHEN 'fast' THEN forest
  WHEN 'ultra_fast' THEN 'linear_regression' ELSE mode END AS tries, train_rows
FROM (VALUES ('all'), ('fast'), ('ultra_fast'), ('linear_regression'), ('gradient_boosting'), ('random_forest'), ('random_forest_tuned')) AS m(mode),
  forests, sizes"""


@query
def training_failures(spark, sf_dir):
    """A candidate that cannot be fitted is recorded, and the one after it is trained."""
    broken = learn.Candidate("broken", LinearRegression(featuresCol="absent", labelCol=TARGET_COLUMN))
    run = _trained(spark, sf_dir, broken, _line(), numeric=["log_likes"], categorical=[])
    rows = [(f["model_name"], True, "absent" in f["error"], run.train_rows) for f in run.failures]
    rows += [(s["model_name"], False, False, run.train_rows) for s in run.scores]
    return spark.createDataFrame(rows, "model_name string, failed boolean, names_the_cause boolean, train_rows bigint")


ORACLES["training_failures"] = f"""{TRAIN_SPLIT}
SELECT model_name, failed, failed AS names_the_cause, train_rows
FROM (VALUES ('broken', true), ('line', false), ('mean_baseline', false)) AS t(model_name, failed), sizes"""


@query
def search_resume(spark, sf_dir):
    """A search that is stopped after four of its six fits, goes on from its ledger, and finds what an unbroken one finds."""
    train = temporal_split(_episode_table(spark, sf_dir), CUTOFF)[0].withColumn(FOLD, fold_of(["video_id", "country", "episode_id"], 3, learn.SEED))
    prepared = learn.preprocessing().fit(train).transform(train).select("features", LABEL_COLUMN, TARGET_COLUMN, FOLD)
    path = new_run_dir(spark, "prepared")
    write_parquet(prepared, path)
    prepared = spark.read.parquet(path)
    grid = {"numTrees": [2, 4], "maxDepth": [2, 3], "minInstancesPerNode": [1, 2]}

    def folds(k):
        return prepared.filter(F.col(FOLD) != k), prepared.filter(F.col(FOLD) == k)

    def search(ledger: str | None, **options):
        return search_forest(learn._forest(4, 3), grid, folds, 3, Ledger(spark, ledger, "resume"), parallelism=2, **options)

    ledger = new_run_dir(spark, "ledger")
    first, second, whole = search(ledger, stop_after=4), search(ledger), search(None)
    rows = [
        (*[p.settings[name] for name in grid], p.folds, len(first.points) < 8, second.fitted, whole.fitted, abs(p.rmse - q.rmse) < 1e-12, second.best() == p)
        for p, q in zip(second.points, whole.points)
    ]
    ddl = "num_trees int, max_depth int, min_instances int, folds int, first_incomplete boolean, fits_after int, fits_whole int, same boolean, chosen boolean"
    found = spark.createDataFrame(rows, ddl)
    return found.withColumn("winners", found.agg(F.count_if("chosen")).scalar()).drop("chosen")


ORACLES["search_resume"] = """SELECT num_trees, max_depth, min_instances, CAST(3 AS INT) AS folds, true AS first_incomplete, CAST(2 AS INT) AS fits_after,
  CAST(6 AS INT) AS fits_whole, true AS same, CAST(1 AS BIGINT) AS winners
FROM (SELECT unnest([2, 4]) AS num_trees), (SELECT unnest([2, 3]) AS max_depth), (SELECT unnest([1, 2]) AS min_instances)"""


@query
def required_columns(spark, sf_dir):
    """Snapshots that lack a required column are refused by its name."""
    raw, rows = inputs.snapshots(spark, sf_dir), []
    for name in REQUIRED_COLUMNS:
        try:
            rename_aliases(raw.drop(*ALIASES[name]))
        except ValueError as error:
            rows.append((name, str(error), raw.count()))
    return spark.createDataFrame(rows, "column string, message string, raw_rows bigint")


ORACLES["required_columns"] = """SELECT c AS "column", 'Missing required columns: [''' || c || ''']' AS message, (SELECT count(*) FROM events) AS raw_rows
FROM (VALUES ('video_id'), ('publish_date'), ('trending_date'), ('view_count'), ('likes'), ('comment_count')) AS t(c)"""


@query
def empty_guards(spark, sf_dir):
    """What the jobs do with tables without rows: nothing is cleaned, and nothing is trained."""
    raw = inputs.snapshots(spark, sf_dir)
    none = raw.filter("event_id < 0")
    target = new_run_dir(spark, "nothing")

    def refused(rows: DataFrame) -> bool:
        try:
            require_rows(rows, "no rows")
        except ValueError:
            return True
        return False

    rows = [("all", is_empty(raw), refused(raw), clean_snapshots(raw, f"{target}/all")), ("none", is_empty(none), refused(none), clean_snapshots(none, f"{target}/none"))]
    return spark.createDataFrame(rows, "input string, empty boolean, refused boolean, cleaned bigint")


ORACLES["empty_guards"] = f"""{TRAINING}
SELECT 'all' AS input, false AS empty, false AS refused, count(*) AS cleaned FROM training UNION ALL SELECT 'none', true, true, 0"""

__all__ = ["ORACLES", "QUERIES"]
