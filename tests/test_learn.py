import datetime as dt
import json
import random

import numpy as np
import pytest
from pyspark.ml import Estimator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F
from snapflow.plans import grow, learn, search
from snapflow.plans.compare import aggregate_metrics, promote_best
from snapflow.plans.score import score_table
from snapflow.schemas import EPISODE_TABLE, MEAN_BASELINE, NUMERIC_FEATURES, SCORED_COLUMNS
from snapflow.sources.metrics import read_metrics, write_metrics, write_model_metrics
from snapflow.sources.models import artifact_name, load_model, model_path
from snapflow.streaming import score_stream

CUTOFF = dt.date(2026, 1, 1)


@pytest.fixture(scope="module")
def episodes(spark, tmp_path_factory):
    """Episodes whose length follows the likes and the country."""
    rng = random.Random(5)
    rows = []
    for i in range(600):
        likes, country = rng.uniform(0, 8), rng.choice(["VIETNAM", "VIETNAM", "JAPAN", "INDIA"])
        log_days = 0.4 + 0.25 * likes + (0.5 if country == "JAPAN" else 0.0) + rng.gauss(0, 0.05)
        day = CUTOFF + dt.timedelta(days=rng.randint(-60, 20))
        rows.append((f"v{i}", country, str(i % 4), day, log_days, likes))
    base = spark.createDataFrame(
        rows, "video_id string, country string, categoryId string, trending_date_parsed date, log_trending_days double, log_likes double"
    )
    numbers = {name: F.rand(seed=i) for i, name in enumerate(NUMERIC_FEATURES) if name != "log_likes"}
    texts = {name: F.lit("") for name in ("title", "description", "tags")}
    table = base.withColumns(
        {**numbers, **texts, "trending_days": F.expm1("log_trending_days"), "view_count": F.lit(1.0), "likes": F.lit(1.0),
         "comment_count": F.lit(1.0), "episode_id": F.lit(1).cast("long"), "reappear_count": F.lit(0.0),
         "episode_start_date": F.col("trending_date_parsed"), "episode_end_date": F.date_add("trending_date_parsed", 2),
         "publish_dow": F.lit(1.0), "hours_to_trending": F.lit(1.0), "publish_timestamp": F.current_timestamp()}
    ).select(*EPISODE_TABLE)
    path = str(tmp_path_factory.mktemp("episodes"))
    table.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


class Broken(Estimator):
    def _fit(self, dataset):
        raise RuntimeError("out of luck")


def test_modes(spark):
    names = lambda *a, **k: [c.name for c in learn.candidates(*a, **k)]
    assert names() == ["linear_regression", "gradient_boosting", "random_forest_tuned"]
    assert names(tune=False)[-1] == "random_forest"
    assert names("fast") == names("random_forest_tuned") == ["random_forest_tuned"]
    assert names("fast", tune=False) == names("random_forest") == ["random_forest"]
    assert names("ultra_fast") == names("linear_regression") == ["linear_regression"]
    assert names("gbt") == names("gradient_boosting") == ["gradient_boosting"]
    with pytest.raises(ValueError, match="Unknown training mode"):
        learn.candidates("best")


def test_forest_grid(spark):
    assert learn.forest_grid(100, 12) == {
        "numTrees": [80, 100, 120], "maxDepth": [10, 12, 14], "minInstancesPerNode": [1, 2], "maxBins": [32, 64],
    }
    assert learn.forest_grid(20, 4)["numTrees"] == [20, 40]
    assert len(learn.random_forest_tuned().grid) == 36


def test_tuned_query_searches_the_whole_grid(spark, sf_dir, monkeypatch):
    from snapflow.catalog import learning

    tried = []

    def train(episodes, tries, *args, **options):
        tried.extend(tries)
        raise InterruptedError

    monkeypatch.setattr(learning.learn, "train_models", train)
    with pytest.raises(InterruptedError):
        learning.train_rf_tuned(spark, sf_dir)
    assert [learn._settings(c) for c in tried] == [learn._settings(learn.random_forest_tuned())]


def test_rows_remember_their_nodes(spark):
    """Forests of the candidates gather few nodes a pass, so a pass must not walk from the roots; their trees are those of a
    forest that does."""
    for candidate in (learn.random_forest(), learn.random_forest_tuned()):
        assert candidate.estimator.getCacheNodeIds() and candidate.estimator.getMaxMemoryInMB() <= 32
        assert candidate.estimator.getSeed() == learn.SEED
    df = spark.range(1500).select(F.rand(1).alias("a"), F.rand(2).alias("b"), F.rand(3).alias("c"))
    rows = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df.withColumnRenamed("c", learn.TARGET_COLUMN)).cache()
    forest = learn._forest(6, 5)
    plain = RandomForestRegressor(**learn._columns(), seed=learn.SEED, numTrees=6, maxDepth=5)
    assert forest.fit(rows).toDebugString.split("\n")[1:] == plain.fit(rows).toDebugString.split("\n")[1:]


def test_smaller_forests_are_parts_of_a_larger_one(spark):
    """Errors of first trees, and of trees cut at a depth, equal those of the trees themselves."""
    df = spark.range(1500).select(F.rand(1).alias("a"), F.rand(2).alias("b"), (F.rand(3) * 3).cast("int").alias("c"))
    rows = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df.withColumn("y", F.col("a") * F.col("c") + F.rand(5) / 10)).cache()

    def forest(depth):
        return RandomForestRegressor(labelCol="y", predictionCol="raw_prediction", numTrees=6, maxDepth=depth, seed=1).fit(rows)

    def rmse(prediction, scored):
        return scored.select(F.sqrt(F.avg(F.pow(prediction - F.col("y"), 2)))).first()[0]

    deep = forest(7)
    errors = search.nested_errors(deep, rows, [2, 6], [3, 7], "y")
    first_two = rows
    for i in range(2):
        first_two = deep.trees[i].setPredictionCol(f"p{i}").transform(first_two)
    assert errors[2, 7] == pytest.approx(rmse((F.col("p0") + F.col("p1")) / 2, first_two), abs=1e-12)
    assert errors[6, 7] == pytest.approx(rmse(F.col("raw_prediction"), deep.transform(rows)), abs=1e-12)
    assert errors[6, 3] == pytest.approx(rmse(F.col("raw_prediction"), forest(3).transform(rows)), abs=1e-12)


@pytest.fixture(scope="module")
def folded(spark):
    df = spark.range(2400).select("id", F.rand(1).alias("a"), F.rand(2).alias("b"), (F.rand(3) * 3).cast("int").alias("c"), F.rand(9).alias("w"))
    df = df.withColumn("y", F.col("a") * F.col("c") + F.rand(5) / 3).withColumn(search.FOLD, (F.col("id") % 2).cast("int"))
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df).cache()


def searched(rows, grid, **settings):
    forest = RandomForestRegressor(labelCol="y", predictionCol="raw_prediction", seed=1, **settings)
    folds = lambda k: (rows.filter(F.col(search.FOLD) != k), rows.filter(F.col(search.FOLD) == k))
    return search.search_forest(forest, grid, folds, 2, search.Ledger(rows.sparkSession, None, "grown"), 2).points


@pytest.mark.parametrize("weighted", [{}, {"weightCol": "w"}])
def test_grown_trees_are_those_of_spark(folded, monkeypatch, weighted):
    """Without draws, a search by trees grown in tasks finds the errors of Spark's own fits."""
    grid = {"numTrees": [1], "maxDepth": [3, 7], "minInstancesPerNode": [5], "maxBins": [16, 32]}
    settings = {"bootstrap": False, "featureSubsetStrategy": "all", **weighted}
    grown = searched(folded, grid, **settings)
    monkeypatch.setattr(grow, "MOST_BYTES", 0)
    fitted = searched(folded, grid, **settings)
    assert [p.settings for p in grown] == [p.settings for p in fitted] and len(grown) == 4
    assert [p.rmse for p in grown] == pytest.approx([p.rmse for p in fitted], abs=1e-9)


def test_grown_forests_are_as_good_as_those_of_spark(folded, monkeypatch):
    grid = {"numTrees": [10, 30], "maxDepth": [4, 8], "minInstancesPerNode": [1, 3]}
    grown = searched(folded, grid)
    monkeypatch.setattr(grow, "MOST_BYTES", 0)
    fitted = searched(folded, grid)
    assert len(grown) == len(fitted) == 8
    assert [p.rmse for p in grown] == pytest.approx([p.rmse for p in fitted], rel=0.1)


def test_a_search_of_rows_that_fit_a_task_needs_no_fit_over_the_cluster(folded, monkeypatch):
    """Every point is found, the same however the rows are laid out and the trees are dealt; only rows beyond a task are left to Spark."""
    monkeypatch.setattr(RandomForestRegressor, "_fit", Broken()._fit)
    grid = {"numTrees": [3, 5], "maxDepth": [2, 6], "minInstancesPerNode": [1, 2]}
    first = searched(folded.coalesce(1), grid)
    monkeypatch.setattr(grow, "ROWS_AND_TREES", 1)  # a task per tree
    second = searched(folded.repartition(5, "id"), grid)
    assert [p.settings for p in first] == [p.settings for p in second] and len(first) == 8
    assert [p.rmse for p in first] == pytest.approx([p.rmse for p in second], abs=1e-12)
    monkeypatch.setattr(grow, "MOST_BYTES", 2400 * (3 + grow.ROW_BYTES) - 1)
    with pytest.raises(RuntimeError, match="out of luck"):
        searched(folded, grid)


def test_forests_that_are_not_grown_here(spark, folded):
    def errors(rows, **settings):
        return grow.grown_errors(RandomForestRegressor(labelCol="y", seed=-3, numTrees=2, **settings), rows, rows, [2], [3])

    assert errors(folded, featureSubsetStrategy="sqrt") is None and errors(folded, maxBins=300) is None
    assert errors(folded, minWeightFractionPerNode=0.1) is None
    assert errors(folded.withColumn("features", F.col("features"))) is not None
    assert errors(folded, subsamplingRate=0.5)[2, 3] > 0
    bad = VectorAssembler(inputCols=["a", "b"], outputCol="features", handleInvalid="keep").transform(
        folded.drop("features").withColumn("b", F.when(F.col("id") != 7, F.col("b")))
    )
    with pytest.raises(Exception, match="must be numbers"):
        errors(bad)
    with pytest.raises(ValueError, match="training rows"):
        errors(folded.where("id < 0"))


def test_a_tree_whose_nodes_are_all_pure():
    x, y = np.array([[0, 0, 1, 1]], np.uint8), np.array([1.0, 1.0, 2.0, 2.0])
    tree = grow.tree_grower(grow.Growth(1, 1, 2, 1, 0.0, None, 1))
    found = tree(x, y, np.ones(4), np.ones(4, np.int64), x, [0, 1, 3], np.random.default_rng(1))
    assert [f.tolist() for f in found] == [[1.5] * 4, y.tolist(), y.tolist()]


def test_bins_are_those_of_spark():
    few = grow.thresholds(np.array([1.0, 2.0, 2.0, 5.0]), np.ones(4), 4)
    assert few.tolist() == [1.5, 3.5]
    many = grow.thresholds(np.arange(12.0), np.ones(12), 4)
    assert many.tolist() == [2.5, 5.5, 8.5]
    assert grow.thresholds(np.array([3.0, 3.0]), np.ones(2), 4).tolist() == []


def test_a_search_goes_on_from_its_ledger(spark, episodes, tmp_path):
    """In a run that is repeated because its model was never saved, only what is not in the ledger is fitted."""
    tuned = learn.random_forest_tuned(4, 3, {"numTrees": [2, 4], "maxDepth": [2, 3], "maxBins": [16, 32]})
    first = learn.train_models(episodes, [tuned], CUTOFF, model_dir=str(tmp_path))
    again = learn.train_models(episodes, [tuned], CUTOFF, model_dir=str(tmp_path))
    other = learn.train_models(episodes, [tuned], CUTOFF, purge=True, model_dir=str(tmp_path))
    assert [r.searches["random_forest_tuned"].fitted for r in (first, again, other)] == [6, 0, 6]
    points = [r.searches["random_forest_tuned"].points for r in (first, again)]
    assert points[0] == points[1] and len(points[0]) == 8
    assert first.search_points().where("chosen").count() == 1
    best = first.searches["random_forest_tuned"].best().settings
    assert first.best.stages[-1].getNumTrees == best["numTrees"] and first.best.stages[-1].getMaxDepth() == best["maxDepth"]


@pytest.fixture(scope="module")
def run(episodes, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("models"))
    tries = [learn.linear_regression(), learn.Candidate("broken", Broken()), learn.gradient_boosting(maxIter=3, maxDepth=3)]
    return base, learn.train_models(episodes, tries, CUTOFF, model_dir=base)


def test_models_beat_the_baseline(run):
    scores = {s["model_name"]: s for s in run[1].scores}
    assert set(scores) == {"linear_regression", "gradient_boosting", MEAN_BASELINE}
    assert all(s["rmse"] < scores[MEAN_BASELINE]["rmse"] for n, s in scores.items() if n != MEAN_BASELINE)
    assert run[1].best_row["rmse"] == min(s["rmse"] for n, s in scores.items() if n != MEAN_BASELINE)


def test_failures_are_recorded(run):
    assert run[1].failures == [{"model_name": "broken", "error": "out of luck"}]


def test_nothing_trained(episodes):
    with pytest.raises(RuntimeError, match="could be fitted"):
        learn.train_models(episodes, [learn.Candidate("broken", Broken())], CUTOFF)


def test_no_test_rows(episodes):
    with pytest.raises(ValueError, match="cutoff"):
        learn.train_models(episodes, [learn.linear_regression()], dt.date(2030, 1, 1))


def test_every_category_keeps_a_slot(episodes):
    many = episodes.withColumn("categoryId", F.xxhash64("video_id", "episode_id").cast("string"))
    run = learn.train_models(many, [learn.linear_regression()], CUTOFF)
    labels = many.filter(F.col("trending_date_parsed") < F.lit(CUTOFF)).select("categoryId").distinct().count()
    assert run.failures == [] and len(run.best.stages[0].labelsArray[1]) == labels > 100


def test_importance_names_columns(run):
    rows = run[1].importance.collect()
    assert {r["feature"] for r in rows} == {*NUMERIC_FEATURES, "country", "categoryId"}
    assert rows[0]["feature"] in ("log_likes", "country")
    assert [r["importance"] for r in rows] == sorted((r["importance"] for r in rows), reverse=True)


def test_summary(spark, run, tmp_path):
    path = str(tmp_path / "summary")
    write_metrics(run[1].summary(), path)
    row = spark.read.json(path).first()
    assert row["best_model"] == row["best_overall_model"] == run[1].best_name
    assert row["train_rows"] + row["test_rows"] == 600
    assert len(row["model_comparison"]) == 3 and len(row["training_failures"]) == 1


def test_resume_skips_what_is_done(run, episodes):
    base, first = run
    again = learn.train_models(episodes, [learn.linear_regression(), learn.gradient_boosting(maxIter=3, maxDepth=3)], CUTOFF, model_dir=base, resume=True)
    assert again.resumed == ["linear_regression", "gradient_boosting"]
    assert again.best_name == first.best_name
    assert set(again.scores[0]) == {"model_name", "rmse", "mae", "r2", "model_family"}
    assert {s["model_name"]: s["rmse"] for s in again.scores} == pytest.approx({s["model_name"]: s["rmse"] for s in first.scores})


def test_resume_trains_anew_what_was_measured_on_other_rows(spark, episodes, tmp_path):
    base, tries = str(tmp_path), [learn.linear_regression()]
    learn.train_models(episodes, tries, CUTOFF, model_dir=base)
    assert learn.train_models(episodes, tries, CUTOFF, purge=True, model_dir=base, resume=True).resumed == []
    assert learn.train_models(episodes, tries, CUTOFF, purge=True, model_dir=base, resume=True).resumed == ["linear_regression"]
    assert learn.train_models(episodes, tries, CUTOFF, model_dir=base, resume=True).resumed == []


def test_purge_drops_training_rows_that_run_into_the_test(run, episodes):
    purged = learn.train_models(episodes, [learn.linear_regression()], CUTOFF, purge=True)
    assert purged.train_rows < run[1].train_rows and purged.test_rows == run[1].test_rows


@pytest.mark.parametrize("fold_local", [False, True])
def test_tuning(episodes, fold_local):
    tuned = learn.random_forest_tuned(5, 4, {"numTrees": [3, 5]})
    result = learn.train_models(episodes, [tuned], CUTOFF, fold_local=fold_local)
    assert result.failures == [] and result.best_name == "random_forest_tuned"
    assert result.best.stages[-1].getNumTrees in (3, 5)


def test_scoring_a_table_and_a_stream(spark, run, episodes):
    base, result = run
    model = load_model(model_path(base, result.best_name))
    scored = score_table(model, episodes.withColumn("country", F.lit("never seen")))
    assert tuple(scored.columns) == SCORED_COLUMNS
    assert scored.filter(F.col("predicted_trending_days").isNull() | F.isnan("predicted_trending_days")).count() == 0
    payload = json.dumps({"video_id": "a", "title": None, "likes": 9.0, "views": 5.0})
    row = score_stream(spark.createDataFrame([(payload,)], "value string"), model).first().asDict()
    assert (row["title"], row["description"], row["country"], row["views"]) == ("", "", "Unknown", 5.0)
    assert row["predicted_trending_days"] is not None and row["likes"] == 9.0


def test_aggregate_and_promote(spark, run, tmp_path):
    base, result = run
    row = aggregate_metrics(spark, base).first()
    assert (row["best_model"], row["best_model_dir"]) == (result.best_name, f"{base}/{result.best_name}")
    assert row["aggregated_models"] == ["gradient_boosting", "linear_regression", MEAN_BASELINE]
    assert promote_best(spark, base, str(tmp_path / "best")) == result.best_name
    assert load_model(str(tmp_path / "best")).stages


def test_metrics_files(spark, tmp_path):
    base = str(tmp_path)
    assert read_metrics(spark, base).count() == 0
    with pytest.raises(RuntimeError, match="No metrics"):
        aggregate_metrics(spark, base)
    write_model_metrics(spark, {"model_name": "a b/c", "rmse": 1.0, "mae": 2.0, "r2": None}, base)
    (tmp_path / "hand_metrics.json").write_text(json.dumps({"model_name": "hand", "rmse": 3.0, "mae": 1.0, "r2": 0.1}, indent=2))
    assert sorted(tuple(r) for r in read_metrics(spark, base).collect()) == [("a b/c", 1.0, 2.0, None), ("hand", 3.0, 1.0, 0.1)]
    assert artifact_name("a b/c") == "a_b_c"
