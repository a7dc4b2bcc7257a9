import datetime as dt
import random
import statistics

import pytest
from plans import executed
from pyspark.ml.evaluation import RegressionEvaluator
from snapflow.operators import evaluate as ev
from snapflow.operators import report as rp
from snapflow.operators.split import temporal_split, training_projection


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(1)
    rows = [(f"m{i % 2}", rng.uniform(1, 30), rng.uniform(1, 30)) for i in range(500)]
    return spark.createDataFrame(rows, "model_name string, trending_days double, prediction double")


def test_metrics_equal_the_evaluator(scored):
    row = ev.regression_metrics(scored).first()
    for name in ("rmse", "mae", "r2"):
        expected = RegressionEvaluator(labelCol="trending_days", predictionCol="prediction", metricName=name).evaluate(scored)
        assert row[name] == pytest.approx(expected, rel=1e-9)


def test_metrics_by_group(scored):
    grouped = {r["model_name"]: r["rmse"] for r in ev.regression_metrics(scored, by=["model_name"]).collect()}
    assert set(grouped) == {"m0", "m1"}
    assert grouped["m0"] == pytest.approx(ev.regression_metrics(scored.filter("model_name = 'm0'")).first()["rmse"])


def test_r2_of_a_constant_label_is_null(spark):
    df = spark.createDataFrame([(2.0, 1.0), (2.0, 3.0)], "trending_days double, prediction double")
    assert tuple(ev.regression_metrics(df).first()) == (1.0, 1.0, None)


def test_baseline(spark):
    train = spark.createDataFrame([(1.0,), (3.0,), (None,)], "trending_days double")
    assert [r["prediction"] for r in ev.constant_baseline(train, train).collect()] == [2.0] * 3
    assert ev.constant_baseline(train.filter("false"), train).first()["prediction"] == 0.0


def scores(spark, *rows):
    return spark.createDataFrame([(n, r, r, 0.5) for n, r in rows], "model_name string, rmse double, mae double, r2 double")


def test_best_model(spark):
    row = ev.best_model(scores(spark, ("b", 2.0), ("a", 2.0), ("c", 3.0), ("mean_baseline", 1.0))).first()
    assert (row["best_model"], row["rmse"], row["baseline_rmse"], row["n_models"]) == ("a", 2.0, 1.0, 4)


def test_only_the_baseline(spark):
    assert ev.best_model(scores(spark, ("mean_baseline", 1.0))).first()["best_model"] == "mean_baseline"


def test_unscored_models_do_not_win(spark):
    row = ev.best_model(scores(spark, ("nan", float("nan")), ("null", None), ("ok", 9.0))).first()
    assert (row["best_model"], row["baseline_rmse"]) == ("ok", None)


def test_model_table_and_union(spark):
    s = scores(spark, ("b", 2.0), ("a", 2.0), ("c", 1.0))
    assert [r["model_name"] for r in ev.model_table(s).collect()] == ["c", "a", "b"]
    both = ev.union_families({"spark": s, "optional": s.limit(1)})
    assert {r["model_family"]: r["count"] for r in both.groupBy("model_family").count().collect()} == {"spark": 3, "optional": 1}


def test_split(spark, tmp_path):
    rows = [(dt.date(2026, 1, d), dt.date(2026, 1, min(d + 3, 28))) for d in range(1, 21)]
    path = str(tmp_path / "t")
    spark.createDataFrame(rows, "trending_date_parsed date, episode_end_date date").write.parquet(path)
    df = spark.read.parquet(path)
    train, test = temporal_split(df, dt.date(2026, 1, 11))
    assert (train.count(), test.count()) == (10, 10)
    assert temporal_split(df, dt.date(2026, 1, 11), purge=True)[0].count() == 7
    assert temporal_split(df)[0].count() == 0
    assert "LessThan(trending_date_parsed" in executed(train)


def test_training_projection_leaves_out_what_is_absent(spark):
    df = spark.createDataFrame([(1, 2.0, "x")], "other int, log_views double, country string")
    assert training_projection(df).columns == ["country", "log_views"]


POINTS = [(1.0, 0.0, None), (2.0, 0.0, 5.0), (4.0, 0.0, 7.0), (4.0, 0.0, 9.0)]


@pytest.fixture(scope="module")
def points(spark):
    return spark.createDataFrame(POINTS, "views double, likes double, comments double")


def test_summary(points):
    rows = {r["metric"]: r for r in rp.metric_summary(points, ["views", "comments"]).collect()}
    assert (rows["views"]["mean"], rows["views"]["max"], rows["views"]["min"]) == (2.75, 4.0, 1.0)
    assert rows["comments"]["stddev"] == pytest.approx(statistics.stdev([5, 7, 9]))


def test_kpis(points):
    row = rp.kpi_row(points, ["views", "comments"]).first()
    assert tuple(row) == (2.75, 7.0, 4)


def test_histogram(points):
    bins = rp.histogram(points, ["views", "likes", "comments"], bins=3).collect()
    counts = {m: [r["n"] for r in sorted((b for b in bins if b["metric"] == m), key=lambda r: r["bin"])] for m in ("views", "likes", "comments")}
    assert counts == {"views": [1, 1, 2], "likes": [4, 0, 0], "comments": [1, 1, 1]}
    assert max(b["bin_end"] for b in bins if b["metric"] == "views") == 4.0


def test_histogram_of_not_a_number(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,)], "v double")
    rows = rp.histogram(df, ["v"], bins=2).orderBy("bin").collect()
    assert [(r["bin_start"], r["n"]) for r in rows] == [(1.0, 1), (2.0, 1)]


def test_percent_of_maximum(points):
    df = rp.engagement_percent(points)
    assert [r["views_pct"] for r in df.collect()] == [25.0, 50.0, 100.0, 100.0]
    assert {r["likes_pct"] for r in df.collect()} == {0.0}
    assert "Window" not in executed(df) and "Join" not in executed(df)


def test_latest_and_timeline(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(9)], "id int, timestamp int")
    assert [r["id"] for r in rp.latest(df, 4, ties=["id"]).collect()] == [8, 5, 2, 7]
    assert [r["id"] for r in rp.timeline(df, ties=["id"]).collect()][:4] == [0, 3, 6, 1]
    assert "TakeOrderedAndProject" in executed(rp.latest(df, 4))


def test_prediction_fields(spark):
    df = spark.createDataFrame(
        [("3.5", "9", "0", "7"), (None, "9", None, "7"), ("x", None, "5", None), (None, None, None, None)],
        "predicted_trending_days string, prediction string, views string, view_count string",
    )
    plain = [(r["predicted_trending_days"], r["views"]) for r in rp.prediction_fields(df).collect()]
    assert plain == [(3.5, 0.0), (9.0, 7.0), (0.0, 5.0), (0.0, 0.0)]
    filled = [r["views"] for r in rp.prediction_fields(df, zero_views_is_missing=True).collect()]
    assert filled == [7.0, 7.0, 5.0, 0.0]


def test_metric_points_of_bare_rows(spark):
    row = rp.metric_points(spark.createDataFrame([(5,)], "prediction_time int")).first()
    assert tuple(row) == (5, 0.0, 0.0, 0.0, 0.0, "Unknown")


def test_latest_feed(spark):
    df = spark.createDataFrame([(1, 7.04), (2, 2.26), (3, 0.1)], "prediction_time int, prediction double")
    assert [(r["tier"], r["days"]) for r in rp.latest_feed(df, 3).collect()] == [("cold", 0.1), ("medium", 2.3), ("hot", 7.0)]
