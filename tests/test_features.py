import datetime as dt
import math

import pytest
from plans import runs_python
from pyspark.sql import functions as F
from snapflow.functions.features import add_shared_features, back_transform, hotness_tier, join_tags, tag_count

DDL = "publish_timestamp timestamp, snap timestamp, view_count double, likes double, comment_count double, title string, description string, tags string"
NOON = dt.datetime(2024, 1, 7, 12)


def features(spark, **given):
    row = {"publish_timestamp": NOON, "snap": NOON + dt.timedelta(hours=2), "view_count": 100.0, "likes": 10.0,
           "comment_count": 5.0, "title": "abc", "description": "de", "tags": "a|b", **given}
    return add_shared_features(spark.createDataFrame([row], DDL), "snap").first()


def test_usual_row(spark):
    r = features(spark)
    assert (r["views_normalized"], r["hours_to_trending"]) == (100.0, 2.0)
    assert (r["like_ratio"], r["comment_ratio"], r["engagement_rate"]) == (0.1, 0.05, 0.15)
    assert (r["views_per_hour"], r["likes_per_hour"], r["comments_per_hour"]) == (50.0, 5.0, 2.5)
    assert (r["title_length"], r["description_length"], r["tag_count"]) == (3.0, 2.0, 2.0)
    assert (r["publish_hour"], r["publish_day_of_week"], r["publish_dow"]) == (12.0, 1.0, 1.0)  # a Sunday
    assert r["log_views"] == pytest.approx(math.log1p(100))
    assert r["log_hours_to_trending"] == pytest.approx(math.log1p(2))


def test_unknown_publish_time(spark):
    r = features(spark, publish_timestamp=None)
    assert r["hours_to_trending"] is None
    assert (r["publish_hour"], r["publish_dow"], r["views_per_hour"], r["log_hours_to_trending"]) == (12.0, 1.0, 0.0, 0.0)


def test_published_after_the_snapshot(spark):
    r = features(spark, snap=NOON - dt.timedelta(hours=1))
    assert (r["hours_to_trending"], r["views_per_hour"]) == (0.0, 0.0)


def test_no_views(spark):
    r = features(spark, view_count=0.0)
    assert (r["like_ratio"], r["comment_ratio"], r["engagement_rate"], r["log_views"]) == (0.0, 0.0, 0.0, 0.0)


def test_missing_counts_leave_no_nulls(spark):
    r = features(spark, likes=None, comment_count=None, view_count=None)
    assert [r[c] for c in ("views_normalized", "log_likes", "like_ratio", "engagement_rate", "likes_per_hour")] == [0.0] * 5


def test_negative_counts_have_log_zero(spark):
    assert features(spark, comment_count=-3.0)["log_comment_count"] == 0.0


@pytest.mark.parametrize("columns", [("views",), ("view_count",), ("views", "view_count")])
def test_views_come_from_whichever_column_exists(spark, columns):
    df = spark.createDataFrame([(1,)], "x int").withColumns({c: F.lit(7.0) for c in columns})
    assert add_shared_features(df, "snap").first()["views_normalized"] == 7.0


def test_first_views_column_wins_unless_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 2.0), (None, None)], "views double, view_count double")
    assert [r["views_normalized"] for r in add_shared_features(df, "snap").collect()] == [1.0, 2.0, 0.0]


def test_text_input(spark):
    df = spark.createDataFrame(
        [("2024-01-07T12:00:00Z", "2024-01-07 13:00:00", "1,000", "50")], "publish_timestamp string, snap string, views string, likes string"
    )
    r = add_shared_features(df, "snap").first()
    assert (r["hours_to_trending"], r["views_normalized"], r["like_ratio"], r["title_length"]) == (1.0, 1000.0, 0.05, 0.0)


def test_snapshot_is_now_if_absent(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 1, 1),)], "publish_timestamp timestamp")
    assert add_shared_features(df, "none").first()["hours_to_trending"] > 24 * 365


@pytest.mark.parametrize(
    ("text", "n"), [(None, 0), ("", 0), ("  ", 0), ("a", 1), ("a|b", 2), ("a | b", 2), ("a||b", 3), ("a|", 2), ("|", 2)]
)
def test_tag_count(spark, text, n):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(tag_count(F.col("t"))).first()[0] == n


def test_join_tags(spark):
    df = spark.createDataFrame([(["a", "b"],), ([],), (None,)], "t array<string>")
    assert [r[0] for r in df.select(join_tags(F.col("t"))).collect()] == ["a|b", "", ""]


def test_back_transform_and_tier(spark):
    df = spark.createDataFrame([(math.log1p(5.126),), (math.log1p(2.0001),), (0.0,)], "p double")
    days = back_transform(F.col("p"), digits=2)
    rows = df.select(days, hotness_tier(days), hotness_tier(days, hot=7.0)).collect()
    assert [tuple(r) for r in rows] == [(5.13, "hot", "medium"), (2.0, "medium", "medium"), (0.0, "cold", "cold")]


def test_no_python_in_the_plan(spark):
    df = add_shared_features(spark.createDataFrame([("a",)], "title string"), "snap")
    assert not runs_python(df)


def test_features_do_not_follow_the_session_time_zone(spark):
    df = spark.createDataFrame([("2024-01-07T00:30:00Z", dt.date(2024, 1, 8))], "publish_timestamp string, day date")
    columns = ["publish_hour", "publish_day_of_week", "hours_to_trending"]
    for zone in ("UTC", "Asia/Bangkok", "America/New_York"):
        session = spark.newSession()
        session.conf.set("spark.sql.session.timeZone", zone)
        here = session.createDataFrame(df.collect(), df.schema)
        assert tuple(add_shared_features(here, "day").select(columns).first()) == (0.0, 1.0, 23.5)
        assert tuple(add_shared_features(here, "day", zone="Asia/Bangkok").select(columns).first()) == (7.0, 1.0, 16.5)
