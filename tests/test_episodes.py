import datetime as dt
import random

from plans import executed, hash_exchanges, runs_python
from pyspark.sql import functions as F
from snapflow.operators.episodes import (
    assign_episodes, attach_episode_targets, collapse_episodes, episode_targets, first_snapshots,
)
from snapflow.plans.training_frame import build_training_frame, clean_snapshots
from snapflow.schemas import EPISODE_TABLE

START = dt.date(2024, 1, 1)


def days(spark, *numbers, item="v"):
    return all_days(spark, {item: numbers})


def all_days(spark, items):
    rows = [(item, "c", START + dt.timedelta(n - 1), float(n)) for item, numbers in items.items() for n in numbers]
    return spark.createDataFrame(rows, "video_id string, country string, trending_date_parsed date, n double")


def collapsed(df, gap=1):
    rows = collapse_episodes(df, gap).orderBy("video_id", "country", "episode_id").collect()
    return [(r["episode_id"], r["trending_days"], r["n"], r["reappear_count"], r["episode_end_date"]) for r in rows]


def by_hand(numbers, gap=1):
    """Episodes of one item as (id, rows, first day, reappearances, last date)."""
    runs = []
    for n in sorted(numbers):
        if runs and n - runs[-1][-1] <= gap:
            runs[-1].append(n)
        else:
            runs.append([n])
    return [
        (i, float(len(run)), float(run[0]), float(i - 1), START + dt.timedelta(run[-1] - 1))
        for i, run in enumerate(runs, 1)
    ]


def test_gap_of_one(spark):
    found = collapsed(days(spark, 1, 2, 3, 5, 8, 9))
    assert [(e[0], e[1], e[3]) for e in found] == [(1, 3.0, 0.0), (2, 1.0, 1.0), (3, 2.0, 2.0)]


def test_gap_of_three_counts_days_seen(spark):
    assert [e[:2] for e in collapsed(days(spark, 1, 2, 3, 5, 8, 9), gap=3)] == [(1, 6.0)]


def test_against_brute_force(spark):
    rng = random.Random(7)
    items = {f"v{i}": sorted(rng.sample(range(1, 60), rng.randint(1, 40))) for i in range(40)}
    df = all_days(spark, items)
    for gap in (1, 2, 5):
        expected = [e for item in sorted(items) for e in by_hand(items[item], gap)]
        assert collapsed(df, gap) == expected
        assert collapsed(df.repartition(5, "n"), gap) == expected


def test_collapse_equals_the_join_form(spark):
    rng = random.Random(3)
    df = all_days(spark, {"v": rng.sample(range(1, 80), 45), "w": rng.sample(range(1, 80), 30)})
    joined = attach_episode_targets(first_snapshots(assign_episodes(df)), episode_targets(df))
    columns = ["video_id", "country", "episode_id", "n", "trending_days", "episode_start_date", "episode_end_date", "log_trending_days"]
    left, right = collapse_episodes(df).select(columns), joined.select(columns)
    assert left.exceptAll(right).count() == right.exceptAll(left).count() == 0


def test_row_labels(spark):
    rows = assign_episodes(days(spark, 1, 2, 4)).orderBy("n").collect()
    assert [(r["date_gap"], r["episode_start_flag"], r["episode_id"]) for r in rows] == [(None, 1, 1), (1, 0, 1), (2, 1, 2)]


def test_episode_days_add_up_and_match_the_span(spark):
    df = days(spark, 1, 2, 3, 7, 8, 20)
    found = collapse_episodes(df)
    assert found.agg(F.sum("trending_days")).first()[0] == df.count()
    span = F.datediff("episode_end_date", "episode_start_date") + 1
    assert found.filter(F.col("trending_days") != span).count() == 0


def test_plan_is_one_exchange_one_sort_no_join(spark, tmp_path):
    path = str(tmp_path / "days")
    days(spark, 1, 2).write.parquet(path)
    df = collapse_episodes(spark.read.parquet(path))
    plan = executed(df)
    assert hash_exchanges(df) == 1
    assert plan.count("Sort [") == 1
    assert "Join" not in plan
    assert not runs_python(df)


SNAP = "video_id string, country string, publish_date string, trending_date string, view_count string, likes string, comment_count string, title string"


def snapshot(day, views="100", likes="10", comments="1", item="v", title="t"):
    date = (START + dt.timedelta(day - 1)).isoformat()
    return (item, "VN", "2023-12-31T12:00:00Z", date, views, likes, comments, title)


def test_training_frame(spark):
    df = spark.createDataFrame([snapshot(1), snapshot(2), snapshot(4, views="1,000")], SNAP)
    frame = build_training_frame(df)
    assert tuple(frame.columns) == EPISODE_TABLE
    first, second = frame.orderBy("episode_id").collect()
    assert (first["trending_days"], first["hours_to_trending"], first["views_normalized"]) == (2.0, 12.0, 100.0)
    assert (second["trending_days"], second["reappear_count"], second["view_count"]) == (1.0, 1.0, 1000.0)
    assert (first["categoryId"], first["description"]) == ("0", "")


def test_a_rejected_day_splits_an_episode(spark):
    df = spark.createDataFrame([snapshot(1), snapshot(2, views="5", likes="9"), snapshot(3)], SNAP)
    assert build_training_frame(df).count() == 2


def test_a_doubled_day_does_not_lengthen_an_episode(spark):
    df = spark.createDataFrame([snapshot(1), snapshot(1, views="500"), snapshot(2)], SNAP)
    row = build_training_frame(df).first()
    assert (row["trending_days"], row["view_count"]) == (2.0, 500.0)


def test_a_hot_item_is_spread_over_its_days(spark):
    """A third of the rows are one item's; what crosses the network is one row per item, day and split."""
    item = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("v"), F.col("id") % 50))
    hot = spark.range(0, 200_000, 1, 8).select(
        item.alias("video_id"), F.concat(F.lit("VN"), F.col("id") % 1).alias("country"), F.lit("2023-12-31T12:00:00Z").alias("publish_date"),
        F.date_add(F.lit(START), (F.col("id") % 30).cast("int")).cast("string").alias("trending_date"),
        (F.col("id") % 1000 + 500).cast("string").alias("view_count"), F.lit("1").alias("likes"),
        F.lit("1").alias("comment_count"), F.lit("t").alias("title"),
    )
    row = build_training_frame(hot).filter("video_id = 'hot'").agg(F.sum("trending_days")).first()
    assert row[0] == 10.0
    plan = executed(build_training_frame(hot))
    assert plan.count("Exchange hashpartitioning") == 2 and "Join" not in plan


def test_result_does_not_depend_on_layout(spark):
    rows = [snapshot(d, views=str(100 + d % 3), item=f"v{d % 5}", title=f"t{d}") for d in range(1, 60)] * 2
    df = spark.createDataFrame(rows, SNAP)
    base = build_training_frame(df)
    for n in (1, 5):
        other = build_training_frame(df.repartition(n))
        assert base.exceptAll(other).count() == other.exceptAll(base).count() == 0


def test_co_located_items_need_one_exchange_and_one_sort(spark, tmp_path):
    rows = [snapshot(d, views=str(100 + d % 3), item=f"v{d % 5}", title=f"t{d}") for d in range(1, 60)] * 2
    path = str(tmp_path / "raw")
    spark.createDataFrame(rows, SNAP).write.parquet(path)
    df = spark.read.parquet(path)
    near, far = build_training_frame(df, co_locate=True), build_training_frame(df)
    assert near.exceptAll(far).count() == far.exceptAll(near).count() == 0
    plan = executed(near)
    assert plan.count("Exchange hashpartitioning") == plan.count("Sort [") == 1


def test_clean_snapshots(spark, tmp_path):
    target = str(tmp_path / "clean")
    df = spark.createDataFrame([snapshot(1), snapshot(2), snapshot(9)], SNAP)
    assert clean_snapshots(df, target) == 2
    assert spark.read.parquet(target).columns == list(EPISODE_TABLE)
    assert clean_snapshots(df.filter("false"), target) == 0
    assert spark.read.parquet(target).count() == 2
