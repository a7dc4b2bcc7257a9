import datetime as dt
import json
import os

import pytest
from plans import executed, runs_python
from pyspark.sql import functions as F
from snapflow.functions.features import add_shared_features
from snapflow.operators.report import metric_points, metric_summary
from snapflow.schemas import NUMERIC_FEATURES, PREDICTION_SCHEMA
from snapflow.sources.kafka import as_messages, source_options
from snapflow.streaming import (
    drop_repeats, parse_messages, read_live_table, rejected_messages, resolve_checkpoint_dir, stream_features,
    valid_messages, write_live_table,
)
from snapflow.workspace import new_run_dir, shared_dir

TIME = dt.datetime(2024, 1, 7, 14)


def feed(spark, *payloads):
    rows = [(p if isinstance(p, str) or p is None else json.dumps(p), TIME) for p in payloads]
    df = spark.createDataFrame(rows, "value string, ts timestamp")
    return df.withColumn("value", F.col("value").cast("binary"))


VIDEO = {"video_id": "a", "title": "t", "publish_time": "2024-01-07T12:00:00Z", "tags": "x|y", "views": 10.0,
         "view_count": 10.0, "likes": 1.0, "comment_count": 1.0, "country": "VN"}


def test_payloads(spark):
    parsed = parse_messages(
        feed(spark, VIDEO, "{bad", "{}", "[]", '""', None, {"video_id": "  "}, {"video_id": 7}, {"video_id": "s", "views": "12"})
    )
    rows = {r["video_id"]: r for r in valid_messages(parsed).collect()}
    assert set(rows) == {"a", "7", "s"}
    assert rows["s"]["views"] == 12.0
    assert "{bad" in {r[0] for r in rejected_messages(parsed).collect()}


def test_a_message_is_either_valid_or_rejected(spark):
    texts = [VIDEO, "{bad", '{"video_id": "a", "likes": 5', {"video_id": "b", "likes": "1,234"}, {"video_id": "c", "likes": "NaN"},
             {"video_id": "d", "likes": {"x": 1}}, {"video_id": "e", "tags": ["x"]}]
    parsed = parse_messages(feed(spark, *texts), keep=["ts"])
    valid = {r["video_id"]: r["likes"] for r in valid_messages(parsed).collect()}
    assert valid == {"a": 1.0, "b": 1234.0, "c": None, "d": None, "e": None}
    assert {r[0] for r in rejected_messages(parsed).collect()} == {"{bad", '{"video_id": "a", "likes": 5'}


def test_messages_are_parsed_once(spark, tmp_path):
    feed(spark, VIDEO).write.parquet(str(tmp_path / "m"))
    plan = executed(valid_messages(parse_messages(spark.read.parquet(str(tmp_path / "m")))))
    assert plan.count("from_json") == 1


def test_no_shuffle_and_no_python_on_the_way_to_features(spark):
    df = stream_features(feed(spark, VIDEO))
    assert "Exchange" not in executed(df)
    assert not runs_python(df)


def test_event_time_country_names_and_carried_columns(spark):
    df = stream_features(feed(spark, VIDEO).withColumn("offset", F.lit(3)), event_time_col="ts", country_names={"VN": "VIETNAM"}, keep=["offset"])
    row = df.first()
    assert (row["hours_to_trending"], row["country"], row["offset"]) == (2.0, "VIETNAM", 3)
    assert stream_features(feed(spark, VIDEO)).first()["hours_to_trending"] > 1000


def test_batch_and_stream_features_are_the_same(spark):
    streamed = stream_features(feed(spark, VIDEO, {**VIDEO, "video_id": "b", "likes": None}), event_time_col="ts")
    rows = [(v, 10.0, l, 1.0, dt.datetime(2024, 1, 7, 12), TIME, "t", "", "x|y") for v, l in (("a", 1.0), ("b", None))]
    batch = add_shared_features(
        spark.createDataFrame(rows, "video_id string, view_count double, likes double, comment_count double, publish_timestamp timestamp, ts timestamp, title string, description string, tags string"),
        "ts",
    )
    columns = ["video_id", "hours_to_trending", *NUMERIC_FEATURES]
    assert streamed.select(columns).collect() == batch.select(columns).collect()


def test_json_leaves_out_nulls(spark):
    df = spark.createDataFrame([("a", None, float("nan"))], "video_id string, x int, y double")
    assert json.loads(as_messages(df).first()["value"]) == {"video_id": "a", "y": "NaN"}
    assert as_messages(df, "video_id").first()["key"] == "a"


def test_kafka_options():
    assert source_options("h:1", "t")["startingOffsets"] == "earliest"
    with pytest.raises(ValueError, match="earliest or latest"):
        source_options("h:1", "t", "middle")


def test_checkpoint_policies(spark, tmp_path):
    base = str(tmp_path / "cp")
    os.makedirs(base)
    (tmp_path / "cp" / "offsets").write_text("0")
    assert resolve_checkpoint_dir(spark, base) == base and os.path.exists(f"{base}/offsets")
    first, second = (resolve_checkpoint_dir(spark, base, "unique") for _ in range(2))
    assert first != second and first.startswith(f"{base}/run_")
    assert resolve_checkpoint_dir(spark, base, "reset") == base and not os.path.exists(f"{base}/offsets")
    assert resolve_checkpoint_dir(spark, base, "reset") == base
    with pytest.raises(ValueError, match="policy"):
        resolve_checkpoint_dir(spark, base, "other")


def test_shared_dir_follows_the_setting(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert new_run_dir(spark, "x") != new_run_dir(spark, "x")


def land(spark, rows, out, checkpoint):
    (rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())
    return spark.read.schema(rows.schema).parquet(out)


@pytest.mark.parametrize("delay", [None, "1 day"])
@pytest.mark.parametrize("salts", [1, 4])
def test_every_id_is_sent_once(spark, tmp_path, delay, salts):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    batch = spark.range(0, 300, 1, 4).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("v"), F.col("id") % 40)).alias("video_id"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id")).alias("ts"),
    )
    os.makedirs(source)
    stream = spark.readStream.schema(batch.schema).parquet(source)
    rows = drop_repeats(stream, event_time_col=None if delay is None else "ts", delay=delay, salts=salts)
    expected = batch.select("video_id").distinct().count()
    for _ in range(2):  # the second round repeats the first and must add nothing
        batch.write.mode("append").parquet(source)
        landed = land(spark, rows, out, checkpoint)
        assert landed.count() == landed.select("video_id").distinct().count() == expected


def test_delay_needs_a_time_column(spark):
    with pytest.raises(ValueError, match="go together"):
        drop_repeats(spark.range(1), ["id"], delay="1 hour")


def test_live_table_and_report(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    messages = as_messages(
        spark.range(1, 5).select(F.col("id").cast("string").alias("video_id"), F.col("id").cast("double").alias("views"),
                                 F.lit(2.0).alias("predicted_trending_days"))
    ).withColumn("ts", F.lit(TIME))
    for rounds in (1, 2):
        messages.write.mode("append").parquet(source)
        stream = spark.readStream.schema(messages.schema).parquet(source)
        points = metric_points(valid_messages(parse_messages(stream, PREDICTION_SCHEMA, keep=["ts"])), "ts")
        write_live_table(points, out, checkpoint, available_now=True).awaitTermination()
        live = read_live_table(spark, out)
        assert live.count() == 4 * rounds
    views = metric_summary(live, ["views"]).first()
    assert (views["mean"], views["max"], views["min"]) == (2.5, 4.0, 1.0)


def test_a_replayed_batch_is_not_counted_twice(spark, tmp_path):
    """Losing the record that a batch was finished makes Spark run it again."""
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    spark.range(5).write.parquet(source)
    stream = spark.readStream.schema("id long").parquet(source)
    write_live_table(stream, out, checkpoint, available_now=True).awaitTermination()
    for name in os.listdir(f"{checkpoint}/commits"):
        os.remove(f"{checkpoint}/commits/{name}")
    write_live_table(stream, out, checkpoint, available_now=True).awaitTermination()
    assert read_live_table(spark, out).count() == 5


def test_a_new_checkpoint_keeps_the_history(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(5).write.parquet(source)
    for name in ("cp1", "cp2"):
        stream = spark.readStream.schema("id long").parquet(source)
        write_live_table(stream, out, str(tmp_path / name), available_now=True).awaitTermination()
    assert read_live_table(spark, out, stream.schema).count() == 10
