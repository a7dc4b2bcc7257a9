"""What is kept up to date batch by batch equals what all rows at once give."""

import datetime as dt
import json
import math
import random
import re

import pytest
from plans import executed
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F
from snapflow.__main__ import main
from snapflow.functions.parse import clean_number
from snapflow.operators.censoring import with_censoring_weights
from snapflow.operators.episodes import collapse_episodes
from snapflow.operators.frequency import frequency_index, indexed
from snapflow.operators.partials import bin_level, histogram_of, merged, partials, summary_of
from snapflow.operators.report import metric_summary
from snapflow.operators.standardize import rename_aliases, standardize, standardize_files, type_columns
from snapflow.plans.episode_store import EpisodeStore
from snapflow.sources.commits import CommitLog
from snapflow.sources.registry import ModelRegistry
from snapflow.streaming import read_live_table, write_live_table
from snapflow.streaming.live import compact_live_table, live_aggregates
from snapflow.streaming.pages import intake_pages
from snapflow.streaming.scoring import score_with_current

DAY = "trending_date_parsed"


# ---------------------------------------------------------------- episodes


@pytest.fixture(scope="module")
def days(spark):
    pick = random.Random(1)
    rows = {
        (f"v{i}", pick.choice("ab") if i % 7 else None, dt.date(2024, 1, d)): (float(i * 100 + d), "t" * pick.randrange(4))
        for i in range(40) for d in range(1, 20) if pick.random() < 0.5
    }
    ddl = f"video_id string, country string, {DAY} date, view_count double, title string"
    return spark.createDataFrame([(*k, *v) for k, v in rows.items()], ddl).cache()


def of_days(df, first, last):
    return df.filter(F.dayofmonth(DAY).between(first, last))


@pytest.mark.parametrize("gap,cuts", [(1, [2, 3, 8, 14, 19]), (3, [1, 2, 3, 4, 6, 9, 19])])
def test_batches_of_days_give_the_same_episodes(spark, days, tmp_path, gap, cuts):
    store, before = EpisodeStore(spark, str(tmp_path), gap, buckets=4), 0
    for last in cuts:
        store.append(of_days(days, before + 1, last))
        before = last
        want = collapse_episodes(of_days(days, 1, last), gap)
        if last in (cuts[2], cuts[-1]):
            got = store.episodes()
            assert got.columns == want.columns
            assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert store.last_day() == days.agg(F.max(DAY)).first()[0]


def test_only_touched_buckets_are_read_and_rewritten(spark, days, tmp_path):
    store = EpisodeStore(spark, str(tmp_path), buckets=8)
    store.append(of_days(days, 1, 10))
    one = of_days(days, 11, 11).filter("video_id = 'v3'")
    extra = one if one.count() else of_days(days, 12, 12).limit(1)
    bucket = extra.select(F.pmod(F.xxhash64("video_id", "country"), F.lit(8))).first()[0]
    number, rows = store.log.latest()
    seen = store._stored(number, {bucket: 1}, closed=False)
    assert {re.search(r"kind=(\w+)/bucket=(\d+)", f).groups() for f in seen.inputFiles()} >= {("tail", str(bucket))}
    assert "PartitionFilters: [" in executed(seen) and seen.count() < store.episodes().count()
    store.append(extra)
    tails = {r.bucket: r.tail_commit for r in store.log.latest()[1]}
    assert tails[bucket] == 2 and {c for b, c in tails.items() if b != bucket} == {1}


def test_days_that_are_known_already_are_refused(spark, days, tmp_path):
    store = EpisodeStore(spark, str(tmp_path))
    with pytest.raises(ValueError, match="No batch"):
        store.episodes()
    assert store.append(days.limit(0)) == 0
    store.append(of_days(days, 1, 5))
    with pytest.raises(ValueError, match="in the store already"):
        store.append(of_days(days, 5, 7))
    assert store.append(days.limit(0)) == 1 == store.log.latest()[0]


def test_a_batch_without_its_commit_is_not_seen_and_can_be_repeated(spark, days, tmp_path, monkeypatch):
    store = EpisodeStore(spark, str(tmp_path))
    store.append(of_days(days, 1, 5))
    before = sorted(map(str, store.episodes().collect()))

    def fail(*args):
        raise RuntimeError("the driver is gone")

    monkeypatch.setattr(store.log, "commit", fail)
    with pytest.raises(RuntimeError):
        store.append(of_days(days, 6, 9))
    monkeypatch.undo()
    assert sorted(map(str, store.episodes().collect())) == before
    store.append(of_days(days, 6, 9))
    assert store.episodes().count() == collapse_episodes(of_days(days, 1, 9)).count()


def test_commits(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"), "name string")
    assert log.latest() == (0, [])
    for number in range(1, 6):
        log.commit(number, [(f"a{number}",), ("b",)])
    assert log.latest()[0] == 5 and sorted(r.name for r in log.latest()[1]) == ["a5", "b"]
    assert len([p for p in (tmp_path / "log/commits").iterdir() if p.is_dir()]) == 2
    with pytest.raises(ValueError):
        log.commit(6, [])


# ---------------------------------------------------------------- late texts, parsing


def snapshots(spark, path, rows=300):
    pick = random.Random(3)
    table = [
        (f"v{pick.randrange(40)}", f"2024-05-0{pick.randrange(1, 4)}", "2024-05-01T00:00:00Z", str(pick.randrange(5)), "1", "0", f"title {i}", "long " * 9, "a|b")
        for i in range(rows)
    ] + [(None, "2024-05-01", "2024-05-01T00:00:00Z", "1", "1", "0", "x", "x", "x")]
    ddl = "video_id string, trending_date string, publish_date string, views string, likes string, comment_count string, title string, description string, tags string"
    spark.createDataFrame(table, ddl).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def sorts(spark, df) -> list[str]:
    """The columns that each Sort of the plan carries."""
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    return re.findall(r"\) Sort[^\n]*\nInput \[\d+\]: \[([^\]]*)\]", text)


def test_late_texts_give_the_same_rows_and_are_never_sorted(spark, tmp_path):
    raw = snapshots(spark, str(tmp_path / "raw"))
    plain, late = standardize(raw), standardize_files(raw)
    assert late.columns == plain.columns
    assert sorted(map(str, late.collect())) == sorted(map(str, plain.collect()))
    carried = " ".join(sorts(spark, late))
    assert "video_id" in carried and not any(name in carried for name in ("title", "description", "tags"))
    assert "description" in " ".join(sorts(spark, plain))


def test_numbers_are_read_once_per_cell(spark, tmp_path):
    raw = snapshots(spark, str(tmp_path / "raw"))
    plan = executed(type_columns(rename_aliases(raw)).filter("view_count >= 0 AND likes <= view_count"))
    assert len(re.findall(r"cast\([^()]*(?:\([^()]*(?:\([^()]*\)[^()]*)*\)[^()]*)* as double\)", plan)) == 3
    odd = ["1.", "+.5", "-7e-2", "0x1p3", "1d", "1F", "--1", "1 2", "١", "1e", ".", "+", "1_0", "1e400", "-1e400", "nan", "+Infinity", "1,2,3", "\t9\n"]
    df = spark.createDataFrame([(x,) for x in odd], "a string")
    found = {r.a: r.n for r in df.select("a", clean_number(df, "a").alias("n")).collect()}
    assert {k: v for k, v in found.items() if v is not None} == {"1.": 1.0, "+.5": 0.5, "-7e-2": -0.07, "1,2,3": 123.0}


# ---------------------------------------------------------------- aggregates that merge


def test_partials_merge_to_those_of_all_rows(spark):
    pick = random.Random(4)
    rows = [(pick.choice([None, float("nan"), pick.gauss(0, 10 ** pick.randrange(-3, 6)), 0.0, 7.0]), float(i)) for i in range(2000)]
    rows += [(-(2.0**40), 0.0), (2.0**41, 1.0)]
    df = spark.createDataFrame(rows, "a double, b double").withColumn("part", F.pmod(F.xxhash64("b"), F.lit(5)))
    whole = partials(df, ["a", "b"])
    parts = [partials(df.filter(F.col("part") == i), ["a", "b"]) for i in range(5)]
    joined = parts[0]
    for part in parts[1:]:
        joined = merged(joined.unionByName(part))
    key = lambda r: (r.metric, r.level, r.bin)
    left, right = sorted(whole.collect(), key=key), sorted(joined.collect(), key=key)
    assert [(key(r), r.n, r.low, r.high) for r in left] == [(key(r), r.n, r.low, r.high) for r in right]
    assert max(r.n for r in histogram_of(joined).groupBy("metric").agg(F.count("*").alias("n")).collect()) <= 64
    clean = df.select(*[F.nanvl(c, F.lit(None).cast("double")).alias(c) for c in ("a", "b")])
    want = {r.metric: r for r in metric_summary(clean, ["a", "b"]).collect()}
    for r in summary_of(joined).collect():
        for name in ("mean", "max", "min", "stddev"):
            assert r[name] == pytest.approx(want[r.metric][name], rel=1e-9, abs=1e-9)


def test_partials_of_little(spark):
    assert partials(spark.createDataFrame([(None,)], "a double"), ["a"]).count() == 0
    one = partials(spark.createDataFrame([(3.5,), (None,)], "a double"), ["a"])
    assert [tuple(r) for r in summary_of(one).collect()] == [("a", 3.5, 3.5, 3.5, None, 1)]
    level = spark.range(1).select(bin_level(F.lit(-0.3), F.lit(1000.0), 64)).first()[0]
    assert math.floor(1000 / 2**level) - math.floor(-0.3 / 2**level) < 64 <= math.floor(1000 / 2 ** (level - 1)) - math.floor(-0.3 / 2 ** (level - 1))


POINTS = "video_id string, views double, likes double"


def land(spark, rows, path):
    spark.createDataFrame(rows, POINTS).coalesce(1).write.mode("append").parquet(path)


def run_live(spark, base, aggregates=("views", "likes"), checkpoint="checkpoint"):
    stream = spark.readStream.schema(POINTS).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    query = write_live_table(stream, f"{base}/live", f"{base}/{checkpoint}", available_now=True, aggregates=aggregates)
    query.awaitTermination()
    return query.id


def test_live_aggregates_follow_the_table_and_read_little(spark, tmp_path):
    base, pick = str(tmp_path), random.Random(5)
    for batch in range(5):
        land(spark, [(f"v{i}", pick.uniform(-5, 10.0**batch), None if i % 3 else float(i)) for i in range(20)], f"{base}/in")
    run = run_live(spark, base)
    run_live(spark, base, checkpoint="another")  # a second stream over the same files
    table = read_live_table(spark, f"{base}/live")
    assert table.count() == 200
    want = {r.metric: r for r in metric_summary(table, ["views", "likes"]).collect()}
    for r in live_aggregates(spark, f"{base}/live").collect():
        assert (r["max"], r["min"]) == (want[r.metric]["max"], want[r.metric]["min"])
        assert r["mean"] == pytest.approx(want[r.metric]["mean"]) and r["stddev"] == pytest.approx(want[r.metric]["stddev"])
    kept = list((tmp_path / "live_aggregates" / f"run_id={run}").iterdir())
    assert len([p for p in kept if p.is_dir()]) <= 2


def test_a_replayed_batch_is_counted_once(spark, tmp_path):
    from snapflow.streaming import live

    base = str(tmp_path / "live")
    rows = spark.createDataFrame([("a", 1.0, 2.0), ("b", 3.0, 4.0)], POINTS)
    for batch in (0, 1, 1, 2, 2):
        live._add_to_aggregates(rows, base, "r", batch, ["views", "likes"])
    assert {r.metric: r.n for r in live_aggregates(spark, base).collect()} == {"views": 6, "likes": 6}


def test_compaction_is_one_step_and_loses_nothing(spark, tmp_path, monkeypatch):
    base, live = str(tmp_path), tmp_path / "live"

    def content():
        return sorted((r.video_id, r.views) for r in read_live_table(spark, str(live)).collect())

    def folders():
        return sum(1 for _ in live.glob("run_id=*/batch_id=*"))

    with pytest.raises(ValueError, match="No batch"):
        read_live_table(spark, str(live))
    assert compact_live_table(spark, str(live)) == 0
    for batch in range(4):
        land(spark, [(f"v{batch}-{i}", float(i), 0.0) for i in range(3)], f"{base}/in")
    run_live(spark, base, ())
    want = content()
    assert len(want) == 12 and folders() == 4

    monkeypatch.setattr(CommitLog, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("gone")))
    with pytest.raises(RuntimeError):
        compact_live_table(spark, str(live))
    monkeypatch.undo()
    assert content() == want
    assert compact_live_table(spark, str(live)) == 3 and content() == want
    assert folders() == 4  # readers that started before still find them
    for batch in range(4, 7):
        land(spark, [(f"v{batch}-{i}", float(i), 0.0) for i in range(3)], f"{base}/in")
    run_live(spark, base, ())
    want = content()
    assert len(want) == 21
    assert compact_live_table(spark, str(live)) == 3 and content() == want
    assert folders() == 4 and compact_live_table(spark, str(live)) == 0 and content() == want


# ---------------------------------------------------------------- streams


def page(*ids, views=5):
    items = [{"id": i, "snippet": {"title": "t"}, "statistics": {"viewCount": str(views), "likeCount": "1", "commentCount": "0"}} for i in ids]
    return json.dumps({"items": items})


def test_every_item_of_a_fetch_is_taken_in_once(spark, tmp_path):
    ddl, base = "value string, region_code string, page_no int", str(tmp_path)
    batches = [
        [(page("a", "b"), "VN", 1), (page("b", "c"), "VN", 2)], [(page("a", "d", views=9), "VN", 3), (page("a"), "TH", 1)], [(page("d", "a"), "TH", 2)],
    ]
    for rows in batches:
        spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(f"{base}/in")
    stream = spark.readStream.schema(ddl).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    for _ in range(2):  # the second run finds nothing new
        intake_pages(stream, f"{base}/out", f"{base}/cp", fetch_keys=["region_code"], available_now=True).awaitTermination()
    rows = spark.read.parquet(f"{base}/out").select("country", "video_id", "views").collect()
    assert sorted(map(tuple, rows)) == [("TH", "a", 5.0), ("TH", "d", 5.0), ("VN", "a", 5.0), ("VN", "b", 5.0), ("VN", "c", 5.0), ("VN", "d", 9.0)]


def scorer(expression):
    return PipelineModel([SQLTransformer(statement=f"SELECT *, {expression} AS raw_prediction FROM __THIS__")])


def test_a_running_stream_takes_the_new_model(spark, tmp_path):
    base = str(tmp_path)
    registry = ModelRegistry(spark, f"{base}/models")
    with pytest.raises(ValueError, match="published"):
        registry.current()
    registry.publish(scorer("0.0D"))

    def send(name):
        spark.createDataFrame([(json.dumps({"video_id": name}),)], "value string").coalesce(1).write.mode("append").parquet(f"{base}/in")

    send("a")
    stream = spark.readStream.schema("value string").parquet(f"{base}/in")
    query = score_with_current(stream, registry, f"{base}/out", f"{base}/cp")
    try:
        query.processAllAvailable()
        assert registry.publish(scorer("log1p(1.0D)")) == 2
        send("b")
        query.processAllAvailable()
        registry.use(1)
        send("c")
        query.processAllAvailable()
    finally:
        query.stop()
    rows = spark.read.parquet(f"{base}/out").orderBy("video_id").collect()
    assert [(r.video_id, r.model_version, r.predicted_trending_days) for r in rows] == [("a", 1, 0.0), ("b", 2, 1.0), ("c", 1, 0.0)]


# ---------------------------------------------------------------- categories and weights


def test_a_million_categories_are_numbered_by_frequency(spark):
    df = spark.range(1_200_000).select((F.col("id") % 1_000_000).cast("string").alias("c"))
    index = frequency_index(df, "c", partitions=6)
    checked = index.agg(F.count("*"), F.count_distinct("index"), F.min("index"), F.max("index"), F.sum(F.when(F.col("n") == 2, F.col("index")))).first()
    assert tuple(checked) == (1_000_000, 1_000_000, 0, 999_999, sum(range(200_000)))
    assert [r.c for r in index.filter("index < 4").orderBy("index").collect()] == ["0", "1", "10", "100"]


def test_categories_with_ties_nulls_and_strangers(spark):
    df = spark.createDataFrame([(c,) for c in ["b", "a", "b", None, "c", "a", "d"]], "c string")
    index = frequency_index(df, "c", partitions=3)
    assert {r.c: (r.n, r["index"]) for r in index.collect()} == {"a": (2, 0), "b": (2, 1), "c": (1, 2), "d": (1, 3)}
    other = spark.createDataFrame([("b",), ("z",), (None,)], "c string")
    assert sorted((r.c or "", r.i) for r in indexed(other, "c", index, "i").collect()) == [("", 4), ("b", 1), ("z", 4)]
    assert frequency_index(df.limit(0), "c", partitions=2).count() == 0


def test_censoring_weights_match_a_plain_estimate(spark):
    pick, last = random.Random(8), dt.date(2024, 3, 1)
    rows = [(float(pick.randrange(1, 7)), last - dt.timedelta(pick.choice([0, 0, 1, 5, 9]))) for _ in range(200)]
    df = spark.createDataFrame(rows, "trending_days double, episode_end_date date")
    for gap in (1, 2):
        cut = [(length, (last - end).days < gap) for length, end in rows]
        found = sorted((r.trending_days, r.censored, r.weight) for r in with_censoring_weights(df, max_gap_days=gap).collect())

        def chance(length):
            kept = 1.0
            for t in sorted({t for t, _ in cut if t < length}):
                at_risk = sum(s >= t for s, _ in cut) - sum(s == t and not c for s, c in cut)
                kept *= 1 - sum(s == t and c for s, c in cut) / at_risk if at_risk else 1
            return kept

        want = sorted((t, c, 0.0 if c else 1 / chance(t)) for t, c in cut)
        assert [x[:2] for x in found] == [x[:2] for x in want]
        assert [x[2] for x in found] == pytest.approx([x[2] for x in want])
    none = with_censoring_weights(df, last_day=dt.date(2025, 1, 1))
    assert {r.weight for r in none.collect()} == {1.0}


# ---------------------------------------------------------------- commands


def test_intake_reports_and_compaction_commands(spark, tmp_path):
    at = lambda name: str(tmp_path / name)
    raw = snapshots(spark, at("raw"))
    for day in (1, 2, 3):
        raw.filter(F.col("trending_date") == f"2024-05-0{day}").write.parquet(at(f"day{day}"))
        main(["intake", "--store", at("store"), "--raw", at(f"day{day}"), "--format", "parquet", "--out", at("episodes")] if day == 3 else
             ["intake", "--store", at("store"), "--raw", at(f"day{day}"), "--format", "parquet"])
    main(["clean", "--raw", at("raw"), "--format", "parquet", "--out", at("whole"), "--late-texts"])
    read = lambda name: sorted(map(str, spark.read.parquet(at(name)).collect()))
    assert read("episodes") == read("whole") != []
    points = "video_id string, timestamp timestamp, views double, likes double, comments double, predicted_trending_days double"
    rows = [(f"v{i}", dt.datetime(2024, 1, 1, i), float(i), 1.0, 0.0, 3.0) for i in range(12)]
    spark.createDataFrame(rows, points).write.parquet(at("in"))
    stream = spark.readStream.schema(points).parquet(at("in"))
    write_live_table(stream, at("live"), at("cp"), True, ("views", "likes")).awaitTermination()
    expected = {"summary": 4, "kpi": 1, "histogram": 80, "engagement": 12, "timeline": 12, "feed": 5, "live-summary": 2, "live-histogram": None}
    for kind, n in expected.items():
        main(["report", "--live", at("live"), "--out", at(kind), "--kind", kind, "--newest", "5"])
        assert spark.read.json(at(kind)).count() == n or n is None
    main(["compact", "--live", at("live")])
    pages = [(page("a", "b"), "VN", 1), (page("a", "c"), "TH", 1)]
    spark.createDataFrame(pages, "value string, region_code string, page_no int").write.parquet(at("pages"))

    def sent(*more):
        main(["pages", at("pages"), at("messages"), "--fetch-keys", "region_code", *more])
        return sorted(json.loads(r[0])["video_id"] for r in spark.read.text(at("messages")).collect())

    assert sent() == ["a", "a", "b", "c"] and sent("--region", "VN") == ["a", "b"] and sent("--once") == ["a", "b", "c"]
    assert len(sent("--limit", "2")) == 2 and sent("--category", "7") == []
