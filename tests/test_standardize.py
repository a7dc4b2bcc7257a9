import datetime as dt

import pytest
from plans import executed, hash_exchanges, runs_python
from pyspark.sql import functions as F
from snapflow.functions.parse import clean_number, normalize_country, parse_date, parse_publish_time
from snapflow.operators.quality import is_empty, require_rows, row_counts, sane_counts
from snapflow.operators.standardize import cleaning_counts, deduplicate, rename_aliases, standardize, type_columns
from snapflow.sources.tables import read_snapshot_csv

RAW = "video_id string, publishedAt string, video_trending_date string, views string, likes string, comment_count string"


def raw(spark, *rows, ddl=RAW):
    return spark.createDataFrame(list(rows), ddl)


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2024.05.01", dt.date(2024, 5, 1)),
        ("2024-05-01", dt.date(2024, 5, 1)),
        ("24.01.05", dt.date(2024, 5, 1)),
        ("05/01/2024", dt.date(2024, 5, 1)),
        ("2024-1-5", None),
        ("24.13.13", None),
        ("2024.02.30", None),
        ("garbage", None),
        ("", None),
        (None, None),
    ],
)
def test_dates(spark, text, expected):
    df = spark.createDataFrame([(text,)], "d string")
    assert one(df.select(parse_date(F.col("d"))))[0] == expected


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2024-05-01T10:20:30Z", "2024-05-01 10:20:30"),
        (" 2024-05-01T10:20:30Z ", "2024-05-01 10:20:30"),
        ("2024-05-01T10:20:30+07", "2024-05-01 03:20:30"),
        ("2024-05-01T10:20:30+07:00", "2024-05-01 03:20:30"),
        ("2024-05-01T10:20:30-02:30", "2024-05-01 12:50:30"),
        ("2024-05-01T10:20:30.250Z", "2024-05-01 10:20:30.25"),
        ("2024-05-01T10:20:30.123456+01:00", "2024-05-01 09:20:30.123456"),
        ("2024-05-01", "2024-05-01 00:00:00"),
        ("2024-05-01 10:20:30", "2024-05-01 10:20:30"),
        ("soon", None),
        ("   ", None),
        (None, None),
    ],
)
def test_publish_times(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert one(df.select(parse_publish_time(F.col("t")).cast("string")))[0] == expected


def test_publish_time_takes_what_a_cast_takes(spark):
    df = spark.createDataFrame([("2024-05-01 10:20:30",), ("nonsense",)], "t string")
    values = [r[0] for r in df.select(parse_publish_time(F.col("t")).cast("string")).collect()]
    assert values == ["2024-05-01 10:20:30", None]


def test_numbers(spark):
    df = spark.createDataFrame([("1,234,567", 3), ("12.5", 4), ("x", 5), (None, None)], "a string, b int")
    rows = df.select(clean_number(df, "a"), clean_number(df, "b")).collect()
    assert [tuple(r) for r in rows] == [(1234567.0, 3.0), (12.5, 4.0), (None, 5.0), (None, None)]


def test_country_names_are_trimmed_of_all_whitespace(spark):
    df = spark.createDataFrame([(" viet nam\t\n",), (None,)], "c string")
    assert [r[0] for r in df.select(normalize_country(F.col("c"))).collect()] == ["VIET NAM", None]


def test_aliases_defaults_and_extras(spark):
    df = raw(spark, ("a", "2024-05-01T00:00:00Z", "2024-05-02", "1,000", "5", "1")).withColumn("extra", F.lit(7))
    row = one(rename_aliases(df))
    assert (row["view_count"], row["country"], row["categoryId"], row["title"], row["extra"]) == ("1,000", "UNKNOWN", "0", "", 7)


def test_two_spellings_of_one_column_are_merged(spark):
    df = raw(
        spark, ("a", None, "2024-05-01T00:00:00Z"), ("b", "2024-06-01T00:00:00Z", "2024-05-01T00:00:00Z"),
        ddl="video_id string, publish_date string, publishedAt string",
    ).withColumns({c: F.lit("1") for c in ("trending_date", "views", "likes", "comment_count")})
    assert [r["publish_date"] for r in rename_aliases(df).orderBy("video_id").collect()] == [
        "2024-05-01T00:00:00Z", "2024-06-01T00:00:00Z",
    ]


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match=r"\['publish_date', 'likes'\]"):
        rename_aliases(spark.createDataFrame([("a", "b", "1", "2")], "video_id string, trending_date string, views string, comment_count string"))


def test_rows_that_cannot_be_placed_are_dropped(spark):
    good = ("a", "2024-05-01T00:00:00Z", "2024-05-02", "1", "1", "1")
    df = raw(spark, good, (None, *good[1:]), ("b", "", *good[2:]), ("c", good[1], "soon", *good[3:]))
    assert [r["video_id"] for r in standardize(df).collect()] == ["a"]


def test_typed_columns_are_taken_as_they_are(spark):
    df = spark.sql(
        "SELECT 'a' video_id, timestamp'2024-05-01 01:02:03' publish_date, date'2024-05-02' trending_date,"
        " 10L view_count, 3 likes, 1.5D comment_count"
    )
    row = one(standardize(df))
    assert row["trending_date_parsed"] == dt.date(2024, 5, 2)
    assert row["publish_timestamp"] == dt.datetime(2024, 5, 1, 1, 2, 3)
    assert (row["view_count"], row["likes"], row["comment_count"]) == (10.0, 3.0, 1.5)


def test_the_larger_of_two_snapshots_of_a_day_is_kept(spark):
    base = ("a", "2024-05-01T00:00:00Z", "2024-05-02")
    df = raw(spark, (*base, "10", "1", "1"), (*base, "1,000", "1", "1"), (*base, "x", "9", "9"))
    assert one(standardize(df))["view_count"] == 1000.0


def test_choice_among_equal_snapshots_does_not_depend_on_layout(spark):
    base = ("a", "2024-05-01T00:00:00Z", "2024-05-02", "10", "1", "1")
    rows = [(*base, f"title {i}") for i in range(50)]
    df = raw(spark, *rows, ddl=RAW + ", title string")
    picks = {one(standardize(df.repartition(n)))["title"] for n in (1, 3, 7)}
    assert len(picks) == 1


def test_losers_are_dropped_before_the_shuffle(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 3)
    plan = executed(deduplicate(df, ["k"], prefer=[F.col("id")]))
    assert plan.index("Final") < plan.index("Exchange hashpartitioning") < plan.index("Partial")


def test_standardize_has_one_exchange_and_no_python(spark):
    df = standardize(raw(spark, ("a", "b", "c", "1", "1", "1")))
    assert hash_exchanges(df) == 1
    assert not runs_python(df)


def test_cells_are_parsed_once(spark, tmp_path):
    path = str(tmp_path / "raw")
    raw(spark, ("a", "2024-05-01T00:00:00Z", "2024-05-02", "1", "1", "1")).write.parquet(path)
    plan = executed(standardize(spark.read.parquet(path)))
    assert plan.count("'T'HH:mm:ssX") == 1
    assert "IsNotNull(video_id)" in plan


def test_sanity(spark):
    df = spark.createDataFrame(
        [("ok", 5.0, 5.0, 0.0), ("likes", 4.0, 5.0, 0.0), ("neg", 4.0, 1.0, -1.0), ("null", 4.0, None, 0.0)],
        "id string, view_count double, likes double, comment_count double",
    )
    assert [r["id"] for r in sane_counts(df).collect()] == ["ok"]


def test_counts_and_guards(spark):
    df = spark.range(10)
    row = one(row_counts(df, all_rows=F.lit(True), even=F.col("id") % 2 == 0, none=F.lit(None).cast("boolean")))
    assert tuple(row) == (10, 5, 0)
    assert not is_empty(df)
    with pytest.raises(ValueError, match="nothing"):
        require_rows(df.filter("id > 99"), "nothing here")


def test_type_columns_never_fail_under_ansi(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    row = one(type_columns(rename_aliases(raw(spark, ("a", "??", "??", "??", "??", "??")))))
    assert row["view_count"] is row["publish_timestamp"] is row["trending_date_parsed"] is None


def test_garbage_is_no_number(spark):
    cells = ["NaN", "Infinity", "-Infinity", "5d", "5f", "0x1", "1e999", "", " ", None, "1,000", " 7 ", "1e3", "-1", ".5"]
    df = spark.createDataFrame([(c, float("nan")) for c in cells], "a string, b double")
    rows = df.select(clean_number(df, "a").alias("a"), clean_number(df, "b").alias("b")).collect()
    assert [r.a for r in rows] == [None] * 10 + [1000.0, 7.0, 1000.0, -1.0, 0.5] and {r.b for r in rows} == {None}


def test_columns_in_another_order_are_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("video_id,likes,view_count\nv,1,10\n")
    (tmp_path / "b.csv").write_text("video_id,view_count,likes\nv,200,2\n")
    with pytest.raises(Exception, match="header"):
        read_snapshot_csv(spark, str(tmp_path)).collect()
    assert read_snapshot_csv(spark, str(tmp_path / "a.csv")).count() == 1
    assert read_snapshot_csv(spark, str(tmp_path / "a.csv")).select("view_count").first()[0] == "10"


def test_a_typed_date_still_prunes_partitions(spark, tmp_path):
    rows = [("v", "2024-01-01T00:00:00Z", dt.date(2024, 1, d), "10", "1", "1") for d in (1, 2, 3)]
    ddl = "video_id string, publish_date string, trending_date date, view_count string, likes string, comment_count string"
    spark.createDataFrame(rows, ddl).write.partitionBy("trending_date").parquet(str(tmp_path / "t"))
    typed = type_columns(rename_aliases(spark.read.parquet(str(tmp_path / "t")))).filter(F.col("trending_date_parsed") > dt.date(2024, 1, 2))
    assert typed.count() == 1
    plan = executed(typed)
    assert "PartitionFilters: []" not in plan and "2024-01-02" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_rejects_are_counted_by_cause(spark):
    good = ("v", "2024-01-01T00:00:00Z", "2024-01-02", "10", "1", "0")
    changed = [{}, {0: None}, {1: "?"}, {2: "?"}, {3: "NaN"}, {5: "-1"}, {4: "11"}, {0: None, 4: "11"}]
    rows = [tuple(change.get(i, cell) for i, cell in enumerate(good)) for change in changed]
    counted = type_columns(rename_aliases(raw(spark, *rows))).agg(*cleaning_counts()).first().asDict()
    assert counted == {"raw_rows": 8, "no_id": 2, "no_publish_time": 1, "no_date": 1, "no_count": 1, "negative_count": 1, "liked_beyond_views": 2}
