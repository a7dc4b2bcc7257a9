import json

import pytest
from plans import runs_python
from pyspark.sql import functions as F
from snapflow.operators.regions import ASIA_PACIFIC, extraction_report, filter_regions, find_country_column
from snapflow.plans.extract import extract_regions
from snapflow.sources.pages import cap_results, flatten_pages
from snapflow.sources.tables import csv_to_parquet, read_episode_table, read_snapshot_csv, write_csv, write_parquet


@pytest.mark.parametrize(
    ("columns", "found"),
    [
        (["id", "Region", "My_Country"], "My_Country"),
        (["region", "video_trending_country__x", "country"], "video_trending_country__x"),
        (["LOCATION"], "LOCATION"),
        (["id", "title"], None),
    ],
)
def test_country_column(columns, found):
    assert find_country_column(columns) == found


@pytest.fixture(scope="module")
def places(spark):
    return spark.createDataFrame([(1, " japan"), (2, "France"), (3, "Viet Nam"), (4, "VIETNAM\t"), (5, None)], "id int, country string")


def test_filter_keeps_all_columns(places):
    kept = filter_regions(places)
    assert kept.columns == places.columns
    assert sorted(r["id"] for r in kept.collect()) == [1, 4]


def test_filter_by_table_equals_filter_by_list(spark, places):
    names = spark.createDataFrame([(n,) for n in (*ASIA_PACIFIC, "JAPAN")], "name string")
    assert filter_regions(places, names).exceptAll(filter_regions(places)).count() == 0
    assert filter_regions(places, names).count() == 2


def test_report(places):
    row = extraction_report(places).first()
    assert (row["scanned_rows"], row["kept_rows"], row["kept_countries"]) == (5, 2, ["JAPAN", "VIETNAM"])


def test_extraction_writes_and_reports_in_one_scan(spark, places, tmp_path):
    report = extract_regions(places, str(tmp_path / "out"))
    assert report == {"scanned_rows": 5, "kept_rows": 2, "kept_countries": ["JAPAN", "VIETNAM"]}
    assert sorted(r["id"] for r in read_snapshot_csv(spark, str(tmp_path / "out")).collect()) == ["1", "4"]


def test_no_country_column(spark):
    with pytest.raises(ValueError, match="No country column"):
        filter_regions(spark.range(1))


def item(video_id, views="1", likes="2", comments="3", **snippet):
    statistics = {"viewCount": views, "likeCount": likes, "commentCount": comments}
    return {
        "id": video_id,
        "snippet": {"title": "t", "description": "line 1\nline 2", "publishedAt": "p", **snippet},
        "statistics": {k: v for k, v in statistics.items() if v is not None},
    }


@pytest.fixture(scope="module")
def pages(spark):
    first = {"items": [item("a", tags=["x", "y"]), item(""), item("b", likes=None), item("c", tags="no list")], "nextPageToken": "n"}
    second = {"items": [item("a", views="99"), item("b", views="7"), {"snippet": {}}, item("d", views=8, categoryId="10")]}
    rows = [("VN", 1, json.dumps(first)), ("VN", 2, json.dumps(second)), ("VN", 3, "{broken"), ("VN", 4, "{}"),
            ("US", 1, json.dumps({"items": [item("z")]}))]
    return spark.createDataFrame(rows, "region_code string, page_no int, value string")


def test_flatten(pages):
    rows = {r["video_id"]: r for r in flatten_pages(pages, fetch_keys=[], region="VN").collect()}
    assert sorted(rows) == ["a", "b", "c", "d"]
    assert (rows["a"]["views"], rows["a"]["view_count"], rows["a"]["tags"]) == (1.0, 1.0, "x|y")
    assert (rows["b"]["views"], rows["c"]["tags"], rows["d"]["views"]) == (7.0, "", 8.0)
    assert (rows["a"]["description"], rows["a"]["country"], rows["d"]["categoryId"]) == ("line 1\nline 2", "VN", "10")


def test_flatten_by_category_and_by_fetch(pages):
    assert [r["video_id"] for r in flatten_pages(pages, fetch_keys=[], category_id="10").collect()] == ["d"]
    assert flatten_pages(pages, fetch_keys=["page_no"], region="VN").count() == 5


def test_flatten_stays_in_the_jvm(pages):
    assert not runs_python(flatten_pages(pages, fetch_keys=[]))


@pytest.mark.parametrize(("asked", "given"), [(0, 0), (10, 10), (250, 250), (500, 300)])
def test_cap(spark, asked, given):
    rows = spark.range(300).select(F.col("id").alias("page_no"), F.lit(0).alias("place"))
    assert cap_results(rows, asked).count() == given


def test_capped_query_returns_every_item(spark, tmp_path):
    from snapflow.catalog import QUERIES

    turns = spark.range(900).selectExpr("id div 4 AS conv_id", "CAST(id % 4 AS INT) AS turn", "'user' AS role", "concat('text ', id) AS text")
    turns.write.parquet(f"{tmp_path}/conversations.parquet")
    listed = QUERIES["api_flatten"](spark, str(tmp_path))
    capped = QUERIES["api_capped"](spark, str(tmp_path))
    assert capped.count() == listed.count() > 500
    assert capped.drop("within_limit").exceptAll(listed).count() == 0
    kept = {r["description"] for r in capped.where("within_limit").collect()}
    beyond = {r["description"] for r in capped.where("NOT within_limit").collect()}
    assert capped.where("within_limit").count() == 500
    place = lambda text: int(text.split()[1])
    assert max(map(place, kept)) <= min(map(place, beyond))


TRICKY = [("1", 'say "hi"'), ("2", "two\nlines"), ("3", " spaced "), ("4", "a,b\\"), ("5", None), ("7", "a\r\nb\rc")]


def test_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "csv")
    df = spark.createDataFrame(TRICKY, "id string, text string")
    write_csv(df, path)
    for back in (read_snapshot_csv(spark, path), read_snapshot_csv(spark, path, columns=["id", "text"])):
        assert sorted(tuple(r) for r in back.collect()) == TRICKY
        assert {t for _, t in back.dtypes} == {"string"}


def test_an_empty_cell_is_null(spark, tmp_path):
    write_csv(spark.createDataFrame([("1", "")], "id string, text string"), str(tmp_path / "csv"))
    assert tuple(read_snapshot_csv(spark, str(tmp_path / "csv")).first()) == ("1", None)


def test_csv_to_parquet(spark, tmp_path):
    write_csv(spark.createDataFrame(TRICKY, "id string, text string"), str(tmp_path / "csv"))
    for _ in range(2):
        csv_to_parquet(spark, str(tmp_path / "csv"), str(tmp_path / "out"))
    assert sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == TRICKY
    assert any(p.name.endswith(".snappy.parquet") for p in (tmp_path / "out").iterdir())


def test_partitioned_parquet(spark, tmp_path):
    path = str(tmp_path / "table")
    write_parquet(spark.range(10).withColumn("k", F.col("id") % 2), path, partition_by=["k"])
    assert read_episode_table(spark, path).filter("k = 1").count() == 5
