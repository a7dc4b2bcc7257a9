"""The test tables, dressed as the inputs the library expects."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CUTOFF = date(2024, 1, 24)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stream_of(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same table as a file stream."""
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their day: user = item, event type = country."""
    return table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))


RAW_SNAPSHOT = (
    "event_id",
    "CASE WHEN event_id % 503 = 0 THEN NULL ELSE CAST(user_id AS STRING) END AS video_id",
    "event_type AS video_trending_country",
    "CAST(user_id % 15 AS STRING) AS video_category_id",
    "CASE WHEN event_id % 401 = 0 THEN 'garbage'"
    " WHEN event_id % 4 = 0 THEN date_format(ts, 'yyyy.MM.dd')"
    " WHEN event_id % 4 = 1 THEN date_format(ts, 'yyyy-MM-dd')"
    " WHEN event_id % 4 = 2 THEN date_format(ts, 'yy.dd.MM')"
    " ELSE date_format(ts, 'MM/dd/yyyy') END AS video_trending__date",
    "CASE WHEN event_id % 307 = 0 THEN ''"
    " WHEN event_id % 311 = 1 THEN date_format(ts - make_dt_interval(0, CAST((event_id * 7) % 200 AS INT)),"
    " \"yyyy-MM-dd'T'HH:mm:ss.SSS'Z'\")"
    " WHEN event_id % 313 = 2 THEN date_format(ts - make_dt_interval(0, CAST((event_id * 7) % 200 AS INT) - 7),"
    " \"yyyy-MM-dd'T'HH:mm:ss'+07:00'\")"
    " ELSE date_format(ts - make_dt_interval(0, CAST((event_id * 7) % 200 AS INT)), \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"
    " END AS video_published_at",
    "CASE WHEN event_id % 613 = 1 THEN 'NaN' WHEN event_id % 617 = 1 THEN 'Infinity' WHEN event_id % 619 = 1 THEN '5d'"
    " WHEN event_id % 631 = 1 THEN '5e7' ELSE format_number(CAST(round(value * 100) AS BIGINT) * 10, 0) END AS video_view_count",
    "CAST(CAST(round(value * 100) AS BIGINT) * (event_id % 120) DIV 10 AS STRING) AS video_like_count",
    "CAST(CASE WHEN event_id % 211 = 0 THEN -1 ELSE CAST(round(value * 100) AS BIGINT) % 97 END AS STRING)"
    " AS video_comment_count",
    "concat('video ', CAST(user_id AS STRING)) AS video_title",
    "CASE WHEN event_id % 7 = 0 THEN NULL ELSE repeat(event_type, CAST(event_id % 4 AS INT)) END AS video_description",
    "CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'a' WHEN 3 THEN 'a | b' ELSE 'a|b||c' END"
    " AS video_tags",
)


# One generated row per event: the cells are made once, as if read from a file, and not again in
# every filter on them.
RAW_CELLS = f"inline(array(struct({', '.join(RAW_SNAPSHOT)})))"


def raw_snapshots(events: DataFrame) -> DataFrame:
    """Events as dirty raw snapshots: text cells, odd column names, four date formats, three spellings of times, numbers that
    are none, gaps and nulls."""
    return events.selectExpr(RAW_CELLS)


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_snapshots(table(spark, sf_dir, "events"))


def preference() -> list:
    """Which of several snapshots of a day is kept; the event id settles ties."""
    return [*[F.col(c).desc_nulls_last() for c in ("view_count", "likes", "comment_count")], F.col("event_id")]


def messages(events: DataFrame) -> DataFrame:
    """Events as the JSON messages of a live feed, some of them broken; ``ts`` is the broker's time."""
    dressed = events.selectExpr("ts", RAW_CELLS)
    plain = F.regexp_replace("video_view_count", ",", "")
    views = F.when(plain.rlike("^[0-9e]+$"), plain).cast("double")
    payload = F.to_json(
        F.struct(
            F.coalesce("video_id", F.lit("  ")).alias("video_id"),
            F.col("video_title").alias("title"),
            F.col("video_description").alias("description"),
            F.col("video_published_at").alias("publish_time"),
            F.col("video_tags").alias("tags"),
            F.when(F.col("event_id") % 3 > 0, F.col("video_view_count")).alias("views"),  # a number as text
            F.when(F.col("event_id") % 3 < 2, views).alias("view_count"),
            F.when(F.col("event_id") % 13 > 0, F.col("video_like_count").cast("double")).alias("likes"),
            F.col("video_comment_count").cast("double").alias("comment_count"),
            F.col("video_trending_country").alias("country"),
            F.col("video_category_id").alias("categoryId"),
        )
    )
    value = F.when(F.col("event_id") % 97 == 5, F.lit("{bad")).otherwise(payload).cast("binary")
    return dressed.select(F.col("ts").cast("timestamp").alias("ts"), "event_id", value.alias("value"))


def prediction_messages(events: DataFrame) -> DataFrame:
    """Events as published predictions, with the field names varying between producers."""
    e = F.col("event_id")
    days_ahead = F.floor("value") / 4
    views = F.round(F.col("value") * 1000)
    payload = F.to_json(
        F.struct(
            F.col("user_id").cast("string").alias("video_id"),
            F.col("event_type").alias("country"),
            F.when(e % 4 > 0, F.when(e % 4 == 1, F.lit(0.0)).otherwise(views)).alias("views"),
            views.alias("view_count"),
            F.round(F.col("value") * 7).alias("likes"),
            F.when(e % 5 > 0, F.round(F.col("value"))).alias("comment_count"),
            F.when(e % 3 > 0, days_ahead).alias("predicted_trending_days"),
            F.when(e % 3 < 2, days_ahead).alias("prediction"),
        )
    )
    return events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), payload.alias("value"))


# --- fixed values: countries given to the 25 nations by key, 17 of them in the default set ---
NATION_COUNTRIES: tuple[str, ...] = (
    "Vietnam", "Thailand", "Indonesia", "Malaysia", "Philippines",
    "Singapore", "Japan", "South Korea", "Hong Kong", "Taiwan",
    "India", "Pakistan", "Bangladesh", "Sri Lanka", "Nepal",
    "Australia", "New Zealand", "Germany", "France", "Brazil",
    "Canada", "Egypt", "Kenya", "Peru", "Spain",
)


def located_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with an untidy country name."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    names = F.array(*[F.lit(name) for name in NATION_COUNTRIES])
    country = F.concat(F.lit(" "), F.lower(F.get(names, F.col("n_nationkey"))), F.lit("\t"))
    places = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", "r_name", country.alias("Trending_Country")
    )
    customers = table(spark, sf_dir, "customer")
    return customers.join(places, customers.c_nationkey == places.n_nationkey).select(
        "c_custkey", "c_acctbal", "r_name", "Trending_Country"
    )


def api_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page of three items per conversation turn: one repeated by the next turn, one whose
    statistics are incomplete in the first turn, one without an id.  Two regions list the same ids."""
    statistics = F.struct(
        F.length("text").cast("string").alias("viewCount"),
        (F.col("turn") * 3).cast("string").alias("likeCount"),
        F.lit("4").alias("commentCount"),
    )
    snippet = F.struct(
        F.col("role").alias("title"),
        F.col("text").alias("description"),
        F.lit("2024-01-01T00:00:00Z").alias("publishedAt"),
        (F.col("conv_id") % 9).cast("string").alias("categoryId"),
        F.when(F.col("turn") % 3 > 0, F.array(F.col("role"), F.lit("t x"))).alias("tags"),
    )

    def item(video_id, stats):
        return F.struct(video_id.alias("id"), snippet.alias("snippet"), stats.alias("statistics"))

    shared = F.floor(F.col("conv_id") / 2)
    pair = F.concat(F.lit("p"), shared, F.lit("-"), F.floor(F.col("turn") / 2))
    late = F.struct(
        statistics["viewCount"].alias("viewCount"),
        F.when(F.col("turn") > 0, statistics["likeCount"]).alias("likeCount"),
        statistics["commentCount"].alias("commentCount"),
    )
    items = F.array(item(pair, statistics), item(F.concat(F.lit("c"), shared), late), item(F.lit(""), statistics))
    return table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        F.when(F.col("conv_id") % 2 == 0, "VN").otherwise("TH").alias("region_code"),
        F.to_json(F.struct(items.alias("items"), F.lit("next").alias("nextPageToken"))).alias("value"),
    )


def arriving(spark: SparkSession, parts: list[DataFrame], path: str) -> None:
    """One file per part, in order of time, below what may be there already."""
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(path)


def file_by_file(spark: SparkSession, path: str) -> DataFrame:
    """A stream whose micro-batches are the files of a folder, the oldest first."""
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
