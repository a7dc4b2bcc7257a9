"""Landed pages of a listing API -> snapshot rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.features import join_tags
from ..functions.parse import text_or_default
from ..operators.standardize import deduplicate
from ..schemas import PAGE_SCHEMA


def flatten_pages(
    pages: DataFrame,
    value_col: str = "value",
    region_col: str = "region_code",
    page_order: Sequence[str] = ("page_no",),
    *,
    fetch_keys: Sequence[str],
    region: str | None = None,
    category_id: str | None = None,
) -> DataFrame:
    """One row per listed item.

    Items without an id or without any of the three statistics are left out.  An item listed twice
    in a fetch keeps its first complete listing, by page and place; ``fetch_keys`` name the columns
    that tell fetches apart.
    """
    if region is not None:
        pages = pages.filter(F.col(region_col) == region)
    carried = list(dict.fromkeys([*fetch_keys, region_col, *page_order]))
    listed = pages.select(
        *carried, F.posexplode(F.from_json(F.col(value_col).cast("string"), PAGE_SCHEMA)["items"]).alias("place", "item")
    )
    snippet, statistics = F.col("item.snippet"), F.col("item.statistics")
    views = statistics["viewCount"].try_cast("double")
    rows = listed.select(
        *carried,
        "place",
        F.col("item.id").alias("video_id"),
        text_or_default(snippet["title"]).alias("title"),
        text_or_default(snippet["description"]).alias("description"),
        text_or_default(snippet["publishedAt"]).alias("publish_time"),
        join_tags(F.from_json(snippet["tags"], "array<string>")).alias("tags"),
        views.alias("views"),
        views.alias("view_count"),
        statistics["likeCount"].try_cast("double").alias("likes"),
        statistics["commentCount"].try_cast("double").alias("comment_count"),
        F.col(region_col).alias("country"),
        snippet["categoryId"].alias("categoryId"),
    ).filter(
        (F.col("video_id") != "")
        & F.col("views").isNotNull()
        & F.col("likes").isNotNull()
        & F.col("comment_count").isNotNull()
    )
    if category_id is not None:
        rows = rows.filter(F.col("categoryId") == category_id)
    return deduplicate(
        rows, [*fetch_keys, "video_id"], prefer=[*[F.col(name) for name in page_order], F.col("place")]
    )


def cap_results(rows: DataFrame, limit: int, order: Sequence[str] = ("page_no", "place")) -> DataFrame:
    """The first ``limit`` rows in listing order."""
    if limit < 0:
        raise ValueError(f"limit must not be negative: {limit}")
    return rows.orderBy(*order).limit(limit)
