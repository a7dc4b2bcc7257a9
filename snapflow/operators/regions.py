"""Keeping the rows of a set of countries."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parse import normalize_country

# --- fixed values: Asia-Pacific countries kept by default ---
ASIA_PACIFIC: tuple[str, ...] = (
    "AUSTRALIA", "BANGLADESH", "HONG KONG", "INDIA", "INDONESIA", "JAPAN", "MALAYSIA", "NEPAL",
    "NEW ZEALAND", "PAKISTAN", "PHILIPPINES", "SINGAPORE", "SOUTH KOREA", "SRI LANKA", "TAIWAN",
    "THAILAND", "VIETNAM",
)

# --- fixed values: words that mark a country column, best first ---
COUNTRY_WORDS: tuple[str, ...] = ("video_trending_country", "trending_country", "country", "region", "location")


def find_country_column(columns: Sequence[str]) -> str | None:
    """The first column that contains the best word, ignoring case."""
    hits = (name for word in COUNTRY_WORDS for name in columns if word in name.lower())
    return next(hits, None)


def _country_column(df: DataFrame, column: str | None) -> str:
    name = column or find_country_column(df.columns)
    if name is None:
        raise ValueError(f"No country column among {df.columns}")
    return name


def filter_regions(
    df: DataFrame, countries: Iterable[str] | DataFrame = ASIA_PACIFIC, column: str | None = None
) -> DataFrame:
    """Rows whose country, trimmed and in capitals, is one of ``countries``; all columns are kept.

    A list becomes an ``IN`` filter.  For a set too big to write down give a one-column DataFrame
    of normalised names: it becomes a left-semi join whose strategy Spark picks by size.
    """
    country = normalize_country(F.col(_country_column(df, column)))
    if isinstance(countries, DataFrame):
        names = countries.toDF("_country").distinct()
        return df.join(names, country == names["_country"], "left_semi")
    return df.filter(country.isin(*countries))


def report_columns(df: DataFrame, countries: Sequence[str], column: str | None) -> list[Column]:
    country = normalize_country(F.col(_country_column(df, column)))
    kept = F.coalesce(country.isin(*countries), F.lit(False))
    return [
        F.count("*").alias("scanned_rows"),
        F.count_if(kept).alias("kept_rows"),
        F.array_sort(F.collect_set(F.when(kept, country))).alias("kept_countries"),
    ]


def extraction_report(
    df: DataFrame, countries: Sequence[str] = ASIA_PACIFIC, column: str | None = None
) -> DataFrame:
    """Rows scanned, rows kept and the sorted countries kept, in one pass; the set is at most ``countries``."""
    return df.agg(*report_columns(df, countries, column))
