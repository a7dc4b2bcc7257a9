"""Cutting a regional table out of the raw snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation

from ..operators.regions import ASIA_PACIFIC, filter_regions, report_columns
from ..sources.tables import write_csv


def extract_regions(
    df: DataFrame, target: str, countries: Sequence[str] = ASIA_PACIFIC, column: str | None = None
) -> dict:
    """Write the rows of ``countries`` as CSV and return rows scanned, rows kept and countries kept.

    One scan gives both: the job has no shuffle, so what is observed while it writes is exact even
    when tasks are run again.
    """
    report = Observation("extraction")
    watched = df.observe(report, *report_columns(df, countries, column))
    write_csv(filter_regions(watched, countries, column), target)
    return report.get
