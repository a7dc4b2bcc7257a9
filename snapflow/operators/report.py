"""Summaries of scored rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.features import hotness_tier

METRICS: tuple[str, ...] = ("views", "likes", "comments", "predicted_trending_days")


def _number(df: DataFrame, name: str) -> Column:
    return F.col(name).try_cast("double") if name in df.columns else F.lit(None).cast("double")


def prediction_fields(df: DataFrame, zero_views_is_missing: bool = False) -> DataFrame:
    """Settle the prediction and the views of rows whose producers name them differently.

    Prediction: ``predicted_trending_days``, else ``prediction``, else 0.  Views: ``views``, else
    ``view_count``, else 0; ``zero_views_is_missing`` lets ``view_count`` replace 0 views too.
    """
    views = _number(df, "views")
    if zero_views_is_missing:
        views = F.nullif(views, F.lit(0.0))
    return df.withColumns(
        {
            "predicted_trending_days": F.coalesce(
                _number(df, "predicted_trending_days"), _number(df, "prediction"), F.lit(0.0)
            ),
            "views": F.coalesce(views, _number(df, "view_count"), F.lit(0.0)),
        }
    )


def metric_points(df: DataFrame, time_col: str = "prediction_time") -> DataFrame:
    """One chart point per scored row."""
    settled = prediction_fields(df, zero_views_is_missing=True)
    video_id = F.coalesce(F.col("video_id"), F.lit("Unknown")) if "video_id" in df.columns else F.lit("Unknown")
    return settled.select(
        F.col(time_col).alias("timestamp"),
        "views",
        F.coalesce(_number(df, "likes"), F.lit(0.0)).alias("likes"),
        F.coalesce(_number(df, "comment_count"), F.lit(0.0)).alias("comments"),
        "predicted_trending_days",
        video_id.alias("video_id"),
    )


def metric_summary(df: DataFrame, metrics: Sequence[str] = METRICS) -> DataFrame:
    """Mean, max, min and sample standard deviation, one row per metric.

    All metrics are aggregated side by side in one pass; only the one-row result is turned.
    """
    measures = {"mean": F.avg, "max": F.max, "min": F.min, "stddev": F.stddev_samp}
    row = df.agg(
        *[fn(m).cast("double").alias(f"{name}_{i}") for i, m in enumerate(metrics) for name, fn in measures.items()]
    )
    lines = [
        F.struct(F.lit(m).alias("metric"), *[F.col(f"{name}_{i}").alias(name) for name in measures])
        for i, m in enumerate(metrics)
    ]
    return row.select(F.inline(F.array(*lines)))


def kpi_row(df: DataFrame, metrics: Sequence[str] = METRICS) -> DataFrame:
    """Mean of each metric and the number of points."""
    return df.agg(*[F.avg(m).alias(f"avg_{m}") for m in metrics], F.count("*").alias("points"))


def histogram(df: DataFrame, metrics: Sequence[str] = METRICS, bins: int = 20) -> DataFrame:
    """``bins`` equal-width bins per metric, empty ones included; the maximum falls in the last bin.

    Bounds of all metrics come from one pass and enter the second as scalars.  The second pass
    counts on (metric, bin), at most ``len(metrics) * bins`` groups per task before the shuffle,
    and so is the table of all bins that the counts are joined to.
    """
    # What is not a number has no bin and must not become a bound.
    df = df.select(*[F.nanvl(F.col(m).cast("double"), F.lit(None).cast("double")).alias(m) for m in metrics])
    ends = {m: (f"_lo_{i}", f"_hi_{i}") for i, m in enumerate(metrics)}
    bounds = df.agg(
        *[F.min(m).alias(lo) for m, (lo, _) in ends.items()],
        *[F.max(m).alias(hi) for m, (_, hi) in ends.items()],
    )
    limits = bounds.select(F.struct("*").alias("limits")).scalar()

    def bin_of(m: str) -> Column:
        lo, hi = (limits.getField(name) for name in ends[m])
        spread = hi - lo
        place = F.floor((F.col(m) - lo) / spread * bins)
        last = F.lit(bins - 1).cast("long")
        return F.when(F.col(m).isNotNull(), F.when(spread > 0, F.least(place, last)).otherwise(F.lit(0).cast("long")))

    placed = df.select(*[bin_of(m).alias(m) for m in metrics])
    counts = (
        placed.unpivot([], list(metrics), "metric", "bin")
        .filter(F.col("bin").isNotNull())
        .groupBy("metric", "bin")
        .agg(F.count("*").alias("n"))
    )
    grid = bounds.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(m).alias("metric"), F.col(lo).alias("lo"), F.col(hi).alias("hi"))
                    for m, (lo, hi) in ends.items()
                ]
            )
        )
    ).select("metric", "lo", "hi", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(bins - 1).cast("long"))).alias("bin"))
    width = (F.col("hi") - F.col("lo")) / bins
    return grid.join(counts, ["metric", "bin"], "left").select(
        "metric",
        "bin",
        (F.col("lo") + F.col("bin") * width).alias("bin_start"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("bin_end"),
        F.coalesce("n", F.lit(0).cast("long")).alias("n"),
    )


def engagement_percent(df: DataFrame, metrics: Sequence[str] = METRICS[:3]) -> DataFrame:
    """Each metric as percent of its maximum in ``<metric>_pct``; a maximum of 0 counts as 1.

    The maxima are scalar subqueries, not a window over everything, so no rows are moved.
    """
    maxima = df.agg(F.struct(*[F.max(m).cast("double").alias(m) for m in metrics]).alias("maxima")).scalar()

    def percent(m: str) -> Column:
        top = F.coalesce(F.nullif(maxima.getField(m), F.lit(0.0)), F.lit(1.0))
        return F.col(m) / top * 100

    return df.withColumns({f"{m}_pct": percent(m) for m in metrics})


def latest(df: DataFrame, n: int, time_col: str = "timestamp", ties: Sequence[str] = ()) -> DataFrame:
    """The newest ``n`` rows, newest first."""
    return df.orderBy(F.col(time_col).desc(), *[F.col(t).desc() for t in ties]).limit(n)


def latest_feed(
    df: DataFrame, n: int = 10, time_col: str = "prediction_time", ties: Sequence[str] = (), hot: float = 7.0
) -> DataFrame:
    """The newest predictions with tier and days rounded to one place."""
    days = F.col("predicted_trending_days")
    newest = latest(prediction_fields(df), n, time_col, ties)
    return newest.withColumns({"tier": hotness_tier(days, hot=hot), "days": F.round(days, 1)})


def timeline(df: DataFrame, time_col: str = "timestamp", ties: Sequence[str] = ()) -> DataFrame:
    """Points in order of time."""
    return df.orderBy(time_col, *ties)
