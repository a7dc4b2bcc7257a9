"""Partial aggregates that merge: counts, sums, spreads, bounds and histograms kept up to date batch by batch.

A row stands for the values of a metric in one bin.  Bins are 2**level wide and start at multiples of their width, so two
neighbouring bins of a level are one bin of the next: partials of different levels merge by shifting the finer
ones, without the values.  The level is the smallest at which the values between the bounds fall into ``bins`` bins, so
it only ever grows, and merging partials gives the rows that all values at once would give.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .report import METRICS

BINS = 64
LEVELS = (-20, 1023)  # narrowest bins, and those that hold every double

PARTIALS = "metric string, level int, bin bigint, n bigint, total double, spread double, low double, high double"


def _width(level: Column) -> Column:
    return F.pow(F.lit(2.0), level)


def _bin(value: Column, level: Column) -> Column:
    return F.floor(value / _width(level))


def bin_level(low: Column, high: Column, bins: int = BINS) -> Column:
    """The smallest level at which the range from low to high touches at most so many bins."""
    levels = F.sequence(F.lit(LEVELS[0]), F.lit(LEVELS[1]))
    return F.get(F.filter(levels, lambda k: _bin(high, k) - _bin(low, k) < bins), F.lit(0))


def _grouped(rows: DataFrame) -> DataFrame:
    """Rows of the same metric and bin as one: sums of squares are taken around the mean of the whole bin."""
    same = Window.partitionBy("metric", "level", "bin")
    mean = F.sum("total").over(same) / F.sum("n").over(same)
    moved = F.col("spread") + F.col("n") * F.pow(F.col("total") / F.col("n") - F.col("mean"), F.lit(2))
    return rows.withColumn("mean", mean).groupBy("metric", "level", "bin").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum(moved).alias("spread"), F.min("low").alias("low"), F.max("high").alias("high")
    )


def partials(df: DataFrame, metrics: Sequence[str] = METRICS, bins: int = BINS) -> DataFrame:
    """The partials of a table; null and what is not a number is left out.

    The bounds of all metrics come from one pass and enter the second as scalars; at most ``bins`` rows a metric
    and task are shuffled.
    """
    df = df.select(*[F.nanvl(F.col(m).cast("double"), F.lit(None).cast("double")).alias(m) for m in metrics])
    limits = df.agg(F.struct(*[bin_level(F.min(m), F.max(m), bins).alias(m) for m in metrics]).alias("levels")).scalar()
    long = df.unpivot([], list(metrics), "metric", "value").filter(F.col("value").isNotNull())
    level = F.coalesce(*[F.when(F.col("metric") == m, limits.getField(m)) for m in metrics])
    placed = long.withColumn("level", level).withColumn("bin", _bin(F.col("value"), F.col("level")))
    return placed.groupBy("metric", "level", "bin").agg(
        F.count("*").alias("n"), F.sum("value").alias("total"), (F.var_pop("value") * F.count("*")).alias("spread"),
        F.min("value").alias("low"), F.max("value").alias("high"),
    )


def merged(parts: DataFrame, bins: int = BINS) -> DataFrame:
    """The partials of all values behind several partials, at one level per metric."""
    of_metric = Window.partitionBy("metric")
    level = bin_level(F.min("low").over(of_metric), F.max("high").over(of_metric), bins)
    # a shift to the right rounds down, as bins do, below zero too
    moved = parts.withColumn("to", level).withColumn("bin", F.expr("shiftright(bin, `to` - level)"))
    return _grouped(moved.drop("level").withColumnRenamed("to", "level"))


def summary_of(parts: DataFrame) -> DataFrame:
    """Mean, max, min, sample standard deviation and number of values, one row per metric, as of all values."""
    whole = _grouped(parts.withColumns({"bin": F.lit(0).cast("bigint"), "level": F.lit(0)}))
    return whole.select(
        "metric", (F.col("total") / F.col("n")).alias("mean"), F.col("high").alias("max"), F.col("low").alias("min"),
        F.when(F.col("n") > 1, F.sqrt(F.col("spread") / (F.col("n") - 1))).alias("stddev"), "n",
    )


def histogram_of(parts: DataFrame, bins: int = BINS) -> DataFrame:
    """Bins that hold values, with their bounds."""
    width = _width(F.col("level"))
    found = merged(parts, bins)
    return found.select("metric", "bin", (F.col("bin") * width).alias("bin_start"), ((F.col("bin") + 1) * width).alias("bin_end"), "n")
