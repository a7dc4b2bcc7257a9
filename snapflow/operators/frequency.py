"""Numbering categories by how often they occur, without gathering them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.tables import write_parquet
from ..workspace import new_run_dir


def frequency_index(df: DataFrame, column: str, partitions: int | None = None) -> DataFrame:
    """``column``, n and index (from 0) of every category, the most frequent first, equal ones by name; nulls are left out.

    Categories are dealt to ranges of their rank, numbered within each, and shifted by the sizes of the ranges before: what one
    task or the driver sees is a range or a number per range, never all categories.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("n").desc(), F.col(column)]
    ranged = counts.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id()  # the partition in the high bits, the place in the low 33
    path = new_run_dir(df.sparkSession, "frequencies")
    write_parquet(ranged.select(column, "n", place.alias("place")), path)
    stored = df.sparkSession.read.parquet(path).withColumn("part", F.shiftright("place", 33))
    sizes = stored.groupBy("part").agg(F.count("*").alias("size"))  # a row per range
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    low = F.col("place").bitwiseAND((1 << 33) - 1)
    return stored.join(F.broadcast(offsets), "part").select(column, "n", (F.col("offset") + low).alias("index"))


def indexed(df: DataFrame, column: str, index: DataFrame, output: str) -> DataFrame:
    """``df`` with the index of its category; a null or a category that the index does not know gets the number of categories."""
    known = index.select(F.col(column).alias("_category"), F.col("index").alias("_index"))
    total = index.agg(F.count("*")).scalar()
    return df.join(known, F.col(column) == F.col("_category"), "left").withColumn(output, F.coalesce("_index", total)).drop("_category", "_index")
