"""CSV and parquet tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_snapshot_csv(
    spark: SparkSession, path: str | list[str], columns: Sequence[str] | None = None, multi_line: bool = True
) -> DataFrame:
    """Raw snapshots: header row, every cell a string or null if empty, quotes doubled inside quotes.

    ``columns`` names the columns up front and saves the look at the header.  ``multi_line`` reads
    quoted line breaks but makes each file one task: convert such files once with
    :func:`csv_to_parquet`, or switch it off where texts hold none and files are split.  A file whose
    header names other columns, or the same in another order, is an error: read it apart and union by name.
    """
    reader = spark.read.options(
        header=True, quote='"', escape='"', mode="PERMISSIVE", inferSchema=False, multiLine=multi_line, enforceSchema=False
    )
    if columns is not None:
        reader = reader.schema(T.StructType([T.StructField(name, T.StringType()) for name in columns]))
    return reader.csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV that :func:`read_snapshot_csv` reads back unchanged, but that empty texts become null."""
    (
        df.write.mode("overwrite")
        .options(
            header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        )
        .csv(path)
    )


def read_episode_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), compression: str = "snappy") -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path, compression=compression)


def csv_to_parquet(spark: SparkSession, source: str | list[str], target: str, multi_line: bool = True) -> None:
    write_parquet(read_snapshot_csv(spark, source, multi_line=multi_line), target)
