"""Raw snapshot rows -> canonical, typed, deduplicated snapshot rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.parse import as_timestamp, finite, parse_date, read_number, with_parsed_columns
from ..schemas import ALIASES, COUNT_COLUMNS, DATE_COLUMN, ITEM_KEYS, OPTIONAL_DEFAULTS, REQUIRED_COLUMNS

SNAPSHOT_KEYS: tuple[str, ...] = (*ITEM_KEYS, DATE_COLUMN)


def rename_aliases(df: DataFrame) -> DataFrame:
    """Give every known spelling its canonical name and add optional columns that are absent.

    If several spellings of one column exist, the first non-null value in the order of
    ``ALIASES`` is taken.  Unknown columns pass through.
    """
    present = set(df.columns)
    found = {name: [s for s in spellings if s in present] for name, spellings in ALIASES.items()}
    missing = [name for name in REQUIRED_COLUMNS if not found[name]]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")

    def canonical(name: str) -> Column:
        spellings = found[name]
        if not spellings:
            return F.lit(OPTIONAL_DEFAULTS[name]).alias(name)
        if len(spellings) == 1:
            return F.col(spellings[0]).alias(name)
        return F.coalesce(*[F.col(s).cast("string") for s in spellings]).alias(name)

    known = {s for spellings in ALIASES.values() for s in spellings}
    return df.select(*[canonical(name) for name in ALIASES], *[c for c in df.columns if c not in known])


def type_columns(df: DataFrame) -> DataFrame:
    """Counts to double, publish time to timestamp, trending date to date; unreadable cells to null.

    Only text is parsed behind the barrier of :func:`with_parsed_columns`: filters on a column that is typed
    already, such as a date the files are partitioned by, still reach the scan.
    """

    def is_text(name: str) -> bool:
        return isinstance(df.schema[name].dataType, T.StringType)

    trending = F.col("trending_date")
    made = {name: (name, read_number(df, name)) for name in COUNT_COLUMNS}
    made["publish_timestamp"] = "publish_date", as_timestamp(df, "publish_date")
    made[DATE_COLUMN] = "trending_date", parse_date(trending) if is_text("trending_date") else trending.cast("date")
    parsed = {name: value for name, (source, value) in made.items() if is_text(source)}
    typed = {name: value for name, (source, value) in made.items() if not is_text(source)}
    read = (with_parsed_columns(df, parsed) if parsed else df).withColumns(typed)
    return read.withColumns({name: finite(F.col(name)) for name in COUNT_COLUMNS})


def identified(df: DataFrame) -> DataFrame:
    """Rows with an id, a publish time and a trending date."""
    return df.filter(
        F.col("video_id").isNotNull() & F.col("publish_timestamp").isNotNull() & F.col(DATE_COLUMN).isNotNull()
    )


def cleaning_counts() -> list[Column]:
    """Counts of typed rows and of those that cleaning rejects, by cause; a row may have several causes."""
    causes = {
        "no_id": F.col("video_id").isNull(),
        "no_publish_time": F.col("publish_timestamp").isNull(),
        "no_date": F.col(DATE_COLUMN).isNull(),
        "no_count": F.greatest(*[F.col(c).isNull() for c in COUNT_COLUMNS]),
        "negative_count": F.least(*COUNT_COLUMNS) < 0,
        "liked_beyond_views": F.col("likes") > F.col("view_count"),
    }
    return [F.count(F.lit(1)).alias("raw_rows"), *[F.count_if(cause).alias(name) for name, cause in causes.items()]]


def default_preference(df: DataFrame) -> list[Column]:
    """Largest counts first; a hash of the whole row settles the rest, so the choice never varies."""
    plain = [c for c in df.columns if not isinstance(df.schema[c].dataType, (T.MapType, T.VariantType))]
    return [*[F.col(c).desc_nulls_last() for c in COUNT_COLUMNS if c in df.columns], F.xxhash64(*plain)]


def deduplicate(
    df: DataFrame, keys: Sequence[str] = SNAPSHOT_KEYS, prefer: Sequence[Column] | None = None
) -> DataFrame:
    """One row per key: the first in the order ``prefer``.

    Spark drops the losers before the shuffle as well as after it (``WindowGroupLimit``), so a key
    that holds most of the rows sends one row per input split.
    """
    order = list(prefer) if prefer is not None else default_preference(df)
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def standardize(
    df: DataFrame, prefer: Sequence[Column] | None = None, co_locate: bool = False, report: Observation | None = None
) -> DataFrame:
    """Rename, type, reject rows that cannot be placed, keep one row per (item, country, day).

    ``co_locate`` brings all rows of an item together first, so that forming its episodes later
    needs no exchange of its own.  Only use it where an item has few snapshots per day: nothing is
    thinned before that exchange, and all rows of an item go to one task.  ``report`` receives
    :func:`cleaning_counts` on the way.
    """
    typed = type_columns(rename_aliases(df))
    placed = identified(typed if report is None else typed.observe(report, *cleaning_counts()))
    return deduplicate(placed.repartition(*ITEM_KEYS) if co_locate else placed, prefer=prefer)


LATE_COLUMNS: tuple[str, ...] = ("title", "description", "tags")


def standardize_files(
    raw: DataFrame, prefer: Sequence[Column] | None = None, late: Sequence[str] = LATE_COLUMNS, report: Observation | None = None
) -> DataFrame:
    """Same rows as :func:`standardize`, for a table read straight from parquet files with long texts.

    Duplicates are settled on narrow rows that know the file and place they came from; the texts named in ``late`` are
    read in a second scan and join the winners by that place.  They are shuffled once and never sorted, and those of
    losers go no further than the scan's own task.  ``prefer`` must not look at them.
    """
    origin = {"_file": F.col("_metadata.file_path"), "_row": F.col("_metadata.row_index")}
    located = rename_aliases(raw.select("*", *[place.alias(name) for name, place in origin.items()]))
    typed = type_columns(located)
    placed = identified(typed if report is None else typed.observe(report, *cleaning_counts()))
    if prefer is None:
        # the hash that settles ties is taken while the whole row is at hand
        plain = default_preference(placed.drop(*origin))
        placed = placed.withColumn("_tie", plain[-1])
        prefer = [*plain[:-1], F.col("_tie")]
    winners = deduplicate(placed.drop(*late), prefer=prefer).drop("_tie")
    texts = located.select(*late, *origin)
    columns = [c for c in typed.columns if c not in origin]
    return texts.join(winners.hint("shuffle_hash"), list(origin)).select(*columns)
