"""Raw snapshots -> one row per episode: first snapshot, features and target."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation

from ..functions.features import add_shared_features
from ..operators.episodes import collapse_episodes
from ..operators.quality import is_empty, sane_counts
from ..operators.standardize import standardize, standardize_files
from ..schemas import DATE_COLUMN, EPISODE_TABLE
from ..sources.tables import read_episode_table, write_parquet
from .episode_store import EpisodeStore

logger = logging.getLogger(__name__)


def build_training_frame(
    raw: DataFrame, max_gap_days: int = 1, prefer: Sequence[Column] | None = None, co_locate: bool = False,
    report: Observation | None = None, late_texts: bool = False,
) -> DataFrame:
    """The episode table of raw snapshot rows.

    Two exchanges: on (item, country, day) for the duplicates, which spreads even a single hot item
    over its days, and on (item, country) for the episodes, where an item has at most one row per
    day.  No joins, no caching.  With ``co_locate`` it is one exchange and one sort, at the price
    named in :func:`snapflow.operators.standardize.standardize`.  ``late_texts`` is for tables read straight from parquet
    files whose texts are long: they are left out until it is known which rows stay.
    """
    if late_texts:
        snapshots = standardize_files(raw, prefer, report=report)
    else:
        snapshots = standardize(raw, prefer, co_locate, report)
    return frame_of_episodes(collapse_episodes(sane_counts(snapshots), max_gap_days))


def frame_of_episodes(episodes: DataFrame) -> DataFrame:
    """The episode table of collapsed episodes, such as those of an :class:`snapflow.plans.episode_store.EpisodeStore`."""
    featured = add_shared_features(episodes, snapshot_ts_col=DATE_COLUMN, views_cols=("view_count",))
    return featured.select(*EPISODE_TABLE).dropna(
        subset=["trending_days", "log_trending_days", "log_views", "log_likes", "log_comment_count"]
    )


def intake_snapshots(raw: DataFrame, store: EpisodeStore) -> int:
    """Clean the raw rows of new days and add them to a store of episodes; returns the number of the store's commit.

    Rows of days that the store has already are an error: a later delivery of an old day needs the whole table.
    """
    return store.append(sane_counts(standardize(raw)))


def clean_snapshots(
    raw: DataFrame, target: str, max_gap_days: int = 1, co_locate: bool = False, late_texts: bool = False
) -> int:
    """Write the episode table of ``raw`` to ``target`` and return its number of rows.

    The table is computed once; its rows are counted from the footers of the files written.
    Raw rows and rejects by cause are counted in the same pass and logged.  Nothing is written if
    ``raw`` is empty.
    """
    if is_empty(raw):
        logger.warning("No rows to clean")
        return 0
    report = Observation("cleaning")
    write_parquet(build_training_frame(raw, max_gap_days, co_locate=co_locate, report=report, late_texts=late_texts), target)
    logger.info("Cleaning: %s", report.get)
    rows = read_episode_table(raw.sparkSession, target).count()
    if rows == 0:
        logger.warning("No rows left after cleaning")
    return rows
