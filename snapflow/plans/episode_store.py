"""Episodes kept up to date: each new batch of days meets the last episodes of the items it has rows of, nothing else.

The store keeps, per item, the last episode (its tail) and apart from it all earlier ones, which no later day can change.
Items are dealt to buckets by a hash; a batch reads and rewrites the tails of the buckets it touches and appends the
episodes that it closes.  What makes up the store is named by a commit, so a batch is in it whole or not at all, and a
batch that was cut short can be run again.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.episodes import collapse_episodes
from ..schemas import DATE_COLUMN, ITEM_KEYS, LABEL_COLUMN, TARGET_COLUMN
from ..sources.commits import CommitLog
from ..sources.tables import write_parquet
from ..workspace import new_run_dir

TAIL, CLOSED = "tail", "closed"


class EpisodeStore:
    """The episodes of all batches so far, equal to those of :func:`collapse_episodes` over all their rows at once.

    Batches come in order of time.  Within a batch an item has at most one row per day.
    """

    def __init__(
        self, spark: SparkSession, path: str, max_gap_days: int = 1, keys: Sequence[str] = ITEM_KEYS, date_col: str = DATE_COLUMN,
        buckets: int = 64,
    ):
        self.spark, self.path, self.max_gap_days = spark, path.rstrip("/"), max_gap_days
        self.keys, self.date_col, self.buckets = list(keys), date_col, buckets
        self.log = CommitLog(spark, path, "bucket int, tail_commit bigint, last_day date")

    def _stored(self, number: int, tails: dict[int, int], closed: bool) -> DataFrame:
        """Current tails of the given buckets; with all closed episodes if asked for."""
        table = self.spark.read.parquet(f"{self.path}/data")
        commit, bucket = F.col("commit"), F.col("bucket")
        wanted = F.lit(False)
        if tails:
            # conditions on partition columns alone: files of other buckets and commits are not opened
            places = [F.struct(F.lit(c).cast("bigint").alias("c"), F.lit(b).alias("b")) for b, c in tails.items()]
            wanted = (F.col("kind") == TAIL) & F.struct(commit.cast("bigint").alias("c"), bucket.alias("b")).isin(places)
        if closed:
            wanted = wanted | ((F.col("kind") == CLOSED) & (commit <= number))
        return table.filter(wanted).drop("commit", "kind", "bucket")

    def episodes(self) -> DataFrame:
        """All episodes of the store; an episode at the end of the data may still grow."""
        number, rows = self.log.latest()
        if not rows:
            raise ValueError(f"No batch has been added to {self.path} yet")
        return self._stored(number, {r.bucket: r.tail_commit for r in rows}, closed=True)

    def last_day(self):
        """The last day that has been added; None for an empty store."""
        return max((r.last_day for r in self.log.latest()[1]), default=None)

    def append(self, days: DataFrame) -> int:
        """Add a batch of rows, all of days after those added before; returns the number of the commit.

        An empty batch adds nothing and returns the last number.
        """
        number, rows = self.log.latest()
        known = {r.bucket: r.tail_commit for r in rows}
        path = new_run_dir(self.spark, "episode-batch")
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        write_parquet(collapse_episodes(days, self.max_gap_days, self.keys, self.date_col).withColumn("bucket", bucket), path)
        batch = self.spark.read.parquet(path)
        first, last, touched = batch.agg(
            F.min("episode_start_date"), F.max("episode_end_date"), F.collect_set("bucket")
        ).first()  # one number per bucket at most
        if not touched:
            return number
        before = max((r.last_day for r in rows), default=None)
        if before is not None and first <= before:
            raise ValueError(f"Days up to {before} are in the store already; the batch starts on {first}")
        merged = self._merged(batch.drop("bucket"), self._tails(number, {b: known[b] for b in touched if b in known}, batch))
        merged = merged.withColumn("bucket", bucket).hint("rebalance", "kind", "bucket")
        number += 1
        merged.write.mode("overwrite").partitionBy("kind", "bucket").parquet(f"{self.path}/data/commit={number}")
        self.log.commit(number, [(b, c, last) for b, c in (known | dict.fromkeys(touched, number)).items()])
        return number

    def _tails(self, number: int, tails: dict[int, int], batch: DataFrame) -> DataFrame:
        if not tails:
            return batch.drop("bucket").limit(0)
        return self._stored(number, tails, closed=False)

    def _merged(self, batch: DataFrame, tails: DataFrame) -> DataFrame:
        """Episodes of the touched buckets after the batch, with the kind they have from now on."""
        names = [c for c in batch.columns if c not in self.keys]
        by_item = Window.partitionBy(*self.keys)
        new = batch.select(
            *self.keys, F.struct(*names).alias("new"), F.min("episode_start_date").over(by_item).alias("first_start"),
            F.count("*").over(by_item).alias("n"),
        )
        old = tails.select(*[F.col(k).alias(f"_{k}") for k in self.keys], F.struct(*[F.col(n) for n in names]).alias("old"))
        same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in self.keys])
        met = new.join(old, same, "full_outer")
        met = met.select(
            *[F.when(F.col("new").isNotNull(), F.col(k)).otherwise(F.col(f"_{k}")).alias(k) for k in self.keys],
            "new", "old", "n",
            F.coalesce(F.datediff("first_start", "old.episode_end_date") <= self.max_gap_days, F.lit(False)).alias("goes_on"),
        )
        # the item's first new episode may continue its last old one
        continued = F.col("goes_on") & (F.col("new.episode_id") == 1)
        shift = F.coalesce("old.episode_id", F.lit(0)) - F.col("goes_on").cast("int")

        def grown(name: str):
            mine, theirs = F.col("new")[name], F.col("old")[name]
            if name == "episode_id":
                return (mine + shift).cast("bigint")
            if name == LABEL_COLUMN:
                return F.when(continued, mine + theirs).otherwise(mine)
            if name == "episode_end_date":
                return mine
            return F.when(continued, theirs).otherwise(mine)

        def entry(kind, episode):
            return F.struct(kind.alias("kind"), episode.alias("episode"))

        kept = entry(F.lit(TAIL), F.col("old"))
        ended = entry(F.lit(CLOSED), F.col("old"))
        last = F.when(F.col("new.episode_id") == F.col("n"), TAIL).otherwise(CLOSED)
        added = entry(last, F.struct(*[grown(name).alias(name) for name in names]))
        parts = (
            F.when(F.col("new").isNull(), F.array(kept))
            .when(F.col("old").isNull() | continued | (F.col("new.episode_id") > 1), F.array(added))
            .otherwise(F.array(ended, added))
        )
        flat = met.select(*self.keys, F.inline(parts)).select(*self.keys, "kind", "episode.*")
        derived = {TARGET_COLUMN: F.log1p(LABEL_COLUMN), "reappear_count": (F.col("episode_id") - 1).cast("double")}
        return flat.withColumns(derived).select(*batch.columns, "kind")
