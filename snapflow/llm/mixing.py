"""Mixing sources to target weights by Poisson replication.

A source's repetition rate is the target amount over the present one.  Each document draws its number
of copies from the Poisson distribution with that mean, by inverting the distribution function at a
number in [0, 1) that hangs on the seed and the document alone, so a rerun gives the same copies.  Copies
are exploded and shuffled over the whole cluster by a hash of seed, document and copy.

Built-in functions only.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import lookup

BROADCAST_SUMS = 1_000_000  # numbers, eight bytes each

def unit_number(seed: int, *keys: Column) -> Column:
    """A double in [0, 1) with 52 bits from the MD5 hash of seed and keys."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(k.cast("string"), F.lit("")) for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def poisson_distributions(rates: DataFrame) -> DataFrame:
    """source and sums, the distribution function at 0, 1, 2 ... as far as it differs from 1, for every row of positive rate.

    The terms are formed as logarithms, so large rates do not underflow, and added up by a window over a row per term, so the
    work is their number.
    """
    last = (F.ceil(F.col("rate") + 12 * F.sqrt("rate")) + 30).cast("long")
    terms = rates.select("source", "rate", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("k"))
    upto = Window.partitionBy("source").orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    factor = F.when(F.col("k") == 0, -F.col("rate")).otherwise(F.log("rate") - F.log(F.col("k").cast("double")))
    terms = terms.withColumn("term", F.exp(F.sum(factor).over(upto))).withColumn("sum", F.sum("term").over(upto))
    sums = F.transform(F.array_sort(F.collect_list(F.struct("k", "sum"))), lambda x: x["sum"])  # of one source
    return terms.groupBy("source").agg(sums.alias("sums"))


def source_rates(
    docs: DataFrame,
    *,
    source_col: str = "source",
    size: Column | None = None,
    weights: Mapping[str, float] | None = None,
    power: float = 0.5,
    scale: float = 1.0,
) -> DataFrame:
    """source, amount, weight, rate: one row per source (null is a source).

    size: what a document weighs (default: one).  weights: target shares by source, those left out get none; without
    it a source's share is its amount to the given power, which evens sources out.  The rates bring the expected
    amount to scale times the present one.  A source without amount has rate 0.
    """
    size = F.lit(1) if size is None else size
    amounts = docs.groupBy(F.col(source_col).alias("source")).agg(F.sum(size).cast("double").alias("amount"))
    if weights is None:
        weighed = amounts.withColumn("weight", F.pow("amount", F.lit(float(power))))
    else:
        pairs = [F.lit(x) for pair in weights.items() for x in (pair[0], float(pair[1]))]
        weight = F.element_at(F.create_map(*pairs), F.col("source")) if pairs else F.lit(0.0)
        weighed = amounts.withColumn("weight", F.coalesce(weight, F.lit(0.0)))
    totals = weighed.agg(F.sum("amount").alias("all_amount"), F.sum(F.when(F.col("amount") > 0, F.col("weight"))).alias("all_weight"))
    weighed = weighed.withColumns({
        "all_amount": _only(totals, "all_amount"), "all_weight": _only(totals, "all_weight"),
    })
    rate = F.col("weight") / F.col("all_weight") * F.col("all_amount") * scale / F.col("amount")
    usable = (F.col("amount") > 0) & (F.col("all_weight") > 0)
    return weighed.select("source", "amount", "weight", F.when(usable, rate).otherwise(0.0).alias("rate"))


def _only(totals: DataFrame, name: str) -> Column:
    return totals.select(name).scalar()


def mix_sources(
    docs: DataFrame,
    rates: DataFrame,
    *,
    seed: int = 0,
    id_col: str = "doc_id",
    source_col: str = "source",
) -> DataFrame:
    """Every document as often as it draws, with ``copy_no`` (from 1) and ``shuffle_key``, in globally shuffled order.

    rates: source and rate, one row per source (source_rates()).  A document whose source has no row there is left out.
    Rows with the same id draw the same number; a null id draws like the empty text.  An empty table gives none.
    The distributions are broadcast only after their numbers have been counted and are few; else documents and rates are
    joined by shuffle.  Columns of docs called copy_no or shuffle_key are replaced; no column may begin with ``__mix_``.
    """
    table = poisson_distributions(rates.where("rate > 0")).select(F.col("source").alias("__mix_source"), F.col("sums").alias("__mix_sums"))
    table = lookup(table, "source_rates", BROADCAST_SUMS, size=F.size("__mix_sums"))
    plain = docs.drop("copy_no", "shuffle_key")
    joined = plain.join(table, plain[source_col].eqNullSafe(F.col("__mix_source")))
    drawn = joined.withColumn("__mix_u", unit_number(seed, F.col(id_col)))
    # the smallest k whose distribution function is above u
    copies = F.size(F.filter("__mix_sums", lambda p: p <= F.col("__mix_u")))
    repeated = (
        drawn.withColumn("__mix_copies", copies).where("__mix_copies > 0")
        .withColumn("copy_no", F.explode(F.sequence(F.lit(1), F.col("__mix_copies"))))
        .withColumn("shuffle_key", F.md5(F.concat_ws("|", F.lit(f"order {seed}"), F.col(id_col).cast("string"), "copy_no")))
        .drop("__mix_source", "__mix_sums", "__mix_u", "__mix_copies")
    )
    return repeated.repartition("shuffle_key").sortWithinPartitions("shuffle_key")
