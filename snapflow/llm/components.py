"""Connected components of links, in rounds of joins; nothing is collected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import written


SALTS = 16


def _with_least(both: DataFrame, least_of: Column) -> DataFrame:
    """Every row with the smallest u of its v, as m.

    The rows of a v are dealt to SALTS tasks, so a node that very many others are tied to is not one task's work: each part
    finds its smallest, the parts of a node agree, and the rows meet the answer of their own part.
    """
    dealt = both.withColumn("salt", F.pmod(F.xxhash64("u"), F.lit(SALTS)).cast("int"))
    parts = dealt.groupBy("v", "salt").agg(F.min("u").alias("least"))
    whole = parts.groupBy("v").agg(F.min("least").alias("least")).select("v", least_of.alias("m"))
    answers = parts.select("v", "salt").join(whole, "v")
    return dealt.join(answers, ["v", "salt"]).drop("salt")


def components(links: DataFrame) -> DataFrame:
    """node, component (its smallest node) of every node of the links (columns a, b; any order, repeats allowed).

    Alternating stars: every node ties its larger neighbours, then its smaller ones, to the smallest it knows, until
    a round gives the same links again.  The number of rounds grows with the logarithm of the longest chain.
    """
    pairs = links.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct()
    pairs = written(pairs, "stars")
    while True:
        both = pairs.unionAll(pairs.select(F.col("u").alias("v"), F.col("v").alias("u")))
        larger = _with_least(both, F.least("v", "least")).where("u > v").select(F.col("u").alias("v"), F.col("m").alias("u")).where("v <> u")
        large = written(larger.distinct(), "stars")
        smaller = _with_least(large, F.col("least"))
        ties = F.array(F.struct("v", F.col("m").alias("u")), F.struct(F.col("u").alias("v"), F.col("m").alias("u")))
        new = written(smaller.select(F.explode(ties).alias("p")).select("p.*").where("v <> u").distinct(), "stars")
        # both tables hold each link once, so as many links, all of them known, are the same links
        same = new.count() == pairs.count() and new.join(pairs, ["v", "u"], "left_anti").isEmpty()
        pairs = new
        if same:
            break
    # stars: every node is tied to the smallest of its component, and to nothing else
    roots = pairs.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct()
    return pairs.select(F.col("v").alias("node"), F.col("u").alias("component")).unionByName(roots)
