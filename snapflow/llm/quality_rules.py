"""Quality rules whose cutoffs are chosen under a stated risk.

Every rule compares one ratio of a text with a cutoff.  Cutoffs are fixed lists from lenient to strict.
On labelled holdout texts a cutoff is certified for a stratum if the exact binomial test rejects "the
share of good texts that it rejects is above the limit".  Along one list cutoffs are tested in their
fixed order and the first failure ends the list, so no correction is needed there; over all rules and
strata the level is divided by their number (Bonferroni).  With the stated confidence, therefore, no
certified cutoff rejects more than the limit of good texts in any stratum.  Of the certified cutoffs
the one that catches most bad labelled texts is used, of equal ones the most lenient.  A stratum
with too few labels for any certificate keeps everything.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import lookup, without, written
from .text_stats import with_counts


@dataclass(frozen=True)
class Rule:
    """Rejects a text whose ratio is above (or, if below, under) the cutoff; cutoffs go from lenient to strict."""

    name: str
    ratio: Column
    cutoffs: tuple[float, ...]
    below: bool = False

    def rejects(self, cutoff: Column) -> Column:
        """Never null; with a null cutoff the rule rejects nothing."""
        value = F.col(f"rule_{self.name}")
        return F.coalesce(value < cutoff if self.below else value > cutoff, F.lit(False))


def share(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


def default_rules() -> list[Rule]:
    return [
        Rule("symbols", share("n_symbols", "n_words"), (1.0, 0.5, 0.3, 0.2, 0.1, 0.05, 0.02)),
        Rule("repeats", share("n_repeat_words", "n_words"), (0.45, 0.4, 0.35, 0.3, 0.25, 0.2)),
        Rule("lines", share("n_dup_lines", "n_lines"), (0.8, 0.6, 0.5, 0.4, 0.3)),
        Rule("capitals", share("n_upper", "word_chars"), (0.6, 0.5, 0.4, 0.3, 0.2, 0.1)),
        Rule("shouts", share("n_bangs", "n_words"), (1.0, 0.8, 0.6, 0.4, 0.3, 0.2, 0.1)),
        Rule("long_words", share("word_chars", "n_words"), (14.0, 12.0, 10.0, 9.0)),
    ]


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def binomial_tail(n: int, k: int, p: float) -> float:
    """Chance of at most k successes in n trials, for k up to the mean.

    Below the mean the terms fall from k downwards, so they are added from there until they no longer count: about the root of
    n of them, one at a time.
    """
    if k >= n:
        return 1.0
    first = math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    total = term = 1.0
    for i in range(k, 0, -1):
        term *= i * (1 - p) / ((n - i + 1) * p)
        total += term
        if term < total * 1e-18:
            break
    return min(1.0, math.exp(first + math.log(total)))


def certified(n: int, rejected: int, limit: float, level: float) -> bool:
    """Is the exact upper confidence bound of the rejection rate at most the limit?"""
    return n > 0 and rejected <= limit * n and binomial_tail(n, rejected, limit) <= level


def choose_cutoffs(
    counts: DataFrame, labels: DataFrame, rules: list[Rule], stratum: str, id_col: str, limit: float, error: float
) -> DataFrame:
    """One row per stratum with a ``cutoff_<rule>`` column each (null: the rule is off there).

    counts: a row per text with the rules' ratios as ``rule_<name>``, the stratum and base_failed.  labels: id and
    quality (1 good, 0 bad; other values and nulls are ignored; of repeated labels the lower counts).
    """
    known = (
        labels.where(F.col("quality").isin(0, 1) & F.col(id_col).isNotNull())
        .groupBy(id_col).agg(F.min("quality").alias("quality"))
    )
    good, bad = F.col("quality") == 1, F.col("quality") == 0
    sums = [F.count(F.when(good, 1)).alias("n")]
    for rule in rules:
        for i, cutoff in enumerate(rule.cutoffs):
            hit = rule.rejects(F.lit(cutoff))
            sums += [F.count(F.when(good & hit, 1)).alias(f"g{i}_{rule.name}")]
            sums += [F.count(F.when(bad & hit, 1)).alias(f"b{i}_{rule.name}")]
    table = counts.where(~F.col("base_failed")).join(known, id_col).groupBy(stratum).agg(*sums)
    table = written(table, "rule_counts")
    tests = max(1, table.count() * len(rules))
    names = [f"cutoff_{r.name}" for r in rules]
    plain = [(r.name, r.cutoffs) for r in rules]

    def pick(batches):
        for batch in batches:
            out = {stratum: batch[stratum]} | {c: [] for c in names}
            for _, row in batch.iterrows():
                for name, cutoffs in plain:
                    best, most = None, 0
                    for i, cutoff in enumerate(cutoffs):
                        if not certified(int(row["n"]), int(row[f"g{i}_{name}"]), limit, error / tests):
                            break
                        if row[f"b{i}_{name}"] > most:
                            best, most = cutoff, row[f"b{i}_{name}"]
                    out[f"cutoff_{name}"].append(best)
            frame = pd.DataFrame(out)
            yield frame.astype({c: "float64" for c in names})

    kinds = f"`{stratum}` {table.schema[stratum].dataType.simpleString()}, " + ", ".join(f"{c} double" for c in names)
    # pandas turns None into NaN here, which as a cutoff would be larger than any ratio: make it null again
    picked = table.mapInPandas(pick, kinds)
    return picked.select(stratum, *[F.when(~F.isnan(c), F.col(c)).alias(c) for c in names])


def judge(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    stratum: str = "lang",
    limit: float = 0.01,
    error: float = 0.05,
    rules: list[Rule] | None = None,
    also: tuple[str, ...] = (),
) -> DataFrame:
    """Counts, base_failed and kept for every row of docs.

    limit: largest share of good texts that one rule may reject in a stratum; error: chance that any certified cutoff
    breaks it; also: further columns of docs to carry along.  Null or empty texts count as texts without words and fail the base rule.  Rows with a null id or
    repeated rows are judged each by themselves; a null stratum is a stratum of its own.  Without labels no rule has
    a cutoff and base_failed alone decides.
    """
    rules = default_rules() if rules is None else rules
    counts = with_counts(docs, (id_col, stratum, *also), text_col)
    counts = counts.withColumns({f"rule_{r.name}": r.ratio for r in rules}).withColumn("base_failed", base_failed())
    counts = written(counts, "text_counts")
    chosen = choose_cutoffs(counts, labels, rules, stratum, id_col, limit, error)
    chosen = lookup(chosen.withColumnRenamed(stratum, "__stratum"), "rule_cutoffs")
    rejected = F.lit(False)
    for rule in rules:
        rejected = rejected | rule.rejects(F.col(f"cutoff_{rule.name}"))
    joined = counts.join(chosen, F.col(stratum).eqNullSafe(F.col("__stratum")), "left")
    return joined.withColumn("kept", ~F.col("base_failed") & ~rejected).drop("__stratum")


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of docs that are kept, all columns unchanged.

    Rejected rows are found again by id and a hash of the text and the stratum, so rows that share an id are kept or
    not each by its own text.
    """
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    stratum = options.get("stratum", "lang")
    tagged = docs.withColumn("__key", F.xxhash64(F.col(text_col), F.col(stratum)))
    rejected = judge(tagged.select(id_col, text_col, stratum, "__key"), labels, **options, also=("__key",)).where("NOT kept")
    return without(tagged, rejected, [id_col, "__key"], "rejected").select(docs.columns)
