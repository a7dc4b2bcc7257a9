"""The corpus pipeline: each stage calls one operator and hands the documents that it keeps to the next.

Quality rules, near-duplicate removal, removal of repeated passages, mixing of sources, encoding.  All stages but the
last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapflow.llm import bpe, jaccard_join, mixing, quality_rules, substring_dedup
from snapflow.llm.tables import without, written

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
SEED = 17


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the certified cutoffs; empty and null texts go."""
    return quality_rules.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 or more the one with the smallest id.  Rows with a null id stay; of
    rows that share an id all stay or go."""
    found = jaccard_join.similar_components(docs)
    return without(docs, found.where(F.col("component_id") < F.col("doc_id")), ["doc_id"], "spare_copies")


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of passages that a document with a smaller id has; other texts stay as they are, null
    texts become empty.  A document of which nothing is left goes."""
    others = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    cleaned = substring_dedup.remove_repeats(docs, carry=others)
    changed = F.col("n_removed") > 0
    left = cleaned.where(~changed | (F.col("n_removed") < F.col("n_words")))
    new = {c: F.col(f"rest.`{c}`") for c in others} | {"doc_id": F.col("doc_id")}
    new["text"] = F.when(changed, F.col("kept")).otherwise(F.col("text"))
    new["n_chars"] = F.when(changed, F.length("kept").cast("long")).otherwise(F.col("rest.n_chars").cast("long"))
    return left.select(*[new[c].alias(c) for c in docs.columns])


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as it draws, with sources evened out by the square root of their amounts of text."""
    rates = mixing.source_rates(docs, size=F.length(F.coalesce("text", F.lit(""))), power=0.5)
    return mixing.mix_sources(docs, rates, seed=SEED).select(docs.columns)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, ids (packed), token_ends and n_tokens of every copy, and the digest of the bytes that the ids decode to.

    A Python worker does both with one vocabulary, and the codes are not stored in between.
    """
    decoded = bpe.encode_decode(docs.select("doc_id", "source", "text"), VOCABULARY)
    return decoded.select("doc_id", "source", "n_tokens", "ids", "token_ends", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality_rules", reject_low_quality),
    ("jaccard_join", keep_one_of_each_group),
    ("substring_dedup", remove_repeated_passages),
    ("source_mix", mix_to_targets),
    ("byte_bpe", encode_texts),
]

#: Exact binomial bounds, components and merges by rank are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
