"""Operators that work text by text."""

import hashlib
import math
import random

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from snapflow.llm import bpe, mixing, quality_gam, quality_rules, token_counts, url_filter
from snapflow.llm.arrays import TextBatch
from snapflow.llm.text_stats import BASE_COUNTS, text_counts

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_words string"
ODD = [None, "", " \n\t ", "a", "\u3000 x\x1cy", "x" * 3000, "don't we've 'tis ''s\r\n  end ", "z\n" * 400, "é\u0301中😀 1²3"]
PARTS = ["a", "s", "re", " ", "  ", "\n", "\t", "'", "''", "é", "1", "²", "!", "ll", "d", "\u00a0", "中", "😀", "'s", "\x1c", "Ab", "#"]


def odd_texts(n=400, seed=3):
    pick = random.Random(seed)
    return ODD + ["".join(pick.choice(PARTS) for _ in range(pick.randrange(30))) for _ in range(n)]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, repeated ids and rows, an extra column with a clashing name."""
    rows = [(i, t, "en", "s", 1, "own") for i, t in enumerate(odd_texts())]
    rows += [(None, "no id here", None, None, None, None), (3, "a", "en", "s", 1, "own"), (3, "a", "en", "s", 1, "own")]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, None, 0), (None, 1, 0), (5, 7, 0)], "doc_id bigint, quality int, toxic int")


def test_counts_match_plain_version():
    texts = odd_texts()
    found = text_counts(TextBatch(pa.array(texts, pa.string())))
    assert [tuple(int(found[c][i]) for c in BASE_COUNTS) for i in range(len(texts))] == [brute.text_counts(t) for t in texts]


def test_pieces_and_merges_match_tokenizer():
    texts = [t or "" for t in odd_texts(3000)] + ["ab'c" * 4000, "q" * 5000]
    words, plain = bpe.Vocabulary(VOCABULARY), brute.tokenizer()
    found = words.encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in found] == [plain.encode_ordinary(t) for t in texts]
    assert [words.decode(x).decode() for x in found] == texts


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 70_000])
def test_scan_is_the_running_product(n):
    kinds = np.random.default_rng(n).integers(0, 8, n)
    state, expected = 0, []
    for k in kinds:
        state = bpe._step(state, int(k))
        expected.append(state)
    assert bpe.VALUE[bpe.scan(bpe.CLASS_FUNCTION[kinds]), 0].tolist() == expected


def test_encode_round_trip_keeps_columns(odd):
    rows = bpe.decode(bpe.encode(odd, VOCABULARY), VOCABULARY).collect()
    assert len(rows) == odd.count()
    for r in rows:
        assert bytes(r.decoded).decode() == (r.text or "") and r.n_tokens * 4 == len(r.ids) == len(r.token_ends)
        if r.n_tokens:
            assert np.frombuffer(r.token_ends, "<u4")[-1] == len(r.decoded)
    assert bpe.encode(odd.limit(0), VOCABULARY).count() == 0


def test_bpe_in_one_worker_is_encoding_then_decoding(odd):
    apart = bpe.decode(bpe.encode(odd, VOCABULARY), VOCABULARY)
    at_once = bpe.encode_decode(odd, VOCABULARY)
    assert at_once.columns == apart.columns and at_once.count() == odd.count()
    assert at_once.exceptAll(apart).count() == 0 == apart.exceptAll(at_once).count()


def test_pipeline_stores_no_codes_and_encodes_in_one_worker(spark, odd):
    import os

    import corpus_pipeline
    from snapflow.workspace import shared_dir

    folder = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    rows = corpus_pipeline.encode_texts(spark, odd, "")
    assert rows.count() == odd.count() and set(os.listdir(folder)) == before
    assert rows._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1


def test_token_counts_match_plain_version(odd):
    rows = token_counts.count_tokens(odd, VOCABULARY, public_tokenizers.PATTERN, fields=("source", "text")).collect()
    by_doc, plain = {}, brute.tokenizer()
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    for i, text in enumerate(odd_texts()):
        if i == 3:
            continue  # its id is repeated
        whole = "s\n" + (text or "")
        own = sorted(by_doc[i], key=lambda r: (r.start, r.stop))
        raw, spans, at = whole.encode(), [], 0
        for token in plain.encode_ordinary(whole):
            size = len(plain.decode_single_token_bytes(token))
            first = len(raw[: at + 1].decode(errors="ignore").encode()) and sum((b & 0xC0) != 0x80 for b in raw[: at + 1]) - 1
            last = sum((b & 0xC0) != 0x80 for b in raw[: at + size])
            spans.append((first, last))
            at += size
        cuts = [r.start for r in own]
        assert sum(r.n_tokens for r in own) == len(spans)
        assert [r.n_tokens for r in own] == brute.majority_counts(spans, cuts, len(whole)) or not text
    assert token_counts.count_tokens(odd.limit(0), VOCABULARY, public_tokenizers.PATTERN).count() == 0


def test_op1_matches_plain_version(spark, sf_dir, odd):
    """All three fields of the query, sections found apart from the operator, empty and null texts too."""
    from snapflow.llm.queries import QUERIES

    encoder, names = brute.tokenizer(), ("source", "lang", "text")

    def check(found, rows):
        want = {(r.doc_id, names[k], i, a, b, n, c) for r in rows for k, i, a, b, n, c in brute.token_sections([r[f] for f in names], encoder)}
        assert {tuple(r) for r in found.select("doc_id", "field", "section", "start", "stop", "n_tokens", "n_crossing").collect()} == want

    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [r for r in table.collect() if len(r.text or "") < 1500]
    check(QUERIES["op1_token_counts"](spark, sf_dir).join(spark.createDataFrame([(r.doc_id,) for r in rows], "doc_id bigint"), "doc_id"), rows)
    short = odd.where("doc_id <> 3 AND length(coalesce(text, '')) < 500")
    check(token_counts.count_tokens(short, VOCABULARY, public_tokenizers.PATTERN, fields=names), short.collect())


def test_gam_of_repeated_ids_scores_each_text(spark):
    """Rows of one id are scored by their own texts; the label of the id counts for all of them; no labels give a constant."""
    good, bad = "the cat sat on the mat and slept " * 3, "$$$ !!! ### 999 !!! " * 4
    rows = [(i, good if i % 2 else bad) for i in range(300)] + [(7, good), (7, bad), (7, None), (None, good), (None, bad)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(300) if i != 7], "doc_id bigint, quality int, toxic int")
    scored = quality_gam.score(docs, labels).collect()
    assert len(scored) == len(rows)
    seven = sorted(r.score for r in scored if r.doc_id == 7)
    assert len(seven) == 4 and seven[0] < 0.2 and seven[-1] > 0.8
    assert all(r.held_out for r in scored if r.doc_id is None) and all(0 <= r.score <= 1 for r in scored)
    assert len({r.score for r in quality_gam.score(docs, labels.limit(0)).collect()}) == 1


def test_gam_matches_plain_version():
    rng = np.random.default_rng(7)
    x = np.column_stack([rng.normal(size=90), rng.integers(0, 3, 90), rng.exponential(size=90), rng.integers(0, 2, 90)]).round(3)
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    y[::11] = 1 - y[::11]
    found = quality_gam.fit(x, y, rounds=8, rate=0.3, n_pairs=2).score(x)
    assert np.abs(found - brute.gam_scores(x.tolist(), y.tolist(), 8, 0.3, 2)).max() < 1e-9


def test_crossing_token_goes_to_the_larger_share():
    section, crossing = token_counts.attribute(np.array([0, 3, 5]), np.array([3, 5, 9]), np.array([0, 4, 8]))
    assert section.tolist() == [0, 0, 1] and crossing.tolist() == [False, True, True]


def test_urls_match_plain_version(spark):
    rules = [
        ("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"),
        ("a.org/fr/x", "block"), ("org/fr/", "block"), ("b.org", "block"),
    ]
    hosts = ["net", "example.net", "a.example.net", "xexample.net", "EXAMPLE.com", "a.org", "b.org", "com", "", "net:80"]
    tails = ["", "/", "/en", "/en/", "/en/a?x", "/de/1#y", "/fr/", "/fr/xyz", "?q=/en/", "#", "//en/", "/fr/x/y"]
    urls = [f"http://{h}{t}" for h in hosts for t in tails] + [None, "", "no", "://", "a://b://net/en/"]
    df = spark.createDataFrame([(i, u, "old") for i, u in enumerate(urls)], "page_id int, url string, host string")
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.filter_urls(df, rules).collect()}
    assert found == {i: brute.url_verdict(u, rules) for i, u in enumerate(urls)}
    assert url_filter.filter_urls(df.limit(0), rules).count() == 0
    assert {r.verdict for r in url_filter.filter_urls(df, [], default="block").collect()} == {"block"}


def test_rules_on_odd_rows(odd, labels):
    rows = quality_rules.judge(odd, labels).collect()
    assert len(rows) == odd.count()
    for r in rows:
        if r.doc_id not in (None, 3):
            text = odd_texts()[r.doc_id]
            n, _, _, _, repeats = expected = brute.text_counts(text)
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected
            assert r.base_failed == (n < 50 or 100 * repeats > 50 * n) and r.kept == (not r.base_failed)
    kept = quality_rules.keep_good(odd, labels)
    assert kept.columns == odd.columns and kept.count() == sum(r.kept for r in rows)
    assert quality_rules.judge(odd.limit(0), labels.limit(0)).count() == 0


def test_binomial_tail_is_exact():
    from math import comb

    for n, k, p in [(10, 0, 0.1), (30, 4, 0.2), (5, 5, 0.5)]:
        exact = sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert abs(quality_rules.binomial_tail(n, k, p) - exact) < 1e-12
    assert not quality_rules.certified(100, 0, 0.01, 0.05) and quality_rules.certified(1000, 0, 0.01, 0.05)


def test_certified_rule_rejects_junk_and_keeps_the_limit(spark):
    clean = " ".join(f"word{i}" for i in range(60))
    junk = " ".join(f"word{i}###" for i in range(60))
    rows = [(i, junk if i % 4 == 0 else clean, "en") for i in range(8000)] + [(9000, junk, "xx"), (9001, junk, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    # one good text in a thousand looks like junk
    marks = [(i, 1 if i % 4 or i % 4000 == 0 else 0) for i in range(8000)]
    marks = spark.createDataFrame(marks, "doc_id bigint, quality int")
    kept = {r.doc_id: r.kept for r in quality_rules.judge(docs, marks).collect()}
    assert all(kept[i] == bool(i % 4) for i in range(8000))
    assert kept[9000] and kept[9001]  # no labels there, no certificate


def test_additive_model_learns_and_scores_every_row(odd, labels, spark, sf_dir):
    rows = quality_gam.score(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert quality_gam.score(odd.limit(0), labels.limit(0)).count() == 0
    rng = np.random.default_rng(0)
    x = rng.uniform(-1, 1, (6000, 3))
    y = ((x[:, 0] * x[:, 1] > 0) | (x[:, 2] > 0.8)).astype(float)  # needs a pair
    model = quality_gam.fit(x[:4000], y[:4000])
    assert ((model.score(x[4000:]) > 0.5) == y[4000:]).mean() > 0.9
    assert (0, 1) in model.pairs


def test_held_out_accuracy(spark):
    base = "/root/testdata/sf0.1"
    docs, marks = (spark.read.parquet(f"{base}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality_gam.score(docs, marks).where("held_out").join(marks, "doc_id").select("score", "quality").toPandas()
    good, bad = (rows.score[rows.quality == q].to_numpy() for q in (1, 0))
    auc = (good[:, None] > bad[None, :]).mean() + (good[:, None] == bad[None, :]).mean() / 2
    assert auc > 0.95, auc
    assert ((rows.score >= 0.3) == (rows.quality == 1)).mean() > 0.93


def test_held_out_is_crc32(spark):
    import zlib

    df = spark.range(50).withColumnRenamed("id", "doc_id")
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in df.select("doc_id", quality_gam.held_out().alias("h")).collect())


def test_bpe_query_against_tokenizer(spark, sf_dir):
    from snapflow.llm.queries import QUERIES

    plain = brute.tokenizer()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    rows = QUERIES["op6_byte_bpe"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = plain.encode_ordinary(texts[r.doc_id] or "")
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


def test_rules_query_against_plain_version(spark, sf_dir):
    from snapflow.llm.queries import QUERIES

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    rows = QUERIES["op8_quality_rules"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute.text_counts(texts[r.doc_id])


def test_pairs_of_ratios_with_two_values_interact():
    """Labels that hang on whether two yes-or-no ratios agree: no table of one ratio can tell, a pair table can."""
    rng = np.random.default_rng(1)
    x = np.column_stack([rng.integers(0, 2, 4000), rng.integers(0, 2, 4000), rng.normal(size=4000)]).astype(float)
    y = (x[:, 0] == x[:, 1]).astype(float)
    model = quality_gam.fit(x, y)
    assert (0, 1) in model.pairs
    assert ((model.score(x) > 0.5) == (y == 1)).mean() > 0.99


def test_tail_of_many_trials():
    """Against a normal approximation where a term per success would be too many."""
    n, p = 10**9, 0.01
    sd = math.sqrt(n * p * (1 - p))
    for z in (0.5, 2.0, 4.0):
        tail = quality_rules.binomial_tail(n, round(n * p - z * sd), p)
        assert abs(tail / (0.5 * math.erfc(z / math.sqrt(2))) - 1) < 0.01


def test_rates_with_very_many_copies(spark):
    """A distribution of a hundred thousand terms: sums rise to 1, and half the mass lies around the rate."""
    rates = spark.createDataFrame([("a", 1e5), (None, 0.3)], "source string, rate double")
    sums = {r.source: r.sums for r in mixing.poisson_distributions(rates).collect()}
    assert abs(sums["a"][-1] - 1) < 1e-6 and abs(sums["a"][100_000] - 0.5) < 0.01 and len(sums[None]) < 60
    assert all(x <= y for x, y in zip(sums["a"], sums["a"][1:]))
    assert abs(sums[None][0] - math.exp(-0.3)) < 1e-15


def test_command(spark, sf_dir, tmp_path):
    from snapflow.llm.__main__ import main

    main(["op3_url_filter", sf_dir, str(tmp_path / "out")])
    assert spark.read.parquet(str(tmp_path / "out")).count() == spark.read.parquet(f"{sf_dir}/pages.parquet").count()
