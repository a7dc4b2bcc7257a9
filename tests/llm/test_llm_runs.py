"""Periodic runs against a plain search."""

import fractions
import hashlib
import random

import brute
import numpy as np
import pytest
from snapflow.llm import periodic_runs
from snapflow.llm.arrays import mix
from snapflow.llm.queries import QUERIES


def found(texts, min_length=0):
    flat = np.array([x for t in texts for x in t], np.uint64)
    first = np.append(0, np.cumsum([len(t) for t in texts])).astype(np.int64)
    rows = periodic_runs.runs_of(mix(flat + np.uint64(5)), first, min_length).tolist()
    return [[tuple(r[1:]) for r in rows if r[0] == i] for i in range(len(texts))]


def made(pick):
    """Pieces of noise and of repeated roots, among them roots that are nearly or wholly powers of shorter ones."""
    kinds, out = pick.choice([1, 2, 3, 50]), []
    while pick.random() < 0.9 and len(out) < 400:
        root = [pick.randrange(kinds) for _ in range(pick.randrange(1, pick.choice([3, 8, 30, 90])))]
        if pick.random() < 0.3:
            root = [0] * (len(root) - 1) + [1]
        if pick.random() < 0.1:
            root = root * 3 + [7]
        out += (root * 10)[: int(len(root) * pick.choice([1, 2, 2.9, 3, 3.1, 5, 9]))]
    return out


@pytest.mark.parametrize("seed", range(12))
def test_runs_match_plain_search(seed):
    pick = random.Random(seed)
    texts = [made(pick) for _ in range(pick.randrange(1, 8))]
    for least in (0, 24):
        assert found(texts, least) == [brute.periodic_runs(t, least) for t in texts]


def test_runs_of_known_sequences():
    fibonacci, before = [0, 1], [0]
    while len(fibonacci) < 900:
        before, fibonacci = fibonacci, fibonacci + before
    overlap_free = [bin(i).count("1") % 2 for i in range(1024)]
    texts = [fibonacci, overlap_free, [0] * 700, [0, 1] * 300, ([0] * 99 + [1]) * 5]
    assert found(texts) == [brute.periodic_runs(t, 0) for t in texts]
    assert found([[], [1], [1, 1], [1, 1, 1]]) == [[], [], [], [(0, 3, 1)]]


def test_one_text_longer_than_a_slice(spark):
    root = [f"w{i}" + "x" * 800 for i in range(1500)]
    text = " ".join(["start"] + root * 4 + ["end"])
    rows = spark.createDataFrame([(1, text), (2, "a " * 30), (3, "b")], "doc_id bigint, text string")
    got = {r.doc_id: [tuple(x) for x in r.runs] for r in periodic_runs.find_runs(rows).collect()}
    assert got == {1: [(1, 6000, 1500)], 2: [(0, 30, 1)], 3: []}


def test_runs_of_odd_rows(spark):
    """Nulls, empty texts, repeated and null ids, columns whose names clash, ties and nested runs."""
    texts = [None, "", " \n ", "a", "x y z " * 10 + "x x " * 13, "x y z " * 8 + "q " + "x y z " * 8, "u\u00a0v\u00a0" * 30]
    rows = [(i, t, "mine", 1) for i, t in enumerate(texts)] + [(4, texts[4], "mine", 1), (None, texts[5], None, 2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, runs string, id int")
    got = periodic_runs.find_runs(docs)
    assert got.columns == ["doc_id", "n_words", "runs", "collapsed"]
    seen = sorted((r.doc_id if r.doc_id is not None else -1, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got.collect())
    want = []
    for i, t, _, _ in rows:
        w = brute.words(t)
        runs = brute.periodic_runs(w)
        want.append((-1 if i is None else i, len(w), runs, brute.collapsed(w, runs)))
    assert seen == sorted(want)
    best = got.where("doc_id = 5").select(periodic_runs.strongest("runs").alias("b")).first().b
    assert tuple(best) == (0, 24, 3)  # the first of equals
    assert periodic_runs.find_runs(docs.limit(0)).count() == 0


def test_op11_matches_plain_version(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    want = {}
    for d, text in docs:
        w = brute.cycled(d, text)
        runs = brute.periodic_runs(w)
        best = max(runs, key=lambda r: (fractions.Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
        lines = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
        hashes = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, brute.collapsed(w, runs))]
        want[d] = (len(runs), *best, 1000 * best[1] // best[2] if runs else None, *hashes)
    got = QUERIES["op11_periodic_runs"](spark, sf_dir)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == want
    assert sum(x[0] for x in want.values()) >= 10
