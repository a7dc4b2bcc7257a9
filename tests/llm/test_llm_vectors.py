"""Whitening and the range join of vectors against plain versions."""

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F
from snapflow.llm import metric_join, vectors, whitening
from snapflow.llm.queries import QUERIES

VECTORS = "vec_id bigint, embedding array<float>, label int, id string, size int, x binary"


def table(spark, rows):
    """With columns whose names the operators use inside."""
    return spark.createDataFrame([(i, v, 1, "mine", 2, b"x") for i, v in rows], VECTORS)


def floats(m):
    return np.asarray(m, np.float32).astype(float).tolist()


def test_packing_keeps_vectors_apart():
    rng = np.random.default_rng(1)
    m = rng.integers(-300, 300, (60, 7))
    m[3], m[4, 5:], m[5] = 0, 0, m[5] * 10**9
    m[6, 0], m[7, 0], m[8, 0], m[9, 1] = -(2**63), 2**15, -(2**15), 2**63 - 1
    packed = vectors.pack_integers(m)
    assert (vectors.unpack_integers(packed, 7) == m).all() and len(set(packed.to_pylist())) == len({tuple(r) for r in m.tolist()})
    assert (vectors.unpack_integers(packed.slice(2, 9), 7) == m[2:11]).all()
    f = rng.normal(size=(20, 5))
    f[:10] = f[:10].astype(np.float32)
    f[3, 3:], f[4, 4], f[5] = 0, -0.0, 1e300
    assert (vectors.unpack_floats(vectors.pack_floats(f), 5) == f).all()
    assert vectors.pack_floats(np.array([[1.0, -0.0]])) == vectors.pack_floats(np.array([[1.0]]))


EIGENVALUES = {
    "apart": np.linspace(1, 2, 64), "one": [3.0], "none": np.zeros(5), "rank one": np.r_[1, np.zeros(19)],
    "equal": np.r_[5, 5, 5, 5, np.ones(30)], "close": np.r_[5, 5, 5, 5, 1 + 1e-9 * np.arange(60)],
    "nearly equal": 1 + 1e-13 * np.arange(40), "pair below float32": np.r_[1e6, 1e6 + 1e-5, np.ones(28)], "wide": 10.0 ** -np.arange(64),
    "huge": np.array([3e200, 2e200, 1e190]), "tiny": np.array([3e-200, 2e-200, 1e-210]),
}


@pytest.mark.parametrize("kind", EIGENVALUES)
def test_eigenpairs_to_double_precision(kind):
    wanted = np.asarray(EIGENVALUES[kind], float)
    q = np.linalg.qr(np.random.default_rng(2).normal(size=(len(wanted), len(wanted))))[0]
    a = (q * wanted) @ q.T
    a = (a + a.T) / 2
    size = max(np.abs(a).max(), 1e-300)
    values, x = whitening.eigenpairs(a)
    assert np.abs(x.T @ x - np.eye(len(a))).max() < 2e-15
    assert np.abs(a @ x - x * values).max() < 2e-15 * size
    assert np.abs(values - np.sort(wanted)[::-1]).max() < 1e-14 * size


def test_refinement_starts_from_few_digits():
    """What float32 leaves open is found by the iterations, not by the start."""
    q = np.linalg.qr(np.random.default_rng(3).normal(size=(30, 30)))[0]
    a = (q * np.arange(1, 31)) @ q.T
    a = (a + a.T) / 2
    rough = np.linalg.eigh(a)[1] + np.random.default_rng(4).normal(size=(30, 30)) * 1e-4
    x = whitening.eigenpairs(a, start=lambda _: rough.astype(np.longdouble))[1]
    assert np.abs(np.abs((x * q[:, ::-1]).sum(0)) - 1).max() < 1e-14


def check_whitened(got, rows):
    n, want, explained = brute.whitened(rows)
    k = len(explained)
    order = lambda r: (r[0] is None, r[0] or 0, r[3] or 0, r[1])
    got = sorted(got, key=order)
    want = sorted([(i, c, n, d, w[c - 1]) for i, d, w in want for c in range(1, k + 1)], key=order)
    assert [tuple(r[:4]) for r in got] == [r[:4] for r in want]
    for c in range(1, k + 1):
        z, y = (np.array([r[4] for r in rows if r[1] == c]) for rows in (got, want))
        assert np.abs(z * np.sign(z @ y) - y).max() < 1e-8
    got.sort(key=lambda r: r.component)
    assert np.allclose([r.explained for r in got], np.repeat(explained, len(got) // k), rtol=1e-9)
    assert {r.identity_error < 1e-6 for r in got} == {True} and len({r.identity_error for r in got}) == 1


def test_whitening_matches_plain_version(spark):
    rng = np.random.default_rng(5)
    m = floats(rng.normal(size=(120, 9)) * np.linspace(3, 0.2, 9))
    rows = list(enumerate(m)) + [(200, m[3]), (3, m[3]), (3, m[4]), (None, m[5]), (300, m[6][:4]), (301, m[6][:4] + [0.0])]
    odd = [(400, None), (401, [1.0, None]), (402, [float("nan")] * 9), (403, [float("inf")] + m[0][1:])]
    check_whitened(whitening.whiten(table(spark, rows + odd)).repartition(5).collect(), rows)


def test_whitening_of_tables_without_variance(spark):
    def of(rows, **more):
        return sorted(map(tuple, whitening.whiten(table(spark, rows), **more).collect()), key=lambda r: r[:2])

    assert of([]) == [] and of([(1, None), (2, [None])]) == [] and of([(1, []), (2, [])]) == []
    one = of([(1, [0.5, 0.25]), (2, [0.5, 0.25])])
    assert one == [(i, c, 1, 0, None, None, None) for i in (1, 2) for c in (1, 2)]
    two = of([(1, [1.0, 0.0, 0.0]), (2, [0.0, 0.0, 0.0]), (2, [0.0, 0.0, 0.0])])
    assert [r[:4] for r in two] == [(i, c, 2, 256 * 256) for i, c in [(1, 1), (1, 2), (1, 3), (2, 1), (2, 1), (2, 2), (2, 2), (2, 3), (2, 3)]]
    assert [abs(r[4]) if r[4] is not None else None for r in two] == [1.0 if r[1] == 1 else None for r in two]
    assert [r[5] for r in two] == [1.0 if r[1] == 1 else 0.0 for r in two] and {r[6] for r in two} == {0.0}


def test_deviations_stay_exact_when_sums_are_large(spark):
    rows = [(1, [2.0**30, 1.0]), (2, [-(2.0**30), 0.5]), (3, [3e38, 0.0])]
    got = {r.vec_id: r.deviation for r in whitening.whiten(table(spark, rows)).where("component = 1").collect()}
    assert got == {1: None, 2: None, 3: None}  # beyond 64 bits
    rows = [(i, [2.0**20 + i, 1.0]) for i in range(3)]
    got = {r.vec_id: r.deviation for r in whitening.whiten(table(spark, rows)).where("component = 1").collect()}
    assert got == {0: (3 * 256) ** 2, 1: 0, 2: (3 * 256) ** 2}


def test_op12_matches_plain_version(spark, sf_dir):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got = QUERIES["op12_embedding_whitening"](spark, sf_dir)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check_whitened(got.collect(), rows)


def near_vectors(seed, dim=6):
    """Spread vectors, chains and groups of near copies around the limit, multiples, exact copies."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, dim))
    near = centres[rng.integers(0, 8, 150)] + rng.normal(size=(150, dim)) * rng.choice([0.02, 0.2, 0.4], 150)[:, None]
    turn = np.linspace(0, 3, 25)
    chain = np.column_stack([np.cos(turn), np.sin(turn), np.zeros((25, dim - 2))])
    m = floats(np.concatenate([rng.normal(size=(120, dim)), near, chain, 1e-20 * near[:5], 1e18 * near[5:9], near[:20]]))
    ids = rng.permutation(len(m)).tolist()
    return list(zip(ids, m))


@pytest.mark.parametrize("seed,small", [(1, False), (2, True), (3, True)])
def test_links_match_plain_version(spark, monkeypatch, seed, small):
    """Also with many cells, parts and chunks, and few rows multiplied at once."""
    rows = near_vectors(seed)
    if small:
        monkeypatch.setattr(metric_join, "TILE_ROWS", 20)
        monkeypatch.setattr(metric_join, "SEND_ROWS", 64)
        monkeypatch.setattr(metric_join, "SAMPLE", 90)
    got = metric_join.near_duplicates(table(spark, rows))
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(map(tuple, got.collect())) == sorted(brute.near_vectors(rows))


def test_links_of_odd_rows(spark):
    rows = near_vectors(4)[:60]
    v = rows[0][1]
    odd = [(1000, None), (1001, []), (1002, [0.0] * 6), (1003, [None] + v[1:]), (1004, [float("nan")] * 6), (1005, [float("inf")] * 6)]
    same = [(2000, v), (2000, v), (2001, v), (2001, [-x for x in v]), (None, v), (None, None), (2002, [1.0]), (2003, [1.0, 0.0])]
    got = metric_join.near_duplicates(table(spark, rows + odd + same)).collect()
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(brute.near_vectors(rows + odd + same), key=key)
    for few in ([], [(5, None)], [(5, v)], [(5, v), (6, v)]):
        assert sorted(map(tuple, metric_join.near_duplicates(table(spark, few)).collect())) == brute.near_vectors(few)


def test_links_at_the_limit(spark):
    """Cosines of exactly 0.95 link; the next smaller ones do not."""
    rows = [(1, [1.0, 0.0]), (2, [19.0, float(np.sqrt(39.0))]), (3, [3.0, 4.0]), (4, [4.0, 3.0])]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    for similarity in (0.95, 0.96, 0.9600000001, 0.5999999999, 0.6, 0.6000000001):
        got = metric_join.near_duplicates(table(spark, rows), similarity=similarity)
        assert sorted(map(tuple, got.collect())) == brute.near_vectors(rows, similarity)


def test_cells_skip_what_cannot_be_near():
    """Of spread groups little is sent; what is left out is never within reach."""
    rng = np.random.default_rng(6)
    u = metric_join.unit(np.repeat(rng.normal(size=(40, 64)), 50, axis=0) + 0.03 * rng.normal(size=(2000, 64)))
    cells = metric_join.Cells(metric_join.farthest_first(u[::7], 40), float(np.sqrt(0.1)))
    home, far = cells.homes(u)
    own = far[np.arange(len(u)), home]
    cells.low, cells.high = (np.array([f(own[home == c]) for c in range(40)]) for f in (np.min, np.max))
    sent = cells.visits(u)
    assert sent.sum() < 0.02 * sent.size
    met = (home[:, None] == home[None, :]) | sent[:, home] | sent[:, home].T
    assert not ((u @ u.T >= 0.95) & ~met).any()


def test_a_large_group_is_counted_without_pairs():
    u = metric_join.unit(np.random.default_rng(7).normal(size=64) + 0.01 * np.random.default_rng(8).normal(size=(3000, 64)))
    weight = np.arange(1, 3001)
    links, root = metric_join.compare(u[:2000], weight[:2000], u[2000:], weight[2000:], True, 0.95)
    assert (root == 0).all()
    assert (links[:2000] == weight.sum() - weight[:2000]).all() and (links[2000:] == weight[:2000].sum()).all()


def test_op13_matches_plain_version(spark, sf_dir):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").where(F.col("vec_id") < 400).collect()]
    close = [(1000 + i, [x + 0.01 * (k % 3) for k, x in enumerate(v)]) for i, v in rows[::9]]
    got = metric_join.near_duplicates(table(spark, rows + close)).collect()
    want = brute.near_vectors([(i, [float(np.float32(x)) for x in v]) for i, v in rows + close])
    assert sorted(map(tuple, got)) == sorted(want) and sum(r[1] for r in want) > 60
    assert QUERIES["op13_embedding_near_dedup"](spark, sf_dir).count() == spark.read.parquet(f"{sf_dir}/embeddings.parquet").count()
