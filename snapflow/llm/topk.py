"""Exact top-k search by inner product with a pivot-distance index.

Every vector gets one more coordinate so that all have the same length M, every query a zero there;
then the largest inner product belongs to the nearest vector, and distances obey the triangle
inequality.  A vector is keyed by its nearest pivot and by its annulus, a range of distances to it; crowded
annuli are split into parts of bounded size.  Of every annulus the range of distances to each of the pivots is known: no
vector of it is nearer to a query q than max over all pivots p of lo - d(q, p) and d(q, p) - hi, which bounds its
inner product from above.  Queries meet their annuli in order of that bound: first the most promising ones, which give
each query a k-th best score, then those whose bound still reaches that score.  The rest is skipped, so results are exact.

Pivots are a bounded sample (the vectors with the smallest hashes of their ids); every row is indexed.  Vectors and
queries travel as integers in the narrowest width that holds them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import written
from .vectors import WIDTHS, matrix, pack_integers, unpack_integers, usable
from .whitening import integers

PIVOTS, ANNULI = 16, 16  # most pivots, and most annuli of a pivot
ANNULUS_ROWS = 2_048  # as many rows are wanted in an annulus before there are more pivots and annuli
PART_ROWS = 16_384  # most vectors that one task compares at once
QUERY_ROWS = 256  # queries packed into one row
BLOCK_QUERIES = 100_000  # about so many queries at most meet a part of an annulus in one task
FIRST_ANNULI = 2  # annuli of the first round
NONE = np.iinfo(np.int64).min
FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


@dataclass
class Geometry:
    """What every task needs to know: all of bounded size."""

    dim: int
    length: float  # M
    largest: int  # size of the largest component
    pivots: np.ndarray

    @property
    def width(self) -> str:
        """Narrowest integers that hold every component."""
        return next(w for w in WIDTHS if self.largest <= np.iinfo(w).max)

    def products(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Inner products, exact; those beyond 64 bits take the nearest number within."""
        most = self.dim * self.largest * self.largest
        if most < 1 << 52:
            return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
        if most < 1 << 62:
            return a @ b.T
        exact = a.astype(object) @ b.astype(object).T
        return np.clip(exact, NONE, np.iinfo(np.int64).max).astype(np.int64)

    def lift(self, v: np.ndarray) -> np.ndarray:
        v = v.astype(np.float64)
        extra = np.sqrt(np.maximum(0.0, self.length**2 - (v * v).sum(1)))
        return np.column_stack([v, extra])

    def distances(self, lifted: np.ndarray) -> np.ndarray:
        """From lifted vectors of length M to the lifted pivots."""
        inner = lifted @ self.lift(self.pivots).T
        return np.sqrt(np.maximum(0.0, 2 * self.length**2 - 2 * inner))

    def bounds(self, queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Largest possible score of every query with a vector of every annulus, whose distances to the pivots lie between
        low and high (a row per annulus, a column per pivot); rounding errors are allowed for."""
        q = queries.astype(np.float64)
        norm, m = np.sqrt((q * q).sum(1)), self.length
        if m == 0:
            return np.zeros((len(q), len(low)))
        stretched = q * np.where(norm > 0, m / np.where(norm > 0, norm, 1), 0)[:, None]
        near = self.distances(np.column_stack([stretched, np.zeros(len(q))]))
        gap = np.zeros((len(q), len(low)))
        for p in range(near.shape[1]):
            own = near[:, p, None]
            np.maximum(gap, np.maximum(low[:, p] - own, own - high[:, p]), out=gap)
        gap = np.maximum(0.0, gap - 1e-6 * m)
        return norm[:, None] * (m - gap * gap / (2 * m)) * (1 + 1e-9) + 1e-3


def top_k(
    vectors: DataFrame, is_query: Column, *, k: int, factor: int, id_col: str = "vec_id", vector_col: str = "embedding",
    pivots: int | None = None,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k best other rows; ties go to the smaller id.

    The score is the inner product of the components floor(factor * x), which are cut to 64 bits, as are scores beyond them.
    is_query is a condition on the columns of vectors.  Rows with a null id, a null vector or a component that is null or
    not finite take no part.  An id names a query: rows with the query's id are not among its candidates, its results
    are the k best pairs of any of its rows with another row, and candidate rows that share an id count each by itself.
    A vector that is shorter than others counts as filled up with zeros.  With fewer than k other rows a query has fewer
    results; a single or no row gives none.  ``pivots`` is the largest number of pivots.
    """
    given = vectors.select(
        F.col(f"`{id_col}`").cast("bigint").alias("id"), F.coalesce(is_query, F.lit(False)).alias("query"),
        F.col(f"`{vector_col}`").cast("array<double>").alias("v"),
    ).where("id IS NOT NULL")

    def pack(batches):
        for batch in batches:
            batch = batch.filter(pa.array(usable(batch.column("v"))))
            x = integers(matrix(batch.column("v")), factor)
            f = x.astype(np.float64)
            largest = np.maximum(x.max(1, initial=0), -(x.min(1, initial=0) + 1))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), batch.column("query"), batch.column("v").value_lengths().cast(pa.int32()),
                    pa.array((f * f).sum(1)), pa.array(largest), pack_integers(x),
                ],
                ["id", "query", "size", "norm", "largest", "x"],
            )

    rows = written(given.mapInArrow(pack, "id bigint, query boolean, size int, norm double, largest bigint, x binary"), "vectors")
    n, dim, top, largest = rows.agg(F.count("*"), F.max("size"), F.max("norm"), F.max("largest")).first()
    geometry = Geometry(max(1, dim or 0), float(np.sqrt(top or 0.0)), int(largest or 0) + 1, np.zeros((0, 1)))
    wanted = max(1, min(PIVOTS if pivots is None else pivots, n // ANNULUS_ROWS))
    chosen = rows.orderBy(F.xxhash64("id"), "id", "x").limit(wanted).select("x").toArrow().column("x").combine_chunks()
    geometry.pivots = unpack_integers(chosen, geometry.dim)
    wanted = len(geometry.pivots)
    rings = max(1, min(ANNULI, n // max(1, wanted * ANNULUS_ROWS)))

    def place(batches):
        for batch in batches:
            far = geometry.distances(geometry.lift(unpack_integers(batch.column("x"), geometry.dim)))
            nearest = far.argmin(1) if batch.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(nearest, pa.int32()), pa.array(far[np.arange(len(far)), nearest], pa.float64())],
                ["id", "query", "x", "pivot", "distance"],
            )

    placed = rows.select("id", "query", "x").mapInArrow(place, "id bigint, query boolean, x binary, pivot int, distance double")
    placed = written(placed, "pivot_distances")
    cuts = placed.groupBy("pivot").agg(F.percentile_approx("distance", [i / rings for i in range(1, rings)] or [1.0], 10_000).alias("cuts"))
    placed = placed.join(F.broadcast(cuts), "pivot")  # a row per pivot
    placed = placed.withColumn("annulus", F.col("pivot") * rings + F.size(F.filter("cuts", lambda c: c < F.col("distance"))))
    part_rows = min(PART_ROWS, max(64, 2 * n // (wanted * rings or 1)))
    placed = placed.withColumn("deal", F.pmod(F.xxhash64("id", "x"), F.lit(1 << 30).cast("long")))
    index = written(placed.select("annulus", "deal", "id", "query", "x"), "pivot_index")
    low, high, size = _rings(index, geometry, wanted * (rings + 1))
    parts = np.maximum(1, -(-size // part_rows))
    full = np.flatnonzero(size)  # annuli that hold vectors
    blocks = index.where("query").count() // BLOCK_QUERIES + 1

    def packs_of(batch):
        """The queries of each block, a bounded number at once."""
        block = batch.column("block").to_numpy()
        for b in np.unique(block).tolist():
            mine = np.flatnonzero(block == b)
            for at in range(0, len(mine), QUERY_ROWS):
                yield b, batch.take(pa.array(mine[at : at + QUERY_ROWS]))

    def visits(queries: DataFrame, first: bool) -> DataFrame:
        """A row for every part of an annulus that a pack of queries has to meet in this round."""

        def run(batches):
            for batch in batches:
                for block, own in packs_of(batch):
                    q = unpack_integers(own.column("x"), geometry.dim)
                    bound = geometry.bounds(q, low[full], high[full])
                    ids, least = own.column("id").to_numpy(), own.column("least").to_numpy()
                    order = np.argsort(-bound, axis=1, kind="stable")
                    turn = np.empty_like(order)
                    np.put_along_axis(turn, order, np.arange(len(full))[None, :].repeat(len(q), 0), 1)
                    meets = (turn < FIRST_ANNULI) if first else (turn >= FIRST_ANNULI) & (bound >= least[:, None])
                    out = {c: [] for c in VISIT.names}
                    for a in np.flatnonzero(meets.any(0)):
                        hit = meets[:, a]
                        packed = ids[hit].tobytes(), q[hit].astype(geometry.width).tobytes(), least[hit].tobytes()
                        for p in range(parts[full[a]]):
                            for c, x in zip(out, (int(full[a]), p, block, *packed)):
                                out[c].append(x)
                    yield pa.RecordBatch.from_pydict(out, schema=VISIT)

        queries = queries.select("*", F.pmod(F.xxhash64("id"), F.lit(blocks).cast("long")).alias("block"))
        return queries.mapInArrow(run, "annulus int, part int, block bigint, ids binary, vectors binary, least binary")

    def compare(rows: pa.Table, packs: pa.Table) -> pa.Table:
        out = {c: [] for c in FOUND.names}
        if rows.num_rows:
            v, ids = unpack_integers(rows.column("x").combine_chunks(), geometry.dim), rows.column("id").to_numpy()
            for who, q, least in zip(*(packs.column(c).to_pylist() for c in ("ids", "vectors", "least"))):
                who, least = np.frombuffer(who, np.int64), np.frombuffer(least, np.int64)
                q = np.frombuffer(q, geometry.width).astype(np.int64).reshape(len(who), -1)
                score = geometry.products(q, v)
                x, y = np.nonzero((score >= least[:, None]) & (who[:, None] != ids[None, :]))
                s = score[x, y]
                order = np.lexsort((ids[y], -s, x))  # by query, best first
                x, y, s = x[order], y[order], s[order]
                rank = np.arange(len(x)) - np.searchsorted(x, x)
                for c, found in zip(out, (who[x], ids[y], s)):
                    out[c].append(found[rank < k])
        return pa.table({c: pa.array(np.concatenate(x) if x else [], pa.int64()) for c, x in out.items()})

    part_of = F.get(F.array(*[F.lit(int(p)) for p in parts]) if len(parts) else F.array().cast("array<int>"), F.col("annulus"))
    dealt = index.withColumn("part", (F.col("deal") % part_of).cast("int"))

    def meet(queries: DataFrame, first: bool) -> DataFrame:
        keys = ["annulus", "part", "block"]
        asked = visits(queries, first).groupBy(*keys)
        each = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block")
        return dealt.select("annulus", "part", each, "id", "x").groupBy(*keys).cogroup(asked).applyInArrow(compare, "query_id bigint, vec_id bigint, score bigint")

    queries = index.where("query").select("id", "x")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    early = meet(queries.withColumn("least", F.lit(int(NONE)).cast("long")), True)
    early = written(early.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k), "first_found")
    reached = early.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("least"))
    later = queries.join(reached, "id", "left").withColumn("least", F.coalesce("least", F.lit(int(NONE)).cast("long")))
    found = early.drop("rank").unionByName(meet(later.select("id", "x", "least"), False))
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _rings(index: DataFrame, geometry: Geometry, annuli: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Smallest and largest distance of each annulus' vectors to each pivot, and their number; bounded by annuli and pivots."""
    pivots = len(geometry.pivots)

    def run(batches):
        low, high, size = np.full((annuli, pivots), np.inf), np.full((annuli, pivots), -np.inf), np.zeros(annuli, np.int64)
        for batch in batches:
            far = geometry.distances(geometry.lift(unpack_integers(batch.column("x"), geometry.dim)))
            annulus = batch.column("annulus").to_numpy()
            np.minimum.at(low, annulus, far)
            np.maximum.at(high, annulus, far)
            size += np.bincount(annulus, minlength=annuli)
        a, p = (x.ravel() for x in np.indices((annuli, pivots)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int32()), pa.array(p, pa.int32()), pa.array(low.ravel()), pa.array(high.ravel()), pa.array(np.repeat(size, pivots))],
            ["annulus", "pivot", "low", "high", "size"],
        )

    found = index.select("annulus", "x").mapInArrow(run, "annulus int, pivot int, low double, high double, size bigint")
    found = found.groupBy("annulus", "pivot").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("size").alias("size")).toPandas()
    low, high, size = np.full((annuli, pivots), np.inf), np.full((annuli, pivots), -np.inf), np.zeros(annuli, np.int64)
    at = found["annulus"].to_numpy(np.int64), found["pivot"].to_numpy(np.int64)
    low[at], high[at], size[at[0]] = found["low"], found["high"], found["size"]
    return low, high, size


VISIT = pa.schema([
    ("annulus", pa.int32()), ("part", pa.int32()), ("block", pa.int64()), ("ids", pa.binary()), ("vectors", pa.binary()), ("least", pa.binary()),
])
