"""Near duplicates of embeddings by an exact metric range join.

Two unit vectors with a cosine of s or more are at most r = sqrt(2 - 2 s) apart.  Every vector lives in the cell of its
nearest pivot.  It is sent on to another cell only if that cell can hold a vector within r: the plane between the
two pivots must be within r of it, and its distance to the other pivot within r of the cell's ring, the range of distances
that the cell's vectors have; both follow from the triangle inequality.  Of two cells one sends to the other, so each
pair of vectors meets once.  Cells are compared independently, in tiles of bounded size: a cell's vectors in parts, its
visitors in chunks, so neither a hot cell nor its visitors gather in one task.

Equal vectors are one node with a weight.  A tile emits no pairs, but per vector how many others it is linked with and one
link to a vector of the same group, which is enough for the components.

Pivots are a bounded sample of the vectors, spread out by farthest-first choice; every vector is in the index.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .tables import written
from .vectors import matrix, pack_floats, unpack_floats, usable

SAMPLE = 4_096  # vectors that pivots are chosen from
PIVOTS = (16, 512)  # so many at least, if there are vectors enough, and at most
TILE_ROWS = 16_384  # most vectors on either side of a tile
BLOCK_ROWS = 512  # rows of a tile that are multiplied at once
SEND_ROWS = 50_000  # rows that a task prepares for sending at once
SALTS = 16  # a vector that very many rows share is joined with them in so many tasks
MAX_TASKS = 4_096
ROUNDING = 1e-9  # distances are wrong by less
COARSE = 1e-4  # products in float32 are wrong by less


def scaled(v: np.ndarray) -> np.ndarray:
    """Rows divided by powers of two, which is exact, so that products neither overflow nor vanish."""
    return np.ldexp(v, -np.frexp(np.abs(v).max(1, initial=0.0))[1][:, None])


def unit(v: np.ndarray) -> np.ndarray:
    """Rows of length 1, whatever their size; rows of zeros stay."""
    v = scaled(v)
    norm = np.sqrt((v * v).sum(1))
    return v / np.where(norm > 0, norm, 1)[:, None]


def distances(u: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Between unit vectors."""
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (u @ w.T)))


def farthest_first(u: np.ndarray, n: int) -> np.ndarray:
    """At most n of the vectors, each the one that is farthest from those before; fewer if there are no more places."""
    chosen = [0]
    far = distances(u, u[:1])[:, 0]
    while len(chosen) < min(n, len(u)):
        k = int(far.argmax())
        if far[k] < 1e-6:
            break
        chosen.append(k)
        far = np.minimum(far, distances(u, u[k : k + 1])[:, 0])
    return u[chosen]


@dataclass
class Cells:
    """Pivots, the ring of each cell, and into how many parts and chunks cells and visitors are cut."""

    pivots: np.ndarray
    reach: float
    low: np.ndarray | None = None
    high: np.ndarray | None = None
    parts: np.ndarray | None = None
    chunks: np.ndarray | None = None

    def homes(self, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest pivot, and the distances to all."""
        far = distances(u, self.pivots)
        return far.argmin(1), far

    def visits(self, u: np.ndarray) -> np.ndarray:
        """For every vector and cell: has the vector to be sent there (not to its own)?"""
        home, far = self.homes(u)
        between = distances(self.pivots, self.pivots)[home]
        at_home = far[np.arange(len(u)), home][:, None]
        plane = (far * far - at_home * at_home) / np.where(between > 0, 2 * between, 1)
        reach = self.reach + ROUNDING
        near = (plane <= reach) & (far <= self.high + reach) & (far >= self.low - reach)
        cell = np.arange(len(self.pivots))[None, :]
        sends = ((cell + home[:, None]) % 2 == 0) == (home[:, None] < cell)  # of two cells one sends
        return near & sends & (cell != home[:, None])


class _Groups:
    """Nodes of a tile that are linked, directly or not."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return int(i)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        for x, y in zip(a.tolist(), b.tolist()):
            x, y = self.root(x), self.root(y)
            if x != y:
                self.up[max(x, y)] = min(x, y)

    def roots(self) -> np.ndarray:
        up = self.up
        while (up[up] != up).any():
            up = up[up]
        return up


class _Side:
    """Vectors of a tile, in double and in single precision."""

    def __init__(self, given: np.ndarray):
        self.given, self.unit = given, unit(given)
        self.rough = self.unit.astype(np.float32)


def links_of(a: _Side, at: int, b: _Side, similarity: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of a block of a and rows of b that have links, and the links between them: cosines in double precision."""
    near = a.rough[at : at + BLOCK_ROWS] @ b.rough.T >= similarity - COARSE
    rows = np.flatnonzero(near.any(1))
    columns = np.flatnonzero(near[rows].any(0))
    rows = rows + at
    cosine = a.unit[rows] @ b.unit[columns].T
    linked = cosine >= similarity
    for i, j in zip(*np.nonzero(np.abs(cosine - similarity) < 1e-13)):  # rounding decides: with more digits, from the vectors as given
        x, y = (scaled(side.given[[k]])[0].astype(np.longdouble) for side, k in ((a, rows[i]), (b, columns[j])))
        linked[i, j] = float((x * y).sum() / np.sqrt((x * x).sum() * (y * y).sum())) >= similarity
    return rows, columns, linked


def compare(home: np.ndarray, home_weight, visitors: np.ndarray, visitor_weight, within: bool, similarity: float):
    """Weight of the links of each vector of a tile, home ones first, and for each a vector of its group."""
    n = len(home)
    weight, groups = np.zeros(n + len(visitors), np.int64), _Groups(n + len(visitors))
    own = _Side(home)
    sides = [(n, _Side(visitors), visitor_weight)] if len(visitors) else []
    if within:
        sides.append((0, own, home_weight))
    for shift, others, other_weight in sides:
        for at in range(0, n, BLOCK_ROWS):
            rows, columns, linked = links_of(own, at, others, similarity)
            if not shift:
                linked &= rows[:, None] != columns[None, :]
            if not linked.any():
                continue
            weight[rows] += linked @ other_weight[columns]
            if shift:
                weight[columns + shift] += home_weight[rows] @ linked
            hit = linked.any(0)
            columns, linked = columns[hit], linked[:, hit]
            first = linked.argmax(0)  # a row that each column is linked with; other rows of the column join that one
            groups.link(columns + shift, rows[first])
            order = np.argsort(first, kind="stable")
            heads, starts = np.unique(first[order], return_index=True)
            i, k = np.nonzero(np.logical_or.reduceat(linked[:, order], starts, axis=1))
            groups.link(rows[i], rows[heads[k]])
    return weight, groups.roots()


NODE = "rep bigint, digest binary"
SENT = pa.schema([
    ("cell", pa.int32()), ("part", pa.int32()), ("chunk", pa.int32()), ("visits", pa.bool_()), ("rep", pa.int64()), ("digest", pa.binary()),
    ("weight", pa.int64()), ("x", pa.binary()),
])
FOUND = pa.schema([("rep", pa.int64()), ("digest", pa.binary()), ("links", pa.int64()), ("root_rep", pa.int64()), ("root_digest", pa.binary())])


def _ddl(schema: pa.Schema) -> str:
    kinds = {pa.int32(): "int", pa.int64(): "bigint", pa.bool_(): "boolean", pa.binary(): "binary"}
    return ", ".join(f"{f.name} {kinds[f.type]}" for f in schema)


def _laid_out(nodes: DataFrame, n: int, dim: int, similarity: float) -> Cells:
    """Cells for a table of nodes; the driver holds a bounded sample and a few numbers per pivot."""
    sample = nodes.orderBy(F.xxhash64("digest"), "digest").limit(SAMPLE).select("x").toArrow()
    sample = unit(unpack_floats(sample.column("x").combine_chunks(), dim))
    wanted = min(max(PIVOTS[0], -(-n // TILE_ROWS)), PIVOTS[1], -(-n // 64))
    cells = Cells(farthest_first(sample, wanted), float(np.sqrt(max(0.0, 2 - 2 * similarity))))
    k = len(cells.pivots)

    def rings(batches):
        size, low, high = np.zeros(k, np.int64), np.full(k, np.inf), np.full(k, -np.inf)
        for batch in batches:
            home, far = cells.homes(unit(unpack_floats(batch.column("x"), dim)))
            own = far[np.arange(len(home)), home]
            size += np.bincount(home, minlength=k)
            np.minimum.at(low, home, own)
            np.maximum.at(high, home, own)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k), pa.int32()), pa.array(size), pa.array(low), pa.array(high)], ["cell", "size", "low", "high"])

    found = nodes.select("x").mapInArrow(rings, "cell int, size bigint, low double, high double").groupBy("cell")
    found = found.agg(F.sum("size").alias("size"), F.min("low").alias("low"), F.max("high").alias("high")).orderBy("cell").toPandas()
    cells.low, cells.high = found["low"].to_numpy(), found["high"].to_numpy()

    def visitors(batches):
        size = np.zeros(k, np.int64)
        for batch in batches:
            size += cells.visits(unit(unpack_floats(batch.column("x"), dim))).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k), pa.int32()), pa.array(size)], ["cell", "size"])

    sent = nodes.select("x").mapInArrow(visitors, "cell int, size bigint").groupBy("cell").agg(F.sum("size").alias("size")).orderBy("cell").toPandas()
    part_rows = min(TILE_ROWS, max(256, 2 * n // k))
    size, own = sent["size"].to_numpy(), found["size"].to_numpy()
    cells.parts = np.maximum(1, -(-own // part_rows))
    cells.chunks = np.maximum(1, -(-(size + own * (cells.parts > 1)) // min(TILE_ROWS, 4 * part_rows)))
    return cells


def _tiles(nodes: DataFrame, cells: Cells, dim: int) -> DataFrame:
    """Every node as often as a tile needs it: at home once per chunk of visitors, as a visitor once per part."""
    parts, chunks = cells.parts, cells.chunks
    step = max(1, SEND_ROWS // int((parts + chunks).max() * len(parts)))

    def send(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                rows = batch.slice(at, step)
                u = unit(unpack_floats(rows.column("x"), dim))
                home, _ = cells.homes(u)
                deal = rows.column("deal").to_numpy()
                part = deal % parts[home]
                i, cell = np.nonzero(cells.visits(u))
                k = parts[cell]  # a visitor meets all parts of another cell
                away = [np.repeat(i, k), np.repeat(cell, k), np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)]
                k = parts[home] - 1 - part  # and the later parts of its own
                i = np.repeat(np.arange(len(u)), k)
                own = [i, home[i], part[i] + 1 + np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)]
                row, cell, to = (np.concatenate(x) for x in zip(away, own))
                chunk = (deal[row] // 4099) % chunks[cell]
                k = chunks[home]  # at home it meets all chunks
                i = np.repeat(np.arange(len(u)), k)
                row, cell, to = np.append(row, i), np.append(cell, home[i]), np.append(to, part[i])
                visits = np.arange(len(row)) < len(chunk)
                chunk = np.append(chunk, np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k))
                kept = rows.select(["rep", "digest", "weight", "x"]).take(pa.array(row))
                arrays = [pa.array(x, pa.int32()) for x in (cell, to, chunk)] + [pa.array(visits)]
                yield pa.RecordBatch.from_arrays([*arrays, *kept.columns], schema=SENT)

    dealt = nodes.withColumn("deal", F.xxhash64("digest").bitwiseAND((1 << 62) - 1))
    return dealt.mapInArrow(send, _ddl(SENT))


def _linked(nodes: DataFrame, cells: Cells, dim: int, similarity: float) -> DataFrame:
    """Per tile and node with links: their weight and a node of the same group."""

    def meet(rows: pa.Table) -> pa.Table:
        visits = rows.column("visits").to_numpy()
        rows = rows.take(pa.array(np.argsort(visits, kind="stable")))
        n = int((~visits).sum())
        v = unpack_floats(rows.column("x").combine_chunks(), dim)
        weight = rows.column("weight").to_numpy()
        within = bool(rows.column("chunk")[0].as_py() == 0)
        links, root = compare(v[:n], weight[:n], v[n:], weight[n:], within, similarity)
        hit = pa.array(np.flatnonzero(links > 0))
        root = rows.select(["rep", "digest"]).take(pa.array(root)).take(hit)
        own = rows.select(["rep", "digest"]).take(hit)
        return pa.table([*own.columns, pa.chunked_array([pa.array(links).take(hit)]), *root.columns], schema=FOUND)

    keys = ["cell", "part", "chunk"]
    tasks = int(min(MAX_TASKS, max(1, (cells.parts * cells.chunks).sum())))
    # a number is given, since adaptive merging goes by bytes, and the work by their square
    return _tiles(nodes, cells, dim).repartition(tasks, *keys).groupBy(*keys).applyInArrow(meet, _ddl(FOUND))


def near_duplicates(
    vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", similarity: float = 0.95
) -> DataFrame:
    """id, n_links, component_id and kept of every row.

    Rows are linked if the cosine of their vectors, in double precision, is at least ``similarity`` (above 0); n_links counts the
    other rows linked directly, component_id is the smallest id reachable by links, itself included, and kept says that it
    is the row's own.  Vectors that are null, all zero or hold a null or a number that is not finite are linked with nothing, and
    so are rows with a null id (their component is null, and they are not kept).  A vector that is shorter than others
    counts as filled up with zeros.  Rows with the same id are rows of their own: they are linked if their vectors are
    alike, and count each other.  An empty table gives an empty result; other columns are left behind.
    """
    given = vectors.select(
        F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v")
    )

    def pack(batches):
        for batch in batches:
            good = usable(batch.column("v"))
            m = matrix(batch.column("v").filter(pa.array(good)))
            place = np.cumsum(good) - 1
            good[good] = m.any(1)
            x = pack_floats(m).take(pa.array(place, mask=~good))
            size = batch.column("v").value_lengths().cast(pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("id"), size, x], ["id", "size", "x"])

    rows = given.mapInArrow(pack, "id bigint, size int, x binary").withColumn("digest", F.unhex(F.md5("x")))
    rows = written(rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")), "packed_vectors")
    part = rows.where("x IS NOT NULL AND id IS NOT NULL")
    grouped = part.groupBy("digest").agg(F.min("id").alias("rep"), F.count("*").alias("weight"), F.first("x").alias("x"))
    nodes = written(grouped, "distinct_vectors")
    n, dim = nodes.count(), part.agg(F.max("size")).first()[0] or 0
    if n:
        found = written(_linked(nodes, _laid_out(nodes, n, dim, similarity), dim, similarity), "linked_vectors")
    else:
        found = rows.sparkSession.createDataFrame([], _ddl(FOUND))
    edges = found.select(F.struct("rep", "digest").alias("a"), F.struct(F.col("root_rep").alias("rep"), F.col("root_digest").alias("digest")).alias("b"))
    named = components(edges).select(F.col("node.digest").alias("digest"), F.col("component.rep").alias("least"))
    links = found.groupBy("digest").agg(F.sum("links").alias("links"))
    known = nodes.select("digest", "rep", "weight").join(links, "digest", "left").join(named, "digest", "left")
    known = known.select(
        "digest", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("least", "rep").alias("component_id")
    )
    spread = part.select("digest", "salt").distinct().join(known, "digest")
    done = rows.select("id", F.when(F.col("id").isNotNull(), F.col("digest")).alias("digest"), "salt").join(spread, ["digest", "salt"], "left")
    component = F.coalesce("component_id", "id")
    return done.select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )
