"""Growing a forest of regression trees to know its errors, a share of the trees per task.

Spark's own fit keeps the rows where they are and sends the statistics of every node of every pass, which costs most where
trees are deep and their nodes many and small.  Rows in bins take a byte per feature, so as long as all of them fit into a
task, a task can hold them and grow whole trees, and nothing is sent between its passes.  The trees are of Spark's kind: its bins,
rows drawn by a Poisson distribution, features drawn per node, the split of the largest fall in variance of those that leave enough
rows on both sides.  Only the draws are others.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# What a task may hold: of every row its bins, and beside them what is known of it while a tree grows.
MOST_BYTES = 512 << 20
ROW_BYTES = 100
MOST_SLOTS = 256  # wider features are sparse, and here every slot takes its byte
MOST_BINS = 256
ROWS_AND_TREES = 200_000  # rows times trees that are worth a task
LEAST_SAMPLE = 10_000  # rows that bins are chosen by, as many as Spark takes, or the square of the number of bins
NOISE = 1e-12  # falls in variance that are smaller, relative to the squares, are rounding errors
BLOCK = "valid boolean, rows int, x binary, truth binary, weight binary, digest binary"


@dataclass(frozen=True)
class Growth:
    """Settings of the trees."""

    seed: int
    trees: int
    bins: int
    least: int  # rows of a node
    least_gain: float
    drawn: float | None  # mean number of times that a row is drawn; None: every row once
    tried: int  # features that a node draws


def _slots(rows: DataFrame, column: str) -> tuple[int, list[int]] | None:
    """Number of features, and those with two values; None if that is not known or one has more categories."""
    attributes = rows.schema[column].metadata.get("ml_attr", {})
    groups = attributes.get("attrs", {})
    if "nominal" in groups or not attributes.get("num_attrs"):
        return None
    return attributes["num_attrs"], [slot["idx"] for slot in groups.get("binary", [])]


def growth_of(forest: RandomForestRegressor, slots: int) -> Growth | None:
    """The settings of a forest; None if they are beyond what is grown here."""
    value = forest.getOrDefault
    strategy = value("featureSubsetStrategy")
    if strategy == "auto":
        strategy = "onethird" if value("numTrees") > 1 else "all"
    tried = {"all": slots, "onethird": math.ceil(slots / 3)}.get(strategy)
    drawn = value("subsamplingRate") if value("bootstrap") else None
    if tried is None or (drawn is None and value("subsamplingRate") != 1) or value("minWeightFractionPerNode") or value("maxBins") > MOST_BINS:
        return None
    return Growth(
        value("seed"), value("numTrees"), value("maxBins"), value("minInstancesPerNode"), value("minInfoGain"), drawn, tried
    )


def thresholds(values: np.ndarray, weights: np.ndarray, bins: int) -> np.ndarray:
    """Upper ends of all bins of a feature but the last: Spark's rule, the middles between neighbouring values, of many values
    those where the weight passes a bin's share."""
    values, place = np.unique(values, return_inverse=True)
    middles = (values[:-1] + values[1:]) / 2
    if len(middles) < bins:
        return middles
    counts = np.bincount(place, weights).tolist()
    share = sum(counts) / bins
    found, target, before = [], share, counts[0]
    for i, count in enumerate(counts[1:]):
        now = before + count
        if abs(before - target) < abs(now - target):
            found.append(middles[i])
            target += share
        before = now
    return np.array(found)


def tree_grower(growth: Growth) -> Callable[..., list[np.ndarray]]:
    """The function that grows a tree.  Like all that runs in the tasks here it is sent whole, so workers need not find this package."""
    bins, least, least_gain, n_tried = growth.bins, growth.least, growth.least_gain, growth.tried

    def fraction(of: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """of squared / weights, and 0 without weight."""
        return np.divide(of * of, weights, out=np.zeros(weights.shape), where=weights > 0)

    def grow_tree(
        x: np.ndarray, y: np.ndarray, weight: np.ndarray, drawn: np.ndarray, asked: np.ndarray, depths: Sequence[int], rng: np.random.Generator
    ) -> list[np.ndarray]:
        """What a tree, grown level by level, predicts for the rows of ``asked`` if it is cut at each of the depths.

        ``x`` and ``asked`` hold a bin per feature and row, ``drawn`` how often a row is drawn.
        """
        (slots, n), m = x.shape, asked.shape[1]
        flat, asked_flat = x.ravel(), asked.ravel()
        at, node = np.flatnonzero(drawn), np.zeros(np.count_nonzero(drawn), np.int64)
        count = drawn[at].astype(np.float64)
        weighted = not (weight == 1).all()
        w = count * weight[at] if weighted else count
        wy, y = w * y[at], y[at]
        left, place, guess = np.arange(m), np.zeros(m, np.int64), np.zeros(m)
        nodes, found = 1 if len(at) else 0, []
        for depth in range(depths[-1] + 1):
            if nodes:
                counts, weights, sums, squares = (np.bincount(node, v, nodes) for v in (count, w, wy, wy * y))
                guess[left] = np.divide(sums, weights, out=np.zeros(nodes), where=weights > 0)[place]
            if depth in depths:
                found.append(guess.copy())
            if not nodes or depth == depths[-1]:
                continue

            def follow(chosen: np.ndarray) -> None:
                """Goes on with some of the nodes, and with the rows in them."""
                nonlocal at, node, count, w, wy, y, left, place, counts, weights, sums, squares, nodes
                number = np.full(nodes, -1)
                number[chosen] = np.arange(len(chosen))
                node, place = number[node], number[place]
                inside, seen = node >= 0, place >= 0
                same = w is count
                at, node, wy, y, count = at[inside], node[inside], wy[inside], y[inside], count[inside]
                w = count if same else w[inside]
                left, place = left[seen], place[seen]
                counts, weights, sums, squares, nodes = counts[chosen], weights[chosen], sums[chosen], squares[chosen], len(chosen)

            base = fraction(sums, weights)
            follow(np.flatnonzero((squares - base > NOISE * squares) & (counts >= 2 * least)))
            if not nodes:
                continue
            base = fraction(sums, weights)
            if n_tried < slots:
                tried = rng.random((nodes, slots)).argpartition(n_tried, axis=1)[:, : n_tried]
            else:
                tried = np.tile(np.arange(slots), (nodes, 1))
            best, best_slot, best_bin = np.full(nodes, -np.inf), np.zeros(nodes, np.int64), np.zeros(nodes, np.int64)
            each, first, cell, key = np.arange(nodes), node * bins, np.empty(len(node), np.int64), np.empty(len(node), np.int64)
            for slot in tried.T:
                (slot * n).take(node, out=cell, mode="clip")
                cell += at
                np.add(first, flat.take(cell), out=key)
                below = lambda v: np.bincount(key, v, nodes * bins).reshape(nodes, bins)[:, :-1].cumsum(axis=1)  # noqa: B023, E731
                w_below, wy_below = below(w), below(wy)
                n_below = below(count) if weighted else w_below
                gain = fraction(wy_below, w_below) + fraction(sums[:, None] - wy_below, weights[:, None] - w_below)
                gain[(n_below < least) | (counts[:, None] - n_below < least)] = -np.inf
                cut = gain.argmax(axis=1)
                gain = gain[each, cut] - base
                better = gain > best
                best[better], best_slot[better], best_bin[better] = gain[better], slot[better], cut[better]
            split = np.flatnonzero((best > NOISE * squares) & (best >= least_gain * weights))
            best_slot, best_bin = best_slot[split], best_bin[split]
            follow(split)
            node = 2 * node + (flat[best_slot[node] * n + at] > best_bin[node])
            place = 2 * place + (asked_flat[best_slot[place] * m + left] > best_bin[place])
            nodes *= 2
        return found

    return grow_tree


def _tasks(spark: SparkSession, n: int) -> list[int]:
    """Keys that a repartition by them deals to n different tasks."""
    keys = spark.range(64 * n).select("id", F.pmod(F.hash("id"), F.lit(n)).alias("task")).groupBy("task").agg(F.min("id").alias("id"))
    return sorted(row["id"] for row in keys.collect())


def grown_errors(
    forest: RandomForestRegressor, train: DataFrame, valid: DataFrame, sizes: Sequence[int], depths: Sequence[int]
) -> dict[tuple[int, int], float] | None:
    """RMSE on ``valid`` of the forests of the first trees of ``forest``, cut at a depth, for all sizes and depths.

    None if the rows are too many for a task, or the forest is of another kind than those grown here.
    """
    spark, features, label = train.sparkSession, forest.getFeaturesCol(), forest.getLabelCol()
    known = _slots(train, features)
    growth = known and growth_of(forest, known[0])
    if not growth or known[0] > MOST_SLOTS:
        return None
    slots, binary = known
    n_train, n_valid = train.count(), valid.count()
    if (n_train + n_valid) * (slots + ROW_BYTES) > MOST_BYTES:
        return None
    if not n_train:
        raise ValueError("A forest needs training rows")
    weight = F.col(forest.getWeightCol()).cast("double") if forest.isSet("weightCol") and forest.getWeightCol() else F.lit(1.0)
    values = [vector_to_array(features).alias("values"), F.col(label).cast("double").alias("truth")]

    def given(rows: DataFrame, is_valid: bool) -> DataFrame:
        rows = rows.select(*values, (F.lit(1.0) if is_valid else weight).alias("weight"), F.lit(is_valid).alias("valid"))
        return rows.withColumn("digest", F.xxhash64("values", "truth", "weight"))

    training = given(train, False)
    share = max(growth.bins**2, LEAST_SAMPLE) / n_train
    sample = training if share >= 1 else training.sample(share, growth.seed)  # to choose the bins by, as Spark does
    sample = sample.select("values", "weight").toArrow()  # some ten thousand rows, or as many as bins squared
    columns = sample["values"].combine_chunks().flatten().to_numpy().reshape(-1, slots).T
    sampled = sample["weight"].to_numpy()
    bins = min(growth.bins, n_train)
    ends = [np.array([0.5]) if j in set(binary) else thresholds(column, sampled, bins) for j, column in enumerate(columns)]

    def pack(batches):
        for batch in batches:
            x = batch["values"].flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, slots)
            truth, weights = (batch[c].to_numpy(zero_copy_only=False).astype(np.float64) for c in ("truth", "weight"))
            is_valid = batch["valid"].to_numpy(zero_copy_only=False).astype(bool)
            if not (np.isfinite(x[~is_valid]).all() and np.isfinite(truth[~is_valid]).all() and (weights >= 0).all()):
                raise ValueError("Features and targets of training rows must be numbers, and weights not negative")
            placed = np.array([np.searchsorted(e, column) for e, column in zip(ends, x.T)], np.uint8).reshape(slots, -1)
            digest = batch["digest"].to_numpy()
            for side in (False, True):
                here = is_valid == side
                if here.any():
                    parts = [pa.array([a.tobytes()], pa.binary()) for a in (placed[:, here], truth[here], weights[here], digest[here])]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([side]), pa.array([here.sum()], pa.int32()), *parts], ["valid", "rows", "x", "truth", "weight", "digest"]
                    )

    chunks = max(1, min(growth.trees, spark.sparkContext.defaultParallelism, n_train * growth.trees // ROWS_AND_TREES))
    keys = _tasks(spark, chunks)
    pairs = [(size, depth) for size in sizes for depth in depths]
    names = [f"sum_{size}_{depth}" for size, depth in pairs]
    grow_tree, seed, trees, mean = tree_grower(growth), growth.seed, growth.trees, growth.drawn

    def side(table, valid):
        """Bins, truth and weights of the rows, in an order that hangs on their values alone."""
        batches = [b for b in table.to_batches() if b.num_rows]
        blocks = [(b, i) for b in batches for i in range(b.num_rows) if b["valid"][i].as_py() == valid]

        def joined(name, kind):
            return np.concatenate([np.empty(0, kind), *[np.frombuffer(b[name][i].as_buffer(), kind) for b, i in blocks]])

        truth, weights, digest = joined("truth", np.float64), joined("weight", np.float64), joined("digest", np.int64)
        order = np.lexsort((truth, digest))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        x, begin = np.empty((slots, len(order)), np.uint8), 0
        for b, i in blocks:
            end = begin + b["rows"][i].as_py()
            x[:, place[begin:end]] = np.frombuffer(b["x"][i].as_buffer(), np.uint8).reshape(slots, -1)
            begin = end
        return x, truth[order], weights[order]

    def grow(key, table):
        x, y, weights = side(table, False)
        asked, truth, _ = side(table, True)
        del table
        sums = np.zeros((len(sizes), len(depths), len(truth)))
        for tree in range(keys.index(key[0].as_py()), trees, chunks):
            rng = np.random.default_rng([seed % (1 << 64), tree])
            drawn = np.ones(len(y), np.int64) if mean is None else rng.poisson(mean, len(y))
            found = np.array(grow_tree(x, y, weights, drawn, asked, depths, rng))
            for size, total in zip(sizes, sums):
                if tree < size:
                    total += found
        columns = {"row": np.arange(len(truth)), "truth": truth, **dict(zip(names, sums.reshape(len(names), -1)))}
        return pa.table(columns)

    rows = training.unionByName(given(valid, True))
    dealt = rows.mapInArrow(pack, BLOCK).withColumn("task", F.explode(F.array(*[F.lit(k).cast("long") for k in keys]))).repartition(chunks, "task")
    ddl = "row bigint, truth double, " + ", ".join(f"{name} double" for name in names)
    grown = dealt.groupBy("task").applyInArrow(grow, ddl).groupBy("row")
    grown = grown.agg(F.first("truth").alias("truth"), *[F.sum(name).alias(name) for name in names])
    error = {pair: F.col(name) / pair[0] - F.col("truth") for pair, name in zip(pairs, names)}
    row = grown.agg(*[F.sqrt(F.avg(error[pair] * error[pair])).alias(name) for pair, name in zip(pairs, names)]).first()
    return {pair: row[name] for pair, name in zip(pairs, names)}
