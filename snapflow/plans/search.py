"""Searching the settings of a forest: shared fits, and a ledger that a restarted search goes on from."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..workspace import new_run_dir, remove
from .grow import grown_errors

FOLD = "_fold"
LEDGER = "search string, settings string, num_trees int, max_depth int, fold int, rmse double"
NESTED = ("numTrees", "maxDepth")  # settings of which the largest values hold the smaller ones
Folds = Callable[[int], tuple[DataFrame, DataFrame]]


def fold_of(columns: Sequence[str], folds: int, seed: int) -> Column:
    """Fold of a row, by a hash of its values: the same in every run, however the rows are laid out.  Equal rows share a fold."""
    return F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(folds)).cast("int")


def settings_text(settings: dict[str, int]) -> str:
    return ", ".join(f"{name}={value}" for name, value in sorted(settings.items()))


class Ledger:
    """Scores of (settings, number of trees, depth, fold) on shared storage, one small file per fit.

    ``search`` names what was searched (data, target, folds); scores of another search are not seen.  Without a path
    nothing is kept.
    """

    def __init__(self, spark: SparkSession, path: str | None, search: str):
        self.spark, self.path, self.search = spark, path, search

    def read(self) -> dict[tuple[str, int, int, int], float]:
        """As many rows as there are points and folds."""
        if self.path is None:
            return {}
        try:
            rows = self.spark.read.schema(LEDGER).json(f"{self.path}/*").where(F.col("search") == self.search).collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return {}
        return {(r.settings, r.num_trees, r.max_depth, r.fold): r.rmse for r in rows}

    def write(self, settings: str, fold: int, scores: dict[tuple[int, int], float]) -> None:
        """A fit that is scored again replaces its file."""
        if self.path is not None:
            rows = [(self.search, settings, trees, depth, fold, rmse) for (trees, depth), rmse in scores.items()]
            name = "".join(c if c.isalnum() else "-" for c in f"{settings} {fold}")
            self.spark.createDataFrame(rows, LEDGER).coalesce(1).write.mode("overwrite").json(f"{self.path}/{name}")


def leaf_values(model: RandomForestRegressionModel, spark: SparkSession, depths: Sequence[int]) -> list[np.ndarray]:
    """Per tree what its leaves predict if the tree is cut at each of the depths: a row per depth, a column per leaf.

    Leaves go from left to right, which is how Spark numbers them.  Below the cut a leaf predicts what its ancestor at that
    depth does.  The nodes are read from the saved form of the model, which lists those of every tree parents first.
    """
    path = new_run_dir(spark, "forest")
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.id", "nodeData.prediction", "nodeData.leftChild", "nodeData.rightChild")
    nodes = nodes.toPandas().sort_values(["treeID", "id"])  # the model's own size
    remove(spark, path)
    found = []
    for _, tree in nodes.groupby("treeID"):
        left, right = tree["leftChild"].to_numpy(), tree["rightChild"].to_numpy()
        inner = np.flatnonzero(left >= 0)
        parent, depth = np.zeros(len(tree), np.int64), np.zeros(len(tree), np.int64)
        parent[left[inner]], parent[right[inner]] = inner, inner
        for node in range(1, len(tree)):
            depth[node] = depth[parent[node]] + 1
        shown = []
        for cut in depths:
            at = np.flatnonzero(left < 0)
            while (deep := depth[at] > cut).any():
                at[deep] = parent[at[deep]]
            shown.append(tree["prediction"].to_numpy()[at])
        found.append(np.array(shown))
    return found


def nested_errors(
    model: RandomForestRegressionModel, rows: DataFrame, sizes: Sequence[int], depths: Sequence[int], label: str
) -> dict[tuple[int, int], float]:
    """RMSE of the forests of the first trees of a fitted one, cut at a depth, for all sizes and depths in one pass over the rows.

    A forest predicts the mean of its trees, and its trees are drawn alike, so the first k of them are a forest of k trees.
    How a node is split does not hang on the depth that is allowed, so a tree that is cut is the tree grown to that depth, up to
    the columns that nodes draw: where a fit takes several passes a level, they draw in another order, by the same chances.
    Spark walks the trees once and names the leaf that a row reaches in each; what the leaves predict is looked up in batches.
    """
    values = leaf_values(model, rows.sparkSession, depths)
    starts = np.cumsum([0, *[v.shape[1] for v in values[:-1]]])
    values = np.concatenate(values, axis=1)
    pairs = [(size, depth) for depth in depths for size in sizes]
    names = [f"error_{size}_{depth}" for size, depth in pairs]

    def errors(batches):
        for batch in batches:
            leaves = batch.column("leaves").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(starts))
            places = leaves.astype(np.int64) + starts
            truth = batch.column("truth").to_numpy(zero_copy_only=False)
            total = [np.cumsum(at_depth[places], axis=1) for at_depth in values]
            columns = [pa.array(total[depths.index(depth)][:, size - 1] / size - truth) for size, depth in pairs]
            yield pa.RecordBatch.from_arrays(columns, names)

    reached = model.copy({model.leafCol: "_leaves"}).transform(rows)
    reached = reached.select(vector_to_array("_leaves").alias("leaves"), F.col(label).alias("truth"))
    found = reached.mapInArrow(errors, ", ".join(f"{name} double" for name in names))
    row = found.agg(*[F.sqrt(F.avg(F.col(name) * F.col(name))).alias(name) for name in names]).first()
    return {pair: row[name] for pair, name in zip(pairs, names)}


@dataclass(frozen=True)
class Point:
    """Settings of a grid and their mean error over the folds."""

    settings: dict[str, int]
    rmse: float
    folds: int


@dataclass(frozen=True)
class Search:
    points: list[Point]  # in the order of the grid
    fitted: int  # forests that were fitted, not taken from the ledger

    def best(self) -> Point:
        """Smallest error; of equal ones the first."""
        return min(self.points, key=lambda p: p.rmse)


def search_forest(
    forest: RandomForestRegressor, grid: dict[str, Sequence[int]], folds: Folds, n_folds: int, ledger: Ledger, parallelism: int,
    stop_after: int | None = None,
) -> Search:
    """Mean error on the target of every point of the grid.

    Settings that differ in the number of trees and the depth alone share a fit per fold: the largest and deepest forest is
    fitted, and its first trees, cut, stand for the others.  Every fit is written to the ledger as soon as it is
    scored, so a search that was stopped fits only what is missing.  ``folds(k)`` gives the training and validation
    rows of fold k.  ``stop_after`` ends the search after so many fits, as a lost driver would; points without all folds are
    left out then.
    """
    sizes, depths = (sorted({int(n) for n in grid.get(name, [forest.getOrDefault(name)])}) for name in NESTED)
    shared: list[dict[str, int]] = [{}]
    for name, values in grid.items():
        if name not in NESTED:
            shared = [{**settings, name: value} for settings in shared for value in values]
    known = ledger.read()
    missing = [
        (settings, fold) for fold in range(n_folds) for settings in shared
        if any((settings_text(settings), size, depth, fold) not in known for size in sizes for depth in depths)
    ]
    missing = missing[:stop_after]

    def fit(task: tuple[dict[str, int], int]):
        settings, fold = task
        train, valid = folds(fold)
        largest = settings | dict(zip(NESTED, (sizes[-1], depths[-1])))
        forest_of_all = forest.copy({forest.getParam(name): value for name, value in largest.items()})
        scores = grown_errors(forest_of_all, train, valid, sizes, depths)
        if scores is None:
            scores = nested_errors(forest_of_all.fit(train), valid, sizes, depths, forest.getLabelCol())
        ledger.write(settings_text(settings), fold, scores)
        return {(settings_text(settings), size, depth, fold): rmse for (size, depth), rmse in scores.items()}

    if missing:
        with ThreadPool(min(parallelism, len(missing))) as pool:
            for scores in pool.imap_unordered(inheritable_thread_target(ledger.spark)(fit), missing):
                known |= scores
    points = []
    for size in sizes:
        for depth in depths:
            for settings in shared:
                errors = [known.get((settings_text(settings), size, depth, fold)) for fold in range(n_folds)]
                if None not in errors:
                    points.append(Point({"numTrees": size, "maxDepth": depth, **settings}, sum(errors) / n_folds, n_folds))
    return Search(points, len(missing))
