"""Training and comparing regressors of the episode length on MLlib."""

from __future__ import annotations

import logging
import math
import time
from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from datetime import date

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from ..functions.features import add_shared_features, back_transform
from ..operators.evaluate import best_model, constant_baseline, regression_metrics
from ..operators.quality import require_rows
from ..operators.split import DEFAULT_CUTOFF, temporal_split, training_projection
from ..schemas import (
    CATEGORICAL_FEATURES, DATE_COLUMN, LABEL_COLUMN, MEAN_BASELINE, METRICS_SCHEMA, NUMERIC_FEATURES, TARGET_COLUMN,
)
from ..sources.metrics import read_metrics, write_model_metrics
from ..sources.models import load_model, model_path, save_model
from .search import FOLD, Ledger, Search, fold_of, search_forest

logger = logging.getLogger(__name__)

RAW_PREDICTION = "raw_prediction"
FOLDS = 3
ROWS_PER_TASK = 250_000
LEAST_ROWS_PER_TASK = 5_000  # tree fitting sends statistics of every node and task, so small tables are not cut small

# --- fixed values: settings of the candidates, and below the grid of the tuned forest ---
SEED = 42
LINEAR_SETTINGS = {"maxIter": 80, "regParam": 0.05}
BOOSTING_SETTINGS = {"maxIter": 60, "maxDepth": 6, "seed": SEED}
DEFAULT_TREES = 100
DEFAULT_DEPTH = 12

# Resources of a forest's fit, which leave its model as good: the statistics of so many MB of nodes are gathered in one
# pass of a task, few enough that adding to them seldom misses the processor's cache.  Rows remember the node that they
# have reached in each tree, else every pass walks down from the roots.
FOREST_RESOURCES = {"maxMemoryInMB": 32, "cacheNodeIds": True}

MODES = ("all", "fast", "ultra_fast", "linear_regression", "gradient_boosting", "random_forest", "random_forest_tuned")


@dataclass(frozen=True)
class Candidate:
    """A regressor to try; with ``grid`` it is tuned by cross-validation on the log target."""

    name: str
    estimator: Estimator
    grid: list | None = None
    family: str = "spark"


def _columns() -> dict[str, str]:
    return {"featuresCol": "features", "labelCol": TARGET_COLUMN, "predictionCol": RAW_PREDICTION}


def linear_regression() -> Candidate:
    return Candidate("linear_regression", LinearRegression(**_columns(), **LINEAR_SETTINGS))


def gradient_boosting(**settings) -> Candidate:
    return Candidate("gradient_boosting", GBTRegressor(**_columns(), **{**BOOSTING_SETTINGS, **settings}))


def _forest(trees: int, depth: int) -> RandomForestRegressor:
    return RandomForestRegressor(**_columns(), seed=SEED, numTrees=trees, maxDepth=depth, **FOREST_RESOURCES)


def random_forest(trees: int = DEFAULT_TREES, depth: int = DEFAULT_DEPTH) -> Candidate:
    return Candidate("random_forest", _forest(trees, depth))


# --- fixed values: the grid ---
def forest_grid(trees: int, depth: int) -> dict[str, list[int]]:
    """Values tried: ``trees`` and 20 more or less (but 20 at least), ``depth`` and 2 more or less (but 4 at least)."""
    return {
        "numTrees": sorted({max(20, trees - 20), trees, trees + 20}),
        "maxDepth": sorted({max(4, depth - 2), depth, depth + 2}),
        "minInstancesPerNode": [1, 2],
        "maxBins": [32, 64],
    }


def random_forest_tuned(
    trees: int = DEFAULT_TREES, depth: int = DEFAULT_DEPTH, grid: dict[str, list[int]] | None = None
) -> Candidate:
    forest = _forest(trees, depth)
    builder = ParamGridBuilder()
    for name, values in (grid or forest_grid(trees, depth)).items():
        builder = builder.addGrid(forest.getParam(name), values)
    return Candidate("random_forest_tuned", forest, builder.build())


def candidates(
    mode: str = "all", trees: int = DEFAULT_TREES, depth: int = DEFAULT_DEPTH, tune: bool = True
) -> list[Candidate]:
    """What a training mode tries.

    ``fast`` is the forest alone, ``ultra_fast`` the linear model alone.  ``tune`` decides between
    the plain and the tuned forest in ``all`` and ``fast``; the models can also be named.
    """
    forest = random_forest_tuned if tune else random_forest
    match mode:
        case "all":
            return [linear_regression(), gradient_boosting(), forest(trees, depth)]
        case "fast":
            return [forest(trees, depth)]
        case "ultra_fast" | "linear_regression":
            return [linear_regression()]
        case "gradient_boosting" | "gbt":
            return [gradient_boosting()]
        case "random_forest":
            return [random_forest(trees, depth)]
        case "random_forest_tuned":
            return [random_forest_tuned(trees, depth)]
    raise ValueError(f"Unknown training mode {mode!r}; choose one of {MODES}")


def preprocessing(
    numeric: Sequence[str] = NUMERIC_FEATURES, categorical: Sequence[str] = CATEGORICAL_FEATURES
) -> Pipeline:
    """Index and one-hot the categories, most frequent first, and assemble all features.

    All categories are counted in one pass.  Values not seen in training, and nulls, get a slot of their own.
    """
    indexed, encoded = [f"{c}_idx" for c in categorical], [f"{c}_vec" for c in categorical]
    categories = [
        StringIndexer(inputCols=[*categorical], outputCols=indexed, handleInvalid="keep"),
        OneHotEncoder(inputCols=indexed, outputCols=encoded, handleInvalid="keep"),
    ]
    assembler = VectorAssembler(inputCols=[*numeric, *encoded], outputCol="features", handleInvalid="keep")
    return Pipeline(stages=[*(categories if categorical else []), assembler])


def feature_importance(model: PipelineModel, transformed: DataFrame, top: int | None = None) -> DataFrame:
    """Importance per input column, largest first.

    Tree importances, or absolute coefficients of a linear model.  The slots of a one-hot column
    are added up under its name; which slot belongs to which column is read from the metadata that
    the assembler leaves on the feature column of ``transformed``.
    """
    last = model.stages[-1]
    weights = getattr(last, "featureImportances", None)
    if weights is None:
        weights = getattr(last, "coefficients", None)
    weights = [] if weights is None else [abs(float(w)) for w in weights.toArray()]
    assembler = next(s for s in reversed(model.stages) if isinstance(s, VectorAssembler))
    sources = sorted(assembler.getInputCols(), key=len, reverse=True)
    attributes = transformed.schema[assembler.getOutputCol()].metadata["ml_attr"]["attrs"]
    totals: dict[str, float] = {}
    for slot in (slot for group in attributes.values() for slot in group):
        if slot["idx"] >= len(weights):
            continue
        source = next(s for s in sources if slot["name"] == s or slot["name"].startswith(f"{s}_"))
        name = source.removesuffix("_vec")
        totals[name] = totals.get(name, 0.0) + weights[slot["idx"]]
    ranked = sorted(totals.items(), key=lambda item: (-item[1], item[0]))[:top]
    return transformed.sparkSession.createDataFrame(ranked, "feature string, importance double").orderBy(
        F.col("importance").desc(), "feature"
    )


@dataclass
class TrainingRun:
    """What a training run leaves behind."""

    best_name: str
    best: PipelineModel
    scores: list[dict]
    best_row: dict
    train_rows: int
    test_rows: int
    importance: DataFrame
    failures: list[dict] = field(default_factory=list)
    resumed: list[str] = field(default_factory=list)
    runtime_seconds: float = 0.0
    numeric: Sequence[str] = NUMERIC_FEATURES
    categorical: Sequence[str] = CATEGORICAL_FEATURES
    searches: dict[str, Search] = field(default_factory=dict)
    saved_model_dir: str | None = None

    def summary(self) -> DataFrame:
        """One row about the whole run, ready for :func:`snapflow.sources.write_metrics`."""
        spark = self.importance.sparkSession
        ddl = (
            "best_model string, best_overall_model string, rmse double, mae double, r2 double,"
            " baseline_rmse double, baseline_mae double, baseline_r2 double, train_rows bigint, test_rows bigint,"
            " feature_columns array<string>, categorical_columns array<string>,"
            " model_comparison array<struct<model_name: string, rmse: double, mae: double, r2: double,"
            " model_family: string>>,"
            " feature_importance array<struct<feature: string, importance: double>>,"
            " training_failures array<struct<model_name: string, error: string>>, runtime_seconds double,"
            " saved_model_dir string"
        )
        row = {
            **self.best_row,
            "best_overall_model": self.best_name,
            "train_rows": self.train_rows,
            "test_rows": self.test_rows,
            "feature_columns": list(self.numeric),
            "categorical_columns": list(self.categorical),
            "model_comparison": self.scores,
            "feature_importance": [r.asDict() for r in self.importance.collect()],  # one row per feature
            "training_failures": self.failures,
            "runtime_seconds": self.runtime_seconds,
            "saved_model_dir": self.saved_model_dir,
        }
        return spark.createDataFrame([row], ddl)

    def search_points(self) -> DataFrame:
        """Every point that was searched: model, settings, mean error on the log target over the folds, and whether it won."""
        rows = [
            (name, point.settings, point.rmse, point.folds, point == search.best())
            for name, search in self.searches.items() for point in search.points
        ]
        ddl = "model_name string, settings map<string, int>, rmse double, folds int, chosen boolean"
        return self.importance.sparkSession.createDataFrame(rows, ddl)


def _featured(df: DataFrame, needed: Sequence[str]) -> DataFrame:
    """Training columns of an episode table; features are derived only if the table lacks any."""
    if not set(NUMERIC_FEATURES) <= set(df.columns):
        df = add_shared_features(df, snapshot_ts_col=DATE_COLUMN)
    return df.select(*dict.fromkeys([*training_projection(df).columns, *needed]))


def _check_rows(train: DataFrame, test: DataFrame) -> tuple[int, int]:
    """Number of training and test rows; fails if there are none."""
    for side, rows in (("before", train), ("after", test)):
        require_rows(rows, f"A cutoff needs rows on both sides; this one has none {side} it")
    return train.count(), test.count()


def _settings(candidate: Candidate) -> str:
    """The estimator's parameters and grid as text, equal for equal settings."""

    def text(params: dict) -> str:
        return ", ".join(sorted(f"{p.name}={v}" for p, v in params.items()))

    return "; ".join([text(candidate.estimator.extractParamMap()), *[text(point) for point in candidate.grid or []]])


def _kept(prepared: DataFrame, rows: int, *more: str) -> DataFrame:
    """Features and labels, evenly spread over the cluster and kept for the passes of training.

    However few or uneven the files of the table, every core gets a share, unless shares would be smaller than
    ``LEAST_ROWS_PER_TASK``, and no share is larger than ``ROWS_PER_TASK``.
    """
    cores = prepared.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(cores, rows // LEAST_ROWS_PER_TASK), math.ceil(rows / ROWS_PER_TASK))
    needed = prepared.select("features", LABEL_COLUMN, TARGET_COLUMN, *more)
    return needed.repartition(tasks).persist(StorageLevel.MEMORY_AND_DISK)


@dataclass(frozen=True)
class _Fitting:
    """What the candidates of a run are fitted on."""

    pre: PipelineModel
    train: DataFrame
    train_x: DataFrame
    plain: Pipeline  # the preprocessing, not fitted
    parallelism: int
    fold_local: bool

    def folds(self, fold: int) -> tuple[DataFrame, DataFrame]:
        """Training and validation rows of a fold, prepared on all training rows, or on those of the fold alone."""
        if not self.fold_local:
            return self.train_x.filter(F.col(FOLD) != fold), self.train_x.filter(F.col(FOLD) == fold)
        inside, outside = self.train.filter(F.col(FOLD) != fold), self.train.filter(F.col(FOLD) == fold)
        prepared = self.plain.fit(inside)
        return prepared.transform(inside), prepared.transform(outside)

    def fit(self, candidate: Candidate, ledger: Ledger) -> tuple[PipelineModel, Search | None]:
        grid = _grid_values(candidate.grid) if isinstance(candidate.estimator, RandomForestRegressor) else None
        if candidate.grid is None:
            return PipelineModel([*self.pre.stages, candidate.estimator.fit(self.train_x)]), None
        if grid is not None:
            search = search_forest(candidate.estimator, grid, self.folds, FOLDS, ledger, self.parallelism)
            best = {candidate.estimator.getParam(name): value for name, value in search.best().settings.items()}
            return PipelineModel([*self.pre.stages, candidate.estimator.fit(self.train_x, best)]), search
        validator = CrossValidator(
            estimator=Pipeline(stages=[*self.plain.getStages(), candidate.estimator]) if self.fold_local else candidate.estimator,
            estimatorParamMaps=candidate.grid,
            evaluator=RegressionEvaluator(labelCol=TARGET_COLUMN, predictionCol=RAW_PREDICTION, metricName="rmse"),
            numFolds=FOLDS,
            parallelism=self.parallelism,
            seed=SEED,
            foldCol=FOLD,
        )
        if self.fold_local:
            return validator.fit(self.train).bestModel, None
        return PipelineModel([*self.pre.stages, validator.fit(self.train_x).bestModel]), None


def _grid_values(grid: list | None) -> dict[str, list] | None:
    """The values of each setting, if the points are all their combinations."""
    if not grid:
        return None
    values: dict[str, list] = {}
    for point in grid:
        for param, value in point.items():
            known = values.setdefault(param.name, [])
            if value not in known:
                known.append(value)
    return values if math.prod(map(len, values.values())) == len(grid) else None


def _weighted(candidate: Candidate, weight_col: str | None) -> Candidate:
    if weight_col is None:
        return candidate
    return replace(candidate, estimator=candidate.estimator.copy({candidate.estimator.getParam("weightCol"): weight_col}))


def with_predictions(scored: DataFrame) -> DataFrame:
    """Predictions in days, unrounded, for evaluation."""
    days = back_transform(F.col(RAW_PREDICTION))
    return scored.withColumns({"prediction": days, "predicted_trending_days": days})


def train_models(
    df: DataFrame,
    tries: Sequence[Candidate] | None = None,
    cutoff: date = DEFAULT_CUTOFF,
    purge: bool = False,
    model_dir: str | None = None,
    resume: bool = False,
    parallelism: int | None = None,
    fold_local: bool = False,
    numeric: Sequence[str] = NUMERIC_FEATURES,
    categorical: Sequence[str] = CATEGORICAL_FEATURES,
    weight_col: str | None = None,
) -> TrainingRun:
    """Fit every candidate on the days before ``cutoff``, score it on the days from it on.

    The preprocessing is fitted once and its output kept for all candidates (``fold_local`` fits
    it anew in each fold instead).  A candidate that fails is recorded and the others go on.  With
    ``model_dir`` every model is saved with its scores as soon as it is done, and ``resume`` skips
    those that have scores there, measured with the same cutoff, purging, numbers of rows and settings; a search of
    settings that was cut short goes on from the fits in its ledger there.
    Every category keeps a slot of its own, in sparse vectors.  ``numeric`` and ``categorical`` name the input columns,
    ``weight_col`` a column of ``df`` with the weights of training rows.  ``parallelism`` is the number of fits of a
    search that run side by side: by default 2, or as many as it takes to give every core a task.
    """
    began = time.perf_counter()
    spark = df.sparkSession
    tries = [_weighted(c, weight_col) for c in (candidates() if tries is None else tries)]
    inputs = [*numeric, *categorical]
    extra = [] if weight_col is None else [weight_col]
    train, test = (_featured(part, [*inputs, *extra]) for part in temporal_split(df, cutoff, purge=purge))
    train = train.withColumn(FOLD, fold_of([*inputs, LABEL_COLUMN], FOLDS, SEED))
    train_rows, test_rows = _check_rows(train, test)

    families = {c.name: c.family for c in tries}
    scores: list[dict] = []
    failures: list[dict] = []
    models: dict[str, PipelineModel] = {}

    split = f"cutoff={cutoff}, purge={purge}, train_rows={train_rows}, test_rows={test_rows}"
    split += "".join(f", {name}={value}" for name, value, usual in (
        ("inputs", inputs, [*NUMERIC_FEATURES, *CATEGORICAL_FEATURES]), ("weight_col", weight_col, None)) if value != usual)
    origins = {c.name: f"{split}, fold_local={fold_local}; {_settings(c)}" for c in tries} | {MEAN_BASELINE: split}

    def record(name: str, row, family: str) -> dict:
        entry = {"model_name": name, "rmse": row["rmse"], "mae": row["mae"], "r2": row["r2"]}
        scores.append({**entry, "model_family": family})
        if model_dir is not None:
            write_model_metrics(spark, {**entry, "measured_on": origins[name]}, model_dir)
        return entry

    # one row per model
    saved = read_metrics(spark, model_dir, with_origin=True).collect() if resume and model_dir else []
    done = {r["model_name"]: r for r in saved if r["measured_on"] == origins.get(r["model_name"])}
    resumed = [c.name for c in tries if c.name in done]
    for name in resumed:
        scores.append({**{c: done[name][c] for c in METRICS_SCHEMA.names}, "model_family": families[name]})

    plain = preprocessing(numeric, categorical)
    if len(resumed) < len(tries):
        pre = plain.fit(train)
    else:
        pre = load_model(model_path(model_dir, resumed[0]))
        pre = PipelineModel(pre.stages[:-1])
    train_x = _kept(pre.transform(train), train_rows, FOLD, *extra)
    test_x = _kept(pre.transform(test), test_rows)
    if parallelism is None:
        parallelism = max(2, spark.sparkContext.defaultParallelism // train_x.rdd.getNumPartitions())
    fitting = _Fitting(pre, train, train_x, plain, parallelism, fold_local)
    searches: dict[str, Search] = {}
    try:
        for candidate in (c for c in tries if c.name not in done):
            started = time.perf_counter()
            try:
                ledger = Ledger(spark, model_dir and f"{model_path(model_dir, candidate.name)}_search", origins[candidate.name])
                model, search = fitting.fit(candidate, ledger)
                if search is not None:
                    searches[candidate.name] = search
                own = fold_local and candidate.grid and search is None  # a pipeline with a preprocessing of its own
                scored = model.transform(test) if own else model.stages[-1].transform(test_x)
                row = regression_metrics(with_predictions(scored)).first()
                if model_dir is not None:
                    save_model(model, model_path(model_dir, candidate.name))
                record(candidate.name, row, candidate.family)
                models[candidate.name] = model
                logger.info("%s took %.2f s", candidate.name, time.perf_counter() - started)
            except Exception as error:  # one bad candidate must not cost the others
                failures.append({"model_name": candidate.name, "error": str(error)})
                logger.exception("%s could not be fitted", candidate.name)
        if not scores:
            raise RuntimeError(f"None of the candidates could be fitted: {failures}")
        record(MEAN_BASELINE, regression_metrics(constant_baseline(train_x, test_x)).first(), "spark")
    finally:
        train_x.unpersist()
        test_x.unpersist()

    score_table = spark.createDataFrame(
        scores, "model_name string, rmse double, mae double, r2 double, model_family string"
    )
    best_row = best_model(score_table).drop("n_models").first().asDict()
    name = best_row["best_model"]
    best = models[name] if name in models else load_model(model_path(model_dir, name))
    return TrainingRun(
        best_name=name, best=best, scores=scores, best_row=best_row,
        train_rows=train_rows, test_rows=test_rows,
        importance=feature_importance(best, best.transform(test)),
        failures=failures, resumed=resumed,
        runtime_seconds=round(time.perf_counter() - began, 2),
        numeric=numeric, categorical=categorical, searches=searches,
        saved_model_dir=model_dir and model_path(model_dir, name),
    )
