"""Training, evaluation and scoring of the duration model."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import product
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressionModel, RandomForestRegressor
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crewcast.params import Params
from crewcast.plans import moments
from crewcast.plans.moments import LinearCodes
from crewcast.session import materialise

# The search grid of each model. "k" is the number of principal components.
GRIDS: dict[str, dict[str, list]] = {
    "elastic_net": {
        "k": [2, 5, 10],
        "maxIter": [10],
        "regParam": [0.1, 0.3],
        "elasticNetParam": [0.0, 0.3, 0.5, 0.8, 1.0],
    },
    "decision_tree": {"k": [2, 10, 20], "maxDepth": [5, 10, 20], "maxBins": [10]},
    "random_forest": {"maxDepth": [2, 5, 10], "maxBins": [10], "numTrees": [20]},
    "gradient_boosting": {"maxDepth": [2, 5], "maxBins": [8], "maxIter": [10]},
}
_REGRESSORS = {
    "elastic_net": LinearRegression,
    "decision_tree": DecisionTreeRegressor,
    "random_forest": RandomForestRegressor,
    "gradient_boosting": GBTRegressor,
}


def grid_points(params: Params, grid: dict[str, Sequence] | None = None) -> list[dict]:
    """Every combination of the model's grid; ``grid`` replaces single entries of it."""
    values = GRIDS[params.model] | dict(grid or {})
    return [dict(zip(values, chosen)) for chosen in product(*values.values())]


def encoded(labels: Sequence[Sequence[str]], params: Params, spark: SparkSession) -> list[Transformer]:
    """Stages that index and one-hot encode the categories and assemble ``features``; ``labels`` are each category's values.

    Unseen and null categories get an all-zero code. Numeric columns enter the vector
    only with ``use_numeric``; rows to score must then have them.
    """
    names = list(params.categorical_cols)
    index = [StringIndexerModel.from_labels(list(x), inputCol=c, outputCol=f"{c}_index", handleInvalid="keep") for c, x in zip(names, labels, strict=True)]
    onehot = OneHotEncoder(inputCols=[f"{c}_index" for c in names], outputCols=[f"{c}_dummy" for c in names])
    onehot = onehot.fit(PipelineModel(index).transform(spark.createDataFrame([], ", ".join(f"{c} string" for c in names))))
    return [*index, onehot, VectorAssembler(inputCols=onehot.getOutputCols() + moments.numbers_of(params), outputCol="features")]


def principal_components(rows: DataFrame, params: Params, most: int) -> LinearCodes:
    """A stage that adds ``pc0``, ``pc1``, ... : the standardised codes on their first components."""
    one = rows.select(F.lit(0).alias(moments.FOLD), F.lit(0.0).alias("label"), *params.categorical_cols, *moments.numbers_of(params))
    sums = moments.sums_of(moments.cells(one, params), params)
    return _components_stage(sums.whole(), sums.keys, params, most)


def _components_stage(sums: np.ndarray, keys: list, params: Params, most: int) -> LinearCodes:
    return LinearCodes.of([f"pc{i}" for i in range(most)], params, keys, moments.components(sums, most))


@dataclass(frozen=True)
class Fitted:
    """The best model, fitted on all rows, and the errors of all grid points over the folds."""

    best: PipelineModel
    points: list[dict]
    errors: np.ndarray  # folds x points

    @property
    def avgMetrics(self) -> list[float]:
        return [float(x) for x in np.nanmean(self.errors, axis=0)]

    @property
    def stdMetrics(self) -> list[float]:
        return [float(x) for x in np.nanstd(self.errors, axis=0)]

    def transform(self, rows: DataFrame) -> DataFrame:
        return self.best.transform(rows)

    def write(self):
        return self.best.write()


def train(rows: DataFrame, params: Params, grid: dict[str, Sequence] | None = None) -> Fitted:
    """Cross-validated search, then a fit of the best grid point on all rows.

    A row's fold is a hash of its id (of its columns where there is none), so folds do
    not move with the partitioning.
    """
    points = grid_points(params, grid)
    kept = moments.folded(rows, params)
    return _train_linear(kept, points, params) if params.model == "elastic_net" else _train_trees(kept, points, params)


def _best(errors: np.ndarray) -> int:
    known = np.isfinite(errors).any(0)
    return int(np.argmin(np.where(known, np.nanmean(np.where(known, errors, 0.0), axis=0), np.inf))) if known.any() else 0


def _train_linear(kept: DataFrame, points: list[dict], params: Params) -> Fitted:
    """All fits of the grid from the sums of each fold: the rows are counted once, and their counts read twice."""
    counted = moments.cells(kept, params)
    sums = moments.sums_of(counted, params)
    most = max((p.get("k") or 0 for p in points), default=0)

    def fits(matrix: np.ndarray, chosen: list[dict]) -> moments.Linear:
        every = moments.components(matrix, most) if most else None
        found = []
        for p in chosen:
            k = p.get("k")
            outputs = moments.Linear(every.constant[:k], every.weights[:, :k]) if k else None
            found.append(moments.elastic_net(matrix, p["regParam"], p["elasticNetParam"], outputs))
        return moments.Linear(np.concatenate([f.constant for f in found]), np.concatenate([f.weights for f in found], 1))

    errors = np.full((params.folds, len(points)), np.nan)
    if len(sums.folds) > 1:
        models = {k: fits(sums.without(k), points) for k in sums.folds}
        for r in moments.fold_errors(counted, params, sums.keys, models).collect():  # folds times grid points
            errors[r["fold"], r["point"]] = r["mae"]
    best = points[_best(errors)]
    stage = LinearCodes.of(["prediction"], params, sums.keys, fits(sums.whole(), [best]))
    return Fitted(PipelineModel([stage]), points, errors)


def _regressor(point: dict, params: Params, **more):
    regressor = _REGRESSORS[params.model](featuresCol="features", weightCol="weight")
    if regressor.hasParam("seed"):
        regressor.set(regressor.getParam("seed"), params.seed)
    for name, value in (point | more).items():
        if name != "k":
            regressor.set(regressor.getParam(name), value)
    return regressor


def _sliced(point: dict) -> list[Transformer]:
    """What a grid point adds to the fold's encoding: the first components as a vector."""
    return [VectorAssembler(inputCols=[f"pc{i}" for i in range(point["k"])], outputCol="features")] if "k" in point else []


def _drawn(point: dict, params: Params) -> tuple[bool, float] | None:
    """How a forest draws the rows of each tree: with replacement or not, and the share; None if it takes them all."""
    bootstrap, share = point.get("bootstrap", True), float(point.get("subsamplingRate", 1.0))
    return None if params.model != "random_forest" or (not bootstrap and share == 1.0) else (bootstrap, share)


def _draws(counted: DataFrame, names: Sequence[str], sampling: tuple[bool, float], trees: int, seed: int) -> Column:
    """How often each tree draws the rows of a cell: of n rows drawn on their own, the sum of their numbers is drawn at once.

    That is a Poisson number of mean n (without replacement a binomial one), seeded by the cell, wherever it lies.
    """
    bootstrap, share = sampling

    @F.pandas_udf("array<long>")
    def draw(cell: pd.Series, n_rows: pd.Series) -> pd.Series:
        out = []
        for c, n in zip(cell, n_rows):
            rng = np.random.default_rng([c & (2**64 - 1), seed & (2**64 - 1)])
            out.append(rng.poisson(share * n, trees) if bootstrap else rng.binomial(n, share, trees))
        return pd.Series(out)

    marked = [x for c in names for x in (F.col(c).isNull(), F.col(c))]
    return draw(F.xxhash64(*marked), F.col("n_rows"))


def _grouped(counted: DataFrame, points: list[dict], params: Params) -> DataFrame:
    """Cells of a fold that agree in all features as one row: their number ``w``, their labels' sum ``s``, and both for each draw of a tree.

    A split lowers the squared error of rows as much as that of their groups' means, so
    trees grow on these as on the rows. Other losses keep the labels apart.
    """
    names = [moments.FOLD, *params.categorical_cols, *moments.numbers_of(params)]
    keys = [*names, "label"] if any(p.get("lossType", "squared") != "squared" for p in points) else names
    numbers = {"": F.col("n_rows")}
    for i, sampling in enumerate(_samplings(points, params)):
        trees = max(_n_trees(p) for p in points if _drawn(p, params) == sampling)
        counted = counted.withColumn(f"_d{i}", _draws(counted, [*names, "label"], sampling, trees, params.seed))
        numbers |= {f"{i}_{t}": F.col(f"_d{i}")[t] for t in range(trees)}
    value = [F.col("label").alias("y")] if "label" in keys else []
    sums = [f(n).alias(f"{c}{tag}") for tag, n in numbers.items() for c, f in (("w", F.sum), ("s", lambda x: F.sum(x * F.col("label"))))]
    found = counted.groupBy(*keys).agg(*sums)
    return materialise(found.select(*found.columns, *value).drop("label"), "model-groups")


def _samplings(points: list[dict], params: Params) -> list[tuple[bool, float]]:
    return sorted({_drawn(p, params) for p in points} - {None})


def _n_trees(point: dict) -> int:
    return point.get("numTrees", 20)


def _fit(point: dict, rows: DataFrame, params: Params, points: list[dict]) -> Transformer:
    """The grid point fitted on grouped rows with ``features``; a forest that draws rows is grown tree by tree."""
    totals = rows.agg(*[F.sum(c).alias(c) for c in rows.columns if c.startswith("w")]).first()
    more = {}
    if point.get("minInstancesPerNode", 1) > 1:  # counts rows, of which a group has many
        more = {"minInstancesPerNode": 1, "minWeightFractionPerNode": min((point["minInstancesPerNode"] - 0.5) / totals["w"], 0.499)}

    def weighed(tag: str) -> DataFrame:
        return rows.where(F.col(f"w{tag}") > 0).select("features", F.col(f"w{tag}").cast("double").alias("weight"), (F.col(f"s{tag}") / F.col(f"w{tag}")).alias("label"))

    sampling = _drawn(point, params)
    if sampling is None:
        return _regressor(point, params, **more).fit(weighed(""))
    several = "onethird" if _n_trees(point) > 1 else "all"
    strategy = point.get("featureSubsetStrategy", "auto")
    more |= {"numTrees": 1, "bootstrap": False, "subsamplingRate": 1.0, "featureSubsetStrategy": several if strategy == "auto" else strategy}
    trees = []
    seeds = np.random.default_rng(params.seed & (2**64 - 1)).integers(2**62, size=_n_trees(point)).tolist()
    for t, seed in enumerate(seeds):
        tag = f"{_samplings(points, params).index(sampling)}_{t}"
        # a tree that drew no row at all takes every one
        trees.append(_regressor(point, params, **more, seed=seed).fit(weighed(tag if totals[f"w{tag}"] else "")))
    return Forest(trees)


class Forest(Transformer, MLWritable, MLReadable):
    """``prediction`` is the mean of the trees' predictions."""

    def __init__(self, trees: Sequence[RandomForestRegressionModel] = ()):
        super().__init__()
        self.trees = list(trees)

    def __repr__(self) -> str:
        return f"RandomForestRegressionModel: uid={self.uid}, numTrees={len(self.trees)}"

    def _transform(self, df: DataFrame) -> DataFrame:
        names = [f"_tree{t}" for t in range(len(self.trees))]
        for name, tree in zip(names, self.trees, strict=True):
            df = tree.setPredictionCol(name).transform(df)
        return df.withColumn("prediction", sum((F.col(c) for c in names), F.lit(0.0)) / len(names)).drop(*names)

    def write(self) -> MLWriter:
        return _ForestWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ForestReader()


class _ForestWriter(MLWriter):
    def __init__(self, stage: Forest):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession, extraMetadata={"numTrees": len(self.stage.trees)})
        for t, tree in enumerate(self.stage.trees):
            tree.save(f"{path}/trees/{t}")


class _ForestReader(MLReader):
    def load(self, path: str) -> Forest:
        found = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        stage = Forest([RandomForestRegressionModel.load(f"{path}/trees/{t}") for t in range(found["numTrees"])])
        stage._resetUid(found["uid"])
        return stage


def _values_of(counted: DataFrame, params: Params) -> list[tuple[int, int, str, int]]:
    """(fold, place of the category, value, rows) on the driver: a row for each fold and category value."""
    listed = F.array(*[F.struct(F.lit(i).alias("i"), F.col(c).cast("string").alias("v")) for i, c in enumerate(params.categorical_cols)])
    each = counted.select(moments.FOLD, "n_rows", F.explode(listed).alias("x")).where("x.v IS NOT NULL")
    return [tuple(r) for r in each.groupBy(moments.FOLD, "x.i", "x.v").agg(F.sum("n_rows")).collect()]


def _train_trees(kept: DataFrame, points: list[dict], params: Params) -> Fitted:
    """Fits of each fold one after the other, ``parallelism`` folds at a time; the encoding is fitted once for a fold.

    The rows are counted once; trees grow on the counts of rows that agree in all features,
    and components and encodings come from the counts, too.
    """
    most = max((p.get("k") or 0 for p in points), default=0)
    counted = moments.cells(kept, params)
    groups = _grouped(counted, points, params)
    sums = moments.sums_of(counted, params) if most else None
    values = [] if most else _values_of(counted, params)
    folds = {r[moments.FOLD] for r in groups.select(moments.FOLD).distinct().collect()}

    def stages(fold: int | None) -> list[Transformer]:
        if most:
            return [_components_stage(sums.whole() if fold is None else sums.without(fold), sums.keys, params, most)]
        rows: list[Counter] = [Counter() for _ in params.categorical_cols]
        for k, i, value, n in values:
            if k != fold:
                rows[i][value] += n
        return encoded([sorted(c, key=lambda v: (-c[v], v)) for c in rows], params, kept.sparkSession)

    def seen(rows: DataFrame, prepared: list[Transformer], *columns: str) -> DataFrame:
        return PipelineModel(prepared).transform(rows).select(*columns, *([f"pc{i}" for i in range(most)] or ["features"]))

    names = [*params.categorical_cols, *moments.numbers_of(params)]
    keys = [*names, "y"] if "y" in groups.columns else names
    numbers = [c for c in groups.columns if c not in (moments.FOLD, *keys)]

    def known_rows(fold: int | None, prepared: list[Transformer]) -> DataFrame:
        rows = groups if fold is None else groups.where(F.col(moments.FOLD) != fold)
        # written first, so that a fit has as many tasks as its groups need
        return seen(materialise(rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in numbers]), "model-rows"), prepared, *numbers)

    errors = np.full((params.folds, len(points)), np.nan)

    def fold_errors(fold: int) -> list[float] | None:
        if fold not in folds or len(folds) == 1:
            return None
        prepared = stages(fold)
        known = known_rows(fold, prepared).persist()
        unseen = seen(counted.where(F.col(moments.FOLD) == fold), prepared, "label", "n_rows").persist()
        try:
            out = []
            for point in points:
                shape = PipelineModel(_sliced(point)).transform
                predicted = _fit(point, shape(known), params, points).transform(shape(unseen))
                error = F.sum(F.abs(F.col("prediction") - F.col("label")) * F.col("n_rows")) / F.sum("n_rows")
                out.append(predicted.agg(error.alias("mae")).first()["mae"])
            return out
        finally:
            known.unpersist()
            unseen.unpersist()

    with ThreadPool(params.parallelism) as pool:
        for fold, found in enumerate(pool.map(fold_errors, range(params.folds), chunksize=1)):
            if found is not None:
                errors[fold] = found
    best = points[_best(errors)]
    prepared = stages(None)
    shaped = PipelineModel(_sliced(best)).transform(known_rows(None, prepared)).persist()
    try:
        return Fitted(PipelineModel([*prepared, *_sliced(best), _fit(best, shaped, params, points)]), points, errors)
    finally:
        shaped.unpersist()


def fold_metrics(model: Fitted, rows: DataFrame) -> DataFrame:
    """Mean absolute error and its spread over the folds, per grid point."""
    points = []
    for i, (mean, spread, chosen) in enumerate(zip(model.avgMetrics, model.stdMetrics, model.points, strict=True)):
        text = ", ".join(sorted(f"{name}={v}" for name, v in chosen.items()))
        points.append((i, text, mean, spread))
    return rows.sparkSession.createDataFrame(points, "grid_point int, settings string, mae double, mae_std double")


def point_errors(model: Fitted, rows: DataFrame) -> DataFrame:
    """A row for each fold and grid point: its settings and the mean absolute error there."""
    names = [n for n in model.points[0] if n != "k" or model.points[0]["k"] is not None]
    found = [
        (fold, *[float(point[n]) for n in names], float(model.errors[fold, i]))
        for fold in range(len(model.errors)) for i, point in enumerate(model.points) if np.isfinite(model.errors[fold, i])
    ]
    return rows.sparkSession.createDataFrame(found, ", ".join(["fold int", *[f"{n} double" for n in names], "mae double"]))


def best_stage(model: Fitted) -> str:
    """The chosen regressor, as text."""
    return str(model.best.stages[-1])


def score(model: Fitted | PipelineModel, rows: DataFrame, params: Params) -> DataFrame:
    """Feature columns with ``JobID`` and ``JobDurationML``, plus the row's own date."""
    scored = model.transform(rows).withColumnsRenamed({"id": "JobID", "prediction": "JobDurationML"})
    names = [*params.categorical_cols, *params.numerical_cols, "JobID", "JobDurationML", "refresh_date"]
    return scored.select(*names)


def mean_absolute_error(df: DataFrame, prediction: str, label: str, *groups: str) -> DataFrame:
    return df.groupBy(*groups).agg(F.avg(F.abs(F.col(prediction) - F.col(label))).alias("mae"))


def group_mean_model(rows: DataFrame, group: str) -> PipelineModel:
    """A model that predicts the mean label of the row's group, and the mean of all rows for a group it does not know."""
    found = rows.groupBy(group).agg(F.sum("label").alias("s"), F.count("*").alias("n")).collect()  # a row for each group
    mean = sum(r["s"] for r in found) / max(sum(r["n"] for r in found), 1)
    keys = [(f"code:{group}", r[group]) for r in found if r[group] is not None]
    weights = np.array([[r["s"] / r["n"] - mean] for r in found if r[group] is not None]).reshape(-1, 1)
    params = Params(categorical_cols=(group,), numerical_cols=())
    return PipelineModel([LinearCodes.of(["prediction"], params, keys, moments.Linear(np.array([mean]), weights))])


def group_mean_prediction(df: DataFrame, group: str, label: str = "label") -> DataFrame:
    """A baseline: the mean label of the row's group."""
    means = df.groupBy(F.col(group).alias("_g")).agg(F.avg(label).alias("prediction"))
    return df.join(means, F.col(group).eqNullSafe(F.col("_g")), "left").drop("_g")
