"""Linear models from sums: the rows are read once, whatever the number of fits."""

from __future__ import annotations

import dataclasses
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml import Transformer
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crewcast.params import Params
from crewcast.session import materialise

FOLD = "_fold"

#: A feature: a category with its value, or a number (no value).
Key = tuple[str, str | None]


def fold_of(params: Params, *columns: str) -> Column:
    """Fold of a row: the leading digits of an md5 of the seed and the columns, nulls as empty text."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    digest = F.md5(F.concat_ws(":", F.lit(str(params.seed)), *parts))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % params.folds).cast("int")


def folded(rows: DataFrame, params: Params) -> DataFrame:
    """Label, categories, numbers and fold; a row's fold hangs on its id, or on all of these columns where there is none."""
    named = ["id"] if "id" in rows.columns else ["label", *params.categorical_cols, *params.numerical_cols]
    return rows.select("label", *params.categorical_cols, *params.numerical_cols, fold_of(params, *named).alias(FOLD))


def numbers_of(params: Params) -> list[str]:
    return list(params.numerical_cols) if params.use_numeric else []


def cells(rows: DataFrame, params: Params) -> DataFrame:
    """Folded rows that agree in all the model sees, counted: what sums and errors are taken from."""
    names = [FOLD, *params.categorical_cols, *numbers_of(params), "label"]
    counted = rows.groupBy(*names).agg(F.count("*").alias("n_rows"))
    return materialise(counted, "model-cells")


@dataclass(frozen=True)
class Sums:
    """Sums of products of the constant (0), the label (1) and the features, of each fold, as far as they are not zero."""

    keys: list[Key]
    entries: np.ndarray  # fold, row, column
    values: np.ndarray

    def matrix(self, chosen: np.ndarray) -> np.ndarray:
        size = len(self.keys) + 2
        out = np.zeros((size, size))
        np.add.at(out, (self.entries[chosen, 1], self.entries[chosen, 2]), self.values[chosen])
        return np.triu(out) + np.triu(out, 1).T

    def without(self, fold: int) -> np.ndarray:
        """Sums over the rows that train this fold's model."""
        return self.matrix(self.entries[:, 0] != fold)

    def whole(self) -> np.ndarray:
        return self.matrix(np.ones(len(self.entries), bool))

    @property
    def folds(self) -> list[int]:
        return sorted(set(self.entries[:, 0].tolist()))


def products(counted: DataFrame, params: Params) -> DataFrame:
    """(fold, a, b, s): for each pair of features the sum of their product over the rows of a fold.

    A category that is null counts for nothing, like one that is not known.
    """
    kind = "struct<name:string,value:string,x:double>"

    def entry(name: str, value: Column, x: Column) -> Column:
        return F.struct(F.lit(name).alias("name"), value.cast("string").alias("value"), x.cast("double").alias("x")).cast(kind)

    none = F.lit(None)
    parts = [entry("", none, F.lit(1.0)), entry("label", none, F.col("label"))]
    parts += [entry(f"code:{c}", F.col(c), F.when(F.col(c).isNotNull(), 1.0)) for c in params.categorical_cols]
    parts += [entry(f"number:{c}", none, F.col(c)) for c in numbers_of(params)]
    listed = counted.select(FOLD, "n_rows", F.filter(F.array(*parts), lambda f: f["x"].isNotNull()).alias("f"))
    first = listed.select(FOLD, "n_rows", "f", F.posexplode("f").alias("i", "a"))
    pairs = first.select(FOLD, "n_rows", "a", F.explode(F.expr("slice(f, i + 1, size(f))")).alias("b"))
    key = [F.struct(f"{c}.name", f"{c}.value").alias(c) for c in ("a", "b")]
    return pairs.groupBy(F.col(FOLD).alias("fold"), *key).agg(F.sum(F.col("n_rows") * F.col("a.x") * F.col("b.x")).alias("s"))


def correlations(counted: DataFrame, params: Params) -> DataFrame:
    """(name_a, value_a, name_b, value_b, n_rows, correlation) of all pairs of category values, the diagonal left out.

    Of pairs that never meet in a row nothing is summed; they have no row here either.
    """
    total = counted.agg(F.sum("n_rows").alias("n")).select(F.coalesce("n", F.lit(0)).alias("n"))
    sums = products(counted, dataclasses.replace(params, use_numeric=False)).groupBy("a", "b").agg(F.sum("s").alias("s"))
    own = sums.where(F.col("a").eqNullSafe(F.col("b")) & F.col("a.name").startswith("code:"))
    pairs = sums.where(~F.col("a").eqNullSafe(F.col("b")) & F.col("a.name").startswith("code:") & F.col("b.name").startswith("code:"))
    n = F.lit(float(total.first()["n"]))
    one, other = (own.select(F.col("a").alias(f"k{i}"), F.col("s").alias(f"s{i}")) for i in "ab")
    joined = pairs.join(one, F.col("a") == F.col("ka")).join(other, F.col("b") == F.col("kb"))
    top = F.col("s") / n - F.col("sa") / n * F.col("sb") / n
    bottom = F.sqrt(F.col("sa") / n * (1 - F.col("sa") / n) * (F.col("sb") / n) * (1 - F.col("sb") / n))
    named = [F.expr(f"substring({c}.name, 6)").alias(f"name_{c}") for c in "ab"] + [F.col(f"{c}.value").alias(f"value_{c}") for c in "ab"]
    return joined.select(*named, F.col("s").cast("long").alias("n_rows"), F.when(bottom > 0, top / bottom).alias("correlation"))


def sums_of(counted: DataFrame, params: Params) -> Sums:
    """The sums on the driver: an entry for each pair of feature values that meet in a row, not for each combination."""
    rows = products(counted, params).select("fold", "a.*", F.col("b.name").alias("b_name"), F.col("b.value").alias("b_value"), "s").collect()
    known = {k for r in rows for k in ((r["name"], r["value"]), (r["b_name"], r["b_value"]))} - {("", None), ("label", None)}
    order = [f"code:{c}" for c in params.categorical_cols] + [f"number:{c}" for c in numbers_of(params)]
    keys = sorted(known, key=lambda k: (order.index(k[0]), k[1] or ""))
    place = {("", None): 0, ("label", None): 1} | {k: i + 2 for i, k in enumerate(keys)}
    entries = [(r["fold"], *sorted((place[r["name"], r["value"]], place[r["b_name"], r["b_value"]]))) for r in rows]
    return Sums(keys, np.array(entries, np.int64).reshape(-1, 3), np.array([r["s"] for r in rows], float))


@dataclass(frozen=True)
class Linear:
    """A constant and weights of the features, a column for each output."""

    constant: np.ndarray
    weights: np.ndarray


def centred(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, float, np.ndarray]:
    """Means and covariance of the features, mean and spread of the label, covariance with the label; divisor n."""
    n = max(sums[0, 0], 1.0)
    mean, label = sums[0, 2:] / n, sums[0, 1] / n
    covariance = sums[2:, 2:] / n - np.outer(mean, mean)
    variance = covariance.diagonal()
    covariance[np.diag_indices(len(mean))] = np.where(variance > 1e-12 * np.maximum(mean**2, 1e-300), variance, 0.0)
    return mean, covariance, label, float(np.sqrt(max(sums[1, 1] / n - label**2, 0.0))), sums[1, 2:] / n - mean * label


def components(sums: np.ndarray, most: int) -> Linear:
    """The standardised features on the first principal components of their correlation."""
    mean, covariance, *_ = centred(sums)
    n = sums[0, 0]
    covariance = covariance * n / max(n - 1, 1)
    spread = np.sqrt(np.maximum(covariance.diagonal(), 0.0))
    scale = np.divide(1.0, spread, out=np.zeros(len(mean)), where=spread > 1e-12)
    _, vectors = np.linalg.eigh(covariance * np.outer(scale, scale))
    vectors = vectors[:, ::-1][:, :most]
    if vectors.size:
        vectors = vectors * np.where(vectors[np.abs(vectors).argmax(0), range(vectors.shape[1])] < 0, -1.0, 1.0)
    weights = np.zeros((len(mean), most))
    weights[:, : vectors.shape[1]] = vectors * scale[:, None]
    return Linear(-(mean @ weights), weights)


def elastic_net(sums: np.ndarray, strength: float, mixture: float, outputs: Linear | None = None) -> Linear:
    """Elastic net by coordinate descent on the sums, of the features or of linear ``outputs`` of them.

    The least of 1/2 |y - Xb|^2 / n + strength (mixture |b| + (1 - mixture) / 2 |b|^2) with features and
    label scaled to unit variance and the strength to the label's, the constant free of
    penalty. Runs until no weight moves.
    """
    mean, covariance, label, spread, shared = centred(sums)
    if outputs is not None:
        mean = outputs.constant + mean @ outputs.weights
        covariance, shared = outputs.weights.T @ covariance @ outputs.weights, shared @ outputs.weights
    deviation = np.sqrt(np.maximum(covariance.diagonal(), 0.0))
    scale = np.divide(1.0, deviation, out=np.zeros(len(mean)), where=deviation > 1e-9)
    b = np.zeros(len(mean))
    if spread > 0:
        c, r = covariance * np.outer(scale, scale), shared * scale / spread
        l1, l2 = strength / spread * mixture, strength / spread * (1 - mixture)
        for _ in range(100_000):
            moved = 0.0
            for j in np.flatnonzero(scale):
                rest = r[j] - c[j] @ b + c[j, j] * b[j]
                new = np.sign(rest) * max(abs(rest) - l1, 0.0) / (c[j, j] + l2)
                moved, b[j] = max(moved, abs(new - b[j])), new
            if moved < 1e-13:
                break
        b = b * spread * scale
    constant = label - mean @ b
    if outputs is None:
        return Linear(np.array([constant]), b[:, None])
    return Linear(np.array([constant + outputs.constant @ b]), (outputs.weights @ b)[:, None])


def _weights(keys: Sequence[Key], linear: Linear) -> pa.Table:
    rows = [("", None, linear.constant)] + [(*k, w) for k, w in zip(keys, linear.weights)]
    return pa.table(
        {
            "name": pa.array([r[0] for r in rows], pa.string()),
            "value": pa.array([r[1] for r in rows], pa.string()),
            "w": pa.array([r[2].tolist() for r in rows], pa.list_(pa.float64())),
        }
    )


def _times(weights: Column, column: str) -> Column:
    return F.transform(weights, lambda w: w * F.col(column))


def _summed(df: DataFrame, weights: DataFrame, features: Sequence[tuple[str, str]], base: dict[str, list[float]] | None = None) -> tuple[DataFrame, Column]:
    """The rows with weights looked up, one small table for each category, and the sum of what was found.

    The constant and the weights of numbers are those of the row's fold, or ``base``.
    """
    parts: list[Column] = []
    for kind, column in [("", ""), *features]:
        name, width = f"{kind}{column}", f"_w{len(parts)}"
        fold = [] if base is not None else [F.col("fold").alias("_f")]
        same = F.lit(True) if base is not None else F.col(FOLD) == F.col("_f")
        table = weights.where(F.col("name") == name).select(*fold, F.col("value").alias("_v"), F.col("w").alias(width))
        if kind == "code:":
            df = df.join(table, same & (F.col(column).cast("string") == F.col("_v")), "left").drop("_v", "_f")
            parts.append(F.coalesce(F.col(width), F.transform(parts[0], lambda x: F.lit(0.0))))
            continue
        if base is None:
            df = df.join(table, same, "left").drop("_v", "_f")
        found = F.col(width) if base is None else F.array(*[F.lit(float(x)) for x in base[name]]).cast("array<double>")
        parts.append(_times(found, column) if kind else found)
    return df, reduce(lambda a, b: F.zip_with(a, b, lambda x, y: x + y), parts)


def _features(params: Params) -> list[tuple[str, str]]:
    return [("code:", c) for c in params.categorical_cols] + [("number:", c) for c in numbers_of(params)]


def fold_errors(counted: DataFrame, params: Params, keys: Sequence[Key], models: dict[int, Linear]) -> DataFrame:
    """(fold, point, n_rows, mae): mean absolute error of each of a fold's models on that fold's rows."""
    tables = [_weights(keys, m).append_column("fold", pa.array([k] * (len(keys) + 1), pa.int32())) for k, m in models.items()]
    weights = counted.sparkSession.createDataFrame(pa.concat_tables(tables))
    found, prediction = _summed(counted, weights, _features(params))
    error = F.transform(prediction, lambda p: F.abs(p - F.col("label")) * F.col("n_rows"))
    each = found.select(F.col(FOLD).alias("fold"), "n_rows", F.posexplode(error).alias("point", "e"))
    return each.groupBy("fold", "point").agg(F.sum("n_rows").alias("n_rows"), (F.sum("e") / F.sum("n_rows")).alias("mae"))


class LinearCodes(Transformer, MLWritable, MLReadable):
    """Adds columns that are a constant plus a weight for each category's value and each number.

    The weights of values are a table (name, value, w) that is joined, so neither a plan nor
    a saved model holds them as text. Values without a weight, null ones too, add nothing;
    a null number makes the outputs null.
    """

    def __init__(
        self, outputs: Sequence[str] = (), features: Sequence[tuple[str, str]] = (), base: dict[str, list[float]] | None = None,
        weights: pa.Table | DataFrame | None = None,
    ):
        super().__init__()
        self.outputs, self.features, self.base, self.weights = list(outputs), [tuple(f) for f in features], dict(base or {}), weights

    @classmethod
    def of(cls, outputs: Sequence[str], params: Params, keys: Sequence[Key], linear: Linear) -> LinearCodes:
        base = {"": linear.constant.tolist()} | {name: w.tolist() for (name, value), w in zip(keys, linear.weights) if value is None}
        features = _features(params)
        base |= {f"number:{c}": [0.0] * len(linear.constant) for kind, c in features if kind == "number:" and f"number:{c}" not in base}
        return cls(outputs, features, base, _weights(keys, linear))

    def _table(self, spark: SparkSession) -> DataFrame:
        return self.weights if isinstance(self.weights, DataFrame) else spark.createDataFrame(self.weights)

    def _transform(self, df: DataFrame) -> DataFrame:
        found, total = _summed(df, self._table(df.sparkSession), self.features, self.base)
        own = [F.col(f"`{c}`") for c in df.columns]
        found = found.select(*own, total.alias("_total"))
        return found.select(*own, *[F.col("_total")[i].alias(c) for i, c in enumerate(self.outputs)])

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, stage: LinearCodes):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        spark, stage = self.sparkSession, self.stage
        own = {"outputs": stage.outputs, "features": stage.features, "base": stage.base}
        DefaultParamsWriter.saveMetadata(stage, path, spark, extraMetadata=own)
        stage._table(spark).write.parquet(f"{path}/weights")


class _Reader(MLReader):
    def load(self, path: str) -> LinearCodes:
        found = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        weights = self.sparkSession.read.parquet(f"{path}/weights")
        stage = LinearCodes(found["outputs"], found["features"], found["base"], weights)
        stage._resetUid(found["uid"])
        return stage
