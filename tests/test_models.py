"""Linear models from sums, against MLlib's own and against plain numpy."""

import dataclasses

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression
from pyspark.sql import functions as F

from crewcast import Params, views
from crewcast.operators import features
from crewcast.plans import forecast, moments
from crewcast.sources import readers, writers

NET = Params(model="elastic_net", folds=3)


@pytest.fixture(scope="module")
def rows(spark, small):
    return features.training_rows(views.construction(spark, small), Params()).cache()


def mllib_errors(rows, params, points, names):
    """Each grid point fitted by MLlib on each fold's rows, on the same features."""
    kept, out = moments.folded(rows, params).cache(), []
    for fold in range(params.folds):
        known, unseen = kept.where(F.col(moments.FOLD) != fold), kept.where(F.col(moments.FOLD) == fold)
        stage = forecast.principal_components(known, params, max(names.values())) if names else None
        errors = []
        for p in points:
            inputs = [f"pc{i}" for i in range(p["k"])] if p["k"] else list(params.numerical_cols)
            shaped = [VectorAssembler(inputCols=inputs, outputCol="features").transform(stage.transform(x) if p["k"] else x) for x in (known, unseen)]
            model = LinearRegression(regParam=p["regParam"], elasticNetParam=p["elasticNetParam"], maxIter=200, tol=1e-12).fit(shaped[0])
            errors.append(RegressionEvaluator(metricName="mae").evaluate(model.transform(shaped[1])))
        out.append(errors)
    return np.array(out)


def test_components_and_elastic_net_as_in_mllib(rows):
    grid = {"k": [2, 10], "regParam": [0.1, 0.3], "elasticNetParam": [0.0, 0.5, 1.0]}
    fitted = forecast.train(rows, NET, grid)
    want = mllib_errors(rows, NET, fitted.points, {"k": 10})
    assert np.abs(fitted.errors - want).max() < 1e-6


def test_numbers_as_in_mllib(rows):
    params = dataclasses.replace(NET, categorical_cols=(), use_numeric=True)
    fitted = forecast.train(rows, params, {"k": [None], "elasticNetParam": [0.0, 0.3, 1.0]})
    want = mllib_errors(rows, params, fitted.points, {})
    assert np.abs(fitted.errors - want).max() < 1e-6


def test_rows_are_read_once(spark, rows, monkeypatch):
    """Thirty grid points and ten folds aggregate the rows a single time."""
    reads = []
    cells = moments.cells
    monkeypatch.setattr(moments, "cells", lambda *a: reads.append(1) or cells(*a))
    fitted = forecast.train(rows, dataclasses.replace(NET, folds=10))
    assert fitted.errors.shape == (10, 30) and np.isfinite(fitted.errors).all() and reads == [1]


def test_saved_linear_model(spark, rows, tmp_path):
    grid = {"k": [3], "regParam": [0.1], "elasticNetParam": [0.3]}
    model = forecast.train(rows, NET, grid)
    writers.save_model(model, f"{tmp_path}/model")
    loaded = readers.load_model(f"{tmp_path}/model")
    new = rows.limit(9).withColumns({"region": F.lit(None).cast("string"), "package_name": F.lit("never seen")})
    for some in (rows, new):
        first, again = ([r.JobDurationML for r in forecast.score(m, some, NET).orderBy("JobID").collect()] for m in (model, loaded))
        assert first == again and None not in first
    plan = loaded.transform(rows)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_sums_are_those_of_the_codes(spark):
    data = [("a", "x", 1.5, 2.0), ("a", "y", 2.5, 3.0), ("b", None, None, 5.0), ("b", "it's", 0.5, 7.0)] * 2
    params = Params(categorical_cols=("region", "market"), numerical_cols=("latitude",), use_numeric=True, folds=2)
    df = spark.createDataFrame([(str(i), *r) for i, r in enumerate(data)], "id string, region string, market string, latitude double, label double")
    sums = moments.sums_of(moments.cells(moments.folded(df, params), params), params)
    assert sums.keys == [("code:region", "a"), ("code:region", "b"), ("code:market", "it's"), ("code:market", "x"), ("code:market", "y"), ("number:latitude", None)]
    x = np.array([[1, r[3]] + [float(r[0] == v) for v in "ab"] + [float(r[1] == v) for v in ("it's", "x", "y")] + [r[2] or 0.0] for r in data])
    assert np.allclose(sums.whole(), x.T @ x)
    assert np.allclose(sum(sums.whole() - sums.without(k) for k in sums.folds), sums.whole())


def test_few_rows(spark):
    one = spark.createDataFrame([("1", "r", "m", "p", 0.0, 0.0, 4.0)], "id string, region string, market string, package_name string, latitude double, longitude double, label double")
    fitted = forecast.train(one, NET)
    assert np.isnan(fitted.errors).all()
    assert [r.prediction for r in fitted.transform(one).collect()] == [4.0]
    same = one.unionAll(one.withColumn("id", F.lit("2"))).unionAll(one.withColumn("id", F.lit("7")))
    assert [r.prediction for r in forecast.train(same, NET).transform(one).collect()] == [4.0]


def test_elastic_net_against_conditions_of_the_least():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 5)) @ rng.normal(size=(5, 5)) + 3
    y = x @ [1.0, 0, -2, 0, 0.5] + rng.normal(size=400)
    full = np.column_stack([np.ones(400), y, x])
    for strength, mixture in [(0.1, 0.0), (0.5, 0.5), (1.5, 1.0)]:
        found = moments.elastic_net(full.T @ full, strength, mixture)
        z, w, s = (x - x.mean(0)) / x.std(0), (y - y.mean()) / y.std(), strength / y.std()
        b = found.weights[:, 0] * x.std(0) / y.std()
        slope = z.T @ (z @ b - w) / 400 + s * (1 - mixture) * b
        assert np.allclose(slope[b != 0], -s * mixture * np.sign(b[b != 0]), atol=1e-9)
        assert (np.abs(slope[b == 0]) <= s * mixture + 1e-9).all()
        assert found.constant[0] == pytest.approx(y.mean() - x.mean(0) @ found.weights[:, 0])


@pytest.mark.parametrize(("model", "grid", "regressor"), [
    ("decision_tree", {"k": [4], "maxDepth": [4]}, DecisionTreeRegressor),
    ("gradient_boosting", {"maxDepth": [2], "maxIter": [3]}, GBTRegressor),
])
def test_trees_of_counted_rows_are_those_of_the_rows(rows, model, grid, regressor):
    """Fitted on one row for each combination of features, as MLlib fits them on every row."""
    params = dataclasses.replace(NET, model=model)
    fitted = forecast.train(rows, params, grid)
    point = fitted.points[0]
    shaped = PipelineModel(fitted.best.stages[:-1]).transform(rows)
    plain = regressor(**{k: v for k, v in point.items() if k != "k"}, seed=params.seed).fit(shaped).transform(shaped)
    want = {r["id"]: r["prediction"] for r in plain.select("id", "prediction").collect()}
    got = {r["id"]: r["prediction"] for r in fitted.transform(rows).select("id", "prediction").collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], rel=1e-6) for k in want)


@pytest.mark.parametrize("model", ["decision_tree", "random_forest", "gradient_boosting"])
def test_trees_count_the_rows_once_and_grow_on_groups(spark, rows, monkeypatch, model):
    """However many rows there are, a tree gets one for each combination of features that it sees."""
    grids = {"decision_tree": {"k": [2], "maxDepth": [2]}, "random_forest": {"maxDepth": [2], "numTrees": [2]}, "gradient_boosting": {"maxDepth": [2], "maxIter": [1]}}
    reads, sizes = [], []
    cells, fit = moments.cells, forecast._fit
    monkeypatch.setattr(moments, "cells", lambda *a: reads.append(1) or cells(*a))
    monkeypatch.setattr(forecast, "_fit", lambda point, known, *a: sizes.append(known.count()) or fit(point, known, *a))
    many = rows.withColumn("id", F.explode(F.array(*[F.concat("id", F.lit(f"/{i}")) for i in range(5)])))
    forecast.train(many, Params(model=model, folds=2), grids[model])
    assert reads == [1] and max(sizes) <= rows.select(*Params().categorical_cols).distinct().count()


def test_draws_of_a_forest_are_those_of_single_rows(spark):
    """Numbers drawn for a cell have mean and variance of n rows drawn one by one, and do not hang on the partitioning."""
    cells = spark.range(2000).select(F.lit(0).alias("_fold"), F.col("id").cast("string").alias("market"), F.lit(3).alias("label"), F.lit(40).alias("n_rows"))
    for sampling, variance in (((True, 1.0), 40.0), ((False, 0.5), 10.0)):
        found = [
            {r.market: r.d for r in df.withColumn("d", forecast._draws(df, ["_fold", "market", "label"], sampling, 3, 1)).collect()}
            for df in (cells, cells.repartition(5))
        ]
        assert found[0] == found[1]
        drawn = np.array(list(found[0].values()))
        assert np.allclose(drawn.mean(0), 40 * sampling[1], rtol=0.03) and np.allclose(drawn.var(0), variance, rtol=0.15)
        assert abs(np.corrcoef(drawn.T)[0, 1]) < 0.1
