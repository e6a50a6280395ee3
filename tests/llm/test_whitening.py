import math

import numpy as np
import pytest

from crewcast.llm import whitening
from crewcast.llm.queries import QUERIES


def whole(v):
    return np.floor(64 * np.asarray(v, np.float64)).astype(np.int64) + 1_000_000


def residual(a, values, x):
    a, x = np.asarray(a, np.longdouble), np.asarray(x, np.longdouble)
    return np.abs(a @ x - x * values).max() / np.abs(a).max(), np.abs(x.T @ x - np.eye(len(a))).max()


def test_query_against_the_definition(spark, small):
    got = QUERIES["op12_whitening"](spark, small).toPandas()
    table = spark.read.parquet(f"{small}/embeddings.parquet").toPandas()
    x = np.stack([whole(v) for v in table.embedding])
    n, sums = len(x), x.sum(0)
    centred = x - sums / n
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:32], vectors[:, ::-1][:, :32]
    want = centred @ vectors / np.sqrt(values)
    assert len(got) == 32 * n and got.n.eq(n).all()
    w = got.sort_values(["vec_id", "component"]).whitened.to_numpy().reshape(n, 32)[np.argsort(np.argsort(table.vec_id))]
    signs = np.sign((w * want).sum(0))
    assert np.abs(w - want * signs).max() < 1e-8
    deviation = {i: sum((n * int(c) - int(s)) ** 2 for c, s in zip(v, sums)) for i, v in zip(table.vec_id, x)}
    assert all(deviation[i] == d for i, d in zip(got.vec_id, got.deviation))
    first = got.drop_duplicates("component").sort_values("component")
    assert np.allclose(first.explained, values / np.trace(covariance), rtol=1e-10)
    assert got.identity_error.nunique() == 1 and got.identity_error.iloc[0] < 1e-9
    error = np.abs(np.cov(w.T, bias=True) - np.eye(32)).max()
    assert got.identity_error.iloc[0] == pytest.approx(error, abs=1e-12)


@pytest.mark.parametrize("gap", [1e-1, 1e-4, 1e-8, 1e-12, 1e-15, 0.0])
def test_clustered_eigenvalues(gap):
    rng = np.random.default_rng(3)
    q = np.linalg.qr(rng.normal(size=(24, 24)))[0]
    values = np.concatenate([[5, 5 + gap, 5 + 2 * gap, 5 + 3 * gap], [2, 2 + gap], np.linspace(0.1, 1, 18)])
    a = np.asarray(q, np.longdouble) * values @ q.T
    found, x = whitening.refined_eigenvectors((a + a.T) / 2)
    off, orthogonal = residual((a + a.T) / 2, found, x)
    assert off < 1e-16 and orthogonal < 1e-17
    assert np.abs(np.sort(found) - np.sort(values)).max() < 1e-14


def test_far_better_than_float32():
    rng = np.random.default_rng(4)
    y = rng.normal(size=(500, 48))
    a = np.asarray(y.T @ y / 500, np.longdouble)
    _, start = np.linalg.eigh(a.astype(np.float32))
    _, x = whitening.refined_eigenvectors(a)
    assert residual(a, np.diag(start.T @ a @ start), start)[0] > 1e-8
    assert residual(a, np.diag(x.T @ a @ x), x)[0] < 1e-17
    values, x = whitening.refined_eigenvectors(np.zeros((3, 3)))
    assert values.tolist() == [0, 0, 0] and np.array_equal(x, np.eye(3))


def test_exact_sums(spark):
    rng = np.random.default_rng(5)
    far = [[float(c) for c in rng.integers(-(2**44), 2**44, 3)] for _ in range(20)]
    near = [[float(c) for c in rng.integers(-9, 9, 3)] for _ in range(50)]
    for rows in (near, near + far):
        x = whitening.whole_vectors(spark.createDataFrame([(i, v) for i, v in enumerate(rows)], "id long, v array<double>"), "id", "v")
        plain = [[int(64 * c) + 1_000_000 for c in v] for v in rows]
        shift = [1_000_000, 999_999, 5]
        first, second = whitening.gram(x, shift)
        y = [[a - b for a, b in zip(v, shift)] for v in plain]
        assert first == [sum(c) for c in zip(*y)]
        assert second == [[sum(v[i] * v[j] for v in y) for j in range(3)] for i in range(3)]


def test_odd_vectors(spark):
    nan, inf = math.nan, math.inf
    rows = [(1, [1.0, 2.0]), (2, None), (3, [1.0, None]), (4, [nan, 1.0]), (5, [inf, 1.0]), (None, [-1.0, 1.5]), (6, [0.5, 1.0]), (6, [0.25, -1.0]), (7, [1.0]), (8, []), (9, [1.0, 2.0])]
    frame = spark.createDataFrame([(*r, "k", 1, 2.0) for r in rows], "vec_id long, embedding array<float>, id string, n int, w double")
    got = whitening.whiten(frame).collect()
    assert sorted(str(r["id"]) for r in got) == ["1", "6", "6", "9", "None"]
    x = np.stack([whole(r[1]) for r in rows if r[0] in (1, 6, 9, None) and r[1]])
    sums = x.sum(0)
    assert sorted(r["deviation"] for r in got) == sorted(int(((5 * v - sums) ** 2).sum()) for v in x)
    assert all(r["n"] == 5 and len(r["w"]) == 2 and r["identity_error"] < 1e-12 for r in got)
    assert np.allclose(np.cov(np.array([r["w"] for r in got]).T, bias=True), np.eye(2))


def test_without_variance(spark):
    frame = spark.createDataFrame([(i, [1.0, 2.0, float(i)]) for i in range(4)], "vec_id long, embedding array<double>")
    got = whitening.whiten(frame).collect()
    assert all(len(r["w"]) == 1 and r["explained"] == [1.0] for r in got)
    got = whitening.whiten(frame.where("vec_id = 1")).collect()
    assert [(r["w"], r["deviation"], r["n"]) for r in got] == [([], 0, 1)]
    assert whitening.whiten(frame.limit(0)).collect() == []
    huge = spark.createDataFrame([(1, [1e30])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="whole number"):
        whitening.whiten(huge).collect()
