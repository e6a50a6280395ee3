"""Whitening of embeddings: principal directions by mixed-precision refinement of float32 eigenvectors."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crewcast.session import materialise

#: Entries times this, plus the offset, are taken as whole numbers.
SCALE, OFFSET = 64, 1_000_000

#: Sums of whole numbers below this are exact in a double.
EXACT = 2**53


def whole_vectors(df: DataFrame, id_col: str, vector_col: str, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """(id, x): every row whose vector is finite, entries as floor(scale * c) + offset.

    Null and empty vectors and those with a null or non-finite entry are dropped, and so are
    vectors of another length than the most common one (of lengths as common the largest). Ids
    may be null and may repeat. Entries too large for a whole number of 52 bits raise.
    """
    v = F.col(vector_col).cast("array<double>")
    rows = df.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where("v IS NOT NULL AND size(v) > 0")
    rows = rows.where(~F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))))
    lengths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    rows = rows.where(F.size("v") == (lengths["d"] if lengths else 0))

    def whole(c):
        fits = F.abs(c) < float(2**52 // scale)
        return F.when(fits, F.floor(F.lit(float(scale)) * c) + F.lit(offset)).otherwise(F.raise_error(F.lit("an entry does not fit a whole number")).cast("long"))

    return materialise(rows.select("id", F.transform("v", whole).alias("x")), "whitening-rows")


def _matrix(column: pa.Array, kind) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(len(column), -1)


def _products(y: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sums of the rows and of their outer products, exactly, in portions whose figures fit 53 bits."""
    most = int(np.abs(y).max()) if y.size else 0
    if most * most * len(y) < EXACT:
        z = y.astype(np.float64)
        yield y.sum(0), (z.T @ z).astype(np.int64)
    elif len(y) > 1:
        for part in np.array_split(y, 2):
            yield from _products(part)
    else:
        whole = y.astype(object)
        yield whole.sum(0), np.outer(whole[0], whole[0])


def gram(rows: DataFrame, shift: list[int]) -> tuple[list[int], list[list[int]]]:
    """Sums of x - shift over all rows and of its products, as whole numbers of any size."""
    d, centre = len(shift), np.array(shift, np.int64)
    upper = np.triu_indices(d)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = np.zeros(d, object), np.zeros(len(upper[0]), object)
        small, size = np.zeros((d, d), np.int64), 0
        for b in batches:
            for sums, products in _products(_matrix(b.column(0), np.int64) - centre):
                first = first + sums.astype(object)
                if products.dtype == object or size >= 512:  # 512 portions below 2^53 fit a long
                    second = second + small[upper].astype(object)
                    small, size = np.zeros((d, d), np.int64), 0
                if products.dtype == object:
                    second = second + products[upper]
                else:
                    small, size = small + products, size + 1
        second = second + small[upper].astype(object)
        i = np.concatenate([np.full(d, -1), upper[0]])
        j = np.concatenate([np.arange(d), upper[1]])
        values = [Decimal(int(v)) for v in [*first, *second]]
        columns = [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(values, pa.decimal128(38, 0))]
        yield pa.RecordBatch.from_arrays(columns, ["i", "j", "s"])

    parts = rows.select("x").mapInArrow(add, "i int, j int, s decimal(38, 0)").groupBy("i", "j").agg(F.sum("s").alias("s"))
    first, second = [0] * d, [[0] * d for _ in range(d)]
    for i, j, s in parts.collect():  # a figure for each pair of dimensions
        if i < 0:
            first[j] = int(s)
        else:
            second[i][j] = second[j][i] = int(s)
    return first, second


def refined_eigenvectors(a: np.ndarray, rounds: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix in extended precision.

    Eigenvectors found in float32 are refined by the iteration of Ogita and Aishima: from
    the defect of orthogonality r = I - X'X and s = X'AX follows a correction X + XE, with
    E = (s_ij + l_j r_ij) / (l_j - l_i) where the eigenvalues l are told apart and r_ij / 2
    where they are not. Eigenvalues closer than the error bound form a cluster: there the
    small problem X_J'(A - mu I)X_J, whose entries are differences within the cluster, is
    solved on its own and turns the cluster's vectors; the next rounds then tell them
    apart. Eigenvalues that are equal to the last digit keep any basis of their space.
    """
    d = len(a)
    scale = np.abs(a).max() if d else 0
    if not d or scale == 0:
        return np.zeros(d), np.eye(d)
    a = np.asarray(a, np.longdouble) / np.longdouble(scale)
    eps, identity, size = np.finfo(np.longdouble).eps, np.eye(d, dtype=np.longdouble), np.sqrt((a * a).sum())
    noise = 8 * d * eps * size  # what rounding leaves
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    for _ in range(rounds):
        r = identity - x.T @ x
        s = x.T @ (a @ x)
        s = (s + s.T) / 2
        values = s.diagonal() / (1 - r.diagonal())
        off = s - np.diag(values)
        bound = 2 * (np.sqrt((off * off).sum()) + size * np.sqrt((r * r).sum()))
        if bound <= noise:
            break
        gaps = values[None, :] - values[:, None]
        close = np.abs(gaps) <= bound
        e = np.where(close, r / 2, (s + values[None, :] * r) / np.where(close, 1, gaps))
        x = x + x @ e
        _turn_clusters(a, x, values, bound, noise)
    x = x + x @ ((identity - x.T @ x) / 2)  # a turn is orthogonal to double precision only
    values = (x * (a @ x)).sum(0)
    order = np.argsort(-values, kind="stable")
    x = x[:, order]
    x = x * np.where(x[np.abs(x).argmax(0), np.arange(d)] < 0, -1, 1)
    return values[order] * np.longdouble(scale), x


def _turn_clusters(a: np.ndarray, x: np.ndarray, values: np.ndarray, bound: np.longdouble, noise: np.longdouble) -> None:
    """Solve the clusters of eigenvalues within ``bound`` of each other, in place."""
    order = np.argsort(values, kind="stable")
    cuts = np.flatnonzero(np.diff(values[order]) > bound) + 1
    for members in np.split(order, cuts):
        if len(members) < 2:
            continue
        mine, mu = x[:, members], values[members].mean()
        t = mine.T @ (a @ mine) - mu * (mine.T @ mine)
        t = (t + t.T) / 2
        off = np.abs(t - np.diag(t.diagonal())).max()
        if off <= noise:  # solved, or equal to the last digit: any basis will do
            continue
        turn = np.linalg.eigh((t / np.abs(t).max()).astype(np.float64))[1].astype(np.longdouble)
        x[:, members] = mine @ turn


@dataclass(frozen=True)
class Whitening:
    """Figures of the fit list: n vectors with sums S, the directions, their variances and shares of the whole variance."""

    n: int
    sums: tuple[int, ...]
    vectors: np.ndarray
    variances: np.ndarray
    explained: tuple[float, ...]


def fit(rows: DataFrame, components: int = 32) -> Whitening:
    """Fit on all ``rows`` (id, x): covariance in whole numbers, its directions by refinement.

    Directions without variance (to rounding) are left out, so there may be fewer than
    ``components``.
    """
    sums = rows.select(F.posexplode("x").alias("i", "c")).groupBy("i").agg(F.sum("c").alias("s"), F.count("*").alias("n")).collect()
    n, d = (sums[0]["n"], len(sums)) if sums else (0, 0)
    totals = [0] * d
    for r in sums:  # a figure for each dimension
        totals[r["i"]] = r["s"]
    if not d:
        return Whitening(0, (), np.zeros((0, 0)), np.zeros(0), ())
    first, second = gram(rows, [(2 * t + n) // (2 * n) for t in totals])
    exact = [[n * second[i][j] - first[i] * first[j] for j in range(d)] for i in range(d)]
    covariance = np.array([[np.longdouble(str(v)) for v in row] for row in exact]) / np.longdouble(n) / np.longdouble(n)
    values, vectors = refined_eigenvectors(covariance)
    kept = int((values > max(values[0], 0) * d * 1e-15).sum())
    kept = min(components, kept) if values[0] > 0 else 0
    whole = covariance.diagonal().sum()
    shares = tuple(float(v / whole) for v in values[:kept])
    return Whitening(n, tuple(totals), vectors[:, :kept].astype(np.float64), values[:kept].astype(np.float64), shares)


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """n x - S as doubles, and its squared length as an exact whole number."""
    bound = n * max(int(np.abs(x).max(initial=0)), 1)
    scaled = x * n - sums if bound < 2**62 else x.astype(object) * n - sums.astype(object)
    most = max(int(np.abs(scaled).max()) if scaled.size else 0, 1)
    if scaled.dtype == object or most * most * scaled.shape[1] >= 2**63:
        whole = (scaled.astype(object) ** 2).sum(1)
        if len(whole) and max(whole) >= 2**63:
            raise OverflowError("a squared deviation does not fit a long")
        return scaled.astype(np.float64), whole.astype(np.int64)
    return scaled.astype(np.float64), (scaled * scaled).sum(1)


def whitened(rows: DataFrame, model: Whitening) -> DataFrame:
    """(id, deviation, w): each vector's squared n-fold distance to the mean and its whitened components."""
    n, sums = model.n, np.array(model.sums, np.int64)
    vectors, spread = model.vectors, np.sqrt(model.variances)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            scaled, whole = _deviations(_matrix(b.column(1), np.int64), n, sums)
            w = (scaled / n) @ vectors / spread
            ends = pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32())
            columns = [b.column(0), pa.array(whole, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(w.ravel(), pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "deviation", "w"])

    return materialise(rows.select("id", "x").mapInArrow(project, "id long, deviation long, w array<double>"), "whitening-vectors")


def identity_error(vectors: DataFrame, n: int, k: int) -> float:
    """Largest entry, in size, of the covariance of ``w`` minus the identity; centred by a pass of its own before multiplying."""
    if not n or not k:
        return 0.0

    def summed(mean: np.ndarray | None):
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(k if mean is None else k * k)
            for b in batches:
                if b.num_rows:
                    w = _matrix(b.column(0), np.float64)
                    total = total + (w.sum(0) if mean is None else ((w - mean).T @ (w - mean)).ravel())
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(total)], ["i", "s"])

        parts = vectors.select("w").mapInArrow(add, "i int, s double").groupBy("i").agg(F.sum("s").alias("s"))
        out = np.zeros(k if mean is None else k * k)
        for i, s in parts.collect():  # a figure for each pair of components
            out[i] = s
        return out / n

    covariance = summed(summed(None)).reshape(k, k)
    return float(np.abs(covariance - np.eye(k)).max())


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 32) -> DataFrame:
    """(id, n, deviation, w, explained, identity_error): a row for each finite vector.

    ``w`` holds up to ``components`` whitened figures: the vector less the mean, projected
    on the unit eigenvectors of the covariance in order of falling eigenvalue, over the
    eigenvalue's root; ``explained`` the eigenvalues' shares of the whole variance. All
    finite vectors are fitted; the covariance is summed in whole numbers, so neither the
    offset nor the order of summing costs a digit.

    Defined cases: null vectors, and those with null or non-finite entries or of an
    uncommon length, have no row; null and repeated ids keep their rows; equal
    eigenvalues have any basis, the same for all rows; directions without variance are
    left out, so equal vectors alone give empty ``w``; an empty table gives no rows.
    """
    rows = whole_vectors(df, id_col, vector_col)
    model = fit(rows, components)
    vectors = whitened(rows, model)
    error = identity_error(vectors, model.n, len(model.explained))
    explained = F.array(*[F.lit(v) for v in model.explained]).cast("array<double>")
    return vectors.select("id", F.lit(model.n).cast("long").alias("n"), "deviation", "w", explained.alias("explained"), F.lit(error).alias("identity_error"))
