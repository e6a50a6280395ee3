"""Quality classifier: random Fourier features, ridge by normal equations, isotonic calibration."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What ``statistics`` returns, in order.
STATISTICS = (
    "log_chars", "log_words", "word_length", "upper", "digits", "space", "stops", "bangs", "signs", "bars", "brackets",
    "not_ascii", "distinct_words", "line_words", "repeated_lines", "short_words", "longest_word", "common_byte",
)

_SETS = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digits": b"0123456789",
    "space": b" \t\n\r\x0b\x0c",
    "stops": b".,;:?",
    "bangs": b"!",
    "signs": b"#$%&*@^~+=",
    "bars": b"|",
    "brackets": b"()[]{}<>/\\_\"",
}
_WEIGHTS = np.zeros((256, len(_SETS) + 1))
for _i, _chars in enumerate(_SETS.values()):
    _WEIGHTS[list(_chars), _i] = 1.0
_WEIGHTS[128:, -1] = 1.0


def statistics(text: str) -> np.ndarray:
    """Numbers that describe a whole text; a text without words has zeros for all ratios."""
    raw = text.encode("utf-8", "surrogatepass")
    out = np.zeros(len(STATISTICS))
    if not raw:
        return out
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    share = counts @ _WEIGHTS / len(raw)
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    n = max(1, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    out[:3] = np.log1p(len(text)), np.log1p(len(words)), lengths.mean()
    out[3:12] = share
    out[12:] = (
        len(set(words)) / n,
        np.log1p(len(words) / max(1, len(lines))),
        1 - len(set(lines)) / max(1, len(lines)),
        float((lengths <= 3).mean()),
        np.log1p(lengths.max()),
        counts.max() / len(raw),
    )
    return out


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def statistics_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Column function: text -> statistics; a null text counts as empty."""
    for texts in batches:
        rows = [statistics(t.as_py() or "") for t in texts]
        flat = np.concatenate(rows) if rows else np.zeros(0)
        offsets = np.arange(len(rows) + 1, dtype=np.int32) * len(STATISTICS)
        yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


@dataclass(frozen=True)
class Model:
    """Standardised statistics -> cosines -> ridge value -> calibrated score."""

    mean: np.ndarray
    scale: np.ndarray
    frequencies: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    steps: tuple[np.ndarray, np.ndarray]

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        waves = np.cos(z @ self.frequencies + self.phases) * np.sqrt(2 / len(self.phases))
        return np.column_stack([np.ones(len(x)), z, waves])

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.features(x) @ self.weights, *self.steps), 0, 1)


def _sums(rows: DataFrame, model: Model, folds: int) -> tuple[np.ndarray, np.ndarray]:
    """Normal equations of each fold: sums over partitions, added up row by row of the matrix."""
    size = len(model.weights)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((folds, size, size + 1))
        seen = set()
        for b in batches:
            f = model.features(_matrix(b.column(0)))
            y, fold = b.column(1).to_numpy().astype(float), b.column(2).to_numpy()
            for k in np.unique(fold):
                mine = f[fold == k]
                total[k] += mine.T @ np.column_stack([mine, y[fold == k]])
                seen.add(int(k))
        for k in seen:
            at = pa.array(np.arange(size) + k * size, pa.int64())
            values = pa.ListArray.from_arrays(
                pa.array(np.arange(size + 1, dtype=np.int32) * (size + 1)), pa.array(total[k].ravel())
            )
            yield pa.RecordBatch.from_arrays([at, values], ["at", "v"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for b in batches:
            for at, v in zip(b.column(0).to_pylist(), _matrix(b.column(1))):
                found[at] = found.get(at, 0) + v
        keys = list(found)
        flat = np.concatenate([found[k] for k in keys]) if keys else np.zeros(0)
        offsets = pa.array(np.arange(len(keys) + 1, dtype=np.int32) * (size + 1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(flat))], ["at", "v"]
        )

    schema = "at long, v array<double>"
    parts = rows.select("x", "y", "fold").mapInArrow(partial, schema)
    whole = parts.repartition("at").mapInArrow(add, schema).collect()  # folds x features rows, whatever the input
    out = np.zeros((folds, size, size + 1))
    for r in whole:
        out[r["at"] // size, r["at"] % size] = r["v"]
    return out[:, :, :-1], out[:, :, -1]


def _isotonic(bins: np.ndarray, total: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over the bins; knots of a rising curve."""
    blocks: list[list[float]] = []
    for b, n, g in zip(bins, total, good):
        blocks.append([b * n, n, g])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + c for a, c in zip(blocks[-1], last)]
    return np.array([x / n for x, n, _ in blocks]), np.array([g / n for _, n, g in blocks])


def learn(
    described: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    statistics_col: str = "statistics",
    label_col: str = "quality",
    waves: int = 128,
    ridge: float = 1e-2,
    folds: int = 5,
    width: float = 1.0,
    seed: int = 23,
) -> Model:
    """Fit on all labelled rows.

    Mean and spread of each statistic come from all documents. The cosines have seeded
    normal frequencies, whose spread is one over ``width`` times the root of the number
    of statistics (a Gaussian kernel). Each task sums the normal equations of its rows by
    fold; the sums are added up and solved. Values of rows outside of the folds that
    fitted them, in bins of a thousandth, give the isotonic curve.

    Null ids and labels give nothing; of repeated ids the larger label counts, and
    documents that share it all learn it. Without labels every score is 0.5.
    """
    size = len(STATISTICS)
    columns = [F.col(statistics_col)[i] for i in range(size)]
    row = described.agg(*[F.avg(c) for c in columns], *[F.stddev_pop(c) for c in columns]).first()
    moments = np.array([v or 0.0 for v in row], float)
    mean, scale = moments[:size], np.where(moments[size:] > 1e-9, moments[size:], 1.0)
    rng = np.random.default_rng(seed)
    frequencies = rng.normal(size=(size, waves)) / (width * np.sqrt(size))
    phases = rng.uniform(0, 2 * np.pi, waves)
    nothing = np.zeros(1 + size + waves)
    model = Model(mean, scale, frequencies, phases, nothing, (np.array([0.0, 1.0]), np.array([0.5, 0.5])))
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).dropna()
    known = known.groupBy("id").agg(F.max("y").alias("y"))
    rows = described.select(F.col(id_col).alias("id"), F.col(statistics_col).alias("x")).join(known, "id")
    rows = rows.withColumn("fold", F.pmod(F.xxhash64(F.lit(seed), F.col("id")), F.lit(folds)).cast("int"))
    squares, products = _sums(rows, model, folds)
    if not squares.any():
        return model
    n = max(1.0, squares[:, 0, 0].sum())
    penalty = ridge * np.sqrt(n) * np.eye(len(nothing))
    penalty[0, 0] = 1e-9
    every, gives = squares.sum(0), products.sum(0)
    outside = np.array([np.linalg.solve(every - squares[k] + penalty, gives - products[k]) for k in range(folds)])

    def held_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            w = outside[b.column(2).to_numpy()]
            raw = (model.features(_matrix(b.column(0))) * w).sum(1)
            yield pa.RecordBatch.from_arrays([pa.array(np.clip(raw, -1, 2)), b.column(1)], ["raw", "y"])

    values = rows.select("x", "y", "fold").mapInArrow(held_out, "raw double, y int")
    bins = values.groupBy(F.round("raw", 3).alias("bin")).agg(F.count("*").alias("n"), F.sum("y").alias("y"))
    table = bins.orderBy("bin").collect()  # 3001 bins at most
    steps = _isotonic(*[np.array([float(r[c]) for r in table]) for c in ("bin", "n", "y")])
    return Model(mean, scale, frequencies, phases, np.linalg.solve(every + penalty, gives), steps)


def scorer(model: Model):
    """A column function: statistics -> score from 0 to 1, higher where label 1 is likelier.

    The score depends on the statistics of the text alone; empty and null texts have
    statistics like any other, and equal texts get equal scores.
    """

    @F.arrow_udf(T.DoubleType())
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for rows in batches:
            yield pa.array(model.score(_matrix(rows)) if len(rows) else [], pa.float64())

    return score
