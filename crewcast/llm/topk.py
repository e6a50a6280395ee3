"""Exact top-k search by blocks of the document range, pruned by summed term maxima."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from crewcast.session import materialise

#: Rows of a block, queries of a batch, and the summaries of blocks and batches that meet in one group, about.
BLOCK_ROWS, BATCH_QUERIES, SUMMARY_BLOCKS, GROUP_BATCHES = 1024, 512, 256, 4

PACKED = "ids binary, terms binary, starts binary, weights binary"


def _pack(ids: list[int], vectors: list[list]) -> tuple[bytes, bytes, bytes, bytes]:
    """A forward index: the terms and weights of each row, one row after the other."""
    rows = [(np.fromiter((t for t, _ in v), np.int64, len(v)), np.fromiter((w for _, w in v), np.int64, len(v))) for v in vectors]
    starts = np.concatenate([[0], np.cumsum([len(t) for t, _ in rows])]).astype(np.int64)
    terms = np.concatenate([t for t, _ in rows]) if rows else np.zeros(0, np.int64)
    weights = np.concatenate([w for _, w in rows]) if rows else np.zeros(0, np.int64)
    return np.array(ids, np.int64).tobytes(), terms.tobytes(), starts.tobytes(), weights.tobytes()


class Rows:
    """A packed forward index."""

    def __init__(self, ids: bytes, terms: bytes, starts: bytes, weights: bytes):
        self.ids, self.terms, self.starts, self.weights = (np.frombuffer(x, np.int64) for x in (ids, terms, starts, weights))

    def columns(self, terms: np.ndarray) -> np.ndarray:
        """Dense weights, rows by the given sorted terms; terms that are not given are left out."""
        at = np.searchsorted(terms, self.terms)
        known = at < len(terms)
        known[known] = terms[at[known]] == self.terms[known]
        row = np.repeat(np.arange(len(self.ids)), np.diff(self.starts))[known]
        out = np.zeros((len(self.ids), len(terms)))
        out[row, at[known]] = self.weights[known]
        return out


def _extremes(rows: Rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Terms of a block with their least and largest weight; rows without a term count as 0."""
    terms, at = np.unique(rows.terms, return_inverse=True)
    low, high = np.full(len(terms), np.iinfo(np.int64).max), np.full(len(terms), np.iinfo(np.int64).min)
    np.minimum.at(low, at, rows.weights)
    np.maximum.at(high, at, rows.weights)
    partial = np.bincount(at, minlength=len(terms)) < len(rows.ids)
    return terms, np.where(partial, np.minimum(low, 0), low), np.where(partial, np.maximum(high, 0), high)


def _batches(rows: DataFrame, size: int, name: str, extremes: bool) -> DataFrame:
    """Rows of (number, packed index): consecutive ids together, ``size`` of them."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(parts, "id").sortWithinPartitions("id")
    ordered = ordered.withColumn("part", F.spark_partition_id())

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, list]] = []
        number = 0

        def block(part: int) -> pa.RecordBatch:
            nonlocal number
            packed = _pack([i for i, _ in held], [v for _, v in held])
            values = [(part << 32) + number, *packed]
            if extremes:
                values += [x.tobytes() for x in _extremes(Rows(*packed))]
            number += 1
            held.clear()
            kinds = [pa.int64()] + [pa.binary()] * (len(values) - 1)
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)

        part = 0
        for b in batches:
            for i, v, part in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                held.append((i, [(x["t"], x["w"]) for x in v]))
                if len(held) == size:
                    yield block(part)
        if held:
            yield block(part)

    schema = f"number long, {PACKED}" + (", found binary, low binary, high binary" if extremes else "")
    names = [c.split()[0] for c in schema.split(", ")]
    return materialise(ordered.select("id", "v", "part").mapInArrow(pack, schema), name)


def _bounds(queries: Rows, terms: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The most that any row of a block can score: per term the better end, summed."""
    q = queries.columns(terms)
    return np.maximum(q * low, q * high).sum(1)


def _top(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best, ties to the smaller id."""
    if len(scores) > k:
        worst = np.partition(scores, len(scores) - k)[len(scores) - k]
        places = np.flatnonzero(scores >= worst)
    else:
        places = np.arange(len(scores))
    return places[np.lexsort((ids[places], -scores[places]))[:k]]


def _plan(batches: DataFrame, blocks: DataFrame, floors: DataFrame | None, ahead: int) -> DataFrame:
    """(query, block) work: without floors each query's ``ahead`` most promising blocks, else all blocks whose bound reaches its floor.

    Every batch of queries meets the summary of every block, not the block itself. A few
    batches and some summaries make a group, so a group stays as large as it is and the
    groups grow in number, with queries times blocks.
    """
    groups = max(1, -(-blocks.count() // SUMMARY_BLOCKS))
    sides = max(1, -(-batches.count() // GROUP_BATCHES))
    summaries = blocks.select("number", "found", "low", "high", F.pmod(F.xxhash64("number"), F.lit(groups)).alias("g"))
    summaries = summaries.withColumn("s", F.explode(F.expr(f"sequence(0L, {sides - 1}L)")))
    asked = batches.select(F.col("number").alias("batch"), "ids", "terms", "starts", "weights")
    first = floors is None
    if not first:
        asked = asked.join(floors, "batch")
    asked = asked.withColumn("s", F.pmod(F.xxhash64("batch"), F.lit(sides)))
    asked = asked.withColumn("g", F.explode(F.expr(f"sequence(0L, {groups - 1}L)")))

    def meet(_, left: Iterator[pa.RecordBatch], right: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [r for b in right for r in b.to_pylist()]
        for b in left:
            for row in b.to_pylist():
                queries = Rows(*[row[c] for c in ("ids", "terms", "starts", "weights")])
                if not held:
                    continue
                numbers = np.array([r["number"] for r in held])
                bounds = np.stack([_bounds(queries, *[np.frombuffer(r[c], np.int64) for c in ("found", "low", "high")]) for r in held])
                out_q, out_b, out_v = [], [], []
                if first:
                    for i in range(len(queries.ids)):
                        best = _top(bounds[:, i], numbers, ahead)
                        out_q.append(np.full(len(best), i)), out_b.append(numbers[best]), out_v.append(bounds[best, i])
                else:
                    floor = np.frombuffer(row["floor"], np.float64)
                    at, i = np.nonzero(bounds >= floor)
                    out_q.append(i), out_b.append(numbers[at]), out_v.append(bounds[at, i])
                place, block, value = (np.concatenate(x) for x in (out_q, out_b, out_v))
                for n in np.unique(block):
                    mine = block == n
                    columns = [pa.array([row["batch"]]), pa.array([n]), pa.array([place[mine].astype(np.int32).tobytes()]), pa.array([value[mine].tobytes()])]
                    yield pa.RecordBatch.from_arrays(columns, ["batch", "block", "places", "bounds"])

    schema = "batch long, block long, places binary, bounds binary"
    return asked.groupBy("s", "g").cogroup(summaries.groupBy("s", "g")).applyInArrow(_whole(meet, schema), schema)


def _whole(function, schema: str):
    """Adapts a function of batches to cogrouped tables."""
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    empty = pa.schema(list(zip(names, kinds)))

    def apply(left: pa.Table, right: pa.Table) -> pa.Table:
        found = list(function(None, iter(left.to_batches()), iter(right.to_batches())))
        return pa.Table.from_batches(found, empty) if found else empty.empty_table()

    return apply


def _scored(work: DataFrame, batches: DataFrame, blocks: DataFrame, floors: DataFrame | None, k: int) -> DataFrame:
    """Scores through the forward indexes: of each query and block the k best rows that reach the floor."""
    asked = batches.select(F.col("number").alias("batch"), *[F.col(c).alias(f"q_{c}") for c in ("ids", "terms", "starts", "weights")])
    if floors is not None:
        asked = asked.join(floors, "batch")
    held = blocks.select(F.col("number").alias("block"), "ids", "terms", "starts", "weights")
    rows = work.join(asked, "batch").join(held, "block")

    def score(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in found:
            for r in b.to_pylist():
                queries = Rows(*[r[f"q_{c}"] for c in ("ids", "terms", "starts", "weights")])
                rows = Rows(*[r[c] for c in ("ids", "terms", "starts", "weights")])
                place = np.frombuffer(r["places"], np.int32)
                terms = np.unique(queries.terms)
                scores = queries.columns(terms)[place] @ rows.columns(terms).T  # whole numbers below 2^53: exact
                floor = np.frombuffer(r["floor"], np.float64)[place] if r.get("floor") else np.full(len(place), -np.inf)
                q_out, id_out, s_out = [], [], []
                for i, q in enumerate(queries.ids[place]):
                    may = np.flatnonzero((scores[i] >= floor[i]) & (rows.ids != q))
                    best = may[_top(scores[i][may], rows.ids[may], k)]
                    q_out.append(np.full(len(best), q)), id_out.append(rows.ids[best]), s_out.append(scores[i][best])
                columns = [np.concatenate(x) if x else np.zeros(0) for x in (q_out, id_out, s_out)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0].astype(np.int64)), pa.array(columns[1].astype(np.int64)), pa.array(columns[2].astype(np.int64))],
                    ["query_id", "id", "score"],
                )

    return rows.mapInArrow(score, "query_id long, id long, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(rows: DataFrame, queries: DataFrame, k: int, *, ahead: int = 2) -> DataFrame:
    """(query_id, rank, id, score): the ``k`` rows of the largest inner product with each query, exactly.

    ``rows`` and ``queries`` have ``id`` (long) and ``v`` (array of (t, w): term and whole
    weight, of any sign). A row is no candidate of the query with its own id.

    Rows are cut into blocks of consecutive ids, each a forward index with the least and
    largest weight of its terms. Of each query the blocks are ordered by the sum of the
    better ends. First the ``ahead`` most promising blocks are scored; the k-th score so
    far is the query's floor. Then all other blocks whose bound reaches the floor are
    scored, and rows below the floor are left out at once. Only blocks that cannot hold
    one of the k best are skipped.

    Defined cases: equal scores go to the smaller id; rows that repeat an id are
    candidates each, and queries that repeat an id must be given once; rows without terms
    score 0; fewer candidates than ``k`` are all returned; without rows or queries the
    result is empty.
    """
    blocks = _batches(rows, BLOCK_ROWS, "topk-blocks", True)
    batches = _batches(queries, BATCH_QUERIES, "topk-queries", False)
    first = materialise(_plan(batches, blocks, None, ahead), "topk-first")
    first = _cut(first, ahead)
    seen = materialise(_best(_scored(first, batches, blocks, None, k), k), "topk-seen")
    floors = materialise(_floors(batches, seen, k), "topk-floors")
    second = materialise(_plan(batches, blocks, floors, ahead), "topk-second")
    done = first.select("batch", "block", F.col("places").alias("done"))
    rest = _without(second.join(done, ["batch", "block"], "left"))
    found = _scored(rest, batches, blocks, floors, k).unionByName(seen.select("query_id", "id", "score"))
    return _best(found, k)


def _cut(work: DataFrame, ahead: int) -> DataFrame:
    """The best ``ahead`` blocks of each query, over all summaries."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                place = np.frombuffer(r["places"], np.int32)
                n = len(place)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["batch"]] * n, pa.int64()), pa.array([r["block"]] * n, pa.int64()), pa.array(place), pa.array(np.frombuffer(r["bounds"], np.float64))],
                    ["batch", "block", "place", "bound"],
                )

    each = work.mapInArrow(spread, "batch long, block long, place int, bound double")
    order = Window.partitionBy("batch", "place").orderBy(F.desc("bound"), "block")
    kept = each.withColumn("r", F.row_number().over(order)).where(F.col("r") <= ahead)
    grouped = kept.groupBy("batch", "block").agg(F.array_sort(F.collect_list("place")).alias("list"))  # a batch at most

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            places = [np.array(x, np.int32).tobytes() for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(places, pa.binary())], ["batch", "block", "places"])

    return materialise(grouped.mapInArrow(pack, "batch long, block long, places binary"), "topk-work")


def _floors(batches: DataFrame, seen: DataFrame, k: int) -> DataFrame:
    """(batch, floor): the k-th score of each query so far, packed; minus infinity where there are fewer."""
    kth = seen.where(F.col("rank") == k).select("query_id", "score")

    def ids(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in found:
            for r in b.to_pylist():
                queries = np.frombuffer(r["ids"], np.int64)
                columns = [pa.array(np.full(len(queries), r["number"])), pa.array(np.arange(len(queries), dtype=np.int32)), pa.array(queries)]
                yield pa.RecordBatch.from_arrays(columns, ["batch", "place", "query_id"])

    places = batches.select("number", "ids").mapInArrow(ids, "batch long, place int, query_id long")
    listed = places.join(kth, "query_id", "left").groupBy("batch")
    listed = listed.agg(F.array_sort(F.collect_list(F.struct("place", F.coalesce(F.col("score").cast("double"), F.lit(float("-inf"))).alias("s")))).alias("l"))

    def pack(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in found:
            floor = [np.array([x["s"] for x in row], np.float64).tobytes() for row in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(floor, pa.binary())], ["batch", "floor"])

    return listed.select("batch", "l").mapInArrow(pack, "batch long, floor binary")


def _without(work: DataFrame) -> DataFrame:
    """Work whose queries have not met the block yet."""

    def drop(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in found:
            rest = []
            for places, done in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                left = np.setdiff1d(np.frombuffer(places, np.int32), np.frombuffer(done or b"", np.int32))
                rest.append(left.tobytes())
            out = pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(rest, pa.binary())], ["batch", "block", "places"])
            yield out.filter(pa.array([bool(r) for r in rest], pa.bool_()))

    return work.select("batch", "block", "places", "done").mapInArrow(drop, "batch long, block long, places binary")
