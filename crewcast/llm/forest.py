"""Approximate nearest neighbours by a forest of random-projection trees."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from crewcast.llm.common import running_sums, smallest_by_hash
from crewcast.session import materialise

#: Rows of a leaf that a task holds at a time.
CHUNK_ROWS = 2048

#: The part of a query's rows that is compared first; the rest must reach what it finds.
OPENING = 8


@dataclass(frozen=True)
class Forest:
    """Trees as arrays: of each node the plane, the children (or the leaf number, as -1 - leaf)."""

    planes: np.ndarray  # nodes x dimensions
    cuts: np.ndarray
    children: np.ndarray  # nodes x 2
    roots: tuple[int, ...]
    n_leaves: int
    reach: float  # square of the largest norm

    def lifted(self, v: np.ndarray) -> np.ndarray:
        """Vectors with one more number that makes all norms equal, so that the largest product is the nearest."""
        rest = np.sqrt(np.maximum(self.reach - (v * v).sum(1), 0.0))
        return np.column_stack([v, rest])

    def leaves(self, v: np.ndarray) -> np.ndarray:
        """The leaf of each row in each tree: rows x trees."""
        x = self.lifted(v)
        out = np.empty((len(x), len(self.roots)), np.int64)
        for t, root in enumerate(self.roots):
            at = np.full(len(x), root)
            while (live := at >= 0).any():
                node = at[live]
                side = (np.einsum("ij,ij->i", x[live], self.planes[node]) >= self.cuts[node]).astype(int)
                at[live] = self.children[node, side]
            out[:, t] = -1 - at
        return out

    def probes(self, v: np.ndarray, sizes: np.ndarray, enough: int) -> list[list[int]]:
        """Leaves of each query, by one queue over all trees: the leaf that is least far over a plane comes first.

        Ends when the leaves hold ``enough`` rows.
        """
        queries = np.column_stack([v / np.linalg.norm(v, axis=1, keepdims=True) * np.sqrt(self.reach), np.zeros(len(v))])
        margins = queries @ self.planes.T - self.cuts if len(self.planes) else np.zeros((len(v), 0))
        out = []
        for row in margins:
            queue = [(-np.inf, r) for r in self.roots]
            heapq.heapify(queue)
            found, n = [], 0
            while queue and n < enough:
                worst, node = heapq.heappop(queue)
                if node < 0:
                    found.append(-1 - node)
                    n += sizes[-1 - node]
                    continue
                m = row[node]
                heapq.heappush(queue, (max(worst, -m), int(self.children[node, 1])))
                heapq.heappush(queue, (max(worst, m), int(self.children[node, 0])))
            out.append(found)
        return out


def grow(sample: np.ndarray, reach: float, trees: int, leaf: int, seed: int) -> Forest:
    """Split the sample at the median of its projections until ``leaf`` rows or fewer are left."""
    rng = np.random.default_rng(seed)
    start = Forest(np.zeros((0, 0)), np.zeros(0), np.zeros((0, 2), int), (), 0, reach)
    x = start.lifted(sample)
    planes: list[np.ndarray] = []
    cuts: list[float] = []
    children: list[list[int]] = []
    n_leaves = 0

    def split(rows: np.ndarray) -> int:
        nonlocal n_leaves
        if len(rows) > leaf:
            for _ in range(5):
                a, b = x[rng.choice(rows, 2, replace=False)]
                plane = a - b
                size = np.linalg.norm(plane)
                if size < 1e-12:
                    plane, size = rng.normal(size=x.shape[1]), 1.0
                plane = plane / size
                values = x[rows] @ plane
                cut = float(np.median(values))
                right = values >= cut
                if 0 < right.sum() < len(rows):
                    node = len(planes)
                    planes.append(plane), cuts.append(cut), children.append([0, 0])
                    children[node] = [split(rows[~right]), split(rows[right])]
                    return node
        n_leaves += 1
        return -n_leaves

    roots = tuple(split(np.arange(len(x))) for _ in range(trees))
    width = x.shape[1]
    return Forest(np.array(planes).reshape(-1, width), np.array(cuts), np.array(children, int).reshape(-1, 2), roots, n_leaves, reach)


def _classes(rows: DataFrame, k: int) -> DataFrame:
    """(id, first, ids, v): each distinct vector once, with the ``k`` + 1 smallest ids that have it, as often as rows do.

    Equal vectors have equal products, and ties go to smaller ids, so no other row of
    them can be among the k nearest of a query. ``id`` numbers the vectors in the order of
    their ``first`` ids.
    """
    order = Window.partitionBy("v").orderBy("id")
    first = rows.withColumn("r", F.dense_rank().over(order)).where(F.col("r") <= k + 1)
    counted = first.groupBy("v", "id").agg(F.least(F.count("*"), F.lit(k)).cast("int").alias("n"))
    grouped = counted.groupBy("v").agg(F.array_sort(F.collect_list(F.struct("id", "n"))).alias("ids"))
    ids = F.flatten(F.transform("ids", lambda x: F.array_repeat(x["id"], x["n"])))
    named = grouped.select(F.get("ids.id", F.lit(0)).alias("first"), ids.alias("ids"), "v", F.lit(0).alias("id"))
    numbered = running_sums(named, [F.col("first")], {"id": F.lit(1).cast("long")}, [F.col("v")])
    return materialise(numbered.select("id", "first", "ids", "v"), "forest-classes")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _packed(v: np.ndarray) -> list[bytes]:
    return [r.tobytes() for r in np.ascontiguousarray(v)]


def nearest(
    rows: DataFrame,
    queries: DataFrame,
    k: int,
    *,
    trees: int = 4,
    leaf_rows: int = 256,
    sample_rows: int = 20_000,
    search_share: float = 1.2,
    search_least: int = 4_000,
    seed: int = 5,
) -> DataFrame:
    """(query_id, rank, id, score): about the ``k`` rows of the largest inner product with each query.

    ``rows`` and ``queries`` have ``id`` (long) and ``v`` (array of double, one length, no
    null, not all zero). A row is no candidate of the query with its own id; rows that
    repeat an id are candidates each, queries that do must be given once; equal scores go
    to the smaller id; with fewer candidates all are returned.

    The trees are grown on distinct vectors with the smallest hashes, at most ``sample_rows``
    (a documented bound); every distinct vector is put into a leaf of each tree. A query
    takes leaves from one queue over all trees until they hold ``search_least`` rows, or
    ``search_share`` of the number of distinct vectors if that is more (a row counts once
    for each tree). All rows of these
    leaves are compared, the nearest leaves first; of the others only rows that reach the
    ``k`` + 1st of these go on. The best are scored again on the given vectors in double
    precision, one product after the other.

    A leaf is held in chunks of ``CHUNK_ROWS`` and its queries stream past, so neither a
    large leaf nor many queries fill a task. Without rows or queries the result is empty.
    """
    classes = _classes(rows, k)
    norm2 = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    row = classes.agg(F.max(norm2).alias("reach"), F.count("*").alias("n")).first()
    if not row["n"]:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, id long, score double")
    sample = smallest_by_hash(classes, F.col("first"), sample_rows).orderBy("id").select("v").toArrow()
    forest = grow(_matrix(sample.column(0).combine_chunks()), row["reach"], trees, leaf_rows, seed)
    n_trees = len(forest.roots)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = _matrix(b.column(1))
            leaves = forest.leaves(v).ravel()
            at = np.repeat(np.arange(len(v)), n_trees)
            packed = pa.array(_packed(v), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(leaves), b.column(0).take(pa.array(at)), packed.take(pa.array(at))], ["leaf", "id", "v"])

    index = materialise(classes.select("id", "v").mapInArrow(route, "leaf long, id long, v binary"), "forest-index")
    counted = index.groupBy("leaf").agg(F.count("*").alias("n")).toArrow()  # one row a leaf: bounded by the sample
    sizes = np.zeros(forest.n_leaves, np.int64)
    sizes[counted["leaf"].to_numpy()] = counted["n"].to_numpy()
    enough = max(search_least, int(search_share * row["n"]))
    chunks = np.maximum(1, -(-sizes // CHUNK_ROWS))

    def probe(opening: bool):
        """Queries beside the leaves to look at: the nearest ones, or all others."""

        def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                v = _matrix(b.column(1))
                packed = pa.array(_packed(v), pa.binary())
                for i in range(0, len(v), 256):
                    found = forest.probes(v[i : i + 256], sizes, enough)
                    cuts = [int(np.searchsorted(np.cumsum(sizes[f]), enough / OPENING)) + 1 for f in found]
                    found = [f[:c] if opening else f[c:] for f, c in zip(found, cuts)]
                    leaves = np.array([x for f in found for x in f], np.int64)
                    at = np.repeat(np.arange(len(found)) + i, [len(f) for f in found])
                    times = chunks[leaves]
                    chunk = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                    at = pa.array(np.repeat(at, times))
                    kind = pa.array(np.ones(len(at), np.int32))
                    columns = [pa.array(np.repeat(leaves, times)), pa.array(chunk), kind, *(b.column(0).take(at), packed.take(at), b.column(2).take(at))]
                    yield pa.RecordBatch.from_arrays(columns, ["leaf", "chunk", "kind", "id", "v", "floor"])

        return look

    large = [(int(i), int(c)) for i, c in enumerate(chunks) if c > 1]
    if large:
        table = rows.sparkSession.createDataFrame(large, "leaf long, c long")
        index = index.join(F.broadcast(table), "leaf", "left")
    else:
        index = index.withColumn("c", F.lit(1))
    index = index.withColumn("c", F.coalesce("c", F.lit(1)))
    held = index.select(
        "leaf", F.pmod(F.xxhash64("id"), F.col("c")).alias("chunk"), F.lit(0).alias("kind"), "id", "v", F.lit(None).cast("double").alias("floor")
    )

    def compared(asked: DataFrame, opening: bool) -> DataFrame:
        probes = asked.select("id", "v", "floor").mapInArrow(probe(opening), "leaf long, chunk long, kind int, id long, v binary, floor double")
        both = held.unionByName(probes).repartition("leaf", "chunk").sortWithinPartitions("leaf", "chunk", "kind")
        return both.mapInArrow(_compare(k + 1), "query_id long, id long, rough double")

    def best(found: DataFrame) -> DataFrame:
        order = Window.partitionBy("query_id").orderBy(F.desc("rough"), "id")
        found = found.groupBy("query_id", "id").agg(F.max("rough").alias("rough"))
        return found.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 8)

    opened = materialise(best(compared(queries.withColumn("floor", F.lit(float("-inf"))), True)), "forest-opened")
    floors = opened.where(F.col("r") == k + 1).select("query_id", F.col("rough").alias("floor"))
    rest = queries.join(floors, F.col("id") == F.col("query_id"), "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
    found = best(compared(rest, False).unionByName(opened.select("query_id", "id", "rough")))

    asked = queries.select(F.col("id").alias("query_id"), F.col("v").alias("q"))
    exact = found.join(classes, "id").join(asked, "query_id")
    score = F.aggregate(F.zip_with("q", "v", lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    members = exact.select("query_id", F.explode("ids").alias("id"), score.alias("score")).where("id != query_id")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = members.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "id", "score")


def _compare(most: int):
    """Of each leaf chunk (its rows first, then its queries) the best rows of each query.

    What a task has found for a query is cut back to its best before it goes on.
    """

    def cut_back(found: list[tuple]) -> list[tuple]:
        q, i, s = (np.concatenate(x) for x in zip(*found))
        by = np.lexsort((i, q))
        again = (q[by][1:] == q[by][:-1]) & (i[by][1:] == i[by][:-1])  # a row of another tree
        by = by[np.concatenate([[True], ~again])]
        by = by[np.lexsort((i[by], -s[by], q[by]))]
        q, i, s = q[by], i[by], s[by]
        starts = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]]))
        place = np.arange(len(q)) - np.repeat(starts, np.diff([*starts, len(q)]))
        keep = place < most + 8
        return [(q[keep], i[keep], s[keep])]

    def batch(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)], ["query_id", "id", "rough"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, vectors, matrix = None, [], [], None
        out: list[tuple] = []
        held = least = 0
        for b in batches:
            keys = np.column_stack([b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2).to_numpy()])
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            all_ids = b.column(3).to_numpy()
            for s, e in zip([0, *cuts], [*cuts, len(keys)]):
                here = (keys[s, 0], keys[s, 1])
                if here != key:
                    key, ids, vectors, matrix = here, [], [], None
                part = np.frombuffer(b"".join(b.column(4)[s:e].to_pylist()), np.float64).reshape(e - s, -1)
                if keys[s, 2] == 0:
                    ids.append(all_ids[s:e])
                    vectors.append(part)
                    continue
                if matrix is None:
                    if not ids:
                        continue
                    row_ids, matrix = np.concatenate(ids), np.concatenate(vectors)
                    reach = np.sqrt((matrix * matrix).sum(1).max())
                scores = part @ matrix.T
                n = min(most, matrix.shape[0])
                top = np.argpartition(scores, matrix.shape[0] - n, axis=1)[:, -n:]
                rough = np.take_along_axis(scores, top, 1)
                slack = 1e-12 * reach * np.sqrt((part * part).sum(1))  # rounding of the products
                keep = rough >= (b.column(5)[s:e].to_numpy() - slack)[:, None]
                out.append((np.repeat(all_ids[s:e], n)[keep.ravel()], row_ids[top][keep], rough[keep]))
                held += out[-1][0].size
                if held > 2 * least + 1_000_000:
                    out = cut_back(out)
                    held = least = out[0][0].size
                if held > 4_000_000:  # that many queries: pass on what there is
                    yield batch(out)
                    out, held, least = [], 0, 0
        if out:
            yield batch(cut_back(out))

    return compare
