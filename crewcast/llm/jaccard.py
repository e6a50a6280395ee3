"""N-gram Jaccard join: prefix filters under several global orders, then verification."""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crewcast.llm.common import fresh, lean
from crewcast.operators.components import label_nodes
from crewcast.session import discard_intermediates, materialise, shuffles_dropped, written_so_far

#: Words of a shingle, and the similarity as a quotient of whole numbers.
SIZE = 5
LEAST = (80, 100)

#: Shingles on the list of frequent ones at most; the list (5 bytes each) goes to every task.
MOST_FREQUENT = 2_000_000

#: Share of the places in the first order whose shingles are counted exactly: more than prefixes reach into, as a rule.
EARLY = 0.3

#: Bits of a place in the order, and of the slice of places that is counted at once.
PLACE_BITS = 40
SLICE_BITS = 12

#: Holders of a shingle whose pairs are listed; more are compared block by block.
CROWD = 16
BLOCK_NODES = 128

#: Shingles of a block's nodes together, about; a block of longer texts has fewer nodes.
BLOCK_SHINGLES = 200_000

#: Rows of two ids that may go to every task.
BROADCAST_ROWS = 500_000

#: Pairs of blocks are compared in portions that move so many times the blocks, or so many MB.
PORTION_TIMES = 2
PORTION_MB = 256

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_FACTOR), -1, 1 << 64))
_ORDERS = (np.uint64(0), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F))

_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


#: A random number for each byte, equal for A-Z and a-z; nothing for white space.
_BYTES = np.where(_WHITE, np.uint64(0), _mixed(np.arange(1, 257, dtype=np.uint64) * _FACTOR))
_BYTES[65:91] = _BYTES[97:123]


class Hasher:
    """Hashes all words of a text at once, by running sums of its bytes times powers of a factor."""

    def __init__(self):
        self.grow(1 << 15)

    def grow(self, size: int) -> None:
        self.powers = np.full(size, _FACTOR)
        self.inverse = np.full(size, _INVERSE)
        self.powers[0] = self.inverse[0] = 1
        np.multiply.accumulate(self.powers, out=self.powers)
        np.multiply.accumulate(self.inverse, out=self.inverse)

    def words(self, text: str) -> np.ndarray:
        """A 64-bit hash of each word, A-Z in lower case."""
        raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        if len(raw) > len(self.powers):
            self.grow(2 * len(raw))
        edges = np.concatenate([[True], _WHITE[raw], [True]])
        turns = np.flatnonzero(edges[1:] != edges[:-1])
        starts, ends = turns[::2], turns[1::2]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[raw] * self.powers[: len(raw)])])
        return _mixed((sums[ends] - sums[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))


def shingles(text: str, hasher: Hasher, size: int = SIZE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``size`` words; of the whole sequence if it is shorter."""
    h = hasher.words(text)
    if not len(h):
        return h
    run = min(size, len(h))
    total = np.full(len(h) - run + 1, np.uint64(run))
    for i in range(run):
        total = total * _FACTOR + h[i : len(h) - run + 1 + i]
    return np.unique(_mixed(total))


def _places(hashes: np.ndarray, order: int = 0) -> np.ndarray:
    return _mixed(hashes ^ _ORDERS[order]) >> np.uint64(64 - PLACE_BITS)


class Orders:
    """Global orders of shingles: frequent ones last, by their count, the others by a hash of their own.

    A frequent shingle is known by 32 bits of its place in the first order; a rare one with
    the same bits counts as frequent, in all sets alike.
    """

    SLOTS = np.uint64((1 << 23) - 1)

    SHORT = np.uint64(PLACE_BITS - 32)

    def __init__(self, frequent: np.ndarray, counts: np.ndarray):
        levels = np.clip(8 * np.log2(np.maximum(counts, 1)), 1, 255)  # eight to a doubling
        self._list((_places(frequent) >> self.SHORT).astype(np.uint32), levels.astype(np.uint8))

    @classmethod
    def of(cls, keys: np.ndarray, levels: np.ndarray) -> Orders:
        """Of the first 32 bits of places, and levels of counts."""
        out = cls.__new__(cls)
        out._list(keys, levels)
        return out

    def _list(self, keys: np.ndarray, levels: np.ndarray) -> None:
        by = np.lexsort((-levels.astype(np.int16), keys))
        self.keys, self.levels = keys[by], levels[by]
        self.slots = np.zeros(int(self.SLOTS) + 1, bool)  # most shingles are told apart by one look-up
        self.slots[self.keys & np.uint32(self.SLOTS)] = True

    def often(self, places: np.ndarray) -> np.ndarray:
        """Levels of counts; 0 for what is not frequent."""
        out = np.zeros(len(places), np.uint64)
        keys = (places >> self.SHORT).astype(np.uint32)
        maybe = np.flatnonzero(self.slots[keys & np.uint32(self.SLOTS)])
        if len(maybe):
            at = np.minimum(np.searchsorted(self.keys, keys[maybe]), len(self.keys) - 1)
            out[maybe] = np.where(self.keys[at] == keys[maybe], self.levels[at], 0)
        return out

    def prefix(self, hashes: np.ndarray, order: int, least: tuple[int, int]) -> np.ndarray:
        """The first shingles, of which a set shares one with each set that is similar enough.

        The place in an order is a function of the shingle: its count, then 40 bits of a
        hash, then (in the rare tie) its value, since sets are sorted.
        """
        a, b = least
        n = len(hashes)
        if not n:
            return hashes
        length = n - (n * a + b - 1) // b + 1
        first = _places(hashes)
        place = (self.often(first) << np.uint64(PLACE_BITS)) | (_places(hashes, order) if order else first)
        return hashes[np.argsort(place, kind="stable")[:length]]


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    flat = np.concatenate(rows) if rows else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64), pa.int64()))


def frequent_shingles(docs: DataFrame, most: int | None = None, each: int = 1 << 22, least: int = 2) -> Orders:
    """Shingles that come up often, with their count.

    A task counts about ``each`` shingles at a time. It reports the shingles that stand early
    in the first order, from which prefixes are made, and of the others those it meets
    ``least`` times; 28 bits of each place travel, by slices of places, and are added up.
    Those with the largest sums make the list, at most ``most``, cut where a histogram of the
    sums (64 cells to a doubling) says; the others' sums count an eighth. It only decides the
    order in which shingles are taken, so a count that is too low costs time, never a link.
    """
    most = MOST_FREQUENT if most is None else most
    low = np.uint64(PLACE_BITS - SLICE_BITS)
    starts = np.arange(1 << SLICE_BITS, dtype=np.uint64) << low
    early = np.uint64(EARLY * (1 << PLACE_BITS))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, held, n = Hasher(), [], 0

        def report() -> Iterator[pa.RecordBatch]:
            places, counts = np.unique(_places(np.concatenate(held)), return_counts=True)
            keep = (places < early) | (counts >= least)
            places, counts = places[keep], np.minimum(counts[keep], (1 << 16) - 1).astype(np.uint16)
            rests, ends = (places & ((np.uint64(1) << low) - np.uint64(1))).astype(np.uint32), [*np.searchsorted(places, starts), len(places)]
            rows = [(k, i, j) for k, (i, j) in enumerate(zip(ends[:-1], ends[1:])) if i < j]
            columns = [pa.array([k for k, _, _ in rows], pa.int32())]
            columns += [pa.array([x[i:j].tobytes() for _, i, j in rows], pa.binary()) for x in (rests, counts)]
            yield pa.RecordBatch.from_arrays(columns, ["slice", "rests", "counts"])

        for b in batches:
            for text in b.column(0):
                held.append(shingles(text.as_py(), hasher))
                n += len(held[-1])
                if n >= each:
                    yield from report()
                    held, n = [], 0
        if n:
            yield from report()

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums of one slice after the other; what comes up ``least`` times at most is left out."""
        last, parts = None, []

        def report() -> Iterator[pa.RecordBatch]:
            rests, counts = (np.concatenate([np.frombuffer(p[k], t) for p in parts]) for k, t in ((0, np.uint32), (1, np.uint16)))
            by = np.argsort(rests)
            rests, heads = np.unique(rests[by], return_index=True)
            sums = np.add.reduceat(counts[by].astype(np.int64), heads)
            keep = sums > least
            places = rests[keep].astype(np.int64) + (last << int(low))
            yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(sums[keep])], ["place", "n"])

        for b in batches:
            for k, rests, counts in zip(b.column(0).to_pylist(), b.column(1), b.column(2)):
                if k != last and parts:
                    yield from report()
                    parts = []
                last = k
                parts.append((rests.as_py(), counts.as_py()))
        if parts:
            yield from report()

    mark = written_so_far()
    told = docs.select("text").mapInArrow(lean(count), "slice int, rests binary, counts binary")
    told = told.repartition("slice").sortWithinPartitions("slice")
    counted = told.mapInArrow(lean(add_up), "place long, n long")
    weight = F.when(F.col("place") < int(early), F.col("n")).otherwise(F.col("n") / 8)
    counted = materialise(counted.withColumn("cell", F.floor(F.log2(weight) * 64).cast("int")), "jaccard-counts")
    cut, kept = 1 << 20, 0
    for cell, n in sorted(counted.groupBy("cell").count().collect(), reverse=True):  # 64 rows for each doubling
        if kept + n > most:
            break
        cut, kept = cell, kept + n
    level = F.least(F.floor(F.log2("n") * 8), F.lit(255)) - 128
    key = F.shiftright("place", int(Orders.SHORT)) - (1 << 31)
    rows = counted.where(F.col("cell") >= cut).select(key.cast("int").alias("key"), level.cast("byte").alias("level")).toArrow()
    discard_intermediates(docs.sparkSession, mark)
    keys, levels = (rows[c].to_numpy().view(t) for c, t in (("key", np.uint32), ("level", np.uint8)))
    return Orders.of(keys ^ np.uint32(1 << 31), levels ^ np.uint8(128))


def _digest(hashes: np.ndarray) -> bytes:
    return blake2b(hashes.tobytes(), digest_size=16).digest()


def _described(docs: DataFrame, orders: Orders, least: tuple[int, int]) -> DataFrame:
    """(uid, id, n, digest of the set, prefix in the first order) of every row."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for b in batches:
            sets = [shingles(t.as_py() or "", hasher) for t in b.column(2)]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    b.column(1),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_digest(s) if len(s) else None for s in sets], pa.binary()),
                    _lists([orders.prefix(s, 0, least) for s in sets]),
                ],
                ["uid", "id", "n", "digest", "prefix"],
            )

    return docs.select("uid", "id", "text").mapInArrow(lean(describe), "uid long, id long, n long, digest binary, prefix array<long>")


def _ends(pairs: DataFrame) -> DataFrame:
    return materialise(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), "jaccard-ends")


def _few(df: DataFrame) -> bool:
    return df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS


def _sent(df: DataFrame) -> DataFrame:
    """``df`` (a written table) sent to every task if it is small, else joined as Spark sees fit."""
    return F.broadcast(df) if _few(df) else df


def _enough(most: Column, both: Column, least: tuple[int, int]) -> Column:
    """Whether two sets, ``both`` shingles together, may be similar enough if they share ``most``."""
    return least[1] * most >= least[0] * (both - most)


def _pairs(rows: DataFrame, least: tuple[int, int], times: int = 1) -> DataFrame:
    """Distinct (a, b), a < b, of rows with two nodes (x, y) that share a shingle and the sizes of their sets (xn, yn).

    Only ids travel. A pair has a row for each shingle that its prefixes share; as in
    ``_likely``, these and the larger rest have to be enough. ``times`` allows for rows
    that are not there.
    """
    pairs = rows.where("x != y").where(f"{least[1]} * least(xn, yn) >= {least[0]} * greatest(xn, yn)")
    sizes = [F.greatest("xn", "yn").alias("larger"), (F.col("xn") + F.col("yn")).alias("both")]
    pairs = pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), *sizes)
    pairs = pairs.groupBy("a", "b").agg(F.count("*").alias("shared"), F.max("larger").alias("larger"), F.max("both").alias("both"))
    rest = F.expr(f"(larger * {least[0]} + {least[1] - 1}) div {least[1]} - 1")
    return pairs.where(_enough(times * F.col("shared") + rest, F.col("both"), least)).select("a", "b")


def _star_pairs(shared: DataFrame, least: tuple[int, int]) -> DataFrame:
    """Each holder of a shingle with the first one: one pair a row at most, whatever the holders.

    A pair lacks rows where another holder comes first, so a quarter of the rows will do; a
    pair left out is met again among all pairs of holders.
    """
    rows = shared.select(F.col("lo.node").alias("x"), F.col("lo.n").alias("xn"), F.col("node").alias("y"), F.col("n").alias("yn"))
    return _pairs(rows, least, times=4)


def _open(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """(token, node, n, comp, holders): holders of the shingles that are held in several components, and their number."""
    known = labels.select(F.col("node").alias("_n"), F.col("label").alias("_l"))
    marked = shared.join(known, F.col("node") == F.col("_n"), "left")
    marked = marked.select("token", "node", "n", F.coalesce("_l", "node").alias("comp"))
    mixed = marked.groupBy("token").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.count("*").alias("holders"))
    return materialise(marked.join(mixed.where("x < y").select("token", "holders"), "token"), "jaccard-open")


def _cross_pairs(held: DataFrame, least: tuple[int, int]) -> DataFrame:
    """All pairs of holders of a shingle that are in different components.

    Two sets in different components share no shingle that is not open, and if they share
    a crowded one, which has no rows here, their blocks are compared.
    """
    left = held.select("token", F.col("node").alias("x"), F.col("n").alias("xn"), F.col("comp").alias("xc"))
    right = held.select("token", F.col("node").alias("y"), F.col("n").alias("yn"), F.col("comp").alias("yc"))
    return _pairs(left.join(right, "token").where("x < y and xc != yc"), least)


def _blocks(held: DataFrame, least: tuple[int, int]) -> tuple[DataFrame, DataFrame]:
    """(node, comp, block) of the holders of crowded shingles, and the pairs of blocks that share such a shingle.

    A node goes with its most crowded shingle and sets of about its size, and the nodes of
    both are dealt over blocks of about ``BLOCK_NODES``, or fewer if these have more than
    ``BLOCK_SHINGLES`` shingles, so that what is alike stands together and the pairs of
    blocks grow far slower than the pairs of nodes. Blocks whose sizes differ too much make
    no pair.
    """
    node = held.groupBy("node", "comp").agg(F.max(F.struct("holders", "token")).alias("top"), F.max("n").alias("n"))
    node = node.withColumn("band", F.floor(F.log("n") / math.log(least[1] / least[0])))
    parts = F.greatest(F.ceil(F.count("*") / BLOCK_NODES), F.ceil(F.sum("n") / BLOCK_SHINGLES))
    sizes = node.groupBy(F.col("top.token").alias("_t"), F.col("band").alias("_band")).agg(parts.alias("_parts"))
    dealt = F.pmod(F.xxhash64("node"), F.col("_parts"))
    placed = node.join(sizes, (F.col("top.token") == F.col("_t")) & (F.col("band") == F.col("_band")))
    placed = materialise(placed.select("node", "comp", "n", F.xxhash64("_t", "_band", dealt).alias("block")), "jaccard-blocks")
    found = held.select("token", F.col("node").alias("_n")).join(placed, F.col("_n") == F.col("node"))
    sets = found.groupBy("token").agg(F.array_sort(F.collect_set("block")).alias("blocks")).select("blocks").distinct()
    left = sets.select("blocks", F.posexplode("blocks").alias("i", "x"))
    pairs = left.select("x", F.explode(F.expr("slice(blocks, i + 1, size(blocks))")).alias("y")).distinct()
    for side in ("y", "x"):
        ends = placed.groupBy(F.col("block").alias(f"_{side}")).agg(F.min("n").alias(f"{side}_lo"), F.max("n").alias(f"{side}_hi"))
        pairs = pairs.join(ends, F.col(side) == F.col(f"_{side}"))
    near = [f"{least[1]} * {a}_hi >= {least[0]} * {b}_lo" for a, b in ("xy", "yx")]
    return placed.drop("n"), materialise(pairs.where(" and ".join(near)).select("x", "y"), "jaccard-block-pairs")


def _block_links(placed: DataFrame, pairs: DataFrame, texts: DataFrame, orders: Orders, least: tuple[int, int]) -> DataFrame:
    """Links between nodes of different components in pairs of blocks, as many as it takes to join the components.

    Inside a task the prefixes under all orders are matched first, then whole sets. Pairs of
    blocks are taken in portions, since each moves both its blocks: what is moved at a time
    stays in proportion to the blocks, whatever the number of pairs.
    """
    rows = texts.select(F.col("node").alias("_n"), "text").join(_sent(placed), F.col("node") == F.col("_n"))
    rows = rows.withColumn("bytes", F.octet_length("text"))
    packed = rows.groupBy("block").agg(F.collect_list(F.struct("node", "comp", "text")).alias("rows"), F.sum("bytes").alias("bytes"))
    packed = materialise(packed, "jaccard-packed")  # about BLOCK_NODES texts or BLOCK_SHINGLES shingles each
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, last, theirs = Hasher(), None, None

        def read(rows: list[dict]) -> tuple[list[dict], list[np.ndarray], list[list[np.ndarray]]]:
            sets = [shingles(r["text"], hasher) for r in rows]
            return rows, sets, [[orders.prefix(x, o, least) for x in sets] for o in range(len(_ORDERS))]

        for b in batches:
            for left, right, y in zip(b.column(0), b.column(1), b.column(2).to_pylist()):
                if y != last:  # rows come by the right block
                    last, theirs = y, read(right.as_py())
                sides, sets, heads = zip(read(left.as_py()), theirs)
                sizes = [np.array([len(x) for x in side]) for side in sets]
                comps = [np.array([r["comp"] for r in side]) for side in sides]
                maybe = comps[0][:, None] != comps[1][None]
                smaller, larger = (f(sizes[0][:, None], sizes[1][None]) for f in (np.minimum, np.maximum))
                maybe &= least[1] * smaller >= least[0] * larger
                for o in range(len(_ORDERS)):
                    if maybe.any():
                        maybe &= _common(*[side[o] for side in heads]) > 0
                if maybe.any():
                    common = _common(*sets)
                    maybe &= least[1] * common >= least[0] * (sizes[0][:, None] + sizes[1][None] - common)
                found, joined = [], {}
                for i, j in zip(*np.nonzero(maybe)):
                    one, two = (_head(joined, int(c)) for c in (comps[0][i], comps[1][j]))
                    if one != two:
                        joined[one] = two
                        found.append((sides[0][i]["node"], sides[1][j]["node"]))
                columns = [pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays(columns, ["a", "b"])

    weights = packed.select(F.col("block").alias("_b"), "bytes")
    moved = pairs.join(weights, F.col("x") == F.col("_b")).agg(F.sum("bytes")).first()[0] or 0
    whole = packed.agg(F.sum("bytes")).first()[0] or 0
    portions = max(1, math.ceil(moved / max(PORTION_TIMES * whole, PORTION_MB << 20)))
    packed, found = packed.drop("bytes"), None
    for k in range(portions):
        some = pairs.where(F.pmod(F.xxhash64("x", "y"), F.lit(portions)) == k)
        both = some.join(packed.withColumnsRenamed({"block": "x", "rows": "left"}), "x")
        both = both.join(packed.withColumnsRenamed({"block": "y", "rows": "right"}), "y")
        with _small_batches(both.sparkSession, 16):  # a row holds two blocks
            links = materialise(both.select("left", "right", "y").mapInArrow(lean(compare), "a long, b long"), "jaccard-links")
        found = links if found is None else found.unionByName(links)
    return found


@contextmanager
def _small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of at most so many rows for what is run inside."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _head(joined: dict[int, int], node: int) -> int:
    while node in joined:
        node = joined[node]
    return node


def _common(left: list[np.ndarray], right: list[np.ndarray], width: int = 1 << 14) -> np.ndarray:
    """Sizes of the intersections of two lists of sets, ``width`` shared members at a time."""
    flat = [np.concatenate(x) if x else np.zeros(0, np.uint64) for x in (left, right)]
    row = [np.repeat(np.arange(len(x)), [len(y) for y in x]) for x in (left, right)]
    shared = np.intersect1d(*flat)
    out = np.zeros((len(left), len(right)))
    for start in range(0, len(shared), width):
        part = shared[start : start + width]
        tables = []
        for values, rows, n in zip(flat, row, (len(left), len(right))):
            at = np.minimum(np.searchsorted(part, values), len(part) - 1)
            hit = part[at] == values
            table = np.zeros((n, len(part)), np.float32)
            table[rows[hit], at[hit]] = 1.0
            tables.append(table)
        out += tables[0] @ tables[1].T
    return out.astype(np.int64)


def _likely(pairs: DataFrame, ends: DataFrame, sets: DataFrame, least: tuple[int, int]) -> DataFrame:
    """Pairs that may be similar enough by the number of shingles that their prefixes share.

    The prefix whose last shingle comes first in the order holds all that the pair shares
    up to there, so the sets share no more than the prefixes do plus what is left of the
    larger rest. Prefixes travel as 32 bits a shingle; equal ones of a prefix are given
    back, so this can only keep more pairs.
    """
    short = F.transform("prefix", lambda h: F.shiftright(h, 32).cast("int"))
    known = sets.select(F.col("uid").alias("node"), "n", short.alias("p")).join(_sent(ends), "node", "left_semi")
    for side in ("b", "a"):
        named = known.select(F.col("node").alias("_node"), F.col("n").alias(f"{side}_n"), F.col("p").alias(f"{side}_p"))
        pairs = pairs.join(named, F.col(side) == F.col("_node")).drop("_node")
    equal = [F.size(p) - F.size(F.array_distinct(p)) for p in ("a_p", "b_p")]
    shared = F.size(F.array_intersect("a_p", "b_p")) + equal[0] + equal[1]
    most = shared + F.greatest(F.col("a_n") - F.size("a_p"), F.col("b_n") - F.size("b_p"))
    return materialise(pairs.where(_enough(most, F.col("a_n") + F.col("b_n"), least)).select("a", "b"), "jaccard-likely")


def _links(pairs: DataFrame, texts: DataFrame, orders: Orders, least: tuple[int, int]) -> DataFrame:
    """Pairs whose prefixes meet under every further order, and then whose whole sets are similar enough."""
    for side in ("b", "a"):
        named = texts.select(F.col("node").alias("_node"), F.col("text").alias(f"{side}_text"))
        pairs = pairs.join(named, F.col(side) == F.col("_node")).drop("_node")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, last, mine, heads = Hasher(), None, None, []

        def prefixes(found: np.ndarray) -> list[np.ndarray]:
            return [orders.prefix(found, o, least) for o in range(1, len(_ORDERS))]

        for b in batches:
            keep = []
            for node, left, right in zip(b.column(0).to_pylist(), b.column(3), b.column(2)):
                if node != last:
                    last, mine = node, shingles(left.as_py(), hasher)
                    heads = prefixes(mine)
                yours = shingles(right.as_py(), hasher)
                near = all(np.isin(x, y).any() for x, y in zip(heads, prefixes(yours)))
                common = len(np.intersect1d(mine, yours, assume_unique=True)) if near else 0
                keep.append(near and least[1] * common >= least[0] * (len(mine) + len(yours) - common))
            yield b.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("a", "b", "b_text", "a_text").mapInArrow(lean(verify), "a long, b long")


def _texts(docs: DataFrame, nodes: DataFrame, repeated: bool) -> DataFrame:
    """(node, text) of nodes, one document for each: that with the node's id whose set has its digest."""
    wanted = materialise(nodes.select("node", "digest", F.col("id").alias("_id")), "jaccard-wanted")
    found = docs.join(_sent(wanted), F.col("id") == F.col("_id")).select("node", "digest", "text")
    if repeated:  # rows that repeat an id may have other texts or blank ones
        found = found.mapInArrow(lean(_right_texts), "node long, digest binary, text string").dropDuplicates(["node"])
    return materialise(found.select("node", "text"), "jaccard-texts")


def _right_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = Hasher()
    for b in batches:
        digests = zip(b.column(2), b.column(1).to_pylist())
        yield b.filter(pa.array([_digest(shingles(t.as_py(), hasher)) == d for t, d in digests], pa.bool_()))


def similar_groups(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least: tuple[int, int] = LEAST
) -> DataFrame:
    """(id, n_shingles, component_id) of every row: groups of documents linked by similar shingle sets.

    Equal sets become one node first. A pair of nodes is a candidate if their prefixes
    share a shingle under each of three global orders. Candidates of the first order come
    from its postings, in three rounds: first each holder of a shingle with the first
    holder; then, where holders are still in different components, all pairs of up to
    ``CROWD`` holders, and for more holders all pairs within pairs of blocks, whose rows
    stay inside the tasks. A pair left out lies within a component already, so the
    components are those of all links. Pairs whose prefixes share too few shingles go, the
    other two orders are intersected, and then whole sets are compared.

    Hashes of shingles have 64 bits and digests of sets 128; equal ones count as equal.

    Defined cases: null and empty texts have no shingles and are in groups of their own;
    a text under five words has one shingle; a null id has its own count and a null
    component; rows that repeat an id are rows of one document each, all returned; ids are
    cast to long; other columns are not read; an empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    sets, classes = _classes(rows.withColumn("uid", F.monotonically_increasing_id()), least)
    out = sets.join(classes, "digest", "left")
    group = F.when(F.col("id").isNotNull(), F.coalesce("group_id", "id"))
    return out.select("id", F.col("n").alias("n_shingles"), group.alias("component_id"))


def _classes(rows: DataFrame, least: tuple[int, int]) -> tuple[DataFrame, DataFrame]:
    """(uid, id, n, digest) of every row, and (digest, group_id, group_uid) of every distinct set with an id.

    The last two are those of the row that stands first in the set's group: the smallest
    id and, of its rows in the group, the smallest uid.
    """
    with shuffles_dropped(rows.sparkSession):
        return _found_classes(rows, least)


def _found_classes(rows: DataFrame, least: tuple[int, int]) -> tuple[DataFrame, DataFrame]:
    filled = rows.where("id IS NOT NULL AND text IS NOT NULL")
    orders = frequent_shingles(filled)
    sets = materialise(_described(rows, orders, least), "jaccard-sets")
    full = sets.where("id IS NOT NULL AND digest IS NOT NULL")
    nodes = full.groupBy("digest").agg(F.min(F.struct("uid", "id")).alias("first"), F.min(F.struct("id", "uid")).alias("head"))
    mark = written_so_far()
    nodes = materialise(nodes.select("digest", F.col("first.uid").alias("node"), F.col("first.id").alias("id"), "head"), "jaccard-nodes")
    copies = full.select("digest", "uid").join(nodes.select("digest", "node"), "digest").where("uid != node").select("uid")
    copies = materialise(copies, "jaccard-copies")
    firsts = full.select("uid", "n", "prefix").join(_sent(copies), "uid", "left_anti")
    if not _few(copies):  # else it is read where it is needed
        firsts = materialise(firsts, "jaccard-firsts")
    postings = firsts.select(F.explode("prefix").alias("token"), F.col("uid").alias("node"), "n").repartition("token")
    ends = postings.groupBy("token").agg(F.min(F.struct("node", "n")).alias("lo"), F.max("node").alias("hi"))
    ends = ends.where("lo.node != hi").drop("hi")
    shared = materialise(postings.join(ends.hint("shuffle_hash"), "token"), "jaccard-shared")

    repeated = not sets.where("id IS NOT NULL").groupBy("id").count().where("count > 1").isEmpty()
    links, tried, texts = None, None, None

    def tell(pairs: DataFrame) -> DataFrame:
        """Compare the pairs that were not yet, and label the components of all links so far."""
        nonlocal links, tried, texts
        pairs = pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti")
        pairs = materialise(pairs, "jaccard-pairs")
        tried = pairs if tried is None else tried.unionByName(pairs)
        pairs = _likely(pairs, _ends(pairs), firsts, least)
        ends = _ends(pairs)
        if texts is None:
            texts = here = _texts(filled, nodes.join(ends, "node", "left_semi"), repeated)
        else:
            more = ends.join(texts.select("node"), "node", "left_anti")
            texts = texts.unionByName(_texts(filled, nodes.join(more, "node", "left_semi"), repeated))
            here = texts.join(_sent(ends), "node", "left_semi")
        found = materialise(_links(pairs, here, orders, least), "jaccard-links")
        links = found if links is None else links.unionByName(found)
        return materialise(label_nodes(links), "jaccard-labels")

    labels = tell(_star_pairs(shared, least))
    held = _open(shared, labels)
    labels = tell(_cross_pairs(held.where(F.col("holders") <= CROWD), least))
    crowded = _open(shared, labels).where(F.col("holders") > CROWD)
    if not crowded.isEmpty():
        placed, pairs = _blocks(crowded, least)
        more = nodes.join(placed.join(texts.select("node"), "node", "left_anti"), "node", "left_semi")
        texts = texts.unionByName(_texts(filled, more, repeated))
        found = _block_links(placed, pairs, texts, orders, least)
        labels = materialise(label_nodes(links.unionByName(found)), "jaccard-labels")

    known = nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    smallest = known.join(labels.select(F.col("node").alias("_n")), F.col("node") == F.col("_n"), "left_semi")
    smallest = smallest.groupBy("label").agg(F.min("head").alias("group"))
    classes = known.join(smallest, "label", "left").withColumn("head", F.coalesce("group", "head"))
    classes = classes.select("digest", F.col("head.id").alias("group_id"), F.col("head.uid").alias("group_uid"))
    classes = materialise(classes, "jaccard-classes")
    discard_intermediates(rows.sparkSession, mark, keep_last=True)
    return sets.drop("prefix"), classes


def one_of_each(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group: one with the group's smallest id; all columns stay.

    Rows are told apart by a number of their own, not by their id: of rows that repeat an
    id and are alike one stays, and each of those in different groups counts for its own
    group. Rows with a null id and rows without words stay.
    """
    uid, other = fresh(docs, "_uid", "_other")
    stored = materialise(docs.withColumn(uid, F.monotonically_increasing_id()), "jaccard-documents")
    rows = stored.select(F.col(uid).alias("uid"), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    sets, classes = _classes(rows, LEAST)
    kept = classes.select(F.col("group_uid").alias("uid")).distinct()
    extra = sets.where("id IS NOT NULL AND digest IS NOT NULL").join(kept, "uid", "left_anti")
    extra = _sent(materialise(extra.select(F.col("uid").alias(other)), "jaccard-extra"))
    return stored.join(extra, F.col(uid) == F.col(other), "left_anti").drop(uid)
