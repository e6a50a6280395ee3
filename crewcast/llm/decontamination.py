"""Benchmark decontamination: suffix arrays of shards of the training documents, searched for every test suffix."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from crewcast.llm.common import fresh, running_sums
from crewcast.session import materialise

#: Consecutive words that make a window; an item of fewer words is one window.
WINDOW = 10

#: Words of the test items that are searched for at a time; more items are searched for in blocks.
BLOCK_WORDS = 4_000_000

#: Words of a shard that may belong to a match, and characters of its texts, about.
SHARD_WORDS, SHARD_CHARS = 1_000_000, 32_000_000

_TABLE = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Runs of letters, digits and characters beyond ASCII, A-Z in lower case."""
    return text.translate(_TABLE).split()


@dataclass
class Tests:
    """The suffixes of a block of test items, as word ids: items one after the other, a 0 after each.

    ``names`` are the ids of the items. ``starts`` lists the places in ``text`` where a
    suffix starts, ``item`` and ``at`` whose suffix it is and from which word on.
    ``windows`` are the suffixes at which a window starts (each text of a window once),
    ``sizes`` their numbers of words and ``holders`` the items that have the window.
    """

    names: list
    words: dict[bytes, int]
    text: np.ndarray
    starts: np.ndarray
    item: np.ndarray
    at: np.ndarray
    windows: np.ndarray
    sizes: np.ndarray
    holders: list[np.ndarray]
    pairs: np.ndarray
    least: int


def tests_of(items: list[tuple], window: int = WINDOW) -> Tests:
    """Prepare (id, text) rows; rows of one id are one item with several texts."""
    words: dict[bytes, int] = {}
    names: dict = {}
    parts, starts, item, at, keys, length = [], [], [], [], {}, 0
    for name, text in items:
        found = words_of(text.encode() if isinstance(text, str) else text or b"")
        if not found:
            continue
        number = names.setdefault(name, len(names))
        ids = [words.setdefault(w, len(words) + 1) for w in found]
        size = min(window, len(ids))
        for i in range(len(ids) - size + 1):
            keys.setdefault(tuple(ids[i : i + size]), (length + i, size, set()))[2].add(number)
        parts += [*ids, 0]
        starts.append(length + np.arange(len(ids)))
        item.append(np.full(len(ids), number))
        at.append(np.arange(len(ids)))
        length += len(ids) + 1
    text = np.array(parts, np.int32)
    whole = lambda x: np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64)
    pairs = np.unique((text[:-1].astype(np.int64) << 32 | text[1:])[(text[:-1] > 0) & (text[1:] > 0)]) if len(text) else whole([])
    return Tests(
        list(names), words, text, whole(starts), whole(item), whole(at),
        np.array([k[0] for k in keys.values()], np.int64), np.array([k[1] for k in keys.values()], np.int64),
        [np.array(sorted(k[2]), np.int64) for k in keys.values()], pairs, min((k[1] for k in keys.values()), default=1),
    )


def suffix_array(text: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """``starts`` in the order of the suffixes of ``text`` (word ids, 0 ends a suffix), told apart up to ``depth`` words.

    Prefix doubling: ranks by one word give ranks by two, then four, until all differ or
    ``depth`` words are covered. Equal suffixes stand in the order of their places.
    """
    rank = np.append(text.astype(np.int64), 0)
    size, n = 1, len(text)
    while size < depth:
        ahead = rank[np.minimum(np.arange(n) + size, n)]
        key = np.where(rank[:n] > 0, rank[:n] * (int(rank.max()) + 1) + ahead, 0)
        values, dense = np.unique(key, return_inverse=True)
        rank[:n] = dense + (1 if len(values) and values[0] > 0 else 0)  # 0 stays what ends a suffix
        size *= 2
        if len(values) == np.count_nonzero(rank[:n]) + 1:
            break
    return starts[np.argsort(rank[starts], kind="stable")]


@dataclass
class Shard:
    """Words of some documents that may belong to a match, 0 between runs, with each word's document and place there."""

    text: np.ndarray
    doc: np.ndarray
    place: np.ndarray
    order: np.ndarray

    @staticmethod
    def of(found: list[np.ndarray], tests: Tests) -> Shard:
        """Words without a test word next to them as in a test cannot be part of a match of two words or more and end a run."""
        if not found:
            none = np.zeros(0, np.int64)
            return Shard(none, none, none, none)
        sizes = np.array([len(x) for x in found])
        text = np.concatenate([y for x in found for y in (x, np.zeros(1, np.int32))])
        doc = np.repeat(np.arange(len(found)), sizes + 1)
        place = np.arange(len(text)) - np.repeat(np.concatenate([[0], np.cumsum(sizes + 1)[:-1]]), sizes + 1)
        if tests.least > 1 and len(text):
            both = np.flatnonzero((text[:-1] > 0) & (text[1:] > 0))
            key = text[both].astype(np.int64) << 32 | text[both + 1]
            at = np.minimum(np.searchsorted(tests.pairs, key), max(len(tests.pairs) - 1, 0))
            both = both[tests.pairs[at] == key] if len(tests.pairs) else both[:0]
            joined = np.zeros(len(text), bool)
            joined[both] = True  # the word and the next one follow each other in a test
            inside = joined.copy()
            inside[1:] |= joined[:-1]
            # a run ends behind its last word; one 0 tells it from the next run
            ends = inside & ~joined
            cut = np.repeat(np.arange(len(text)), np.where(inside, np.where(ends, 2, 1), 0))
            stop = np.zeros(len(cut), bool)
            stop[1:] = cut[1:] == cut[:-1]
            text, doc, place = np.where(stop, 0, text[cut]), doc[cut], place[cut]
        starts = np.flatnonzero(text > 0)
        return Shard(text, doc, place, suffix_array(text, starts, int(np.diff(np.flatnonzero(np.concatenate([[0], tests.text]) == 0)).max(initial=1))))

    def extend(self, low: np.ndarray, high: np.ndarray, depth: int, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Within [low, high) of the suffix array, whose suffixes agree on ``depth`` words, those with ``word`` next."""

        def search(a: np.ndarray, b: np.ndarray, after: bool) -> np.ndarray:
            a, b = a.copy(), b.copy()
            open_ = np.flatnonzero(a < b)
            while len(open_):
                middle = (a[open_] + b[open_]) // 2
                at = self.order[middle] + depth
                have = np.where(at < len(self.text), self.text[np.minimum(at, len(self.text) - 1)], 0)
                below = have <= word[open_] if after else have < word[open_]
                a[open_] = np.where(below, middle + 1, a[open_])
                b[open_] = np.where(below, b[open_], middle)
                open_ = open_[a[open_] < b[open_]]
            return a

        left = search(low, high, False)
        return left, search(left, high, True)

    def windows(self, tests: Tests) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        """(windows, places in ``order``, size): all occurrences of the windows, by their size."""
        for size in np.unique(tests.sizes):
            number = np.flatnonzero(tests.sizes == size)
            low, high = np.zeros(len(number), np.int64), np.full(len(number), len(self.order), np.int64)
            for depth in range(size):
                low, high = self.extend(low, high, depth, tests.text[tests.windows[number] + depth])
                kept = low < high
                number, low, high = number[kept], low[kept], high[kept]
            counts = high - low
            ends = np.cumsum(counts)
            places = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts) + np.repeat(low, counts)
            yield np.repeat(number, counts), places, int(size)

    def longest(self, tests: Tests) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each test suffix the words of its longest match, and the range of the suffix array that has it."""
        length, lows, highs = (np.zeros(len(tests.starts), np.int64) for _ in range(3))
        number = np.arange(len(tests.starts))
        low, high = np.zeros(len(number), np.int64), np.full(len(number), len(self.order), np.int64)
        depth = 0
        while len(number):
            word = tests.text[tests.starts[number] + depth]
            number, low, high, word = (x[word > 0] for x in (number, low, high, word))
            low, high = self.extend(low, high, depth, word)
            kept = low < high
            number, low, high = number[kept], low[kept], high[kept]
            depth += 1
            length[number], lows[number], highs[number] = depth, low, high
        return length, lows, highs

    def first(self, lows: np.ndarray, highs: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Of each range of the suffix array the suffix whose document has the smallest rank, then the smallest place.

        Minima over ranges of 1, 2, 4, ... are made one after the other; two of them cover any range.
        """
        key = rank[self.doc[self.order]] << 40 | self.place[self.order]
        at = np.arange(len(key))
        out, span = np.zeros(len(lows), np.int64), 1
        while True:
            mine = np.flatnonzero((highs - lows >= span) & (highs - lows < 2 * span))
            a, b = at[lows[mine]], at[highs[mine] - span]
            out[mine] = self.order[np.where(key[a] <= key[b], a, b)]
            if not (highs - lows >= 2 * span).any():
                return out
            at = np.where(key[at[:-span]] <= key[at[span:]], at[:-span], at[span:])
            span *= 2


def _shards(texts: Iterator[tuple], tests: Tests) -> Iterator[tuple[list, np.ndarray, Shard]]:
    """(ids, word counts, shard) of (id, text) rows, about ``SHARD_WORDS`` and ``SHARD_CHARS`` at a time; a document is never split."""
    known = tests.words
    ids, found, words, chars = [], [], 0, 0
    for number, text in texts:
        split = words_of(text or b"")
        found.append(np.fromiter(map(known.get, split, repeat(0)), np.int32, len(split)))
        ids.append(number)
        words += len(split) + 1
        chars += len(text or b"")
        if words >= SHARD_WORDS or chars >= SHARD_CHARS:
            yield ids, np.array(list(map(len, found))), Shard.of(found, tests)
            ids, found, words, chars = [], [], 0, 0
    if ids:
        yield ids, np.array(list(map(len, found))), Shard.of(found, tests)


def _hit_spans(shard: Shard, counts: np.ndarray, tests: Tests) -> pa.StructArray:
    """Word count, hit spans and item numbers of each document of a shard."""
    n, base = len(counts), np.cumsum(counts + 1) - counts - 1  # a gap behind each document
    change, owners = np.zeros(int((counts + 1).sum()) + 1, np.int64), [np.zeros(0, np.int64)]
    for window, places, size in shard.windows(tests):
        first = shard.order[places]
        doc = shard.doc[first]
        start = base[doc] + shard.place[first]
        change += np.bincount(start, minlength=len(change)) - np.bincount(start + size, minlength=len(change))
        met = np.unique(doc << 32 | window)
        held = [tests.holders[w] for w in met & 0xFFFFFFFF]
        owners.append(np.repeat(met >> 32, [len(h) for h in held]) << 32 | np.concatenate([*held, owners[0]]))
    hit = np.concatenate([[0], np.cumsum(change) > 0, [0]]).astype(np.int8)
    starts, ends = np.flatnonzero(np.diff(hit) == 1), np.flatnonzero(np.diff(hit) == -1)
    doc = np.searchsorted(base, starts, "right") - 1
    owned = np.unique(np.concatenate(owners))
    names = np.array(tests.names, object)[owned & 0xFFFFFFFF]
    spans = pa.StructArray.from_arrays([pa.array(starts - base[doc], pa.int64()), pa.array(ends - base[doc], pa.int64())], ["start", "end"])
    upto = np.arange(n + 1)
    return pa.StructArray.from_arrays(
        [
            pa.array(counts, pa.int64()),
            pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, upto), pa.int32()), spans),
            pa.ListArray.from_arrays(pa.array(np.searchsorted(owned >> 32, upto), pa.int32()), pa.array(names, pa.string())),
        ],
        ["n_words", "spans", "items"],
    )


_FOUND = "n_words long, spans array<struct<start:long,end:long>>, items array<string>"


def _searcher(docs: DataFrame, tests: Tests):
    """A column function: text -> struct(n_words, spans, items) for one block of test items."""
    sent = docs.sparkSession.sparkContext.broadcast(tests)

    @F.arrow_udf(_FOUND)
    def search(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        texts = ((None, t) for b in batches for t in b.cast(pa.binary()).to_pylist())
        for _, counts, shard in _shards(texts, sent.value):
            yield _hit_spans(shard, counts, sent.value)

    return search


def _united(spans: str):
    """Spans of several blocks, those that touch or overlap as one."""

    @F.arrow_udf("array<struct<start:long,end:long>>")
    def unite(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for b in batches:
            out = []
            for row in b.to_pylist():
                merged: list[dict] = []
                for s in sorted(row or [], key=lambda s: s["start"]):
                    if merged and s["start"] <= merged[-1]["end"]:
                        merged[-1]["end"] = max(merged[-1]["end"], s["end"])
                    else:
                        merged.append(dict(s))
                out.append(merged)
            yield pa.array(out, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))

    return unite(spans)


def _blocks(items: DataFrame, id_col: str, text_col: str, window: int) -> list[Tests]:
    """The items in blocks of about ``BLOCK_WORDS`` words; an item's rows stay together."""
    rows = items.select(F.col(id_col).cast("string").alias("name"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    sizes = rows.groupBy("name").agg(F.sum(F.length("text") + 1).alias("chars"))  # a word has one character at least
    if (sizes.agg(F.sum("chars").alias("n")).first()["n"] or 0) <= BLOCK_WORDS:
        return [tests_of([(r["name"], r["text"]) for r in rows.collect()], window)]
    placed = running_sums(sizes, [F.col("name")], {"before": F.col("chars")})
    placed = placed.select(F.col("name").alias("_name"), F.expr(f"before div {BLOCK_WORDS}").alias("block"))
    rows = materialise(rows.join(placed, F.col("name").eqNullSafe(F.col("_name"))).select("block", "name", "text"), "test-blocks")
    numbers = sorted(r["block"] for r in rows.select("block").distinct().collect())
    return [tests_of([(r["name"], r["text"]) for r in rows.where(F.col("block") == b).collect()], window) for b in numbers]


def contamination(
    docs: DataFrame,
    items: DataFrame,
    *,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """Add ``n_words``, ``spans`` and ``items`` to each document: its words, which of them are hit, and by which items.

    Words are runs of letters, digits and characters beyond ASCII, A-Z in lower case. A
    window is ``window`` consecutive words of an item, or all words of an item of fewer.
    Words of a document inside an occurrence of a window are hit; ``spans`` lists them as
    (start, end) word numbers, ``items`` the ids (as text, in byte order) of the items with an
    occurring window.

    Each task cuts its documents into shards, builds the suffix array of a shard's words
    (those next to each other as in some item) and narrows it down word by word, in binary
    searches, for all test suffixes at which a window starts. The test items go to all
    tasks, ``BLOCK_WORDS`` characters at a time; for more items the documents are searched
    again for each block and the spans merged by document.

    Defined cases: a null or empty text has no words and no hits; an item without words
    has no windows; rows that share an item id are one item; windows of items without id
    hit words, but the item is not listed; repeated documents keep a row each; names of
    other columns are kept, an underscore is appended to an added one that clashes; an
    empty table gives an empty result, without items nothing is hit.
    """
    blocks = _blocks(items, item_col, item_text_col, window)
    names = dict(zip(("n_words", "spans", "items"), fresh(docs, "n_words", "spans", "items")))
    own = [F.col(f"`{c}`") for c in docs.columns]
    if len(blocks) == 1:
        [found] = fresh(docs, "_found")
        each = docs.withColumn(found, _searcher(docs, blocks[0])(F.col(text_col).cast("string")))
        parts = {c: F.col(f"{found}.{c}") for c in names}
    else:
        each, parts = _in_blocks(docs, text_col, blocks), {c: F.col(f"found.{c}") for c in names}
        own = [F.col(f"row.`{c}`") for c in docs.columns]
    parts["items"] = F.array_sort(F.array_compact(parts["items"]))
    return each.select(*own, *[parts[c].alias(n) for c, n in names.items()])


def _in_blocks(docs: DataFrame, text_col: str, blocks: list[Tests]) -> DataFrame:
    """(row, found): the rows searched for one block after the other, what was found merged by row."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    numbered = docs.select(F.monotonically_increasing_id().alias("id"), row.alias("row"), F.col(text_col).cast("string").alias("text"))
    numbered = materialise(numbered, "numbered-documents")
    each = reduce(DataFrame.unionByName, [numbered.select("id", _searcher(docs, b)("text").alias("f")) for b in blocks])
    lists = [F.flatten(F.collect_list(f"f.{c}")).alias(c) for c in ("spans", "items")]  # a list for each block
    merged = each.groupBy("id").agg(F.max("f.n_words").alias("n_words"), *lists)
    found = F.struct("n_words", _united("spans").alias("spans"), F.array_distinct("items").alias("items"))
    return numbered.select("id", "row").join(merged.select("id", found.alias("found")), "id")


def longest_matches(
    docs: DataFrame,
    items: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    least: int = 2,
) -> DataFrame:
    """(item, at, length, id, place): for every suffix of every item its longest verbatim match in the documents.

    ``item`` is the item's id as text, ``at`` the suffix's first word, ``length`` the words
    matched, ``id`` and ``place`` the document and its word where a longest match starts (of
    several the one of the smallest id, then place). Suffixes matched by fewer than
    ``least`` (two at the least) words have no row. Cases as in ``contamination``; of items
    with several texts the longest match of each word number is kept.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType

    def searched(tests: Tests) -> DataFrame:
        tests.least = max(2, least)
        sent = docs.sparkSession.sparkContext.broadcast(tests)

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tests = sent.value
            texts = (r for b in batches for r in zip(b.column(0), b.column(1).cast(pa.binary()).to_pylist()))
            for ids, _, shard in _shards(texts, tests):
                length, lows, highs = shard.longest(tests)
                kept = np.flatnonzero(length >= tests.least)
                values = [i.as_py() for i in ids]
                order = sorted(range(len(values)), key=lambda i: (values[i] is not None, values[i]))
                rank = np.argsort(np.array(order, np.int64))
                at = shard.first(lows[kept], highs[kept], rank)
                columns = [
                    pa.array([tests.names[i] for i in tests.item[kept]], pa.string()), pa.array(tests.at[kept], pa.int64()), pa.array(length[kept], pa.int64()),
                    pa.array([values[i] for i in shard.doc[at]], to_arrow_type(kind)), pa.array(shard.place[at], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["item", "at", "length", "id", "place"])

        return rows.mapInArrow(search, f"item string, at long, length long, id {kind.simpleString()}, place long")

    found = reduce(DataFrame.unionByName, [searched(b) for b in _blocks(items, item_col, item_text_col, WINDOW)])
    best = F.min(F.struct((-F.col("length")).alias("length"), "id", "place")).alias("b")
    return found.groupBy("item", "at").agg(best).select("item", "at", (-F.col("b.length")).alias("length"), "b.id", "b.place")


def decontaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents that no window of an item hits, columns as they are."""
    found = contamination(docs, items, **options)
    return found.where(F.size(F.col(found.columns[-2])) == 0).select(*[F.col(f"`{c}`") for c in docs.columns])
