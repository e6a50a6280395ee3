"""Phrase collocations: a depth-truncated suffix tree of the corpus, built in vertical partitions."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from crewcast.llm.common import running_sums
from crewcast.session import materialise

#: Words of the longest phrase: the depth at which the tree is cut.
DEPTH = 5

#: Suffixes of a group of word prefixes, about: what one task builds a subtree of.
GROUP_SUFFIXES = 1_000_000

#: A vocabulary of at most so many words and bytes goes to every task; a larger one is joined.
VOCABULARY_WORDS, VOCABULARY_BYTES = 500_000, 16_000_000

#: Distinct words, and characters read, after which a task hands its counts on.
COUNT_WORDS, COUNT_CHARS = 400_000, 32_000_000

#: Words of an encoded run and suffixes that a task sorts at a time, about.
RUN_WORDS, SORT_SUFFIXES = 500_000, 1_000_000

_UPPER, _ENDS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b".,;:!?\n\x0b\x0c\r"
_STOP = b"\xff"  # no byte of UTF-8
_TABLE = bytes.maketrans(_UPPER + _ENDS, _UPPER.lower() + _STOP * len(_ENDS))


def words_of(text: bytes) -> list[bytes]:
    """Words in lower case (A-Z only); ``_STOP`` stands where a piece ends."""
    return text.translate(_TABLE).replace(_STOP, b" \xff ").split()


def _rows(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    columns = [batch.column(n) for n in names]
    return zip(*[(c.cast(pa.binary()) if pa.types.is_string(c.type) else c).to_pylist() for c in columns])


def _texts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    text, lang = F.col(text_col).cast("string"), F.col(lang_col).cast("string")
    return docs.select(F.coalesce(lang, F.lit("und")).alias("lang"), text.alias("text")).where("text IS NOT NULL")


def word_counts(texts: DataFrame, least: int) -> DataFrame:
    """(lang, word, f): words with ``least`` occurrences or more, and under a null word all occurrences of the language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, Counter] = {}
        read = 0

        def flush() -> pa.RecordBatch:
            langs, words, counts = [], [], []
            for lang, found in held.items():
                stops = found.pop(_STOP, 0)
                total = found.pop(None, 0) - stops
                langs += [lang] * (len(found) + 1)
                words += [*found, None]
                counts += [*found.values(), total]
            held.clear()
            columns = [pa.array(langs, pa.binary()).cast(pa.string()), pa.array(words, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["lang", "word", "n"])

        for b in batches:
            for lang, text in _rows(b, "lang", "text"):
                words = words_of(text)
                found = held.setdefault(lang, Counter())
                found.update(words)
                found[None] += len(words)
                read += len(text)
                if read > COUNT_CHARS or sum(map(len, held.values())) > COUNT_WORDS:
                    yield flush()
                    read = 0
        yield flush()

    counted = texts.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("f"))
    return materialise(counted.where(F.col("word").isNull() | (F.col("f") >= least)), "phrase-words")


def vocabulary_of(words: DataFrame, budget: int) -> DataFrame:
    """(id, lang, word, f, part): words numbered from 1, those up to the budget packed into parts of about ``budget`` occurrences.

    A word with more occurrences than the budget is in no part (null): its prefix is extended.
    """
    cold = F.when(F.col("f") <= budget, F.col("f")).otherwise(0)
    numbered = running_sums(words.select("lang", "word", "f"), [F.col("lang"), F.col("word")], {"id": F.lit(1).cast("long"), "before": cold.cast("long")})
    part = F.when(F.col("f") <= budget, F.expr(f"before div {budget}"))
    return materialise(numbered.select((F.col("id") + 1).alias("id"), "lang", "word", "f", part.alias("part")), "phrase-vocabulary")


def _packed(runs: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Runs one after the other, a 0 between them, about ``RUN_WORDS`` to a row."""
    held, size = [], 0

    def row() -> pa.RecordBatch:
        data = np.concatenate([x for r in held for x in (r, np.zeros(1, np.int32))])
        return pa.RecordBatch.from_arrays([pa.array([data.tobytes()], pa.binary())], ["run"])

    for run in runs:
        held.append(run)
        size += len(run) + 1
        if size >= RUN_WORDS:
            yield row()
            held, size = [], 0
    if held:
        yield row()


def _linked(ids: np.ndarray) -> np.ndarray:
    """Ids without those that have no neighbour to form a phrase with, and one 0 for each gap."""
    known = ids > 0
    beside = np.zeros(len(ids) + 2, bool)
    beside[1:-1] = known
    useful = known & (beside[:-2] | beside[2:])
    ids = np.where(useful, ids, 0)
    return ids[(ids > 0) | (np.concatenate([[0], ids[:-1]]) > 0)]


def encoded(texts: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(run): the corpus as word ids (int32), 0 for piece ends and words outside of the vocabulary.

    A vocabulary within the limits goes to every task; beyond them the words of the texts
    are joined with it and put back in order.
    """
    size = vocabulary.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("word")), F.lit(0)).alias("b")).first()
    if size["n"] > VOCABULARY_WORDS or size["b"] > VOCABULARY_BYTES:
        return materialise(_joined(texts, vocabulary), "phrase-runs")
    table: dict[bytes, dict[bytes, int]] = {}
    listed = vocabulary.select("lang", "word", "id").toArrow()  # within the limits
    for lang, word, number in _rows(listed, "lang", "word", "id"):
        table.setdefault(lang, {})[word] = number
    sent = texts.sparkSession.sparkContext.broadcast(table)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value

        def runs() -> Iterator[np.ndarray]:
            for b in batches:
                for lang, text in _rows(b, "lang", "text"):
                    if lang in known:
                        words = words_of(text)
                        yield _linked(np.fromiter(map(known[lang].get, words, repeat(0)), np.int32, len(words)))

        return _packed(runs())

    return materialise(texts.mapInArrow(encode, "run binary"), "phrase-runs")


def _joined(texts: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """The same runs by a join of every word occurrence; a document's words come back in order, one after the other."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc, lang, text in _rows(b, "doc", "lang", "text"):
                words = words_of(text)
                for start in range(0, len(words), RUN_WORDS):
                    part = words[start : start + RUN_WORDS]
                    kept = [(w, start + i) for i, w in enumerate(part) if w != _STOP]
                    n = len(kept)
                    columns = [
                        pa.array([doc] * n, pa.int64()), pa.array([i for _, i in kept], pa.int64()),
                        pa.array([lang] * n, pa.binary()).cast(pa.string()), pa.array([w for w, _ in kept], pa.binary()).cast(pa.string()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["doc", "at", "lang", "word"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def runs() -> Iterator[np.ndarray]:
            last, left = None, np.zeros(0, np.int32)
            for b in batches:
                if not b.num_rows:
                    continue
                doc, at, ids = (b.column(i).to_numpy() for i in range(3))
                gap = np.flatnonzero((np.diff(doc) != 0) | (np.diff(at) != 1)) + 1
                pieces = np.split(ids.astype(np.int32), gap)
                if last == (doc[0], at[0] - 1):
                    pieces[0] = np.concatenate([left, pieces[0]])
                elif len(left) > 1:
                    yield left
                yield from (p for p in pieces[:-1] if len(p) > 1)
                last, left = (doc[-1], at[-1]), pieces[-1]
            if len(left) > 1:
                yield left

        return _packed(runs())

    numbered = texts.select(F.monotonically_increasing_id().alias("doc"), "lang", "text")
    tokens = numbered.mapInArrow(split, "doc long, at long, lang string, word string")
    known = tokens.join(vocabulary.select("lang", "word", "id"), ["lang", "word"]).select("doc", "at", "id")
    return known.repartition("doc").sortWithinPartitions("doc", "at").mapInArrow(pack, "run binary")


def suffixes(run: np.ndarray) -> np.ndarray:
    """The first ``DEPTH`` words of every suffix of a run, 0 after its end; suffixes of one word are left out."""
    padded = np.concatenate([run, np.zeros(DEPTH, np.int32)])
    starts = np.flatnonzero((run > 0) & (padded[1 : len(run) + 1] > 0))
    out = np.empty((len(starts), DEPTH), np.int32)
    out[:, 0], out[:, 1] = run[starts], padded[starts + 1]
    for d in range(2, DEPTH):
        out[:, d] = np.where(out[:, d - 1] > 0, padded[starts + d], 0)
    return out


@dataclass
class Partition:
    """Which group of prefixes a suffix belongs to.

    ``first`` holds the first word id of each packed part. ``levels`` has, for each
    length, the prefixes above the budget: sorted keys (place of the prefix without its
    last word, last word), the number of their first group and how many groups the words
    that follow are dealt to. All lists are at most as long as occurrences / budget.
    """

    first: np.ndarray
    levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]

    def hot(self, rows: np.ndarray, upto: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows whose first ``upto`` words are above the budget, and the place of that prefix in its level."""
        index, place = np.arange(len(rows)), np.zeros(len(rows), np.int64)
        for d in range(upto):
            keys = self.levels[d][0]
            key = (place << 32) | rows[index, d]
            at = np.minimum(np.searchsorted(keys, key), max(len(keys) - 1, 0))
            same = keys[at] == key if len(keys) else np.zeros(len(index), bool)
            index, place = index[same], at[same]
        return index, place

    def groups(self, rows: np.ndarray) -> np.ndarray:
        """Number of each suffix's group times 8, plus the length of the prefix that all of the group's suffixes go beyond; -1 for none."""
        part = np.searchsorted(self.first, rows[:, 0], "right") - 1
        out = (part.astype(np.int64) << 3) + 1
        for d in range(1, len(self.levels) + 1):
            index, place = self.hot(rows, d)
            _, starts, shares = self.levels[d - 1]
            after = rows[index, d].astype(np.int64)
            dealt = starts[place] + (after * 2654435761 % 4294967296 >> 7) % shares[place]
            out[index] = np.where(after > 0, (dealt << 3) + d, -1)
        return out


def vertical_partition(runs: DataFrame, vocabulary: DataFrame, budget: int) -> tuple[Partition, DataFrame | None]:
    """Prefixes extended word by word while they have more than ``budget`` suffixes; and those of two words or more with their counts."""
    parts = vocabulary.where("part IS NOT NULL").groupBy("part").agg(F.min("id").alias("id"))
    first = np.sort(np.array([r["id"] for r in parts.select("id").collect()], np.int64))
    number, levels, found = len(first), [], None
    hot = vocabulary.where(F.col("part").isNull()).select(F.col("id").alias("key"), "f").collect()
    partition = Partition(first, levels)
    while hot:
        keys = np.array([r["key"] for r in hot], np.int64)
        order = np.argsort(keys)
        shares = -(-np.array([r["f"] for r in hot], np.int64)[order] // budget)
        levels.append((keys[order], number + np.cumsum(shares) - shares, shares))
        number += int(shares.sum())
        depth = len(levels)
        if depth == DEPTH - 1:
            break

        def count(batches: Iterator[pa.RecordBatch], depth: int = depth) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for run in b.column(0).to_pylist():
                    rows = suffixes(np.frombuffer(run, np.int32))
                    index, place = partition.hot(rows, depth)
                    after = rows[index, depth].astype(np.int64)
                    index, key = index[after > 0], (place << 32 | after)[after > 0]
                    key, at, n = np.unique(key, return_index=True, return_counts=True)
                    words = rows[index[at], : depth + 1].tolist()
                    columns = [pa.array(key, pa.int64()), pa.array(n, pa.int64()), pa.array(words, pa.list_(pa.int32()))]
                    yield pa.RecordBatch.from_arrays(columns, ["key", "n", "words"])

        counted = runs.mapInArrow(count, "key long, n long, words array<int>").groupBy("key", "words").agg(F.sum("n").alias("f"))
        counted = materialise(counted.where(F.col("f") > budget), "phrase-prefixes")
        hot = counted.select("key", "f").collect()  # at most occurrences / budget
        nodes = counted.select("words", "f")
        found = nodes if found is None else found.unionByName(nodes)
    return partition, found


def _sorted(rows: np.ndarray, counts: np.ndarray | None, groups: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """Distinct rows in order (of their group, then of their words) with their summed counts."""
    wide = rows.astype(np.int64)
    keys = [wide[:, 4], (wide[:, 2] << 32) | wide[:, 3], (wide[:, 0] << 32) | wide[:, 1]]
    order = np.lexsort(keys if groups is None else [*keys, groups])
    rows = rows[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]).any(1)
    at = np.flatnonzero(new)
    if counts is None:
        summed = np.diff(np.append(at, len(rows)))
    else:
        summed = np.add.reduceat(counts[order], at) if len(at) else np.zeros(0, np.int64)
    return rows[at], summed, None if groups is None else groups[order][at]


def _pack(rows: np.ndarray) -> bytes:
    """Leaves column by column and byte by byte, compressed: sorted ids share their upper bytes."""
    planes = np.ascontiguousarray(rows.T).view(np.uint8).reshape(DEPTH + 1, len(rows), 4).transpose(0, 2, 1)
    return len(rows).to_bytes(4, "little") + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def _unpack(packed: bytes) -> np.ndarray:
    n = int.from_bytes(packed[:4], "little")
    size = (DEPTH + 1) * n * 4
    planes = np.frombuffer(pa.decompress(packed[4:], size, "zstd", asbytes=True), np.uint8).reshape(DEPTH + 1, 4, n)
    return np.ascontiguousarray(planes.transpose(0, 2, 1)).view(np.int32)[:, :, 0]


def leaves(runs: DataFrame, partition: Partition) -> DataFrame:
    """(grp, leaves): distinct truncated suffixes with their counts, by group; equal ones of a task are counted there."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            rows = np.concatenate(held)
            groups = partition.groups(rows)
            rows, counts, groups = _sorted(rows[groups >= 0], None, groups[groups >= 0])
            cuts = np.flatnonzero(np.diff(groups)) + 1 if len(groups) else np.zeros(0, np.int64)
            parts = [_pack(p) for p in np.split(np.column_stack([rows, counts.astype(np.int32)]), cuts)] if len(groups) else []
            firsts = groups[np.concatenate([[0], cuts])] if len(groups) else groups
            return pa.RecordBatch.from_arrays([pa.array(firsts, pa.int64()), pa.array(parts, pa.binary())], ["grp", "leaves"])

        for b in batches:
            for run in b.column(0).to_pylist():
                held.append(suffixes(np.frombuffer(run, np.int32)))
                size += len(held[-1])
                if size >= SORT_SUFFIXES:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return runs.mapInArrow(deal, "grp long, leaves binary")


def subtree(group: int, packed: list[bytes], least: int) -> pa.Table:
    """Nodes of one group's subtree with ``least`` occurrences or more, below the prefix its suffixes go beyond.

    Sorted leaves are the tree: a node is a run of leaves with the same first words, and
    its count the sum of theirs.
    """
    both = np.concatenate([_unpack(x) for x in packed], 1)
    rows, totals, _ = _sorted(np.ascontiguousarray(both[:DEPTH].T), both[DEPTH].astype(np.int64), None)
    words, counts = [], []
    differ = np.zeros(len(rows), bool)
    if len(rows):
        differ[0] = True
    for d in range(DEPTH):
        differ[1:] |= rows[1:, d] != rows[:-1, d]
        if d < (group & 7) or not len(rows):
            continue
        at = np.flatnonzero(differ)
        total = np.add.reduceat(totals, at)
        kept = (rows[at, d] > 0) & (total >= least)
        words += rows[at[kept], : d + 1].tolist()
        counts += total[kept].tolist()
    return pa.table({"words": pa.array(words, pa.list_(pa.int32())), "f": pa.array(counts, pa.int64())})


def phrase_counts(runs: DataFrame, vocabulary: DataFrame, least: int, budget: int) -> DataFrame:
    """(words, f): every phrase of two to ``DEPTH`` word ids with ``least`` occurrences or more."""
    partition, hot = vertical_partition(runs, vocabulary, budget)

    def build(key, table):
        return subtree(key[0].as_py(), table.column("leaves").to_pylist(), least)

    found = leaves(runs, partition).groupBy("grp").applyInArrow(build, "words array<int>, f long")
    if hot is not None:
        found = found.unionByName(hot.where(F.col("f") >= least))
    return materialise(found, "phrase-counts")


def collocations(
    docs: DataFrame,
    *,
    text_col: str = "text",
    lang_col: str = "lang",
    least: int = 100,
    budget: int = GROUP_SUFFIXES,
) -> DataFrame:
    """(lang, phrase, a, l, r, n, score): phrases of two to five words with ``least`` occurrences or more.

    A text is cut into pieces at ``. , ; : ! ?`` and line ends, a piece into words at
    spaces and tabs, A-Z in lower case. ``a`` counts the contiguous occurrences of a phrase
    in pieces, overlaps included, ``n`` all words of its language. Cutting the phrase in
    two gives ``l`` and ``r``, the occurrences of the first part and of the rest, and the
    score floor(1000 a n / (l r)), exact up to 38 digits; of all cuts the one with the
    lowest score counts, then the one with the shorter first part. A phrase that a longer
    one contains as often is left out.

    The counts come from a suffix tree of word ids cut at five words. Word prefixes are
    packed into groups of about ``budget`` suffixes, prefixes with more are extended by
    one word; each task builds the subtree of a group from the group's distinct suffixes,
    which were counted before the shuffle.

    Defined cases: a null text has no words; a null language is ``und``; repeated rows
    count each; an empty table, or one without frequent phrases, gives an empty result.
    """
    texts = _texts(docs, text_col, lang_col)
    counted = word_counts(texts, least)
    vocabulary = vocabulary_of(counted.where("word IS NOT NULL"), budget)
    nodes = phrase_counts(encoded(texts, vocabulary), vocabulary, least, budget)
    kept = _closed(nodes)
    cuts = _best_cuts(_named(kept, vocabulary), nodes, vocabulary, counted.where("word IS NULL").select("lang", F.col("f").alias("n")))
    return cuts.select("lang", "phrase", "a", "l", "r", "n", "score")


def _closed(nodes: DataFrame) -> DataFrame:
    """Phrases without those that a longer one contains as often; one more word is enough to look at."""
    inner = F.expr("array(slice(words, 1, size(words) - 1), slice(words, 2, size(words) - 1))")
    longer = nodes.where(F.size("words") > 2).select(F.explode(inner).alias("words"), F.col("f").alias("most"))
    longer = longer.groupBy("words").agg(F.max("most").alias("most"))
    return nodes.join(longer, "words", "left").where("most IS NULL OR most < f").select("words", F.col("f").alias("a"))


def _named(phrases: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Phrases with their language and text."""
    each = phrases.select("words", "a", F.posexplode("words").alias("at", "id"))
    each = each.join(vocabulary.select(F.col("id").cast("int").alias("id"), "lang", "word"), "id")
    grouped = each.groupBy("words", "a", "lang").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("w"))  # five at most
    return grouped.select("words", "a", "lang", F.array_join(F.transform("w", lambda x: x["word"]), " ").alias("phrase"))


def _best_cuts(phrases: DataFrame, nodes: DataFrame, vocabulary: DataFrame, totals: DataFrame) -> DataFrame:
    parts = nodes.unionByName(vocabulary.select(F.array(F.col("id").cast("int")).alias("words"), "f"))
    cuts = phrases.join(totals, "lang").withColumn("k", F.explode(F.expr("sequence(1, size(words) - 1)")))
    cuts = cuts.withColumns({"head": F.expr("slice(words, 1, k)"), "tail": F.expr("slice(words, k + 1, size(words))")})
    cuts = cuts.join(parts.toDF("head", "l"), "head").join(parts.toDF("tail", "r"), "tail")
    score = F.expr("(cast(1000 as decimal(4, 0)) * (cast(a as decimal(19, 0)) * cast(n as decimal(19, 0)))) div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0)))")
    best = cuts.withColumn("cut", F.struct(score.alias("score"), "k", "l", "r")).groupBy("lang", "phrase", "a", "n").agg(F.min("cut").alias("cut"))
    return best.select("lang", "phrase", "a", "n", "cut.score", "cut.l", "cut.r")


def ranked(found: DataFrame, most: int = 2000, spread: int = 64) -> DataFrame:
    """The first ``most`` phrases of each language with their rank, by score, then ``a``, then phrase in byte order.

    Ranked in ``spread`` portions of a language first, so that no task sees a whole language.
    """
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = found.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(spread)))
    first = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*order))).where(F.col("rank") <= most)
    last = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= most)
    return last.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
