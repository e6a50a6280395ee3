"""Language-model scores: the likelihood of a text over all segmentations into known pieces."""

from __future__ import annotations

import math
import os
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crewcast.llm.pieces import MARK, processor
from crewcast.session import materialise

#: A word is frequent if it is at least one of this many training tokens; there are no
#: more frequent words than that, whatever the corpus.
FREQUENT = 100_000

#: Distinct words that a task counts before it passes them on.
HELD_WORDS = 400_000

LOG10 = math.log(10)


def tokens(text: bytes | None) -> list[bytes]:
    """Lower-cased (A-Z) words between ASCII white space."""
    return text.lower().split() if text else []


def _word(raw: bytes) -> str:
    return MARK + raw.decode("utf-8", "replace")


@dataclass(frozen=True)
class Pieces:
    """Natural logs of the chances of the pieces of a vocabulary, of bytes, and of the end."""

    chances: dict[str, float]
    byte_chances: tuple[float, ...]
    end: float

    @property
    def longest(self) -> int:
        return max(map(len, self.chances), default=1)


class Lattice:
    """Natural log of the summed chances of all segmentations of a word.

    The forward recursion, in logs: what leads up to a place in a word depends on the
    characters before it alone, so the part that a word shares with the one before is kept.
    A character may also be spelt by its byte pieces, so that no word is impossible.
    """

    def __init__(self, pieces: Pieces):
        self.known, self.bytes, self.longest = pieces.chances, pieces.byte_chances, pieces.longest
        self.spelt: dict[str, float] = {}
        self.last, self.forward = "", [0.0]

    def spell(self, char: str) -> float:
        if len(self.spelt) > 100_000:
            self.spelt.clear()
        cost = self.spelt[char] = sum(self.bytes[b] for b in char.encode("utf-8", "replace"))
        return cost

    def log_chance(self, word: str) -> float:
        known, longest, spelt, exp = self.known.get, self.longest, self.spelt, math.exp
        kept = len(os.path.commonprefix((self.last, word)))
        forward = self.forward[: kept + 1]
        for end in range(kept + 1, len(word) + 1):
            char = word[end - 1]
            cost = spelt.get(char)
            best = forward[end - 1] + (self.spell(char) if cost is None else cost)
            total = 1.0  # of the chances so far, over exp(best)
            for start in range(end - longest if end > longest else 0, end):
                chance = known(word[start:end])
                if chance is not None:
                    value = forward[start] + chance
                    if value > best:
                        total = total * exp(best - value) + 1.0
                        best = value
                    else:
                        total += exp(value - best)
            forward.append(best + math.log(total) if total != 1.0 else best)
        self.last, self.forward = word, forward
        return forward[-1]


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c, n): each word with its count in training rows (``learns``) and in all rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learnt, rest = Counter(), Counter()

        def batch() -> pa.RecordBatch:
            words = list(dict.fromkeys([*learnt, *rest]))
            c = [learnt[w] for w in words]
            columns = [pa.array(words, pa.binary()), pa.array(c, pa.int64()), pa.array([a + rest[w] for a, w in zip(c, words)], pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["word", "c", "n"])

        for b in batches:
            for learns, text in zip(b.column(0).to_pylist(), b.column(1)):
                (learnt if learns else rest).update(tokens(text.as_py()))
                if len(learnt) + len(rest) > HELD_WORDS:
                    yield batch()
                    learnt.clear()
                    rest.clear()
        yield batch()

    counted = docs.select("learns", "text").mapInArrow(count, "word binary, c long, n long")
    return counted.groupBy("word").agg(F.sum("c").alias("c"), F.sum("n").alias("n"))


def estimate(counts: DataFrame, ends: int, model: bytes, add: float = 0.5) -> Pieces:
    """Chances of the vocabulary's pieces, bytes and the end in the training rows.

    The vocabulary is the model file's. Its own scores are ranks of merges, not chances,
    so a piece's score is the log of its smoothed share of the pieces into which the model
    segments the training words, each distinct word once, weighed by its count.
    """

    def segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp, found = processor(model), np.zeros(processor(model).vocab_size(), np.int64)
        for b in batches:
            words = [w.decode("utf-8", "replace") for w in b.column(0).to_pylist()]
            for ids, c in zip(sp.encode(words, num_threads=1), b.column(1).to_pylist()):
                for i in ids:
                    found[i] += c
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(found[at])], ["piece", "c"])

    pieces = counts.where("c > 0").select("word", "c").mapInArrow(segment, "piece long, c long")
    rows = pieces.groupBy("piece").agg(F.sum("c").alias("c")).collect()  # the vocabulary at most
    sp = processor(model)
    found = np.zeros(sp.vocab_size())
    for r in rows:
        found[r["piece"]] = r["c"]
    usable = [i for i in range(len(found)) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    total = found[usable].sum() + ends + add * (len(usable) + 1)
    logs = np.log((found + add) / total)
    byte = {int(sp.id_to_piece(i)[3:5], 16): logs[i] for i in usable if sp.is_byte(i)}
    floor = math.log(add / total)
    chances = {sp.id_to_piece(i): float(logs[i]) for i in usable if not sp.is_byte(i)}
    return Pieces(chances, tuple(float(byte.get(b, floor)) for b in range(256)), math.log((ends + add) / total))


def _scored_words(counts: DataFrame, pieces: Pieces) -> DataFrame:
    """Each distinct word with the log10 chance that the lattice gives it."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(pieces)
        for b in batches:
            values = [lattice.log_chance(_word(w)) / LOG10 for w in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(values, pa.float64())], ["word", "c", "n", "lattice"])

    return counts.select("word", "c", "n").sortWithinPartitions("word").mapInArrow(score, "word binary, c long, n long, lattice double")


def score_texts(
    docs: DataFrame,
    learns: Column,
    model: bytes,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    frequent: int = FREQUENT,
) -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score) of every row of ``docs``.

    Tokens are the lower-cased words and one end. ``base_score`` is their smoothed unigram
    log10 chance under the rows where ``learns`` is true. ``score`` is the log10 chance of
    the text under the lattice: pieces never cross words, so it is the sum over the words
    of the log of all their segmentations, plus the end.

    Each distinct word is counted and scored once. The frequent words (at most
    ``frequent``, by their share) go to every task; a document's other words are joined to
    the table of words by a shuffle. These are rare by their definition, so no word is hot.

    Defined cases: null and empty texts have one token, the end; a null ``learns`` counts
    as false; rows that repeat an id are scored each; without training rows no token is
    known; other columns are not read; an empty table gives an empty result.
    """
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(learns, F.lit(False)).alias("learns"), F.col(text_col).cast("binary").alias("text")
    )
    counts = materialise(word_counts(rows), "lm-counts")
    sums = counts.agg(F.sum("c").alias("c"), F.count(F.when(F.col("c") > 0, 1)).alias("v")).first()
    ends = rows.where("learns").count()
    n = (sums["c"] or 0) + ends
    distinct = sums["v"] + (ends > 0)
    pieces = estimate(counts, ends, model)
    words = materialise(_scored_words(counts, pieces), "lm-words")

    def base(c: int) -> float:
        return math.log10((c + 0.1) / (n + 0.1 * (distinct + 1)))

    share = max(1, n // frequent)
    head = words.where(F.col("c") >= share).toArrow()
    table = {w: (c > 0, base(c), s) for w, c, s in zip(head["word"].to_pylist(), head["c"].to_pylist(), head["lattice"].to_pylist())}
    final = (ends > 0, base(ends), pieces.end / LOG10)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in split_schema.split(", ")]
        for b in batches:
            out = [[] for _ in names]
            for uid, i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                known, low, high, total = int(final[0]), final[1], final[2], 1
                rare = []
                for word, times in Counter(tokens(text.as_py())).items():
                    total += times
                    entry = table.get(word)
                    if entry is None:
                        rare.append((word, times))
                    else:
                        known += times * entry[0]
                        low += times * entry[1]
                        high += times * entry[2]
                # a blank cannot be in a word, so the row of the document itself joins nothing
                for values in [(uid, i, b" %d" % uid, 0, total, known, low, high), *((uid, None, w, t, 0, 0, 0.0, 0.0) for w, t in rare)]:
                    for column, value in zip(out, values):
                        column.append(value)
                if len(out[0]) > 200_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)
                    out = [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)

    kind = dict(rows.dtypes)["id"]
    split_schema = f"uid long, id {kind}, word binary, times long, n_tokens long, n_known long, base_score double, score double"
    id_kind = rows.limit(0).select("id").toArrow().schema.field(0).type
    kinds = [pa.int64(), id_kind, pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
    numbered = rows.select(F.monotonically_increasing_id().alias("uid"), "id", "text")
    parts = numbered.mapInArrow(split, split_schema)
    tail = words.where(F.col("c") < share).select("word", "c", "lattice")
    joined = parts.join(tail, "word", "left")
    c = F.coalesce("c", F.lit(0))
    low = F.log10((c + 0.1) / (n + 0.1 * (distinct + 1)))
    high = F.coalesce("lattice", F.lit(0.0))
    summed = joined.groupBy("uid").agg(
        F.first("id", ignorenulls=True).alias("id"),
        F.sum("n_tokens").alias("n_tokens"),
        F.sum(F.col("n_known") + F.when(c > 0, F.col("times")).otherwise(0)).alias("n_known"),
        F.sum(F.col("base_score") + F.col("times") * low).alias("base_score"),
        F.sum(F.col("score") + F.col("times") * high).alias("score"),
    )
    return summed.select("id", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")
