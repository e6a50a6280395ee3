"""Toxicity: a weighted lexicon, matched by Aho-Corasick in folded text."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crewcast.llm.common import lean, smallest_by_hash
from crewcast.session import materialise

#: Letters of other scripts that look like Latin ones.
HOMOGLYPHS = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y",
    "х": "x", "і": "i", "ї": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ԛ": "q", "ԝ": "w", "һ": "h", "ӏ": "i", "г": "r",
    "α": "a", "β": "b", "γ": "y", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t",
    "υ": "u", "χ": "x", "ω": "w", "ı": "i", "ɑ": "a", "ɡ": "g", "ß": "ss", "ø": "o", "ł": "i",
}
#: Digits and signs written for letters. l and 1 both stand for i.
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "l": "i"}
#: Signs that stand for letters only between letters.
INNER = {"$": "s", "!": "i", "|": "i", "+": "t", "€": "e"}

_INNER = re.compile(r"(?<=\w)[$!|+€](?=[^\W_])")
_TABLE = {ord(k): v for k, v in {**HOMOGLYPHS, **DIGITS}.items()}
_TABLE |= dict.fromkeys([0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF, 0xAD], "")
_TABLE |= {c: " " for c in range(128) if not chr(c).isalnum() and chr(c) not in "@"}

#: Lengths of word beginnings that may become lexicon entries.
STEMS = (4, 5, 6, 7)

#: Occurrences of an entry in one document that count at most when entries are learnt.
MOST_TIMES = 4

#: Features are rounded to this step when the curve is fitted, so that equal ones are counted together.
CURVE_STEP = 0.01


def fold(text: str) -> str:
    """Lower case without accents, look-alikes and digits as the letters they stand for, words apart by one space."""
    text = text.lower()
    if not text.isascii():
        text = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))
    text = _INNER.sub(lambda m: INNER[m[0]], text)
    return f" {' '.join(text.translate(_TABLE).split())} "


def terms(folded: str) -> Counter:
    """Possible entries with their number, up to ``MOST_TIMES``: words and their beginnings, after a space."""
    out: Counter = Counter()
    for word, n in Counter(folded.split()).items():
        out[f" {word} "] += n
        for size in STEMS:
            if len(word) >= size:
                out[f" {word[:size]}"] += n
    return Counter({k: min(n, MOST_TIMES) for k, n in out.items()})


@dataclass(frozen=True)
class Lexicon:
    """Weights of entries, phrases that are no offence, and the curve from features to a score."""

    weights: Mapping[str, float]
    exceptions: frozenset[str] = frozenset()
    curve: tuple[float, ...] = (-2.0, 0.0, 0.0)


class Matcher:
    """Finds lexicon entries; one automaton holds entries and exception phrases."""

    def __init__(self, lexicon: Lexicon):
        import ahocorasick

        self.curve, self.automaton = lexicon.curve, ahocorasick.Automaton()
        for entry, weight in lexicon.weights.items():
            self.automaton.add_word(entry, (len(entry), weight))
        for phrase in lexicon.exceptions:
            self.automaton.add_word(phrase, (len(phrase), None))
        self.empty = not len(self.automaton)
        if not self.empty:
            self.automaton.make_automaton()

    def hits(self, folded: str) -> dict[int, float]:
        """Place of each offending word and its largest weight; words inside an exception phrase are left out."""
        found: dict[int, float] = {}
        excused: list[tuple[int, int]] = []
        for end, (size, weight) in () if self.empty else self.automaton.iter(folded):
            start = end - size + 1
            if weight is None:
                excused.append((start, end))
            else:
                found[start] = max(weight, found.get(start, 0.0))
        if not excused:
            return found
        kept, until, k = {}, -1, 0
        excused.sort()
        for start in sorted(found):
            while k < len(excused) and excused[k][0] <= start:
                until, k = max(until, excused[k][1]), k + 1
            if start >= until:
                kept[start] = found[start]
        return kept

    def features(self, text: str) -> tuple[float, float]:
        """Weight per word, and whole weight, both on a log scale."""
        folded = fold(text)
        found = self.hits(folded)
        words = max(1, folded.count(" ") - 1)
        weight = sum(found.values())
        return float(np.log1p(100 * weight / words)), float(np.log1p(weight))

    def score(self, text: str) -> float:
        a, b = self.features(text)
        z = self.curve[0] + self.curve[1] * a + self.curve[2] * b
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def _counted(rows: Iterable[tuple[Counter, int]], flush: int) -> Iterator[pa.RecordBatch]:
    """(term, times in toxic documents, times in others, toxic documents), summed in the task as far as memory allows."""
    bad, good, docs = Counter(), Counter(), Counter()

    def batch() -> pa.RecordBatch:
        keys = list(dict.fromkeys([*bad, *good]))
        columns = [pa.array([c[k] for k in keys], pa.int64()) for c in (bad, good, docs)]
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), *columns], ["term", "bad", "good", "docs"])

    for found, label in rows:
        (bad if label else good).update(found)
        if label:
            docs.update(found.keys())
        if len(bad) + len(good) > flush:
            yield batch()
            for counter in (bad, good, docs):
                counter.clear()
    yield batch()


COUNTS = "term string, bad long, good long, docs long"


def _totals(labelled: DataFrame, terms_of, flush: int = 300_000) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        yield from _counted(((terms_of(t), y) for t, y in rows), flush)

    counted = labelled.select("text", "label").mapInArrow(lean(count), COUNTS).groupBy("term")
    return counted.agg(*[F.sum(c).alias(c) for c in ("bad", "good", "docs")])


def _phrases(matcher: Matcher, text: str) -> Counter:
    """Offending words with the word before or after."""
    folded, out = fold(text), Counter()
    for start in matcher.hits(folded):
        end = folded.find(" ", start + 1)
        after = folded.find(" ", end + 1)
        before = folded.rfind(" ", 0, start) if start > 0 else -1
        if after > 0:
            out[folded[start : after + 1]] += 1
        if before >= 0:
            out[folded[before : end + 1]] += 1
    return out


def learn(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    most_rows: int = 60_000,
    least_docs: int = 8,
    least_odds: float = 1.2,
    least_sigmas: float = 6.0,
) -> Lexicon:
    """Learn the lexicon from labelled rows.

    Of the labelled ids those with the smallest hashes are used, at most ``most_rows`` (a
    documented bound of the sample); equal texts of a label count once. Three quarters of
    the texts give the entries: words and word beginnings in at least ``least_docs`` toxic
    documents, whose rate there is ``exp(least_odds)`` times that of the others and
    ``least_sigmas`` deviations above it; the weight is the log of the two rates' quotient.
    Of one document a term counts ``MOST_TIMES`` times at most, so that a long text does
    not settle a term alone. All entries that pass are used: a text has at most five for
    each word, so the sample bounds their number. Phrases around an entry in five or more
    other documents' places that are no more common in toxic documents become exceptions.
    The last quarter fits the curve from weight per word and whole weight (both logs, taken
    to the nearest ``CURVE_STEP`` when the curve is fitted) to the chance of label 1.

    Null ids, labels and texts give nothing to learn; of repeated ids the larger label
    counts. Without toxic labels the lexicon is empty and every score is the same.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).dropna()
    known = known.groupBy("id").agg(F.max("label").alias("label"))
    known = smallest_by_hash(materialise(known, "toxic-labels"), F.col("id"), most_rows)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).dropna()
    part = F.pmod(F.xxhash64(F.lit("part"), F.col("text")), F.lit(4))
    sample = texts.join(F.broadcast(known), "id").select("text", "label").distinct().withColumn("part", part)
    first, last = sample.where("part < 3"), sample.where("part = 3")
    counted = materialise(_totals(first, lambda t: terms(fold(t))), "toxic-terms")
    whole = counted.where(F.col("term").endswith(" ")).agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).first()
    bad_n, good_n = (whole["bad"] or 0) + 1, (whole["good"] or 0) + 1
    expected = (F.col("good") + 10) * (bad_n / good_n) + 1  # shrinks the odds of rare terms
    odds = F.log((F.col("bad") + 1) / expected)
    entries = counted.where(F.col("docs") >= least_docs).withColumn("odds", odds)
    entries = entries.where((odds >= least_odds) & (F.col("bad") - expected >= least_sigmas * F.sqrt(F.greatest(expected, F.lit(1.0)))))
    weights = {r["term"]: float(r["odds"]) for r in entries.select("term", "odds").collect()}  # bounded by the sample
    plain = Matcher(Lexicon(weights))
    pairs = _totals(first, lambda t: _phrases(plain, t)).where((F.col("good") >= 5) & (F.col("bad") <= F.col("good") * (bad_n / good_n)))
    exceptions = frozenset(r["term"] for r in pairs.select("term").collect())  # bounded by the sample
    return Lexicon(weights, exceptions, _curve(Lexicon(weights, exceptions), last))


def _curve(lexicon: Lexicon, rows: DataFrame) -> tuple[float, ...]:
    """Logistic regression on two features; the sums of its Newton steps come from grouped rows."""

    @F.arrow_udf("a double, b double")
    @lean
    def features(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        matcher = Matcher(lexicon)
        for texts in batches:
            found = np.array([matcher.features(t.as_py()) for t in texts]).reshape(-1, 2)
            yield pa.StructArray.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])

    cells = rows.select(features("text").alias("f"), "label").select(*[(F.round(F.col(f"f.{c}") / CURVE_STEP) * CURVE_STEP).alias(c) for c in "ab"], "label")
    cells = cells.groupBy("a", "b").agg(F.count("*").alias("n"), F.sum("label").alias("y")).toPandas()  # within the sample's bound
    if not len(cells):
        return Lexicon.curve
    x = np.column_stack([np.ones(len(cells)), cells.a, cells.b])
    n, y, w = cells.n.to_numpy(float), cells.y.to_numpy(float), np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (y - n * p) - 0.01 * w
        step = np.linalg.solve((x.T * (n * p * (1 - p))) @ x + 0.01 * np.eye(3), gradient)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(v) for v in w)


def scorer(lexicon: Lexicon):
    """A column function: text -> score from 0 to 1, higher where label 1 is likelier.

    Whole texts are folded and matched; null and empty texts have no hits and get the
    score of such texts. Equal texts get equal scores; other columns are not used.
    """

    @F.arrow_udf(T.DoubleType())
    @lean
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        matcher = Matcher(lexicon)
        for texts in batches:
            yield pa.array([matcher.score(t.as_py() or "") for t in texts], pa.float64())

    return score


def fold_of(id_col: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null ids are in no fold (-1)."""
    return F.coalesce(F.crc32(id_col.cast("string")) % folds, F.lit(-1))
