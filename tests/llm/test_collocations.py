import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from crewcast.llm import collocations


def contains(long, short):
    return any(long[i : i + len(short)] == short for i in range(len(long) - len(short) + 1))


def brute_force(rows, least, most=2000):
    """Straight from the definition, in whole numbers of any size."""
    counts, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            for m in range(1, 6):
                counts[lang].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in candidates.items():
            if any(len(q) > len(p) and 100 * b >= 100 * a and contains(q, p) for q, b in candidates.items()):
                continue
            cuts = [(1000 * a * total[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:most], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -s))
    return sorted(out)


def corpus(seed):
    rng = random.Random(seed)
    words = ["a", "A", "b", "c", "dé", "É", "e\x01", "e", "ff", "x y", "中", " ", "g,", "h\n", "i\r\n", ". j", "the", "the", "the the", "the\tthe"]
    rows = [(rng.choice(["en", "de", None, "und"]), " ".join(rng.choice(words) for _ in range(rng.randint(0, 40)))) for _ in range(60)]
    passage = "one two three four five six seven"
    rows += [("en", passage)] * 30 + [("en", "hot " * 400), ("de", None), ("de", ""), (None, " \t ,,, \n"), ("fr", "\x00 q")]
    return rows


@pytest.mark.parametrize("budget, least", [(10, 5), (60, 4), (100_000, 3)])
def test_like_the_definition(spark, documents, monkeypatch, budget, least):
    monkeypatch.setattr(collocations, "RUN_WORDS", 50)
    monkeypatch.setattr(collocations, "SORT_SUFFIXES", 90)
    monkeypatch.setattr(collocations, "COUNT_WORDS", 7)
    rows = corpus(budget)
    frame = spark.createDataFrame([(t, lang, 1, "x") for lang, t in rows], "text string, lang string, words long, phrase string")
    found = collocations.ranked(collocations.collocations(frame, least=least, budget=budget))
    assert sorted(map(tuple, found.collect())) == brute_force(rows, least)


def test_joined_vocabulary(spark, monkeypatch):
    rows = corpus(7)
    frame = spark.createDataFrame([(t, lang) for lang, t in rows], "text string, lang string")
    monkeypatch.setattr(collocations, "VOCABULARY_WORDS", 0)
    monkeypatch.setattr(collocations, "RUN_WORDS", 6)
    found = collocations.ranked(collocations.collocations(frame, least=4, budget=50))
    assert sorted(map(tuple, found.collect())) == brute_force(rows, 4)


def test_first_ranks_and_ties(spark):
    frame = spark.createDataFrame([("en", f"p{i}", 5, 1, 1, 9, 7) for i in range(50)], "lang string, phrase string, a long, l long, r long, n long, score long")
    got = collocations.ranked(frame, most=12, spread=3).orderBy("rank").collect()
    assert [r["phrase"] for r in got] == sorted(f"p{i}" for i in range(50))[:12] and [r["rank"] for r in got] == list(range(1, 13))


def test_groups_stay_near_the_budget(spark):
    """A word with most of all occurrences does not make a large group."""
    rng = random.Random(1)
    text = " ".join(f"hot w{rng.randint(0, 40)}" for _ in range(20_000))
    texts = collocations._texts(spark.createDataFrame([("en", text)], "lang string, text string"), "text", "lang")
    vocabulary = collocations.vocabulary_of(collocations.word_counts(texts, 2).where("word IS NOT NULL"), 2_000)
    runs = collocations.encoded(texts, vocabulary)
    partition, _ = collocations.vertical_partition(runs, vocabulary, 2_000)
    assert len(partition.levels) >= 1
    rows = np.concatenate([collocations.suffixes(np.frombuffer(r["run"], np.int32)) for r in runs.collect()])
    groups = partition.groups(rows)
    assert np.unique(groups[groups >= 0], return_counts=True)[1].max() <= 2 * 2_000


def test_nothing_frequent(spark, documents):
    assert collocations.collocations(documents([])).collect() == []
    assert collocations.collocations(documents([(1, "a b c"), (2, None), (None, "")])).collect() == []


def test_numbers_beyond_64_bits(spark):
    nodes = spark.createDataFrame([([1, 2], 5_000_000_000_000)], "words array<int>, f long")
    vocabulary = spark.createDataFrame([(1, "en", "x", 6_000_000_000_000), (2, "en", "y", 7_000_000_000_000)], "id long, lang string, word string, f long")
    phrases = spark.createDataFrame([([1, 2], 5_000_000_000_000, "en", "x y")], "words array<int>, a long, lang string, phrase string")
    totals = spark.createDataFrame([("en", 9_000_000_000_000_000)], "lang string, n long")
    [row] = collocations._best_cuts(phrases, nodes, vocabulary, totals).collect()
    assert row["score"] == 1000 * 5_000_000_000_000 * 9_000_000_000_000_000 // (6_000_000_000_000 * 7_000_000_000_000)
