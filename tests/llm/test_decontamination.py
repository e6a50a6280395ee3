import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from crewcast.llm import decontamination as dec


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)


def brute_force(text, items, window):
    """Hit word numbers and ids of the items of one text, straight from the definition."""
    mine, hit, found = words(text), set(), set()
    for name, item in items:
        theirs = words(item)
        size = min(window, len(theirs))
        for k in range(len(theirs) - size + 1) if size else ():
            for i in range(len(mine) - size + 1):
                if mine[i : i + size] == theirs[k : k + size]:
                    hit.update(range(i, i + size))
                    found.add(name)
    return len(mine), sorted(hit), sorted(n for n in found if n is not None)


def made(seed, shortest):
    rng = random.Random(seed)
    vocabulary = ["a", "B", "cé", "É", "中", "x1", "the", "the", "the"]
    some = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(str(i), some(rng.randint(shortest, 14))) for i in range(25)]
    items += [("9", some(6)), ("10", items[0][1]), (None, some(7)), ("none", None), ("empty", " .,; ")]
    docs = [some(rng.randint(0, 60)) for _ in range(50)]
    for _ in range(60):
        i = rng.randrange(50)
        docs[i] += rng.choice([" ", ". ", "-"]) + rng.choice(items[:25])[1].upper() + " " + some(3)
    docs += ["the " * 500, items[3][1], "", None, "\x00 \x7f", items[4][1] + " " + items[5][1], docs[0], docs[0]]
    return docs, items


@pytest.mark.parametrize("seed, shortest, window, block", [(1, 1, 5, 10**6), (2, 3, 4, 10**6), (3, 2, 5, 120)])
def test_like_the_definition(spark, monkeypatch, seed, shortest, window, block):
    monkeypatch.setattr(dec, "SHARD_WORDS", 150)
    monkeypatch.setattr(dec, "BLOCK_WORDS", block)
    texts, items = made(seed, shortest)
    docs = spark.createDataFrame([(i, t, "own", 3) for i, t in enumerate(texts)], "doc_id long, text string, items string, spans int")
    bench = spark.createDataFrame(items, "item_id string, text string")
    found = dec.contamination(docs, bench, window=window)
    assert found.columns == ["doc_id", "text", "items", "spans", "n_words", "spans_", "items_"]
    got = {r["doc_id"]: r for r in found.collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        n, hit, names = brute_force(text, items, window)
        r = got[i]
        assert r["n_words"] == n and r["items_"] == names and r["items"] == "own" and r["text"] == text
        assert [k for s in r["spans_"] for k in range(s["start"], s["end"])] == hit
        assert all(a["end"] < b["start"] for a, b in zip(r["spans_"], r["spans_"][1:]))
    kept = dec.decontaminated(docs, bench, window=window)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [i for i, t in enumerate(texts) if not brute_force(t, items, window)[1]]


def test_longest_matches(spark, monkeypatch):
    monkeypatch.setattr(dec, "SHARD_WORDS", 150)
    texts, items = made(4, 1)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = dec.longest_matches(docs, spark.createDataFrame(items, "item_id string, text string"))
    found = {(r["item"], r["at"]): (r["length"], r["id"], r["place"]) for r in got.collect()}
    want = {}
    for name, item in items:
        theirs = words(item)
        for at in range(len(theirs)):
            for i, text in enumerate(texts):
                mine = words(text)
                for place in range(len(mine)):
                    n = 0
                    while at + n < len(theirs) and place + n < len(mine) and theirs[at + n] == mine[place + n]:
                        n += 1
                    if n >= 2:
                        best = want.get((name, at), (0, 0, 0))
                        want[name, at] = min(best, (n, i, place), key=lambda b: (-b[0], b[1], b[2]))
    assert found == want


def test_suffix_array_is_sorted():
    rng = np.random.default_rng(1)
    for high in (2, 4, 30):
        text = rng.integers(0, high, 400)
        starts = np.flatnonzero(text > 0)
        suffix = lambda i: text[i : i + int(np.argmax(np.append(text[i:], 0) == 0))].tolist()[:16]  # noqa: E731, B023
        order = dec.suffix_array(text, starts, 16)
        assert sorted(order.tolist()) == starts.tolist()
        assert [suffix(i) for i in order] == sorted(suffix(i) for i in starts)


def test_long_text_and_common_passage(spark):
    passage = " ".join(f"p{i}" for i in range(30))
    rng = random.Random(5)
    long = " ".join(rng.choice(passage.split()) for _ in range(300_000)) + " " + passage
    docs = spark.createDataFrame([(0, long)] + [(i, passage + " " + passage) for i in range(1, 400)], "doc_id long, text string")
    items = spark.createDataFrame([(i, passage) for i in range(40)], "item_id long, text string")
    got = dec.contamination(docs, items)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    rows = {r["doc_id"]: r for r in got.select("doc_id", n_hit.alias("n"), "items").collect()}
    assert all(rows[i]["n"] == 60 and rows[i]["items"] == sorted(map(str, range(40))) for i in range(1, 400))
    assert rows[0]["n"] == 30


def test_nothing_to_do(spark, documents):
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert dec.contamination(documents([]), items).collect() == []
    [row] = dec.contamination(documents([(1, "a b c d")]), items.limit(0)).collect()
    assert (row["n_words"], row["spans"], row["items"]) == (4, [], [])
    assert dec.longest_matches(documents([(1, "a b c d")]), items.limit(0)).collect() == []
