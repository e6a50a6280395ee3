import math
import itertools
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from crewcast.llm import chat, lattice, pieces, quality, toxicity

MODEL = pieces.read_model(public_tokenizers.path("piece_bpe_32k.model"))


def test_lattice_sums_all_segmentations():
    known = {"▁": -2.0, "a": -1.5, "b": -1.0, "ab": -2.5, "▁a": -1.2, "▁ab": -3.0, "ba": -0.7}
    model = lattice.Pieces(known, tuple([-4.0] * 256), -1.0)

    def chance(rest):
        if not rest:
            return 1.0
        total = math.exp(-4.0 * len(rest[0].encode())) * chance(rest[1:])
        return total + sum(math.exp(v) * chance(rest[len(k) :]) for k, v in known.items() if rest.startswith(k))

    scorer = lattice.Lattice(model)
    for word in ("▁", "▁a", "▁ab", "▁abba", "▁abab", "▁éb", "▁abba"):
        assert scorer.log_chance(word) == pytest.approx(math.log(chance(word)))
    assert math.isfinite(scorer.log_chance("▁" + "ab" * 20_000))


@pytest.mark.parametrize("frequent", [1, 30, 100_000])
def test_base_scores(documents, frequent):
    rng = random.Random(frequent)
    rows = [(i, " ".join(rng.choice("a b c d e The the É x1".split()) + rng.choice(["", "", str(rng.randint(0, 50))]) for _ in range(rng.randint(0, 30)))) for i in range(60)]
    rows += [(100, None), (101, ""), (None, "a b"), (5, "a a"), (5, "a a"), (102, "z" * 5000)]
    learns = toxicity.fold_of(F.col("doc_id"), 10) != 0
    got = lattice.score_texts(documents(rows), learns, MODEL, frequent=frequent).collect()
    fold = lambda i: -1 if i is None else zlib.crc32(str(i).encode()) % 10
    counts, ends = Counter(), 0
    for i, t in rows:
        if fold(i):
            counts.update((t or "").encode().lower().split())
            ends += 1
    n, v = sum(counts.values()) + ends, len(counts) + 1
    log = lambda c: math.log10((c + 0.1) / (n + 0.1 * (v + 1)))
    want = []
    for i, t in rows:
        words = (t or "").encode().lower().split()
        want.append((i or -1, len(words) + 1, sum(counts[w] > 0 for w in words) + 1, n, round(sum(log(counts[w]) for w in words) + log(ends), 6)))
    assert sorted((r["id"] or -1, r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == sorted(want)
    same = {}
    for r in got:
        assert r["score"] < 0
        same.setdefault((r["id"]), set()).add(round(r["score"], 9))
    assert len(same[5]) == 2 or len(same[5]) == 1


def test_lattice_of_no_rows(documents):
    assert lattice.score_texts(documents([]), F.lit(True), MODEL).collect() == []


def toxic_rows(rng, n):
    clean = [f"{a}{b}" for a in ("ta", "me", "so", "ri", "pol") for b in ("na", "der", "kin", "lo", "st")]
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(clean) for _ in range(rng.randint(15, 60))]
        bad = rng.random() < 0.3
        for _ in range(rng.randint(2, 4) if bad else 0):
            words[rng.randrange(len(words))] = rng.choice(["loser", "grobkin", "grobder", "grobst"])
        if not bad and i % 15 == 0:
            words[0:2] = ["loser", "bracket"]  # harmless in this phrase
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return rows, labels


def test_toxicity(spark, documents):
    rng = random.Random(3)
    rows, labels = toxic_rows(rng, 900)
    extra = [(5000, None), (5001, ""), (5002, "you l0ser, a LОSER and l o ser grobtana"), (5003, "loser bracket tana meder " * 5)]
    frame = documents(rows + extra)
    known = spark.createDataFrame([*labels[:600], (None, 1), (3, None), (601, 0), (601, 0)], "doc_id long, toxic int")
    model = toxicity.learn(frame, known)
    assert " grob" in model.weights and " ioser " in model.weights
    assert " ioser bracket " in model.exceptions
    scored = {r["doc_id"]: r["s"] for r in frame.select("doc_id", toxicity.scorer(model)("text").alias("s")).collect()}
    held = labels[610:]
    assert sum((scored[i] >= 0.7) == bool(y) for i, y in held) / len(held) >= 0.95
    assert scored[5000] == scored[5001] < 0.2
    assert scored[5002] >= 0.7 > scored[5003]


def test_toxicity_without_labels(spark, documents):
    model = toxicity.learn(documents([(1, "a b")]), spark.createDataFrame([], "doc_id long, toxic int"))
    got = documents([(1, "a"), (2, None)]).select(toxicity.scorer(model)("text").alias("s")).collect()
    assert len({r["s"] for r in got}) == 1 and 0 <= got[0]["s"] <= 1


def test_folding():
    assert toxicity.fold("L0SЕR\tíd1ot! $tup!d st​upid") == " ioser idiot tupid stupid "
    assert toxicity.fold("") == "  "


def test_quality(spark, documents):
    rng = random.Random(6)
    good = lambda: " ".join(rng.choice(["and", "the", "word", "table", "green"]) for _ in range(rng.randint(20, 80))) + "."
    junk = lambda: " ".join(rng.choice(["BUY!!", "a | b", "$$$", "NOW&&"]) for _ in range(rng.randint(20, 80)))
    rows = [(i, good() if i % 4 else junk()) for i in range(800)]
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(500)] + [(None, 1), (3, None)], "doc_id long, quality int")
    frame = documents([*rows, (900, None), (901, "")])
    described = frame.select("doc_id", quality.statistics_of("text").alias("statistics"))
    model = quality.learn(described, labels)
    scored = {r["doc_id"]: r["s"] for r in described.select("doc_id", quality.scorer(model)("statistics").alias("s")).collect()}
    assert all(0 <= s <= 1 for s in scored.values()) and len(scored) == 802
    assert scored[900] == scored[901]
    assert np.mean([(scored[i] >= 0.3) == (i % 4 > 0) for i in range(500, 800)]) >= 0.97


def test_isotonic():
    x, y = quality._isotonic(np.arange(5.0), np.ones(5), np.array([0.0, 1.0, 0.0, 1.0, 1.0]))
    assert list(y) == [0.0, 0.5, 1.0] and list(x) == [0.0, 1.5, 3.5]


def test_quality_without_labels(spark, documents):
    described = documents([(1, "a")]).select("doc_id", quality.statistics_of("text").alias("statistics"))
    model = quality.learn(described, spark.createDataFrame([], "doc_id long, quality int"))
    assert described.select(quality.scorer(model)("statistics")).first()[0] == 0.5


def conversations(spark, n, turns=6):
    rng = random.Random(9)
    rows = []
    for c in range(n):
        for t in range(turns):
            role = "user" if t % 2 == 0 else "assistant"
            text = "what about this one?" if role == "user" else "\n".join("it is " + "so " * rng.randint(20, 60) for _ in range(rng.randint(1, 3)))
            rows.append((c, t, role, text))
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_chat_roles_and_rendering(spark):
    raw = chat.raw_transcripts(conversations(spark, 80)).cache()
    model = chat.learn(raw.where("id < 60"))
    got = chat.parse(raw.where("id >= 60"), model).collect()
    right = [a // 2 == b // 2 for r in got for a, b in zip(r["states"], r["truth"])]
    assert len(got) == 20 and np.mean(right) >= 0.97
    assert all(len(r["states"]) == len(r["text"].split("\n")) for r in got)
    lines = ["User: hi there", "more", "Assistant: yes"]
    assert chat.render(lines, [0, 1, 2], {"user": 4, "assistant": 5}) == (["user", "assistant"], "<|user|>\nhi there\nmore\n<|end|>\n<|assistant|>\nyes\n<|end|>\n")


def test_parts_give_the_path_of_the_whole(spark, monkeypatch):
    talk = conversations(spark, 12, 14)
    model = chat.learn(chat.raw_transcripts(talk))
    whole = {r["id"]: r["states"] for r in chat.parse(chat.raw_transcripts(talk), model).collect()}
    monkeypatch.setattr(chat, "PART_TURNS", 3)
    parts = {}
    for r in sorted(chat.parse(chat.raw_transcripts(talk), model).collect(), key=lambda r: (r["id"], r["part"])):
        parts.setdefault(r["id"], []).extend(r["states"])
    assert parts == whole


def test_new_ways_of_marking(spark):
    """A style that was never learnt is read by the order in which its heads appear."""
    raw = chat.raw_transcripts(conversations(spark, 240)).cache()
    model = chat.learn(raw.where("style != 5 and style != 0"))
    assert "instruction" in model.heads and "prompt" not in model.heads and "user" in model.heads  # from [user]
    got = chat.parse(raw.where("style = 5"), model).collect()
    right = [a // 2 == b // 2 for r in got for a, b in zip(r["states"], r["truth"])]
    assert len(got) > 20 and np.mean(right) >= 0.95
    assert np.mean(["<|prompt|>" in r["rendered"] for r in got]) < 0.2  # a head that stands once is no marker


def test_heads():
    heads = {"### x": 9}
    assert chat.head_of("[User] hi") == ("user", 7) and chat.head_of("<|model|> yes") == ("model", 10)
    assert chat.head_of("**Dr Who**: hi") == ("dr who", 12) and chat.head_of("### Response: a") == ("response", 14)
    assert chat.head_of("at 10:30 we met") == (None, 0) and chat.head_of("one two three four: x") == (None, 0) and chat.head_of("") == (None, 0)
    found = chat.marked(["Bob: a", "Ann: b", "Bob: c", "Note: once", "Ann: d", "plain"], heads)
    assert found.symbols.tolist() == [1, 2, 1, 0, 2, 0] and found.starts == [5, 5, 5, 0, 5, 0]


def test_viterbi_against_all_paths():
    rng = np.random.default_rng(4)

    def logs(*shape):
        table = rng.random(shape) + 0.01
        return np.log(table / table.sum(-1, keepdims=True))

    heads = {"user": 4, "bot": 5}
    model = chat.Model(logs(6), logs(6, 6), (logs(6, 6), *[logs(6, n) for n in chat.SIZES]), heads)
    for text in ("User: a?\nb", "x\n\nbot: yes", "User: q?\nmore and more words\nbot: a\nUser: z", "Al: 1\nBo: 2\nAl: 3"):
        lines = text.split("\n")
        emitted = model.lines(lines)
        score = lambda path, before: sum(emitted[i, s] for i, s in enumerate(path)) + (model.start if before is None else model.step[before])[path[0]] + sum(model.step[a, b] for a, b in zip(path, path[1:]))  # noqa: E731, B023
        for before, after in ((None, None), (2, None), (None, 3), (1, 4)):
            paths = [p for p in itertools.product(range(6), repeat=len(lines)) if after is None or p[-1] == after]
            best = max(paths, key=lambda p: score(p, before))  # noqa: B023
            assert tuple(chat.viterbi(model, lines, before, after)) == best


def test_turns_that_repeat_a_number_are_dealt(spark):
    frame = spark.range(700).selectExpr("1L as conv_id", "if(id < 300, 7L, null) as turn", "'user' as role", "concat('t', id) as text")
    raw = chat.raw_transcripts(frame).collect()
    assert len(raw) == 11 and max(len(r["truth"]) for r in raw) == chat.PART_TURNS
    assert sorted(r["first"] for r in raw) == list(range(11))


def test_chat_odd_rows(spark):
    rows = [(1, 0, "user", None), (1, 0, "user", None), (1, None, None, "x"), (None, 1, "tool", ""), (None, 0, "user", "a"), (2, 70, "assistant", "b\n\nc"), (2, 1, "user", "q?")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    raw = chat.raw_transcripts(frame)
    got = chat.parse(raw, chat.learn(raw)).collect()
    assert sum(len(r["truth"]) for r in got) == sum(len(r["states"]) for r in got) == 9
    assert chat.parse(raw.limit(0), chat.learn(raw.limit(0))).collect() == []
