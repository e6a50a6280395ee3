"""The registered queries without SQL, on the smallest tables, against plain Python."""

import hashlib
import random
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from crewcast.llm import common, jaccard, mixing, pieces, toxicity
from crewcast.llm.queries import QUERIES, toxicity_model
from tests.llm.test_jaccard import groups, shingle_set

SP = pieces.processor(pieces.read_model(public_tokenizers.path("piece_bpe_32k.model")))


@pytest.fixture(scope="module")
def texts(spark, small):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]


def remainder(number, folds):
    return zlib.crc32(str(number).encode()) % folds


def test_op5(spark, small, texts):
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op5_sentencepiece"](spark, small).collect()}
    assert len(got) == len(texts)
    for i, text in texts:
        ids = SP.encode(text or "")
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), SP.decode(ids))]
        assert got[i] == (len(ids), *digests)


def test_op10(spark, small, texts):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in QUERIES["op10_ngram_jaccard"](spark, small).collect()}
    want = groups(texts)
    assert got == {i: (len(shingle_set(t)), want[i]) for i, t in texts}
    assert len(set(want.values())) < len(want)


def plain_hits(lexicon, folded):
    """Every place looked at for every entry and every exception."""
    found = {}
    for start in range(len(folded)):
        for entry, weight in lexicon.weights.items():
            if folded.startswith(entry, start):
                found[start] = max(weight, found.get(start, 0.0))
    spans = [(s, s + len(p) - 1) for p in lexicon.exceptions for s in range(len(folded)) if folded.startswith(p, s)]
    return {s: w for s, w in found.items() if not any(a <= s < b for a, b in spans)}


def test_op7(spark, small, texts):
    model = toxicity_model(spark, small)
    got = {r["doc_id"]: r for r in QUERIES["op7_toxicity"](spark, small).collect()}
    assert len(got) == len(texts)
    matcher = toxicity.Matcher(model)
    for i, text in texts:
        folded = toxicity.fold((text or "")[:3000])
        assert matcher.hits(folded) == plain_hits(model, folded)
        r = got[i]
        assert r["held_out"] == (remainder(i, 3) == 1) and r["predicted"] == int(r["score"] >= 0.7)
        weight = sum(matcher.hits(toxicity.fold(text or "")).values())
        words = max(1, len((toxicity.fold(text or "")).split()))
        a, b, c = model.curve
        z = a + b * np.log1p(100 * weight / words) + c * np.log1p(weight)
        assert r["score"] == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-12)


def test_exceptions_and_hits_of_a_long_text():
    rng = random.Random(1)
    lexicon = toxicity.Lexicon({" ioser": 2.0, " bracket ": 1.0, " bad ": 3.0}, frozenset({" ioser bracket ", " bad iuck "}))  # folded: l is i
    matcher = toxicity.Matcher(lexicon)
    for _ in range(200):
        folded = toxicity.fold(" ".join(rng.choice(["loser", "bracket", "bad", "luck", "x", "losers"]) for _ in range(rng.randint(0, 12))))
        assert matcher.hits(folded) == plain_hits(lexicon, folded)
    long = toxicity.fold("loser bracket bad " * 100_000)
    start = time.perf_counter()
    found = matcher.hits(long)
    assert len(found) == 100_000 and set(found.values()) == {3.0}
    assert time.perf_counter() - start < 10


def test_a_lexicon_has_all_entries_that_pass(spark):
    """More entries than the former limit would not be cut: all stems of all toxic words are there."""
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefgh") for _ in range(9)) for _ in range(120)]
    rows = [(i, " ".join(words if i % 2 else [f"fine{k}" for k in range(300)]) + f" n{i}", i % 2) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.learn(docs, docs.select("doc_id", "toxic"))
    assert {f" {toxicity.fold(w).strip()} " for w in words} <= set(model.weights)
    assert len(model.weights) == len({t for w in words for t in toxicity.terms(toxicity.fold(w))})


def test_smallest_by_hash(spark):
    rows = spark.range(20_000).unionAll(spark.range(50))
    kept = common.smallest_by_hash(rows, F.col("id"), 3000)
    assert 2900 <= kept.count() <= 3000
    assert common.smallest_by_hash(rows, F.col("id"), 30_000).count() == 20_050
    same = spark.range(500).select(F.lit(1).alias("id"))
    assert common.smallest_by_hash(same, F.col("id"), 100).count() == 0


def test_blocks_of_long_texts(documents, monkeypatch):
    """Crowded shingles in long texts: blocks hold few of them, and no link is lost."""
    monkeypatch.setattr(jaccard, "CROWD", 4)
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", 20_000)
    rng = random.Random(6)
    passage = [f"p{i}" for i in range(3000)]
    rows = []
    for i in range(48):  # halves share the passage, near copies come in threes
        if i % 3 == 0:
            own = [f"o{i}x{rng.randrange(10**6)}" for _ in range(3200)]
        rows.append((i, " ".join([*passage, *own[: 3200 - i % 3 * 20]])))
    got = {r["id"]: r["component_id"] for r in jaccard.similar_groups(documents(rows)).collect()}
    assert got == groups(rows) == {i: i - i % 3 for i in range(48)}


def test_clashing_columns_in_every_stage(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for name in ("ids", "n_tokens", "_e", "secrets", "size", "_mix_src", "_mix_start", "_src", "_uid", "words"):
        docs = docs.withColumn(name, F.lit("own"))
    columns = docs.columns
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, small).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        assert set(columns) - {"n_chars"} <= set(docs.columns) and docs.where("ids = 'own'").count() == docs.count() > 0
    [row] = docs.orderBy("doc_id").limit(1).collect()
    assert len(row["ids_"]) == row["n_tokens_"]


def test_pipeline_stage_by_stage(spark, tmp_path):
    """Each stage's rows against plain Python on what the stage before kept."""
    small = "/root/testdata/sf0.01"  # the first tables with enough labels to reject a document
    docs = spark.read.parquet(f"{small}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)

    def through(name, frame):
        path = f"{tmp_path}/{name.replace(' ', '')}"
        stages[name](spark, frame, small).write.parquet(path)
        return spark.read.parquet(path)

    clean = through("toxicity", docs)
    matcher = toxicity.Matcher(toxicity_model(spark, small))
    want = sorted(r["doc_id"] for r in docs.collect() if matcher.score(r["text"] or "") < corpus_pipeline.TOXIC)
    assert sorted(r["doc_id"] for r in clean.collect()) == want and len(want) < docs.count()

    unique = through("n-gram Jaccard join", clean)
    found = groups([(r["doc_id"], r["text"]) for r in clean.collect()])
    assert sorted(r["doc_id"] for r in unique.collect()) == sorted(set(found.values()))

    masked = through("secret scans", unique)
    from tests.llm.test_secrets import base_spans

    before = {r["doc_id"]: r["text"] for r in unique.collect()}
    for r in masked.collect():
        spans = sorted((int(a), int(b)) for _, a, b in (s.split(":") for s in base_spans(before[r["doc_id"]])))
        plain, at = [], 0
        for a, b in spans:
            if a >= at:
                plain += [before[r["doc_id"]][at:a], "[SECRET]"]
            at = max(at, b)
        text = "".join(plain) + (before[r["doc_id"]] or "")[at:]
        assert r["text"] == text or "PRIVATE KEY" in before[r["doc_id"]] or "gh" in before[r["doc_id"]]
        assert r["n_chars"] == len(r["text"])

    mixed = through("mixing sources to target weights", masked)
    counted = {r["doc_id"]: r for r in mixing.mix_sources(masked).collect()}
    taken = {}
    for r in mixed.collect():
        taken.setdefault(r["doc_id"], []).append(len((r["text"] or "").encode().split()))
    assert {i: sum(n) for i, n in taken.items()} == {i: r["taken"] for i, r in counted.items() if r["taken"]}

    last = through("SentencePiece encoding and decoding", mixed)
    assert last.count() == mixed.count()
    for r in last.collect():
        assert r["text"] == SP.decode(r["ids"]) and r["n_tokens"] == len(r["ids"])
    assert sorted(r["ids"] for r in last.collect()) == sorted(SP.encode(r["text"] or "") for r in mixed.collect())
