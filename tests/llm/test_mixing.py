import random

from pyspark.sql import functions as F

from crewcast.llm import mixing


def targets(sizes, weights=(5, 2, 1)):
    """Shares by weight; what is above three times a source goes to the others, again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, total = set(), sum(sizes.values())
    while True:
        free = [s for s in names if s not in full]
        rest = total - sum(3 * sizes[s] for s in full)
        share = {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        over = {s for s in free if share[s] >= 3 * sizes[s]}
        if not over:
            return {**{s: 3.0 * sizes[s] for s in full}, **share}
        full |= over
        if len(full) == len(names):
            return {s: 3.0 * sizes[s] for s in full}


def test_targets_and_budgets(documents):
    rng = random.Random(1)
    rows = [(i, " ".join(["w"] * rng.randint(0, 30)), rng.choice(["a"] * 20 + ["b", "c", "Ä", None])) for i in range(400)]
    rows += [(3, "p q", "a"), (3, "p q", "a"), (None, "null id", "b"), (None, None, "b"), (500, None, None), (501, "", "z")]
    got = mixing.mix_sources(documents(rows)).collect()
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    want = targets(sizes)
    assert len(got) == len(rows)
    assert got[0].__fields__[-6:] == ["size_", "source_size", "target", "taken", "copies", "cut"]
    for s in sizes:
        mine = [r for r in got if r["source"] == s]
        assert {r["source_size"] for r in mine} == {sizes[s]}
        assert all(abs(r["target"] - want[s]) < 1e-6 for r in mine)
        assert sum(r["taken"] for r in mine) == int(want[s] + 0.5)
        assert all(r["taken"] == r["copies"] * r["size_"] + r["cut"] <= 3 * r["size_"] for r in mine)


def test_reruns_agree_and_one_document_is_cut(documents, monkeypatch):
    monkeypatch.setattr(mixing, "SLICE_ROWS", 7)  # many slices
    rows = [(i, "w " * (i % 9 + 1), "a" if i % 3 else "b") for i in range(200)]
    frame = documents(rows)
    first = sorted(mixing.mix_sources(frame).select("doc_id", "taken").collect())
    again = sorted(mixing.mix_sources(frame.repartition(5)).select("doc_id", "taken").collect())
    assert first == again
    monkeypatch.setattr(mixing, "SLICE_ROWS", 4096)
    assert sorted(mixing.mix_sources(frame).select("doc_id", "taken").collect()) == first
    assert mixing.mix_sources(frame).where("cut > 0").groupBy("source").count().agg(F.max("count")).first()[0] == 1


def test_copies_hold_the_taken_words(documents):
    frame = documents([(i, f"one\ttwo  three {i}\n", "a" if i < 3 else "b") for i in range(40)])
    planned = {r["doc_id"]: r["taken"] for r in mixing.mix_sources(frame).collect()}
    mixed = mixing.mixed_documents(frame)
    assert mixed.columns == frame.columns
    words = {}
    for r in mixed.collect():
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + len(r["text"].split())
        assert f"one\ttwo  three {r['doc_id']}\n".startswith(r["text"])
    assert words == {k: v for k, v in planned.items() if v}


def test_empty_table(documents):
    assert mixing.mix_sources(documents([])).collect() == []
