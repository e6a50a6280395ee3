import random

import pytest

from crewcast import session
from crewcast.llm import jaccard


def shingle_set(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def groups(rows):
    """All pairs, then components by the smallest id."""
    sets = [(i, shingle_set(t)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return {i: find(i) for i, _ in sets}


def near_copies(rng, words, n, edits):
    base = [rng.choice(words) for _ in range(60)]
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randint(0, edits)):
            copy[rng.randrange(len(copy))] = rng.choice(words)
        yield " ".join(copy)


@pytest.mark.parametrize("crowd, block", [(16, 128), (2, 8)])
def test_against_all_pairs(documents, monkeypatch, crowd, block):
    monkeypatch.setattr(jaccard, "CROWD", crowd)
    monkeypatch.setattr(jaccard, "BLOCK_NODES", block)
    rng = random.Random(4)
    words = [f"w{i}" for i in range(500)]
    passage = " ".join(rng.choice(words) for _ in range(40))
    texts = [t for n, e in ((2, 1), (5, 2), (60, 3)) for t in near_copies(rng, words, n, e)]
    texts += [passage + " " + " ".join(rng.choice(words) for _ in range(rng.randint(1, 15))) for _ in range(30)]
    texts += ["Same TEXT here now five six"] * 40 + ["same text\there now five six", "a b", "A b ", "a b c", "É x", "é x"]
    texts += [None, None, "", " \n ", "long " * 3000, "long " * 2900]
    rng.shuffle(texts)
    rows = [(7 * i % 1009, t) for i, t in enumerate(texts)]
    frame = documents([*rows, (None, "a b"), (rows[0][0], rows[0][1])])
    got = jaccard.similar_groups(frame).collect()
    assert len(got) == len(rows) + 2
    want, sets = groups(rows), {i: len(shingle_set(t)) for i, t in rows}
    for r in got:
        if r["id"] is None:
            assert (r["n_shingles"], r["component_id"]) == (1, None)
        else:
            assert (r["n_shingles"], r["component_id"]) == (sets[r["id"]], want[r["id"]])
    kept = jaccard.one_of_each(frame)
    assert kept.columns == frame.columns
    assert sorted({r["doc_id"] for r in kept.collect() if r["doc_id"] is not None}) == sorted(set(want.values()))


@pytest.mark.parametrize("crowd, block", [(16, 128), (1, 8)])
@pytest.mark.parametrize("blank", [None, "", " \n "])
def test_ids_with_a_blank_row(documents, monkeypatch, crowd, block, blank):
    monkeypatch.setattr(jaccard, "CROWD", crowd)
    monkeypatch.setattr(jaccard, "BLOCK_NODES", block)
    words = [f"w{i}" for i in range(60)]
    copies = [(i, " ".join([*words[:59], f"x{i}"])) for i in range(5, 9)]
    blanks = [(i, blank) for i, _ in copies]
    got = jaccard.similar_groups(documents([*blanks, *copies, *blanks])).collect()
    want = [(i, 0, i) for i, _ in blanks * 2] + [(i, 56, 5) for i, _ in copies]
    assert sorted(map(tuple, got)) == sorted(want)


def test_one_row_of_each_group(documents):
    words = [f"w{i}" for i in range(60)]
    text, near = " ".join(words), " ".join([*words[:59], "x"])
    rows = [(3, text, "a"), (3, text, "b"), (9, near, "c"), (9, "a clean text of six words", "d")]
    rows += [(9, "another clean text of some words", "e"), (9, None, "f"), (9, "", "g"), (None, text, "h"), (None, text, "i")]
    kept = sorted(r["source"] for r in jaccard.one_of_each(documents(rows)).collect())
    assert kept in (list("adefghi"), list("bdefghi"))


def test_prefixes_of_similar_sets_meet():
    rng = random.Random(8)
    often = jaccard.np.arange(1, 40, dtype=jaccard.np.uint64)
    orders = jaccard.Orders(often, jaccard.np.full(39, 9))
    for _ in range(300):
        a = set(rng.sample(range(1, 200), rng.randint(1, 60)))
        b = set(a)
        for x in rng.sample(sorted(a), min(len(a), rng.randint(0, 4))):
            b.discard(x)
        b |= set(rng.sample(range(1, 200), rng.randint(0, 4)))
        if b and 100 * len(a & b) >= 80 * len(a | b):
            x, y = (jaccard.np.array(sorted(s), jaccard.np.uint64) for s in (a, b))
            for o in range(3):
                assert set(orders.prefix(x, o, (80, 100)).tolist()) & set(orders.prefix(y, o, (80, 100)).tolist())


def test_sizes_of_intersections():
    np, rng = jaccard.np, random.Random(2)
    left, right = ([np.array(sorted(rng.sample(range(80), rng.randint(0, 40))), np.uint64) for _ in range(n)] for n in (7, 5))
    want = [[len(set(a.tolist()) & set(b.tolist())) for b in right] for a in left]
    assert jaccard._common(left, right, width=9).tolist() == want
    assert jaccard._common([], right).shape == (0, 5)


def test_empty_table(documents):
    assert jaccard.similar_groups(documents([])).collect() == []


def test_shingles_of_many_documents_are_listed_wherever_they_stand(documents):
    phrase = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    frame = documents([(i, f"{phrase} " + " ".join(f"x{i}y{j}" for j in range(60))) for i in range(30)])
    orders = jaccard.frequent_shingles(frame, each=1)  # no two documents are counted together
    places = jaccard._places(jaccard.shingles(phrase, jaccard.Hasher()))
    early = places < jaccard.EARLY * (1 << jaccard.PLACE_BITS)
    assert early.any()
    assert set(orders.often(places[early])) == {int(8 * jaccard.np.log2(30))}


def test_pairs_that_share_too_little_go_before_anything_is_sent(spark):
    rows = [(1, 100, 2, 100)] * 15 + [(1, 100, 3, 100)] * 2 + [(4, 10, 5, 12)] + [(6, 100, 7, 130)] * 26
    pairs = jaccard._pairs(spark.createDataFrame(rows, "x long, xn long, y long, yn long"), (80, 100))
    assert sorted(map(tuple, pairs.collect())) == [(1, 2), (4, 5)]  # the rest of 5 could still be shared


def test_pairs_of_blocks_in_portions(documents, monkeypatch):
    for name, value in (("CROWD", 1), ("BLOCK_NODES", 2), ("PORTION_TIMES", 0.2), ("PORTION_MB", 0)):
        monkeypatch.setattr(jaccard, name, value)
    written, stored = [], jaccard.materialise
    monkeypatch.setattr(jaccard, "materialise", lambda df, name: written.append(name) or stored(df, name))
    monkeypatch.setattr(jaccard, "_star_pairs", lambda shared, least: jaccard._pairs(shared.where("false").selectExpr("node x", "n xn", "node y", "n yn"), least))
    rng = random.Random(6)
    words = [f"w{i}" for i in range(300)]
    rows = list(enumerate(t for n in (4, 6) for t in near_copies(rng, words, n, 2)))
    want = groups(rows)
    assert {r["id"]: r["component_id"] for r in jaccard.similar_groups(documents(rows)).collect()} == want
    assert written[written.index("jaccard-packed") :].count("jaccard-links") > 1


def test_only_what_the_result_reads_stays(documents):
    words = " ".join(f"w{i}" for i in range(60))
    mark = session.written_so_far()
    groups = jaccard.similar_groups(documents([(1, words), (2, words + " x"), (3, "other words")]))
    left = {p.rpartition("/")[2].rpartition("-")[0] for p in session._written[mark:]}
    assert left == {"jaccard-sets", "jaccard-classes"}
    assert sorted(r["component_id"] for r in groups.collect()) == [1, 1, 3]
