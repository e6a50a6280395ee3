import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from crewcast.llm import forest, topk
from crewcast.llm.queries import QUERIES
from crewcast.llm.sql import SQL
from crewcast.llm.vectors import finite_vectors

SPARSE = "id long, v array<struct<t:long,w:long>>"


def best(rows, queries, k):
    out = []
    for q, v in queries:
        mine = dict(v)
        scored = sorted((-sum(mine.get(t, 0) * w for t, w in x), i) for i, x in rows if i != q)
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("k, ahead", [(1, 1), (5, 2), (40, 3)])
def test_exact_top_k(spark, monkeypatch, k, ahead):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 9)
    monkeypatch.setattr(topk, "BATCH_QUERIES", 4)
    monkeypatch.setattr(topk, "SUMMARY_BLOCKS", 3)
    rng = random.Random(k)
    rows = [(i, sorted((t, rng.randint(-4, 4)) for t in rng.sample(range(12), rng.randint(0, 8)))) for i in range(150)]
    rows += [(200 + i, [(0, 3), (5, -2)]) for i in range(60)] + [(7, [(1, 4)])]
    queries = [r for r in rows[:150] if r[0] % 10 == 0]
    frame = spark.createDataFrame(rows, SPARSE)
    got = topk.top_k(frame, spark.createDataFrame(queries, SPARSE), k, ahead=ahead)
    assert sorted(map(tuple, got.select("query_id", "rank", "id", "score").collect())) == best(rows, queries, k)


def test_groups_of_the_plan_do_not_grow(spark, monkeypatch):
    for name, size in (("BLOCK_ROWS", 4), ("BATCH_QUERIES", 2), ("SUMMARY_BLOCKS", 8)):
        monkeypatch.setattr(topk, name, size)
    whole = topk._whole

    def watched(function, schema):
        apply = whole(function, schema)

        def check(left, right):
            assert left.num_rows <= 16 and right.num_rows <= 32, (left.num_rows, right.num_rows)
            return apply(left, right)

        return check

    monkeypatch.setattr(topk, "_whole", watched)
    rows = [(i, [(i % 5, 1 + i % 7), (5 + i % 3, 2)]) for i in range(200)]
    frame = spark.createDataFrame(rows, SPARSE)
    got = topk.top_k(frame, frame, 3)
    assert sorted(map(tuple, got.select("query_id", "rank", "id", "score").collect())) == best(rows, rows, 3)


def test_top_k_of_few_or_none(spark):
    rows = [(1, [(0, 2)]), (2, [(0, 1)])]
    frame = spark.createDataFrame(rows, SPARSE)
    assert len(topk.top_k(frame, frame, 5).collect()) == 2
    assert topk.top_k(frame, frame.limit(0), 5).collect() == []
    assert topk.top_k(frame.limit(0), frame, 5).collect() == []


def test_odd_vectors_take_no_part(spark):
    nan = float("nan")
    rows = [(1, [1.0, 2.0]), (2, None), (3, [1.0, None]), (4, [nan, 1.0]), (5, [float("inf"), 1.0]), (None, [1.0, 1.0]), (6, [0.0, 1.0]), (6, [0.0, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("id", F.lit("x"))
    got = finite_vectors(frame, "vec_id", "embedding").collect()
    assert sorted((r["id"], r["v"]) for r in got) == [(1, [1.0, 2.0]), (6, [0.0, 1.0]), (6, [0.0, 1.0])]


def dense(spark, rows):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows], "id long, v array<double>")


def test_forest_recall_scores_and_copies(spark, monkeypatch):
    monkeypatch.setattr(forest, "CHUNK_ROWS", 50)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 16))
    v = centres[rng.integers(0, 12, 1500)] + 0.4 * rng.normal(size=(1500, 16))
    v[500:1000] = v[500]  # a third of all rows are one vector
    rows = list(enumerate(v))
    queries = [r for r in rows if r[0] % 20 == 0]
    got = forest.nearest(dense(spark, rows), dense(spark, queries), 10, leaf_rows=40, search_share=1.0, search_least=300).collect()
    found = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        assert r["score"] == pytest.approx(float(v[r["query_id"]] @ v[r["id"]]), abs=1e-9)
        found.setdefault(r["query_id"], []).append(r["id"])
    hits = 0
    for q, x in queries:
        scores = v @ x
        want = [i for i in np.lexsort((np.arange(1500), -np.round(scores, 9))) if i != q][:10]
        assert len(found[q]) == 10 and q not in found[q]
        hits += len(set(want) & set(found[q]))
    assert hits / (10 * len(queries)) >= 0.9


def test_forest_of_few_or_none(spark):
    rows = dense(spark, [(1, [1, 0]), (2, [2, 0]), (3, [2, 0])])
    got = [tuple(r) for r in forest.nearest(rows, rows.where("id = 3"), 5).orderBy("rank").collect()]
    assert got == [(3, 1, 2, 4.0), (3, 2, 1, 2.0)]
    assert forest.nearest(rows.limit(0), rows, 5).collect() == []
    assert forest.nearest(rows, rows.limit(0), 5).collect() == []


@pytest.fixture(scope="module")
def repeated(spark, small, tmp_path_factory):
    """Embeddings with rows that repeat an id, some of them queries, with other vectors and with the same."""
    folder = str(tmp_path_factory.mktemp("repeated"))
    table = spark.read.parquet(f"{small}/embeddings.parquet")
    other = table.where("vec_id between 4 and 9").withColumns({"vec_id": F.col("vec_id") % 2 * 50 + 3, "embedding": F.transform("embedding", lambda x: x * 2)})
    more = table.where("vec_id = 12").withColumn("vec_id", F.explode(F.array(*[F.lit(i) for i in (0, 20, 50, 50, 60, 61, 61)])))
    odd = spark.createDataFrame([(7, None), (7, [float("nan")] * 64), (None, [1.0] * 64)], "vec_id long, embedding array<float>")
    table.unionByName(other).unionByName(more).unionByName(odd.withColumn("label", F.lit(0))).write.parquet(f"{folder}/embeddings.parquet")
    return folder


def test_repeated_ids_are_candidates_each(spark, repeated):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{repeated}/embeddings.parquet/*.parquet'")
    want = con.execute(SQL["op2_exact_top_k"]).fetchall()
    got = QUERIES["op2_exact_top_k"](spark, repeated).select("query_id", "rank", "vec_id", "score").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_forest_query_recall_and_exact_scores(spark, repeated):
    rows = [(r["vec_id"], np.array(r["embedding"], float)) for r in spark.read.parquet(f"{repeated}/embeddings.parquet").collect() if r["vec_id"] is not None and r["embedding"]]
    rows = [(i, v) for i, v in rows if np.isfinite(v).all() and v.any()]
    asked = {}
    for i, v in rows:
        if i % 20 == 0 and (i not in asked or v.tolist() > asked[i].tolist()):
            asked[i] = v
    got = QUERIES["op3_random_projection_forest"](spark, repeated).collect()
    found, hits = {}, 0
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert set(found) == set(asked)
    for q, v in asked.items():
        scored = sorted(((-float(v @ x), i) for i, x in rows if i != q))[:20]
        mine = found[q]
        assert len(mine) == 20 and [s for _, s in mine] == sorted((s for _, s in mine), reverse=True)
        known = {}
        for i, x in rows:
            known.setdefault(i, []).append(float(v @ x))
        assert all(min(abs(s - t) for t in known[i]) < 1e-12 for i, s in mine) and q not in [i for i, _ in mine]
        left = [i for _, i in scored]
        for i, _ in mine:
            if i in left:
                left.remove(i)
                hits += 1
    assert hits / (20 * len(asked)) >= 0.9
