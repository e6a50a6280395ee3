import os

import duckdb
import pytest

import corpus_pipeline
from crewcast.llm.queries import QUERIES
from crewcast.llm.sql import SQL


def plain(frame):
    frame = frame[sorted(frame.columns)]
    return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in frame.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_match_sql(spark, small, name):
    con = duckdb.connect()
    for file in os.listdir(small):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{small}/{file}'")
    got, want = QUERIES[name](spark, small).toPandas(), con.execute(SQL[name]).fetchdf()
    assert len(got) and sorted(got.columns) == sorted(want.columns)
    assert plain(got) == plain(want)


def test_stages(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    planted = [(10_000 + i, f"a note {i} with token=abcdef{i} and AKIA{'Z' * 16}", "en", "src0", 1) for i in range(9)]
    docs = docs.unionByName(spark.createDataFrame(planted, "doc_id long, text string, lang string, source string, n_chars long"))
    columns, kept = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, small).write.parquet(f"{tmp_path}/{k}")
        after = spark.read.parquet(f"{tmp_path}/{k}")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert after.columns == columns
        kept[name] = (docs.toPandas(), after.toPandas())
        docs = after
    before, after = kept["n-gram Jaccard join"]
    assert set(after.doc_id) <= set(before.doc_id) and len(after) < len(before)
    before, after = kept["secret scans"]
    assert list(sorted(before.doc_id)) == list(sorted(after.doc_id))
    assert after.text.str.contains("[SECRET]", regex=False).any() and not after.text.str.contains("AKIA[A-Z0-9]{16}").any()
    before, after = kept["mixing sources to target weights"]
    words = lambda f: f.text.str.encode("utf-8").map(lambda b: len(b.split())).sum()
    assert abs(words(after) - words(before)) <= before.source.nunique()
    last = kept["SentencePiece encoding and decoding"][1]
    assert (last.n_tokens == last.ids.map(len)).all() and len(last) == len(after)


def test_empty_and_odd_documents(spark, small, tmp_path):
    odd = spark.createDataFrame(
        [(1, None, "en", "a", None), (1, "", None, None, 0), (None, "token=abcdefgh", "en", "a", 3)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    for case, docs in {"odd": odd, "empty": odd.limit(0)}.items():
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            stage(spark, docs, small).write.parquet(f"{tmp_path}/{case}{k}")
            docs = spark.read.parquet(f"{tmp_path}/{case}{k}")
        assert docs.count() == 0 if case == "empty" else docs.count() >= 1


def test_run_leaves_its_result_only(spark, small):
    from crewcast.session import written_so_far

    mark = written_so_far()
    rows = corpus_pipeline.run(spark, small)
    assert written_so_far() == mark + 1
    assert rows.count() > 0 and {"doc_id", "ids", "n_tokens", "text"} <= set(rows.columns)
