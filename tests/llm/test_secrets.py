import random
import re

import pytest
from pyspark.sql import functions as F

from crewcast.llm import secrets

BASE = [
    ("assign", re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
]
TEXTS = [
    None,
    "",
    "nothing here",
    "password=hunter22 and 😀 Token : 'abc.def-ghi'",
    "api_key=token: abcdefgh apikey=\"12345\" APIKEY=123456",
    "AKIA" + "A1" * 8 + " AKIAAKIA" + "B" * 12 + " AKIA123",
    "é" * 3 + "0123456789abcdef01234567" + "g" + "a" * 23 + "g" + "b" * 30,
    "secret=token=abcdefgh" + " secret: x" * 300 + " passwd=zzzzzz" * 300,
    "tok en sec ret pass word",
    "-----BEGIN RSA PRIVATE KEY----- ghp_" + "a1B2" * 9,
    "x" * 100_000 + " token=abcdef",
]


def base_spans(text):
    found = [
        (m.start(), i, m.end(), kind)
        for i, (kind, pattern, group, least) in enumerate(BASE)
        for m in pattern.finditer(text or "")
        if len(m[group]) >= least
    ]
    return [f"{kind}:{a}:{b}" for a, _, b, kind in sorted(found)]


@pytest.mark.parametrize("broadcast_rows", [0, 1000])
def test_base_spans(documents, broadcast_rows):
    rows = [*enumerate(TEXTS), (3, "token=abcdef"), (3, TEXTS[3]), (None, TEXTS[3])]
    frame = documents(rows)
    got = secrets.find_secrets(frame, secrets.BASE, broadcast_rows=broadcast_rows)
    assert got.columns == [*frame.columns, "secrets_"]
    texts = got.select("doc_id", "text", secrets.span_text(got["secrets_"]).alias("spans")).collect()
    assert len(texts) == len(rows)
    for r in texts:
        assert r["spans"] == ",".join(base_spans(r["text"]))


def test_more_kinds(documents):
    got = secrets.find_secrets(documents([(1, TEXTS[9])]), out="found").first()["found"]
    assert [s["kind"] for s in got] == ["pem", "github"]


def test_mask(documents):
    frame = secrets.find_secrets(documents([(1, "é token=abcdef, AKIA" + "A" * 16 + "!"), (2, "plain"), (3, None)]), out="f")
    got = {r[0]: r[1] for r in frame.select("doc_id", secrets.masked(frame["text"], frame["f"])).collect()}
    assert got == {1: "é [SECRET], [SECRET]!", 2: "plain", 3: None}


def test_mask_of_overlapping_spans(spark):
    def plain(text, spans):
        out, at = [], 0
        for a, b in spans:
            if a >= at:
                out += [text[at:a], "[SECRET]"]
            at = max(at, b)
        return "".join(out) + text[at:]

    rng, rows = random.Random(1), []
    for i in range(200):
        text = "".join(rng.choice("abé中 😀") for _ in range(rng.randint(1, 60)))
        starts = sorted(rng.randrange(len(text)) for _ in range(rng.randint(0, 30)))
        rows.append((i, text, sorted(("k", a, min(len(text), a + rng.randint(1, 9))) for a in starts)))
    frame = spark.createDataFrame(rows, "id long, text string, s array<struct<kind:string,start:long,end:long>>")
    got = dict(frame.select("id", secrets.masked(frame["text"], frame["s"])).collect())
    assert got == {i: plain(t, [(a, b) for _, a, b in s]) for i, t, s in rows}


def test_very_many_secrets_in_a_text(documents):
    n = 20_000
    frame = secrets.find_secrets(documents([(1, "é token=abcdef12; " * n)]), out="f")
    [row] = frame.select(F.size("f").alias("n"), secrets.masked(frame["text"], frame["f"]).alias("m")).collect()
    assert row["n"] == n and row["m"] == "é [SECRET]; " * n


def test_trigram_queries():
    kinds = {r.kind: secrets.trigram_query(r.pattern) for r in secrets.BASE}
    assert kinds["hex"] == []
    assert kinds["access"] == [[frozenset({"aki", "kia"})]]
    assert frozenset({"tok", "oke", "ken"}) in kinds["assign"][0]
    assert secrets.trigram_query("ab|cde") == []
    assert secrets.trigram_query("abc.*def") == [[frozenset({"abc"})], [frozenset({"def"})]]


def test_empty_table(documents):
    assert secrets.find_secrets(documents([])).collect() == []
