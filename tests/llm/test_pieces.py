import random

import public_tokenizers
from pyspark.sql import functions as F

from crewcast.llm import pieces

MODEL = pieces.read_model(public_tokenizers.path("piece_bpe_32k.model"))


def texts():
    rng = random.Random(2)
    parts = ["a", "the", " ", "  ", "▁", "\n", "\t", "é", "　", "中", "\x00", "😀", "ﬁ", "<s>", "<unk>", "<0x0A>", "​", "ing"]
    return [None, "", " ", "▁", "word " * 5000, *["".join(rng.choice(parts) for _ in range(rng.randint(0, 15))) for _ in range(400)]]


def test_like_the_library(documents):
    sp = pieces.processor(MODEL)
    frame = documents(list(enumerate(texts())))
    encoded = frame.withColumn("e", pieces.encoder(MODEL)("text"))
    got = encoded.select("text", "e.ids", "e.decoded", pieces.decoder(MODEL)(F.col("e.ids")).alias("again")).collect()
    assert len(got) == 405
    for r in got:
        ids = sp.encode(r["text"] or "")
        assert r["ids"] == ids
        assert r["decoded"] == r["again"] == sp.decode(ids)


def test_small_tables_and_portions(monkeypatch):
    monkeypatch.setattr(pieces, "TABLE_BYTES", 800)
    table, sp = pieces.ChunkTable(MODEL), pieces.processor(MODEL)
    for part in pieces.portions(["a b c d", "", "b c e " * 9, "a"]):
        ids, decoded = pieces.encode_batch(table, part)
        assert ids.to_pylist() == sp.encode(part) and decoded.to_pylist() == part
    assert [len(p) for p in pieces.portions(["x" * 400_000, "x" * 300_000, "y"])] == [1, 2]


def test_long_texts_in_parts(monkeypatch):
    monkeypatch.setattr(pieces, "PORTION_CHARS", 11)
    monkeypatch.setattr(pieces, "LONG_CHUNK", 5)
    table, sp = pieces.ChunkTable(MODEL), pieces.processor(MODEL)
    rng = random.Random(3)
    parts = ["a", "the ", " ", "   ", "▁", " ▁ ", "中" * 9, "word ", "\n", "internationalisation "]
    for text in ["", " ", *["".join(rng.choice(parts) for _ in range(rng.randint(1, 60))) for _ in range(300)]]:
        assert "".join(pieces.parts_of(text)) == text
        ids, decoded = pieces.encode_batch(table, [text])
        assert ids.to_pylist() == [sp.encode(text)] and decoded.to_pylist() == [sp.decode(sp.encode(text))]


def test_the_table_is_bounded_by_bytes():
    """Texts without white space are one chunk each and are not kept; short ones are, up to the bound."""
    table, sp = pieces.ChunkTable(MODEL), pieces.processor(MODEL)
    long = ["".join(chr(0x4E00 + (7 * i + 13 * j) % 9000) for j in range(2000)) for i in range(5000)]
    for part in pieces.portions(long):
        ids, _ = pieces.encode_batch(table, part)
    assert ids.to_pylist()[-1] == sp.encode(long[-1])
    assert not table.rows and table.used == 0
    for i in range(60):
        pieces.encode_batch(table, [" ".join(f"w{i}x{j}" for j in range(20_000)), ""])
        assert table.used <= pieces.TABLE_BYTES + 20_000_000
    assert len(table.rows) < 500_000


def test_empty_table(documents):
    assert documents([]).withColumn("e", pieces.encoder(MODEL)("text")).collect() == []
