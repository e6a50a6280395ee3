"""SentencePiece encoding and decoding through a table of distinct chunks."""

from __future__ import annotations

import itertools
import re
import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crewcast.llm.common import lean

MARK = "▁"
ENCODED = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())])

#: Bytes that a task's table of distinct chunks may take, about. A full table is emptied and filled anew.
TABLE_BYTES = 70_000_000

#: Longer chunks are encoded each time and not kept.
LONG_CHUNK = 64

#: Characters that a task works on at a time, about; a longer text is taken apart at white space.
PORTION_CHARS = 500_000

#: Texts that are made Python strings at a time.
TAKEN_TEXTS = 256

#: Python's own bytes for a string, its place in the table and in lists, about.
_OBJECTS = 140


def read_model(path: str) -> bytes:
    """The model file (some hundred kB). It is read once, by the driver, and travels with the function."""
    with open(path, "rb") as file:
        return file.read()


def processor(model: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=model)


def check_chunks(model: bytes) -> None:
    """Raise unless no piece has a white-space mark after another character and the text is taken as it is."""
    sp = processor(model)
    crossing = [p for p in map(sp.id_to_piece, range(sp.vocab_size())) if MARK in p.lstrip(MARK)]
    if crossing:
        raise ValueError(f"pieces cross white-space marks: {crossing[:3]}")
    if sp.decode(sp.encode("  a \n b")) != "  a \n b":
        raise ValueError("the model changes white space, so marked words do not stand alone")


class ChunkTable:
    """Row of each distinct marked word: its ids, and its decoded text where that is not the word itself.

    A chunk is a run of marks with what follows up to the next mark. Merges happen only
    inside of pieces, and no piece goes on from another character to a mark, so the
    pieces of a text are the pieces of its chunks, one after the other.
    """

    def __init__(self, model: bytes):
        self.sp = processor(model)
        self.mark = [self.sp.piece_to_id(MARK)]
        self.reset()

    def reset(self) -> None:
        self.rows: dict[str, int] = {}
        self.ids, self.ends, self.other, self.used = np.zeros(1 << 16, np.int32), np.zeros(1 << 12, np.int64), {}, 0

    def _segmented(self, chunks: list[str]) -> tuple[list[list[int]], dict[int, str]]:
        """Ids of chunks, and by number the decoded text of those that decode to something else."""
        if not chunks:
            return [], {}
        found = self.sp.encode([c[1:] for c in chunks], num_threads=1)  # the library puts the first mark back
        if MARK in chunks:
            found = [self.mark if c == MARK else ids for c, ids in zip(chunks, found)]
        texts = self.sp.decode(found, num_threads=1)
        plain = "\n".join(texts) == "\n".join(chunks).replace(MARK, " ").replace("\n ", "\n")[1:]
        if plain:
            return found, {}
        return found, {i: f" {t}" for i, (c, t) in enumerate(zip(chunks, texts)) if c[1:].replace(MARK, " ") != t}

    def add(self, chunks: list[str]) -> None:
        """Segment the short chunks that the table does not have yet."""
        if self.used > TABLE_BYTES:
            self.reset()
        new = [c for c in dict.fromkeys(chunks) if len(c) <= LONG_CHUNK and c not in self.rows]
        if not new:
            return
        found, other = self._segmented(new)
        n, upto = len(self.rows), int(self.ends[len(self.rows)])
        ends = upto + np.cumsum(list(map(len, found)), dtype=np.int64)
        last = int(ends[-1])
        self.ids, self.ends = _grown(self.ids, last), _grown(self.ends, n + len(new) + 1)
        self.ids[upto:last] = np.fromiter(itertools.chain.from_iterable(found), np.int32, last - upto)
        self.ends[n + 1 : n + 1 + len(new)] = ends
        self.rows.update(zip(new, range(n, n + len(new))))
        self.other.update({n + i: t for i, t in other.items()})
        self.used += sum(map(sys.getsizeof, new)) + len(new) * _OBJECTS + 4 * (last - upto) + len(other) * 2 * _OBJECTS

    def joined(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, dict[int, str]]:
        """Number of ids of each chunk, all ids, and by number the chunks that decode to something else.

        Long chunks are segmented here and not kept.
        """
        self.add(chunks)
        row = np.fromiter(map(self.rows.get, chunks, itertools.repeat(-1)), np.int64, len(chunks))
        long = np.flatnonzero(row < 0)
        other = {}
        if self.other:
            strange = np.zeros(len(self.rows) + 1, bool)  # the last place is that of long chunks
            strange[list(self.other)] = True
            other = {i: self.other[row[i]] for i in np.flatnonzero(strange[row]).tolist()}
        starts, sizes = self.ends[row], self.ends[row + 1] - self.ends[row]
        if not len(long):
            return sizes, self.ids[np.repeat(starts, sizes) + _ranges(sizes)], other
        found, texts = self._segmented([chunks[i] for i in long])
        other |= {int(long[i]): t for i, t in texts.items()}
        sizes[long] = list(map(len, found))
        from_table = np.repeat(row >= 0, sizes)
        flat = np.empty(len(from_table), np.int32)
        kept = row >= 0
        flat[from_table] = self.ids[np.repeat(starts[kept], sizes[kept]) + _ranges(sizes[kept])]
        flat[~from_table] = np.fromiter(itertools.chain.from_iterable(found), np.int32)
        return sizes, flat, other


def _ranges(sizes: np.ndarray) -> np.ndarray:
    """0 .. n-1 for each n, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)


def _grown(held: np.ndarray, size: int) -> np.ndarray:
    if size <= len(held):
        return held
    out = np.zeros(max(size, 2 * len(held)), held.dtype)
    out[: len(held)] = held
    return out


CHUNK = re.compile(f"{MARK}+[^{MARK}]*")
_BORDER = re.compile(f"(?<=[^ {MARK}])[ {MARK}]")


def chunks_of(text: str, first: bool = True) -> list[str]:
    """Marked words of a text; what follows a text's first part keeps the mark that it starts with."""
    return CHUNK.findall((MARK if first else "") + text.replace(" ", MARK)) if text else []


def parts_of(text: str) -> Iterator[str]:
    """A text in parts of about ``PORTION_CHARS``, each but the first from a mark behind a word on."""
    start = 0
    while len(text) - start > PORTION_CHARS and (border := _BORDER.search(text, start + PORTION_CHARS)):
        yield text[start : border.start()]
        start = border.start()
    yield text[start:]


def portions(texts: Iterable[str]) -> Iterator[list[str]]:
    """Consecutive texts of about ``PORTION_CHARS`` together; a longer one stands alone."""
    part, size = [], 0
    for text in texts:
        if part and size + len(text) > PORTION_CHARS:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text)
    if part:
        yield part


def encode_batch(table: ChunkTable, texts: list[str]) -> tuple[pa.ListArray, pa.Array]:
    """Ids and decoded text of each text: rows of its chunks, joined back by position."""
    if len(texts) == 1:
        return _encode_long(table, texts[0])
    found = [chunks_of(t) for t in texts]
    chunks = list(itertools.chain.from_iterable(found))
    sizes, flat, other = table.joined(chunks)
    upto = np.concatenate([[0], np.cumsum(sizes)])
    last = np.concatenate([[0], np.cumsum([len(f) for f in found], dtype=np.int64)])
    decoded = [t.replace(MARK, " ") for t in texts]
    for i in np.unique(np.searchsorted(last, np.array(list(other), np.int64), "right") - 1).tolist():
        decoded[i] = _decoded(chunks, int(last[i]), int(last[i + 1]), other)[1:]
    return pa.ListArray.from_arrays(pa.array(upto[last], pa.int32()), pa.array(flat, pa.int32())), pa.array(decoded, pa.string())


def _decoded(chunks: list[str], start: int, end: int, other: dict[int, str]) -> str:
    return "".join([other[k] if k in other else chunks[k].replace(MARK, " ") for k in range(start, end)])


def _encode_long(table: ChunkTable, text: str) -> tuple[pa.ListArray, pa.Array]:
    """One text, part by part: of a part only ids and decoded text stay."""
    ids, decoded = [], []
    for i, part in enumerate(parts_of(text)):
        chunks = chunks_of(part, first=i == 0)
        _, flat, other = table.joined(chunks)
        ids.append(flat)
        decoded.append(_decoded(chunks, 0, len(chunks), other))
    flat = np.concatenate(ids)
    return pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), pa.array(flat, pa.int32())), pa.array(["".join(decoded)[1:]], pa.string())


def _strings(texts: pa.Array) -> Iterator[str]:
    """A batch's texts, a few made Python strings at a time."""
    for start in range(0, len(texts), TAKEN_TEXTS):
        yield from (t or "" for t in texts.slice(start, TAKEN_TEXTS).to_pylist())


def encoder(model: bytes):
    """A column function: text -> struct(ids, decoded).

    ``ids`` are those of the library for the whole text, without begin or end; ``decoded``
    is what the library decodes them to. Each task segments and decodes a distinct marked
    word once and joins its ids back by position.

    Defined cases: a null text counts as empty; an empty text has no ids and decodes to
    an empty text; bytes that no piece covers become byte pieces; a text without white
    space is one chunk, and chunks of over ``LONG_CHUNK`` characters are segmented anew each
    time; other columns are not touched.
    """
    check_chunks(model)

    @F.arrow_udf(ENCODED)
    @lean
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = ChunkTable(model)
        for texts in batches:
            for part in portions(_strings(texts)):
                yield pa.StructArray.from_arrays(encode_batch(table, part), ["ids", "decoded"])

    return encode


def decoder(model: bytes):
    """A column function: array of ids -> text, as the library decodes them; null ids count as none."""

    @F.arrow_udf(T.StringType())
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        sp = processor(model)
        for ids in batches:
            yield pa.array([sp.decode(x or []) for x in ids.to_pylist()], pa.string())

    return decode


def ids_text(ids: Column) -> Column:
    """Decimal ids joined by commas."""
    return F.array_join(ids.cast("array<string>"), ",")
