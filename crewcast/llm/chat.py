"""Chat formatting: a hidden Markov model recovers the roles of transcript lines, then turns are rendered."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crewcast.llm.common import fresh
from crewcast.operators.ranking import spread_rank
from crewcast.session import materialise

ROLES = ("user", "assistant", "system")

#: Ways in which raw transcripts mark a speaker; 0, 1, 2 are the roles.
STYLES = (
    ("User: ", "Assistant: ", "System: "),
    ("Human: ", "AI: ", "Context: "),
    ("Q: ", "A: ", "S: "),
    ("### Instruction: ", "### Response: ", "### System: "),
    ("[user] ", "[assistant] ", "[system] "),
    ("<|prompt|> ", "<|model|> ", "<|system|> "),
)

#: A state is a role and whether the line goes on with a turn: 2 * role + (1 if it goes on).
N_STATES = 2 * len(ROLES)

#: Turns of a conversation in one part. Parts are parsed apart and joined at their ends.
PART_TURNS = 64

#: A marker: a short head in brackets, between bars or before a colon, at the start of a line.
_MARKER = re.compile(r"^[#*\s]*(?:\[([^\[\]\n]{1,24})\]|<\|([^|\n]{1,24})\|>|([^\s:\[\]<>|][^:\n]{0,23}?)\**\s*:(?=\s|$))\s*")

#: Words of a head at most.
HEAD_WORDS = 3

#: Heads that a transcript repeats but learning did not meet count by their order of appearance, up to so many.
NEW_HEADS = 3

#: Symbols of the marker feature before those of the heads learnt: no marker, then new heads.
PLAIN = 1 + NEW_HEADS

#: A head is learnt if one line in so many, or more, has it; so there are no more heads than that.
HEAD_SHARE = 10_000

#: Values of the other line features: length, question, empty line.
SIZES = (8, 2, 2)


def head_of(line: str) -> tuple[str | None, int]:
    """The head of a line's marker in lower case, and where the words after it begin."""
    found = _MARKER.match(line)
    head = next(g for g in found.groups() if g).strip().lower() if found else ""
    return (head, found.end()) if head and len(head.split()) <= HEAD_WORDS else (None, 0)


@dataclass(frozen=True)
class Marked:
    """The lines of a text: symbol of the marker (0: none), where the words begin, and the other features."""

    symbols: np.ndarray
    starts: list[int]
    others: np.ndarray


def marked(lines: list[str], heads: dict[str, int]) -> Marked:
    """Heads learnt have symbols of their own; others are markers if the text repeats them, told apart by their order."""
    found = [head_of(x) for x in lines]
    times = Counter(h for h, _ in found if h is not None)
    new: dict[str, int] = {}
    symbols, starts, others = [], [], []
    for line, (head, at) in zip(lines, found):
        symbol = heads.get(head, 0)
        if not symbol and head is not None and times[head] > 1:
            symbol = 1 + min(new.setdefault(head, len(new)), NEW_HEADS - 1)
        symbols.append(symbol)
        starts.append(at if symbol else 0)
        words = line[starts[-1] :].strip()
        size = min(7, len(words).bit_length() // 2 if len(words) < 64 else len(words).bit_length() - 3)
        others.append((size, int(words.endswith("?")), int(not words)))
    return Marked(np.array(symbols, int), starts, np.array(others, int).reshape(len(lines), len(SIZES)))


@dataclass(frozen=True)
class Model:
    """Logs of the chances of the first state, of the next state, and of feature values in a state; heads and their symbols."""

    start: np.ndarray
    step: np.ndarray
    emit: tuple[np.ndarray, ...]
    heads: dict[str, int]

    def lines(self, lines: list[str]) -> np.ndarray:
        found = marked(lines, self.heads)
        columns = [found.symbols, *found.others.T]
        return sum(table[:, c] for table, c in zip(self.emit, columns)).T


def learn(transcripts: DataFrame, add: float = 0.2) -> Model:
    """Count states, steps and features over transcripts with ``text`` and ``truth`` (state of each line, -1 unknown).

    What marks a speaker is learnt, not given: any short head in brackets, between bars or
    before a colon that is frequent enough becomes a symbol, with its chances in each
    state. All lines are counted once more as if no head were known, which gives the
    chances of new heads by their order. The counts are summed over all rows; what comes
    to the driver is the tables' size.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()

        def flush() -> pa.RecordBatch:
            columns = [[k[i] for k in found] for i in range(3)] + [list(found.values())]
            kinds = (pa.string(), pa.int32(), pa.string(), pa.int64())
            out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["what", "a", "b", "n"])
            found.clear()
            return out

        for b in batches:
            for text, truth, part in zip(*(c.to_pylist() for c in b.columns)):
                lines, last = text.split("\n"), -1
                shapes = marked(lines, {})
                for i, (line, state) in enumerate(zip(lines, truth)):
                    if state >= 0:
                        if last >= 0:
                            found["step", last, str(state)] += 1
                        elif i == 0 and part == 0:
                            found["start", 0, str(state)] += 1
                        found["emit0", state, str(shapes.symbols[i])] += 1
                        head, _ = head_of(line)
                        if head is not None:
                            found["head", state, head] += 1
                        for k, v in enumerate(shapes.others[i].tolist(), 1):
                            found[f"emit{k}", state, str(v)] += 1
                    last = state
            if len(found) > 200_000:
                yield flush()
        yield flush()

    counted = transcripts.select("text", "truth", "first").mapInArrow(count, "what string, a int, b string, n long")
    counted = materialise(counted.groupBy("what", "a", "b").agg(F.sum("n").alias("n")), "chat-counts")
    lines = counted.where("what = 'emit0'").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    often = counted.where("what = 'head'").groupBy("b").agg(F.sum("n").alias("n")).where((F.col("n") > 1) & (F.col("n") * HEAD_SHARE >= lines))
    heads = {r["b"]: PLAIN + i for i, r in enumerate(often.select("b").orderBy("b").collect())}
    tables = {"start": np.full((1, N_STATES), add), "step": np.full((N_STATES, N_STATES), add)}
    tables |= {f"emit{k}": np.full((N_STATES, n), add) for k, n in enumerate((PLAIN + len(heads), *SIZES))}
    for r in counted.where("what != 'head'").collect():
        tables[r["what"]][r["a"], int(r["b"])] += r["n"]
    for r in counted.where("what = 'head'").join(F.broadcast(often.select("b")), "b").collect():  # within the share
        tables["emit0"][r["a"], heads[r["b"]]] += r["n"]
    logs = {k: np.log(t / t.sum(1, keepdims=True)) for k, t in tables.items()}
    return Model(logs["start"][0], logs["step"], tuple(logs[f"emit{k}"] for k in range(1 + len(SIZES))), heads)


def through(model: Model, lines: list[str]) -> np.ndarray:
    """Best log chance of a part from each state before it to each state at its end."""
    best = np.where(np.eye(N_STATES, dtype=bool), 0.0, -np.inf)
    for emitted in model.lines(lines):
        best = (best[:, :, None] + model.step[None]).max(1) + emitted
    return best


def viterbi(model: Model, lines: list[str], before: int | None, after: int | None) -> list[int]:
    """The likeliest states of a part's lines, given the state before it and the state at its end where known."""
    emitted = model.lines(lines)
    best = emitted[0] + (model.start if before is None else model.step[before])
    back = []
    for row in emitted[1:]:
        options = best[:, None] + model.step
        back.append(options.argmax(0))
        best = options.max(0) + row
    states = [int(best.argmax()) if after is None else after]
    for choices in reversed(back):
        states.append(int(choices[states[-1]]))
    return states[::-1]


def _ends(model: Model, parts: list[list[str]] | list[np.ndarray]) -> list[tuple[int | None, int]]:
    """State before and at the end of each part, from the parts' matrices in order.

    The first matrix starts in the start distribution, which its first line has in place of a step.
    """
    best, back = parts[0][0], []
    for matrix in parts[1:]:
        options = best[:, None] + matrix
        back.append(options.argmax(0))
        best = options.max(0)
    ends = [int(best.argmax())]
    for choices in reversed(back):
        ends.append(int(choices[ends[-1]]))
    ends = ends[::-1]
    return [(None, ends[0]), *zip(ends, ends[1:])]


def render(lines: list[str], states: list[int], heads: dict[str, int]) -> tuple[list[str], str]:
    """Roles of the turns, and the canonical text: each turn between its role's tag and an end tag.

    A marker is taken off where a turn starts.
    """
    turns: list[tuple[int, list[str]]] = []
    for line, state, at in zip(lines, states, marked(lines, heads).starts):
        if not turns or state % 2 == 0 or turns[-1][0] != state // 2:
            turns.append((state // 2, [line[at:].strip()]))
        else:
            turns[-1][1].append(line.strip())
    text = "".join(f"<|{ROLES[r]}|>\n" + "\n".join(x).strip("\n") + "\n<|end|>\n" for r, x in turns)
    return [ROLES[r] for r, _ in turns], text


def parse(transcripts: DataFrame, model: Model) -> DataFrame:
    """Add ``states`` (one a line), ``roles`` (one a turn) and ``rendered`` to parts of transcripts.

    ``transcripts`` has ``id``, ``part`` (order of the parts of an id) and ``text``. A
    transcript of one part is decoded at once. Of others each part gives the best chance
    from each state before it to each at its end; these small matrices are put in order,
    which settles the states at the seams, and each part is then decoded by itself, so a
    very long conversation is spread over tasks with the result of one Viterbi pass.

    Defined cases: an empty text is one empty line; null texts count as empty; a null id
    is an id; rows that repeat an id and part are decoded each, with one state at a seam;
    names of other columns are kept, an underscore is appended to an added one that clashes.
    """
    n_key, n_part, n_before, n_after, n_done, k = fresh(transcripts, "_key", "_part", "before", "after", "_d", "_k")
    states, roles, rendered = fresh(transcripts, "states", "roles", "rendered")
    source = transcripts.withColumn("text", F.coalesce("text", F.lit("")))
    key = F.coalesce(F.col("id").cast("string"), F.lit("null"))
    counts = source.groupBy(key.alias("_key")).agg(F.countDistinct("part").alias("_n")).where("_n > 1").select("_key")
    long = materialise(source.select(key.alias("_key"), "part", "first", "text").join(counts, "_key", "left_semi"), "chat-long")

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for part, text in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                lines = text.split("\n")
                if part == 0:
                    best = model.start + model.lines(lines[:1])[0]
                    for emitted in model.lines(lines[1:]) if lines[1:] else []:
                        best = (best[:, None] + model.step).max(0) + emitted
                    found = np.tile(best, (N_STATES, 1))
                else:
                    found = through(model, lines)
                out.append(found.ravel().tolist())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.list_(pa.float64()))], ["_key", "_part", "m"])

    small = long.dropDuplicates(["_key", "part"]).select("_key", "part", "first", "text")
    small = small.mapInArrow(matrices, "_key string, _part long, m array<double>")

    def seams(table: pa.Table) -> pa.Table:
        table = table.sort_by("_part")
        parts = [np.array(m).reshape(N_STATES, N_STATES) for m in table["m"].to_pylist()]
        found = _ends(model, parts)
        columns = [table["_key"], table["_part"], pa.array([a for a, _ in found], pa.int32()), pa.array([b for _, b in found], pa.int32())]
        return pa.table(columns, names=["_key", "_part", "before", "after"])

    known = small.groupBy("_key").applyInArrow(seams, "_key string, _part long, before int, after int").toDF(n_key, n_part, n_before, n_after)
    joined = source.withColumn(k, key).join(known, (F.col(k) == F.col(n_key)) & (F.col("part") == F.col(n_part)), "left")

    @F.arrow_udf("states array<int>, roles array<string>, rendered string")
    def decode(text: pa.Array, before: pa.Array, after: pa.Array) -> pa.Array:
        out = []
        for t, a, b in zip(text.to_pylist(), before.to_pylist(), after.to_pylist()):
            lines = t.split("\n")
            states = viterbi(model, lines, a, b)
            roles, rendered = render(lines, states, model.heads)
            out.append({"states": states, "roles": roles, "rendered": rendered})
        kind = pa.struct([("states", pa.list_(pa.int32())), ("roles", pa.list_(pa.string())), ("rendered", pa.string())])
        return pa.array(out, kind)

    decoded = joined.withColumn(n_done, decode("text", n_before, n_after))
    found = [F.col(f"{n_done}.{c}").alias(n) for c, n in (("states", states), ("roles", roles), ("rendered", rendered))]
    return decoded.select(*[F.col(f"`{c}`") for c in transcripts.columns], *found)


def raw_transcripts(
    conversations: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """(id, style, part, first, text, truth): conversations as the raw text that a dump of chats holds.

    A hash of the id picks the way speakers are marked (``style``); about one marker in six
    is missing. ``truth`` is the state of each line. Turns stand in parts of at most
    ``PART_TURNS``, whatever their numbers; ``first`` is 0 for the first part. Rows without
    a turn stand before the others; equal turns go by a hash of role and text.
    """
    role = F.array_position(F.array(*map(F.lit, ROLES)), F.coalesce(F.col(role_col), F.lit(""))).cast("int") - 1
    number = F.pmod(F.xxhash64(F.lit("style"), id_col), F.lit(len(STYLES))).cast("int")
    heads = F.get(F.array(*[F.array(*map(F.lit, s)) for s in STYLES]), number)
    marked = F.pmod(F.xxhash64(F.lit("mark"), id_col, turn_col, text_col), F.lit(6)) > 0
    text = F.coalesce(F.col(text_col), F.lit(""))
    shown = F.when(marked & (role >= 0), F.concat(F.get(heads, role), text)).otherwise(text)
    states = F.transform(F.split(text, "\n"), lambda x, i: F.when(role < 0, -1).otherwise(2 * role + (i > 0).cast("int")))
    turns = conversations.select(
        F.col(id_col).alias("id"), number.alias("style"), F.coalesce(F.col(turn_col).cast("long"), F.lit(-(2**62))).alias("turn"),
        F.xxhash64(text_col, role_col).alias("tie"), shown.alias("shown"), states.alias("states"),
    )
    placed = spread_rank(turns, ["id"], ["turn", "tie"], "pos")
    placed = placed.withColumn("part", F.floor(F.col("pos") / PART_TURNS).cast("long"))
    turn = F.struct("pos", "shown", "states")
    parts = placed.groupBy("id", "style", "part").agg(F.array_sort(F.collect_list(turn)).alias("ts"))  # PART_TURNS turns at most
    return parts.select(
        "id",
        "style",
        "part",
        F.col("part").alias("first"),
        F.array_join(F.transform("ts", lambda x: x["shown"]), "\n").alias("text"),
        F.flatten(F.transform("ts", lambda x: x["states"])).alias("truth"),
    )
