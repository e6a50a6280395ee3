"""Secret scans through an inverted index of trigrams, with DataFrame operations only."""

from __future__ import annotations

import itertools
import re._parser as regex_parser
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crewcast.llm.common import fresh, let
from crewcast.session import materialise


@dataclass(frozen=True)
class Rule:
    """A kind of secret: a match of ``pattern`` whose ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: The base kinds, in the order of the result, and two more.
BASE = (
    Rule(
        "assign",
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    # A run of the class is matched whole or not at all, so a least length inside the
    # pattern finds the same spans as dropping short matches does.
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
)

#: Candidates up to this many rows (16 bytes each) are sent to every task; more are joined by a shuffle.
BROADCAST_ROWS = 500_000

#: Strings that a run of literals may stand for before the run is cut.
MOST_STRINGS = 64

#: AND of ORs of trigram sets.
Query = list[list[frozenset[str]]]


def _strings(tree, most: int) -> list[str] | None:
    """All strings that a parsed expression matches, lower-cased; None if they are too many."""
    out = [""]
    for op, arg in tree:
        name = str(op)
        if name == "LITERAL":
            piece = [chr(arg).lower()]
        elif name == "IN":
            piece = _members(arg)
        elif name == "SUBPATTERN":
            piece = _strings(arg[3], most)
        elif name == "BRANCH":
            parts = [_strings(x, most) for x in arg[1]]
            piece = None if None in parts else [s for p in parts for s in p]
        elif name == "MAX_REPEAT" and arg[1] <= 8:
            one = _strings(arg[2], most)
            piece = None if one is None else [s for n in range(arg[0], arg[1] + 1) for s in _repeated(one, n, most)]
        else:
            piece = None
        if piece is None or len(out) * len(piece) > most:
            return None
        out = [a + b for a in out for b in dict.fromkeys(piece)]
    return out


def _members(items) -> list[str] | None:
    chars: list[str] = []
    for op, arg in items:
        if str(op) == "LITERAL":
            chars.append(chr(arg).lower())
        elif str(op) == "RANGE" and arg[1] - arg[0] < 8:
            chars += [chr(c).lower() for c in range(arg[0], arg[1] + 1)]
        else:
            return None
    return list(dict.fromkeys(chars))


def _repeated(strings: Sequence[str], n: int, most: int) -> list[str]:
    if len(strings) ** n > most:
        return list(itertools.islice(("".join(x) for x in itertools.product(strings, repeat=n)), most + 1))
    return ["".join(x) for x in itertools.product(strings, repeat=n)]


def trigram_query(pattern: str) -> Query:
    """What every match contains: for each run of literals, the trigrams of one of its strings.

    The expression is cut into runs that stand for few strings; anything else (large
    classes, open repeats) ends a run. A run with a string of under three characters
    demands nothing. An empty result means that no trigram is mandatory.
    """
    query: Query = []
    run: list = []

    def close() -> None:
        strings = _strings(run, MOST_STRINGS) or [""]
        sets = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}
        if all(sets):
            query.append(sorted((s for s in sets if not any(t < s for t in sets)), key=sorted))
        run.clear()

    for item in regex_parser.parse(pattern):
        run.append(item)
        if _strings(run, MOST_STRINGS) is None:
            run.pop()
            close()
            if _strings([item], MOST_STRINGS) is not None:
                run.append(item)
    close()
    return query


def postings(docs: DataFrame, rules: Sequence[Rule], id_col: str, text_col: str) -> DataFrame:
    """The inverted index: (trigram, id) of every trigram that a rule's query names.

    Trigrams are those of the lower-cased text, whatever the rule's case, which can only
    add candidates. A document gives a trigram once.
    """
    wanted = sorted({t for r in rules for alternatives in trigram_query(r.pattern) for s in alternatives for t in s})
    low = docs.select(F.col(id_col).alias("id"), F.lower(text_col).alias("low")).where("id IS NOT NULL")
    found = F.array_compact(F.array(*[F.when(F.col("low").contains(t), F.lit(t)) for t in wanted]))
    return low.select("id", F.explode(found).alias("trigram"))


def candidates(index: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(id, rules): bit r is set where the postings satisfy the query of rule r."""
    spark = index.sparkSession
    rows, full = [], []
    for r, rule in enumerate(rules):
        query = trigram_query(rule.pattern)
        for g, alternatives in enumerate(query):
            for a, trigrams in enumerate(alternatives):
                rows += [(t, r, g, a, 1 << i, (1 << len(trigrams)) - 1, (1 << len(query)) - 1) for i, t in enumerate(sorted(trigrams))]
    names = ("trigram", "r", "g", "a", "bit", "all_bits", "all_runs")
    clauses = spark.range(1).select(F.inline(F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in rows])))
    hits = index.repartition("id").join(F.broadcast(clauses), "trigram")
    alternatives = hits.groupBy("id", "r", "g", "a", "all_bits", "all_runs").agg(F.bit_or("bit").alias("bits"))
    runs = alternatives.where("bits = all_bits").withColumn("run", F.expr("shiftleft(1, g)"))
    rules_met = runs.groupBy("id", "r", "all_runs").agg(F.bit_or("run").alias("runs")).where("runs = all_runs")
    return rules_met.groupBy("id").agg(F.bit_or(F.expr("shiftleft(1, r)")).alias("rules"))


def _starts(steps: Column) -> Column:
    """Exclusive running sums of an array, by blocks, so that long arrays stay cheap."""
    block = 128

    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0).cast("long"), lambda a, x: a + x)

    def by_block(sums: Column) -> Column:
        heads = F.transform(F.sequence(F.lit(0), F.size(sums) - 1), lambda b: total(F.slice(sums, 1, b)))
        return let(heads, lambda h: F.transform(F.sequence(F.lit(0), F.size(steps) - 1), lambda i: (
            F.get(h, F.floor(i / block).cast("int")) + total(F.slice(steps, (i - i % block) + 1, i % block))
        )))

    blocks = F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / block).cast("int"))
    return let(F.transform(blocks, lambda b: total(F.slice(steps, b * block + 1, F.lit(block)))), by_block)


def rule_spans(text: Column, rule: Rule, number: int) -> Column:
    """Leftmost non-overlapping matches of a rule: array of (start, number, end), code points."""
    spans = "array<struct<start:bigint,number:int,end:bigint>>"

    def placed(matches: Column) -> Column:
        lengths = F.transform(matches, lambda m: F.length(m).cast("long"))
        gaps = F.transform(F.split(text, rule.pattern, -1), lambda g: F.length(g).cast("long"))
        sizes = lengths
        if rule.group:
            groups = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
            sizes = F.transform(groups, lambda g: F.length(g).cast("long"))
        steps = let(gaps, lambda g: F.zip_with(lengths, F.slice(g, 1, F.size(lengths)), lambda a, b: F.struct(a.alias("n"), b.alias("gap"))))
        starts = let(steps, lambda s: F.zip_with(s, let(F.transform(s, lambda x: x["n"] + x["gap"]), _starts), lambda x, at: F.struct((at + x["gap"]).alias("start"), x["n"].alias("n"))))
        sized = F.zip_with(starts, sizes, lambda x, size: F.struct(x["start"].alias("start"), F.lit(number).alias("number"), (x["start"] + x["n"]).alias("end"), size.alias("size")))
        kept = F.filter(sized, lambda x: x["size"] >= rule.least)
        return F.transform(kept, lambda x: F.struct(x["start"].alias("start"), x["number"].alias("number"), x["end"].alias("end")))

    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    return let(found, lambda m: F.when(F.size(m) > 0, placed(m)).otherwise(F.array())).cast(spans)


def find_secrets(
    docs: DataFrame,
    rules: Sequence[Rule] = BASE + MORE,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    out: str = "secrets",
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Add ``out``: the spans of all rules, array of (kind, start, end) by start, then rule.

    Rules with mandatory trigrams are verified only where the postings of their query
    meet; rules without are matched against every text. The candidates (an id and a bit
    set) go to all tasks when they are few, else they are joined by a shuffle.

    Defined cases: null and empty texts have no spans; a null id has no postings, so all
    rules are matched against its text; rows of one id share their candidates and are
    each verified; other columns stay as they are; an empty table gives an empty result.
    """
    met, key, name = fresh(docs, "_rules", "_id", out)
    scanned = 0
    for r, rule in enumerate(rules):
        scanned |= (not trigram_query(rule.pattern)) << r
    every = (1 << len(rules)) - 1
    if scanned == every:
        joined = docs.withColumn(met, F.lit(every))
    else:
        found = candidates(postings(docs, rules, id_col, text_col), rules).toDF(key, met)
        found = materialise(found, "secret-candidates")
        if found.limit(broadcast_rows + 1).count() <= broadcast_rows:
            found = F.broadcast(found)
        joined = docs.join(found, F.col(id_col) == F.col(key), "left").drop(key)
    bits = F.when(F.col(id_col).isNull(), every).otherwise(F.coalesce(F.col(met), F.lit(0)).bitwiseOR(F.lit(scanned)))
    text = F.coalesce(F.col(text_col), F.lit(""))
    empty = F.array().cast("array<struct<start:bigint,number:int,end:bigint>>")
    each = [
        F.when(bits.bitwiseAND(F.lit(1 << r)) != 0, rule_spans(text, rule, r)).otherwise(empty)
        for r, rule in enumerate(rules)
    ]
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    spans = F.transform(
        F.array_sort(F.concat(*each)),
        lambda x: F.struct(F.get(kinds, x["number"]).alias("kind"), x["start"].alias("start"), x["end"].alias("end")),
    )
    return joined.withColumn(name, spans).select(*docs.columns, name)


def span_text(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def _root(n: Column) -> Column:
    return F.greatest(F.lit(1), F.ceil(F.sqrt(n)).cast("int"))


def _reach(ends: Column) -> Column:
    """Largest of 0 and the earlier ends, before each and after all; by blocks, so that long arrays stay cheap."""
    n = F.size(ends)

    def largest(part: Column) -> Column:
        return F.coalesce(F.array_max(part), F.lit(0).cast("long"))

    def found(block: Column) -> Column:
        heads = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / block).cast("int")), lambda b: largest(F.slice(ends, b * block + 1, block)))
        return let(heads, lambda h: F.transform(F.sequence(F.lit(0), n), lambda i: F.greatest(
            largest(F.slice(h, F.lit(1), F.floor(i / block).cast("int"))), largest(F.slice(ends, i - i % block + 1, i % block))
        )))

    return let(_root(n), found)


def _pieces(text: Column, gaps: Column, mask: str) -> Column:
    """The texts of (start, end) gaps, in order, with the mask between: read from stretches of the text, not each from its start."""

    def piece(of: Column, start: Column, end: Column) -> Column:
        return F.substring(of, (start + 1).cast("int"), (end - start).cast("int"))

    def stretch(some: Column) -> Column:
        base, last = F.element_at(some, 1)["start"], F.element_at(some, -1)["end"]
        return let(F.struct(piece(text, base, last).alias("text"), base.alias("base")), lambda x: F.array_join(
            F.transform(some, lambda g: piece(x["text"], g["start"] - x["base"], g["end"] - x["base"])), mask
        ))

    def joined(block: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor((F.size(gaps) - 1) / block).cast("int"))
        return F.array_join(F.transform(blocks, lambda b: let(F.slice(gaps, b * block + 1, block), stretch)), mask)

    return let(_root(F.size(gaps)), joined)


def masked(text: Column, spans: Column, mask: str = "[SECRET]") -> Column:
    """The text with each span replaced; overlapping spans are masked as one.

    What is kept are the gaps between the spans, sorted by start, from the largest end so
    far to the next start. The work grows with the text times the root of the spans.
    """
    starts = F.array_append(F.transform(spans, lambda s: s["start"]), F.length(text).cast("long"))
    reach = let(F.transform(spans, lambda s: s["end"]), _reach)
    gaps = F.filter(F.zip_with(reach, starts, lambda a, b: F.struct(a.alias("start"), b.alias("end"))), lambda g: g["start"] <= g["end"])
    return F.when(F.size(spans) > 0, let(gaps, lambda g: _pieces(text, g, mask))).otherwise(text)
