"""Mixing sources to target weights, with DataFrame operations only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from crewcast.llm.common import WORD, fresh, let, n_words, running_sums
from crewcast.session import materialise

#: Rows in one slice of the random order, about. Slices are what one window sorts.
SLICE_ROWS = 4096


def random_key(doc_id: Column, seed: int) -> Column:
    """A hash-random key that depends on the id and the seed alone, so that reruns agree."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))))


def _source_key(source: Column) -> Column:
    """Equal for equal sources and never null; null sorts last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source.cast("string")))


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, most_epochs: int) -> DataFrame:
    """Target of each source: ``sizes`` has ``src`` (key) and ``source_size``.

    Sources in key order take the weights in turn. A target ends at ``most_epochs``
    times the source's size and the rest is shared out again by weight: the level
    (words a unit of weight) is then the largest that a source meets after all
    sources with a smaller size-to-weight ratio are full.
    """
    total = sizes.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("n")).first()["n"]
    wanted = total * share
    ranked = running_sums(sizes, [F.col("src")], {"rank": F.lit(1)})
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    weighted = ranked.withColumns({"weight": weight.cast("long"), "cap": F.col("source_size") * most_epochs})
    ratio = F.col("cap").cast("double") / F.col("weight")
    before = running_sums(weighted, [ratio], {"full": F.col("cap"), "gone": F.col("weight")}, [F.col("src")])
    all_weight = F.lit(before.agg(F.coalesce(F.sum("weight"), F.lit(0)).alias("n")).first()["n"])
    level = before.agg(F.max((F.lit(wanted) - F.col("full").cast("double")) / (all_weight - F.col("gone")))).first()[0]
    share_of = F.least(F.col("cap").cast("double"), F.lit(level or 0.0) * F.col("weight"))
    return before.select("src", "source_size", share_of.alias("target"))


def mix_sources(
    docs: DataFrame,
    size: Column | None = None,
    *,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    weights: Sequence[int] = (5, 2, 1),
    share: float = 1.0,
    most_epochs: int = 3,
    seed: int = 17,
) -> DataFrame:
    """Add to each document what a mix of the sources takes of it.

    Each source gets a budget of words (its target, rounded). Its documents stand in a
    hash-random order; the mix takes them in turn, again from the start when the source
    is used up, and cuts the last one at the exact budget.

    Added columns (an underscore is appended where a name is taken): ``size`` words,
    ``source_size``, ``target``, ``taken`` words with repeats, ``copies`` whole copies and
    ``cut`` words of one more copy.

    The order is dealt in slices by the leading digits of the key, so a source of any
    share of the rows is spread evenly and no task sorts a whole source: a row's place is
    the sum of the earlier slices of its source plus the earlier rows of its slice.

    Defined cases: a null text or one without words has size 0 and nothing is taken; a
    null source is a source of its own, the last; null ids share one key; repeated rows
    count each, and which of equal rows is cut is not defined, though the multiset of
    results is; an empty table gives an empty result; ties in the key go by id, then size.
    """
    size = n_words(F.col(text_col)) if size is None else size
    names = fresh(docs, "size", "source_size", "target", "taken", "copies", "cut")
    n_size, n_all, n_target, n_taken, n_copies, n_cut = names
    src, key, piece, before = fresh(docs, "_src", "_key", "_slice", "_before")
    keyed = docs.withColumns(
        {n_size: size, src: _source_key(F.col(source_col)), key: random_key(F.col(id_col), seed)}
    )
    slices = max(1, -(-docs.count() // SLICE_ROWS))
    place = F.conv(F.substring(F.col(key), 1, 8), 16, 10).cast("double") / float(1 << 32)
    keyed = keyed.withColumn(piece, F.floor(place * slices).cast("long"))
    totals = keyed.groupBy(F.col(src).alias("src"), F.col(piece).alias("piece")).agg(F.sum(n_size).alias("n"))
    totals = materialise(totals, "mix-slices")
    targets = source_targets(totals.groupBy("src").agg(F.sum("n").alias("source_size")), weights, share, most_epochs)
    earlier = Window.partitionBy("src").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.withColumn("start", F.coalesce(F.sum("n").over(earlier), F.lit(0))).join(targets, "src")
    inside = Window.partitionBy(src, piece).orderBy(key, F.col(id_col), n_size)
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    placed = keyed.withColumn(before, F.coalesce(F.sum(n_size).over(inside), F.lit(0)))
    theirs = starts.drop("n").columns
    mine = dict(zip(theirs, fresh(placed, *[f"_mix_{c}" for c in theirs])))
    starts = starts.select(*[F.col(c).alias(n) for c, n in mine.items()])
    joined = placed.join(starts, (F.col(src) == F.col(mine["src"])) & (F.col(piece) == F.col(mine["piece"])))
    whole, n = F.col(mine["source_size"]), F.col(n_size)
    budget = F.floor(F.col(mine["target"]) + 0.5).cast("long")
    epochs = F.when(whole > 0, F.expr(f"floor(`{mine['target']}` + 0.5) div `{mine['source_size']}`")).otherwise(F.lit(0)).cast("long")
    rest = budget - epochs * whole
    last = F.greatest(F.lit(0), F.least(n, rest - F.col(mine["start"]) - F.col(before)))
    out = {
        n_all: whole,
        n_target: F.col(mine["target"]),
        n_taken: epochs * n + last,
        n_copies: epochs + F.when((last == n) & (n > 0), 1).otherwise(0),
        n_cut: F.when(last < n, last).otherwise(0),
    }
    out = {c: v.cast("double" if c == n_target else "long") for c, v in out.items()}
    return joined.withColumns(out).select(*docs.columns, *names)


def mixed_documents(docs: DataFrame, *, text_col: str = "text", **options) -> DataFrame:
    """The mix itself: one row per copy, with the columns of ``docs``.

    A document cut at the budget appears once more with its first words only. Documents
    of which nothing is taken are left out, as the weights ask.
    """
    mixed = mix_sources(docs, text_col=text_col, **options)
    copies, cut = mixed.columns[-2:]
    [words] = fresh(mixed, "_words")
    runs = F.when(F.col(copies) > 0, F.array_repeat(F.lit(-1).cast("long"), F.col(copies).cast("int")))
    runs = F.coalesce(runs, F.array().cast("array<bigint>"))
    runs = F.when(F.col(cut) > 0, F.concat(runs, F.array(cut))).otherwise(runs)
    rows = mixed.withColumn(words, F.explode(runs))
    return rows.withColumn(
        text_col, F.when(F.col(words) < 0, F.col(text_col)).otherwise(_first_words(F.col(text_col), F.col(words)))
    ).select(*docs.columns)


def _first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its ``n``-th word, white space between words kept."""
    gaps = F.split(text, WORD, -1)
    found = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    kept = let(found, lambda f: let(gaps, lambda g: F.zip_with(F.slice(g, 1, n.cast("int")), F.slice(f, 1, n.cast("int")), lambda gap, word: F.concat(gap, word))))
    return F.array_join(kept, "")
