"""Registered queries of the operators."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crewcast.llm import chat, collocations, decontamination, forest, jaccard, lattice, mixing, pieces, quality, secrets, topk, toxicity, whitening
from crewcast.llm.common import n_words, table
from crewcast.llm.vectors import finite_vectors, one_of_each_id
from crewcast.session import materialise

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_mix_sources(spark, sf_dir):
    """Words that a mix of all sources takes of each document."""
    docs = table(spark, sf_dir, "documents")
    sizes = materialise(docs.select("doc_id", "source", n_words(F.col("text")).alias("words")), "mix-sizes")
    mixed = mixing.mix_sources(sizes, F.col("words"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query
def op8_secret_scan(spark, sf_dir):
    """Spans of secrets in every document; the base kinds counted and hashed."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.find_secrets(docs)
    base = F.filter("secrets", lambda s: s["kind"].isin(*[r.kind for r in secrets.BASE]))

    def count(kind):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(r.kind) for r in secrets.BASE],
        F.sha2(secrets.span_text(base), 256).alias("base_sha256"),
        secrets.span_text(F.col("secrets")).alias("spans"),
    )


@query
def op5_sentencepiece(spark, sf_dir):
    """Digests of the ids of every document and of their decoded text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = docs.select("doc_id", pieces.encoder(pieces.read_model(PIECES))("text").alias("e"))
    return encoded.select(
        "doc_id",
        F.size("e.ids").cast("long").alias("n_tokens"),
        F.sha2(pieces.ids_text(F.col("e.ids")), 256).alias("ids_sha256"),
        F.sha2("e.decoded", 256).alias("decoded_sha256"),
    )


def toxicity_model(spark, sf_dir):
    """Lexicon from the labels whose crc32 modulo 3 is not 1."""
    labels = table(spark, sf_dir, "labels").where(toxicity.fold_of(F.col("doc_id"), 3) != 1)
    return toxicity.learn(table(spark, sf_dir, "documents"), labels)


@query
def op7_toxicity(spark, sf_dir):
    """Toxicity of every document, learnt from two thirds of the labels."""
    score = toxicity.scorer(toxicity_model(spark, sf_dir))
    scored = table(spark, sf_dir, "documents").select("doc_id", score("text").alias("score"))
    held_out = (toxicity.fold_of(F.col("doc_id"), 3) == 1).alias("held_out")
    return scored.select("doc_id", held_out, "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query
def op9_quality(spark, sf_dir):
    """Quality of every document, learnt from four fifths of the labels."""
    docs = table(spark, sf_dir, "documents").select("doc_id", quality.statistics_of("text").alias("statistics"))
    described = materialise(docs, "quality-statistics")
    labels = table(spark, sf_dir, "labels").where(toxicity.fold_of(F.col("doc_id"), 5) != 0)
    score = quality.scorer(quality.learn(described, labels))
    scored = described.select("doc_id", score("statistics").alias("score"))
    held_out = (toxicity.fold_of(F.col("doc_id"), 5) == 0).alias("held_out")
    return scored.select("doc_id", held_out, "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op10_ngram_jaccard(spark, sf_dir):
    """Group of every document under links of 0.8 between sets of five-word shingles."""
    groups = jaccard.similar_groups(table(spark, sf_dir, "documents"))
    return groups.withColumnRenamed("id", "doc_id")


@query
def op2_exact_top_k(spark, sf_dir):
    """The 5 largest inner products of every 50th vector, components as whole 256ths."""
    rows = finite_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    whole = F.transform("v", lambda x: F.floor(F.lit(256.0) * x).cast("long")).alias("v")
    rows = materialise(rows.select("id", whole), "topk-rows")
    listed = F.filter(F.transform("v", lambda w, i: F.struct(i.cast("long").alias("t"), w.alias("w"))), lambda x: x["w"] != 0)
    found = topk.top_k(rows.withColumn("v", listed), one_of_each_id(rows.where("id % 50 = 0")).withColumn("v", listed), 5)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


@query
def op3_random_projection_forest(spark, sf_dir):
    """About the 20 nearest vectors of every 20th vector, by inner product."""
    rows = finite_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    rows = materialise(rows.where(F.exists("v", lambda x: x != 0)), "forest-rows")
    found = forest.nearest(rows, one_of_each_id(rows.where("id % 20 = 0")), 20)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


@query
def op6_lattice_scores(spark, sf_dir):
    """Log10 chance of every text; a tenth of the ids is held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    fold = toxicity.fold_of(F.col("doc_id"), 10)
    scored = lattice.score_texts(docs, fold != 0, pieces.read_model(PIECES))
    held_out = (toxicity.fold_of(F.col("id"), 10) == 0).alias("held_out")
    return scored.select(F.col("id").alias("doc_id"), held_out, *scored.columns[1:])


@query
def op4_chat_format(spark, sf_dir):
    """Every conversation, as a raw transcript, parsed and rendered; a fifth of them is held out, and so is a way of marking."""
    raw = materialise(chat.raw_transcripts(table(spark, sf_dir, "conversations")), "chat-raw")
    held_out = toxicity.fold_of(F.col("id"), 5) == 0
    new_style = F.col("style") == len(chat.STYLES) - 1
    model = chat.learn(raw.where(~held_out & ~new_style))
    parsed = chat.parse(raw, model)
    right = F.size(F.filter(F.zip_with("states", "truth", lambda a, b: F.floor(a / 2) == F.floor(b / 2)), lambda x: x))
    return parsed.select(
        F.col("id").alias("conv_id"),
        "part",
        held_out.alias("held_out"),
        new_style.alias("new_style"),
        F.size("states").cast("long").alias("n_lines"),
        right.cast("long").alias("n_right"),
        F.array_join("roles", ",").alias("roles"),
        "rendered",
    )


@query
def op11_collocations(spark, sf_dir):
    """The 2000 strongest phrases of two to five words of each language."""
    return collocations.ranked(collocations.collocations(table(spark, sf_dir, "documents")))


@query
def op12_whitening(spark, sf_dir):
    """Up to 32 whitened components of every embedding."""
    found = whitening.whiten(table(spark, sf_dir, "embeddings"))
    each = found.select("id", "n", "deviation", "explained", "identity_error", F.posexplode("w").alias("at", "whitened"))
    return each.select(
        F.col("id").alias("vec_id"), (F.col("at") + 1).alias("component"), "n", "deviation", "whitened",
        F.get("explained", F.col("at")).alias("explained"), "identity_error",
    )


@query
def op13_decontamination(spark, sf_dir):
    """Words of every document that lie in ten-word windows of benchmark items."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.contamination(docs, table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    counted = found.select("doc_id", "n_words", hit.alias("n_hit"), "items")
    return counted.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )
