"""The corpus pipeline: stages over ``documents``, each written as Parquet and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crewcast.llm import jaccard, mixing, pieces, secrets, toxicity
from crewcast.llm.common import fresh, table
from crewcast.llm.queries import PIECES
from crewcast.session import discard_intermediates, materialise, written_so_far

#: Documents with this score or more are rejected.
TOXIC = 0.7


#: Bytes of texts that go to a Python worker at a time, about.
BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """From here on texts reach Python in small batches, whatever their length: both sides of the pipe hold one each."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{BATCH_BYTES}b")


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic; two thirds of the labels teach the lexicon."""
    small_batches(spark)
    labels = table(spark, sf_dir, "labels").where(toxicity.fold_of(F.col("doc_id"), 3) != 1)
    score = toxicity.scorer(toxicity.learn(docs, labels))
    return docs.where(score("text") < TOXIC)


def unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones: that with the smallest id."""
    small_batches(spark)
    return jaccard.one_of_each(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked; ``n_chars`` follows the text."""
    [spans] = fresh(docs, "secrets")
    found = secrets.find_secrets(docs, out=spans)
    found = found.withColumn("text", secrets.masked(F.col("text"), F.col(spans)))
    return found.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each whole copy that the mix takes, and one for the cut copy at the end of a budget."""
    mixed = mixing.mixed_documents(docs)
    return mixed.withColumn("n_chars", F.length("text").cast("long"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids and the text that these decode to; added names get an underscore where one is taken."""
    small_batches(spark)
    found, count, ids = fresh(docs, "_e", "n_tokens", "ids")
    encoded = docs.withColumn(found, pieces.encoder(pieces.read_model(PIECES))("text"))
    columns = [F.col(c) for c in docs.columns if c not in ("text", "n_chars")]
    parts = [F.size(f"{found}.ids").cast("long").alias(count), F.col(f"{found}.ids").alias(ids), F.col(f"{found}.decoded").alias("text")]
    return encoded.select(*columns, *parts)


STAGES = [
    ("toxicity", clean),
    ("n-gram Jaccard join", unique),
    ("secret scans", without_secrets),
    ("mixing sources to target weights", mix),
    ("SentencePiece encoding and decoding", encode),
]

#: Learnt scores and token ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what a stage wrote on its way, and the stage before it, goes once its result is stored."""
    docs, mark = table(spark, sf_dir, "documents"), written_so_far()
    for k, (_, stage) in enumerate(STAGES):
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{k}")
        discard_intermediates(spark, mark, keep_last=True)
    return docs
