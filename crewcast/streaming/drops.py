"""Each new file drop is processed once."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from crewcast import schemas
from crewcast.params import Params
from crewcast.plans.allocation import Inputs, allocate
from crewcast.operators.clean import latest_per_key, parse_dates
from crewcast.operators.overlay import text_overlay, typed_overlay
from crewcast.plans.forecast import score
from crewcast.operators.features import scoring_rows
from crewcast.sources.readers import load_model
from crewcast.sources.writers import publish_whole, write_overlay, write_predictions

log = logging.getLogger(__name__)
POLL = "10 minutes"  # fixed value: how often a folder is looked at


def drop_stream(spark: SparkSession, folder: str, schema: T.StructType, archive: str | None = None) -> DataFrame:
    """CSV files of a folder as a stream; consumed files may be moved to an archive.

    Spark moves the files of a batch once a later batch has run.
    """
    reader = spark.readStream.schema(schema).option("header", True).option("enforceSchema", False)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.csv(folder)


def newest_rows(stream: DataFrame, key: str, newest: str) -> DataFrame:
    """One row per key over all drops so far: the newest, ties settled by the remaining columns.

    The rows are kept as state of the stream, so a drop is only compared with what is
    known of its keys and no earlier file is read again. A row that comes late, with an
    older ``newest`` than the known one, changes nothing; a null counts as oldest. Run it
    with ``mode="complete"`` to get the whole table after each drop. For state beyond the
    executors' memory choose Spark's RocksDB state store.
    """
    rest = [c for c in stream.columns if c not in (key, newest)]
    best = F.max(F.struct(newest, *rest)).alias("_row")
    return stream.groupBy(key).agg(best).select(key, "_row.*").select(*stream.columns)


def table_handler(root: str) -> Callable[[DataFrame, int], None]:
    """Publishes each batch as the whole table; a batch that runs again leaves what it had published."""

    def handle(batch: DataFrame, number: int) -> None:
        publish_whole(batch, root, number)

    return handle


def run_on_drops(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], state: str, once: bool = True, mode: str = "append"
) -> StreamingQuery:
    """Call ``handle`` per batch of new files; ``state`` remembers what was done."""
    writer = stream.writeStream.outputMode(mode).foreachBatch(handle).option("checkpointLocation", state)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=POLL)).start()


def allocation_handler(
    static: Callable[[], Inputs | None], params: Params | Callable[[], Params], path: str
) -> Callable[[DataFrame, int], None]:
    """Allocates each job drop against the tables of the moment.

    ``static`` returns the other inputs, or None while crews are missing; that batch
    fails and is taken up again by the next start, so that no job drop is lost.
    ``params`` may be a function, asked for each batch: the day of planning then moves
    with a stream that runs for days.
    """

    def handle(batch: DataFrame, number: int) -> None:
        if batch.isEmpty():
            return
        known = static()
        if known is None:
            log.warning("batch %s waits: no crew table yet", number)
            raise RuntimeError("crew table is missing")
        now = params() if callable(params) else params
        jobs = parse_dates(batch, schemas.JOB_SITE_DATES)
        inputs = Inputs(jobs, known.crews, known.events, known.weather, known.holidays)
        overlay = text_overlay(typed_overlay(allocate(inputs, now)))
        write_overlay(overlay, f"{path}/batch={number}", now.as_of)

    return handle


def scoring_handler(model_path: str, params: Params, path: str) -> Callable[[DataFrame, int], None]:
    """Scores each construction drop and writes it by day, below a folder of its own.

    A later drop with rows of the same day so adds to them; a batch that is run again
    replaces its own rows. ``latest_predictions`` reads one row per job.
    """

    def handle(batch: DataFrame, number: int) -> None:
        predictions = score(load_model(model_path), scoring_rows(batch), params)
        write_predictions(predictions, f"{path}/batch={number}")

    return handle


def latest_rows(spark: SparkSession, path: str, key: str) -> DataFrame:
    """One row per key over all batches below ``path``: that of the latest batch."""
    rows = spark.read.option("recursiveFileLookup", False).parquet(path)
    return latest_per_key(rows, [key], "batch").drop("batch")


def latest_predictions(spark: SparkSession, path: str) -> DataFrame:
    return latest_rows(spark, path, "JobID")
