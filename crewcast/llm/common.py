"""Small helpers shared by the operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Mapping, Sequence
from contextlib import suppress
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from crewcast.session import materialise

#: A word: a run without ASCII white space (Java and RE2 syntax).
WORD = r"[^\x20\x09-\x0D]+"


def lean(function):
    """The generator function, which at its end gives freed memory back to the system.

    Spark's Python workers outlive their tasks and wait beside the JVM of the next stage.
    """

    @wraps(function)
    def run(batches):
        yield from function(batches)
        pa.default_memory_pool().release_unused()
        with suppress(OSError, AttributeError):  # glibc only
            ctypes.CDLL("libc.so.6").malloc_trim(0)

    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` does not have yet, whatever its other columns are called."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def n_words(text: Column) -> Column:
    """Number of words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def running_sums(
    df: DataFrame, order: Sequence[Column], sums: Mapping[str, Column], tie: Sequence[Column] = ()
) -> DataFrame:
    """Exclusive running sums of the whole table in ``order``, without a task that sees all rows.

    Range partitions hold consecutive rows; each adds up its own, and the totals of the
    earlier partitions are added. The table is written once, so that the partition of a
    row stays what it was.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    [part] = fresh(df, "_part")
    whole = df.withColumns(dict(sums)).repartitionByRange(parts, *order, *tie)
    whole = materialise(whole.withColumn(part, F.spark_partition_id()), "running")
    inside = Window.partitionBy(part).orderBy(*order, *tie).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    totals = whole.groupBy(F.col(part).alias("_p")).agg(*[F.sum(c).alias(f"_t{i}") for i, c in enumerate(sums)])
    starts = totals.select("_p", *[F.coalesce(F.sum(f"_t{i}").over(earlier), F.lit(0)).alias(f"_s{i}") for i in range(len(sums))])
    numbered = whole.withColumns({c: F.coalesce(F.sum(c).over(inside), F.lit(0)) for c in sums})
    joined = numbered.join(F.broadcast(starts), F.col(part) == F.col("_p"))
    return joined.select(
        *[c for c in df.columns if c not in sums], *[(F.col(c) + F.col(f"_s{i}")).alias(c) for i, c in enumerate(sums)]
    )


def smallest_by_hash(df: DataFrame, key: Column, most: int, cells: int = 4096) -> DataFrame:
    """Rows with the smallest hashes of ``key``: all, or as many as fit ``most`` when cut between cells of hashes.

    Counts of cells decide where to cut, so no task sees more than its own rows.
    """
    total = df.count()
    if total <= most:
        return df
    place = F.shiftrightunsigned(F.xxhash64(key), 11) / float(1 << 53)
    top = min(1.0, 2 * most / total)
    cell = F.floor(place / F.lit(top) * cells)
    counts = dict(df.where(place < top).groupBy(cell.alias("c")).count().collect())  # a row for each cell
    kept, cut = 0, 0
    while cut < cells and kept + counts.get(cut, 0) <= most:
        kept, cut = kept + counts.get(cut, 0), cut + 1
    return df.where(place < F.lit(top * cut / cells))
