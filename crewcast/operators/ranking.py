"""Row numbers within groups that may be too large for one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from crewcast.operators.joins import join_null_safe
from crewcast.session import materialise


def spread_rank(
    df: DataFrame, keys: Sequence[str], order: Sequence, out: str, counted: Column | None = None
) -> DataFrame:
    """Number of earlier rows within ``keys`` by ``order``, without a task per group.

    Range partitions split a large group at its order key; each partition counts its
    own rows and adds those of the group's earlier partitions. ``counted`` restricts
    which rows count. The order must be total for a stable result.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    weight = F.lit(1) if counted is None else counted.cast("int")
    ranged = df.withColumn("_w", weight).repartitionByRange(parts, *keys, *order)
    ranged = materialise(ranged.withColumn("_part", F.spark_partition_id()), "ranked")
    inside = Window.partitionBy(*keys, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy(*keys, "_part").agg(F.sum("_w").alias("_n"))
    starts = totals.select(*keys, "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    numbered = ranged.withColumn("_before", F.coalesce(F.sum("_w").over(inside), F.lit(0)))
    return (
        join_null_safe(numbered, starts, [*keys, "_part"])
        .withColumn(out, F.col("_before") + F.col("_start"))
        .drop("_part", "_w", "_before", "_start")
    )
