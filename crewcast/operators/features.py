"""Training rows: label, null handling and outlier fences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crewcast.functions.dates import whole_days
from crewcast.operators.clean import drop_columns, latest_per_key, require, upper_columns
from crewcast.params import Params
from crewcast.schemas import FORECAST_DROPPED


def base_features(construction: DataFrame) -> DataFrame:
    """One row per id without the unused columns, region and market in upper case."""
    unique = latest_per_key(construction, ["id"], "refresh_date")
    return upper_columns(drop_columns(unique, FORECAST_DROPPED), "region", "market")


def add_label(df: DataFrame, end: str = "tower_end", start: str = "civil_start") -> DataFrame:
    """Duration label in days; negative and unknown durations are dropped."""
    return df.withColumn("label", whole_days(F.col(end), F.col(start))).where("label >= 0")


def group_quantiles(df: DataFrame, value: str, group: str, exact: bool = False) -> DataFrame:
    """Lower and upper quartile per group, approximate unless ``exact``."""
    if exact:
        q1 = F.expr(f"percentile_disc(0.25) WITHIN GROUP (ORDER BY {value})")
        q3 = F.expr(f"percentile_disc(0.75) WITHIN GROUP (ORDER BY {value})")
        return df.groupBy(group).agg(q1.alias("q1"), q3.alias("q3"))
    pair = F.percentile_approx(value, [0.25, 0.75]).alias("q")
    return df.groupBy(group).agg(pair).select(group, F.col("q")[0].alias("q1"), F.col("q")[1].alias("q3"))


def day_sketches(df: DataFrame, value: str, group: str, day: Column, k: int = 400) -> DataFrame:
    """``(day, group, sketch)``: a mergeable sketch of each day's values, so that later fences need no old rows."""
    known = df.where(F.col(value).isNotNull())
    return known.groupBy(day.alias("day"), group).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), k).alias("sketch"))


def sketched_quantiles(sketches: DataFrame, group: str) -> DataFrame:
    """``(group, n_rows, q1, q3)`` from the sketches of any days, ranks right to about a percent."""
    merged = sketches.groupBy(group).agg(F.kll_merge_agg_double("sketch").alias("sketch"))
    quantiles = [F.kll_sketch_get_quantile_double("sketch", F.lit(q)).alias(n) for q, n in ((0.25, "q1"), (0.75, "q3"))]
    return merged.select(group, F.kll_sketch_get_n_double("sketch").alias("n_rows"), *quantiles)


def within_fences(df: DataFrame, value: str, group: str, exact: bool = False) -> DataFrame:
    """Rows inside the closed Tukey fences of their group.

    Grouped quartiles (merged partially before the shuffle) joined back, rather than
    a window that would sort a whole group in one task.
    """
    fences = group_quantiles(df, value, group, exact).select(
        F.col(group).alias("_group"),
        (F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))).alias("_low"),
        (F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))).alias("_high"),
    )
    inside = F.col(group).eqNullSafe(F.col("_group")) & F.col(value).between(F.col("_low"), F.col("_high"))
    return df.join(fences, inside).drop("_group", "_low", "_high")


def training_rows(construction: DataFrame, params: Params) -> DataFrame:
    return training_rows_of(base_features(construction), params)


def training_rows_of(base: DataFrame, params: Params) -> DataFrame:
    """Training rows of records that are unique already."""
    labelled = add_label(base)
    complete = require(labelled, [*params.numerical_cols, *params.categorical_cols])
    return within_fences(complete, "label", "package_name")


def scoring_rows(construction: DataFrame) -> DataFrame:
    return base_features(construction)
