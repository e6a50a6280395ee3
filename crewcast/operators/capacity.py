"""Crew capacity per day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crewcast.functions.dates import day_range
from crewcast.params import Params


def empty_capacity(crews: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """A zero for every crew and day, in long form."""
    names = crews.select("crew_name").distinct().withColumns({"_a": F.lit(first), "_b": F.lit(last)})
    return day_range(names, "_a", "_b").select("day", "crew_name", F.lit(0).alias("capacity"))


def booked_days(jobs: DataFrame, params: Params) -> DataFrame:
    """Days taken by booked jobs: the duration plus the crew's downtime."""
    booked = jobs.where(F.col("CrewIdBooked").isNotNull() & F.col("JobStartDateForecast").isNotNull())
    last = F.date_add("JobStartDateForecast", F.col("JobDuration") - 1 + params.workers_downtime)
    spans = booked.withColumn("_last", last)
    return day_range(spans, "JobStartDateForecast", "_last").select(
        "day", F.col("CrewIdBooked").alias("crew_name")
    )


def crew_capacity(
    crews: DataFrame, jobs: DataFrame, first: dt.date, last: dt.date, params: Params
) -> DataFrame:
    """Zero less one per booking, for every crew and day of the range."""
    base = empty_capacity(crews, first, last)
    used = booked_days(jobs, params).where(F.col("day").between(F.lit(first), F.lit(last)))
    used = used.groupBy("day", "crew_name").agg(F.count("*").cast("int").alias("_n"))
    return base.join(used, ["day", "crew_name"], "left").select(
        "day", "crew_name", (F.col("capacity") - F.coalesce("_n", F.lit(0))).alias("capacity")
    )


def column_names(df: DataFrame, column: str, most: int = 10_000) -> list[str]:
    """The values of a column, sorted, as names of a matrix's columns; too many raise."""
    rows = df.select(column).dropna().distinct().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} values of {column} for one matrix")
    return sorted(r[0] for r in rows)


def capacity_matrix(capacity: DataFrame, crews: list[str]) -> DataFrame:
    """Days by the named crews, for display."""
    chosen = capacity.where(F.col("crew_name").isin(crews))
    return chosen.groupBy("day").pivot("crew_name", crews).agg(F.sum("capacity"))
