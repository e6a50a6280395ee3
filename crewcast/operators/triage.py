"""Derived job columns, status codes known before placement, and phases."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crewcast.params import Params

BOOKED, FORECAST, NEW = 1, 2, 3


def job_start(params: Params) -> Column:
    return F.coalesce(
        "JobStartDateActual",
        "JobStartDateForecast",
        "SiteReadinessForecast",
        F.date_add("JobCreateDate", params.site_readiness_span),
    )


def job_duration(params: Params) -> Column:
    """Days from the forecast dates, else the model's value rounded up, else the default."""
    planned = F.datediff("JobEndDateForecast", "JobStartDateForecast") + 1 + params.job_buffer
    return F.coalesce(planned, F.ceil("JobDurationML"), F.lit(params.job_duration)).cast("int")


def fill_defaults(jobs: DataFrame, params: Params) -> DataFrame:
    return jobs.withColumns(
        {
            "JobStart": job_start(params),
            "JobDuration": job_duration(params),
            "Priority": F.coalesce("Priority", F.lit(params.job_default_priority)).cast("int"),
            "JobStartMaxOffset": F.coalesce(
                "JobStartMaxOffset", F.lit(params.scheduled_backlog_offset)
            ).cast("int"),
        }
    )


def known_crew(jobs: DataFrame, crews: DataFrame) -> DataFrame:
    """Adds ``CrewKnown`` and the vendor a booked crew is locked under.

    ``LockVendor`` is the booked vendor, or the crew's vendor when only one vendor
    lists that crew. Jobs without a booking take no part in the join.
    """
    names = crews.groupBy(F.col("crew_name").alias("_name")).agg(
        F.min("VendorID").alias("_low"), F.max("VendorID").alias("_high")
    )
    names = names.select(
        "_name", F.lit(True).alias("_listed"), F.when(F.col("_low") == F.col("_high"), F.col("_low")).alias("_vendor")
    )
    booked = jobs.where(F.col("CrewIdBooked").isNotNull()).join(names, F.col("CrewIdBooked") == F.col("_name"), "left")
    booked = booked.withColumns(
        {"CrewKnown": F.col("_listed").isNotNull(), "LockVendor": F.coalesce("VendorBooked", "_vendor")}
    ).drop("_name", "_listed", "_vendor")
    unbooked = jobs.where(F.col("CrewIdBooked").isNull())
    return booked.unionByName(
        unbooked.withColumns({"CrewKnown": F.lit(False), "LockVendor": F.lit(None).cast("string")})
    )


def unknown_booked_crew(jobs: DataFrame, crews: DataFrame) -> DataFrame:
    """Booked jobs whose crew is not in the crew table."""
    booked = jobs.where(F.col("CrewIdBooked").isNotNull())
    return booked.join(crews, booked["CrewIdBooked"] == crews["crew_name"], "left_anti")


def _true(condition: Column) -> Column:
    """A comparison with null counts as false."""
    return F.coalesce(condition, F.lit(False))


def status_code(params: Params) -> Column:
    """Code 9, 5, 8 or 3, the first that applies; null for a job that may be placed."""
    today = F.lit(params.as_of)
    booked = F.col("CrewIdBooked").isNotNull()
    unbooked = ~booked
    late = F.datediff(today, "JobStart") > F.col("JobStartMaxOffset")
    far = F.datediff("JobStart", today) > params.scheduled_backlog_offset
    bad = [
        F.col("JobStartDateForecast") > F.col("JobEndDateForecast"),
        F.col("JobDuration") > params.job_duration_max,
        booked & F.col("JobStartDateActual").isNull() & F.col("JobStartDateForecast").isNull(),
        unbooked & (F.col("JobStartDateActual") <= today),
        F.col("JobStart").isNull(),
    ]
    any_bad = reduce(lambda a, b: a | b, [_true(c) for c in bad])
    return (
        F.when(unbooked & (_true(late) | _true(far)), 9)
        .when(any_bad, 5)
        .when(booked & ~F.col("CrewKnown"), 8)
        .when(unbooked & (F.col("CountQualified") == 0), 3)
    )


def status_label(code: Column, params: Params) -> Column:
    pairs = [F.lit(x) for item in params.tracking_codes.items() for x in item]
    return F.create_map(*pairs)[code]


def phase() -> Column:
    """1 booked, 2 unbooked with a forecast start, 3 unbooked without; null when already coded."""
    return F.when(
        F.col("ResourceStatus").isNull(),
        F.when(F.col("CrewIdBooked").isNotNull(), BOOKED)
        .when(F.col("JobStartDateForecast").isNotNull(), FORECAST)
        .otherwise(NEW),
    )


def triage(jobs: DataFrame, params: Params) -> DataFrame:
    """Expects the filled columns plus ``CrewKnown`` and ``CountQualified``."""
    return jobs.withColumn("ResourceStatus", status_code(params)).withColumn("phase", phase())


def placement_order() -> list[Column]:
    """Sort key of the greedy, as whole numbers with nulls last, ending in the job id."""
    last = F.lit(2**40)

    def number(column: Column) -> Column:
        return F.coalesce(column.cast("long"), last)

    step = F.col("phase")
    third = F.when(step == BOOKED, F.unix_date("JobStart")).when(
        step == FORECAST, F.unix_date("JobStartDateForecast")
    )
    fifth = F.when(step != BOOKED, F.col("CountQualified"))
    return [
        step.cast("long"),
        number(F.col("Priority")),
        number(F.unix_date("SiteReadinessForecast")),
        number(third),
        number(F.unix_date("JobCreateDate")),
        number(fifth),
        F.col("JobID"),
    ]
