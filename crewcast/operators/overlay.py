"""Output tables of the allocation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crewcast.operators.triage import status_label
from crewcast.params import Params

MISSING = "#"  # fixed value: text written for an unknown vendor, crew or start


def with_placements(jobs: DataFrame, placed: DataFrame) -> DataFrame:
    """Every triaged job once, with its placement or the code it already had.

    Jobs that triage settled pass through; only the others take part in the join.
    """
    found = placed.select(
        "JobID",
        F.col("ResourceStatus").alias("_status"),
        "RecommendedVendor",
        "RecommendedWorker",
        F.date_from_unix_date("planned_day").alias("PlannedJobStart"),
    )
    live = jobs.where(F.col("phase").isNotNull()).join(found, "JobID", "left")
    live = live.withColumn("ResourceStatus", F.col("_status")).drop("_status")
    return jobs.where(F.col("phase").isNull()).unionByName(live, allowMissingColumns=True)


def typed_overlay(jobs: DataFrame) -> DataFrame:
    """Output columns with their own types; missing values are null."""
    return jobs.select(
        F.col("JobID").alias("WpId"),
        F.col("RecommendedVendor").alias("VendorId"),
        F.col("RecommendedWorker").alias("CrewId"),
        F.col("PlannedJobStart").alias("PlannedStartDate"),
        F.col("refresh_date").alias("RefreshDate"),
        "ResourceStatus",
        "JobDuration",
    )


def _text_or_missing(name: str) -> Column:
    text = F.col(name).cast("string")
    return F.when(text.isNull() | (text == "nan"), F.lit(MISSING)).otherwise(text).alias(name)


def text_overlay(overlay: DataFrame) -> DataFrame:
    """The overlay as planners read it, with a mark for missing values."""
    marked = ("VendorId", "CrewId", "PlannedStartDate")
    return overlay.select(*[_text_or_missing(c) if c in marked else F.col(c) for c in overlay.columns])


def labelled(overlay: DataFrame, params: Params) -> DataFrame:
    return overlay.withColumn("StatusLabel", status_label(F.col("ResourceStatus"), params))


def with_predictions(jobs: DataFrame, predictions: DataFrame) -> DataFrame:
    """Adds the predicted duration to planner jobs."""
    scored = predictions.select("JobID", "JobDurationML")
    return jobs.drop("JobDurationML").join(scored, "JobID", "left")
