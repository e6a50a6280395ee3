"""Readers for the CSV drops."""

from __future__ import annotations

import re

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crewcast import schemas
from crewcast.operators.clean import parse_dates
from crewcast.plans.allocation import Inputs


def read_csv(spark: SparkSession, path: str, schema: T.StructType, name: str | None = None) -> DataFrame:
    """CSV with a header that must agree with the schema; unreadable values become null.

    ``name`` restricts a folder to files of that name, subfolders included.
    """
    reader = spark.read.schema(schema).option("header", True).option("enforceSchema", False)
    if name is not None:
        reader = reader.option("pathGlobFilter", name).option("recursiveFileLookup", True)
    return reader.csv(path)


def read_construction(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.CONSTRUCTION)


def read_latest(spark: SparkSession, folder: str, name: str, schema: T.StructType) -> DataFrame | None:
    """The most recently written file, or folder of part files, called ``name`` below a folder, or None.

    Only file names and times are looked at to choose; rows are read once.
    """
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", "modificationTime")
    place = F.regexp_extract("path", rf"^(.*/{re.escape(name)})(/[^/]+)?$", 1)
    found = listing.select(place.alias("place"), "modificationTime").where("place != ''")
    written = found.groupBy("place").agg(F.max("modificationTime").alias("at"))
    newest = written.orderBy(F.col("at").desc(), F.col("place").desc()).first()
    return None if newest is None else read_csv(spark, newest["place"], schema)


def require_tables(**tables: DataFrame | None) -> None:
    """Stop, naming them, when input tables are missing or empty."""
    missing = [name for name, df in tables.items() if df is None or df.isEmpty()]
    if missing:
        raise ValueError(f"missing input tables: {', '.join(sorted(missing))}")


def read_planner_inputs(
    spark: SparkSession,
    folder: str,
    jobs: str = "job_site.csv",
    crews: str = "vendor_crew.csv",
    events: str = "events.csv",
    weather: str = "weather.csv",
    holidays: DataFrame | None = None,
) -> Inputs:
    """The four planner tables with parsed dates; all of them must be there."""
    tables = {
        "jobs": (jobs, schemas.JOB_SITE, schemas.JOB_SITE_DATES),
        "crews": (crews, schemas.VENDOR_CREW, schemas.VENDOR_CREW_DATES),
        "events": (events, schemas.EVENTS, schemas.EVENT_DATES),
        "weather": (weather, schemas.WEATHER, schemas.WEATHER_DATES),
    }
    found = {k: read_latest(spark, folder, name, schema) for k, (name, schema, _) in tables.items()}
    require_tables(**found)
    parsed = {k: parse_dates(found[k], dates) for k, (_, _, dates) in tables.items()}
    return Inputs(**parsed, holidays=holidays)


def read_holidays(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.HOLIDAYS)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
