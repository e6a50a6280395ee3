"""Cleaning, filtering and deduplication of the input tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from crewcast.functions.dates import parse_date
from crewcast.params import Params


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop the listed columns; missing ones are ignored."""
    return df.drop(*columns)


def upper_columns(df: DataFrame, *columns: str) -> DataFrame:
    """Upper-case text columns; null stays null."""
    return df.withColumns({c: F.upper(c) for c in columns})


def parse_dates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Turn the text columns among ``columns`` into dates; bad text becomes null."""
    text = [c for c in columns if isinstance(df.schema[c].dataType, T.StringType)]
    return df.withColumns({c: parse_date(F.col(c)) for c in text}) if text else df


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key; null keys count as equal.

    A rank filter of 1 is applied before the shuffle as well, so a key that holds
    many rows sends one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def latest_per_key(df: DataFrame, keys: Sequence[str], latest: str) -> DataFrame:
    """One row per key: the newest, ties settled by the remaining columns."""
    rest = [c for c in df.columns if c not in keys and c != latest]
    order = [F.col(c).desc_nulls_last() for c in [latest, *rest]]
    return first_per_key(df, keys, order)


def not_placeholder(df: DataFrame, column: str, value: str) -> DataFrame:
    """Drop rows booked to the placeholder value; null rows stay."""
    return df.where(~F.col(column).eqNullSafe(value))


def open_jobs(df: DataFrame) -> DataFrame:
    return df.where(F.col("JobEndDateActual").isNull())


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows with a null in any listed column."""
    return df.dropna(how="any", subset=list(columns))


def filter_and_sort(df: DataFrame, condition: Column, columns: Sequence[str]) -> DataFrame:
    """Filter, then sort ascending with nulls last."""
    return df.where(condition).orderBy(*[F.col(c).asc_nulls_last() for c in columns])


def clean_jobs(jobs: DataFrame, params: Params) -> DataFrame:
    """Parsed, deduplicated open jobs.

    The duplicates go first: which row survives decides whether the job is open.
    """
    dates = [f.name for f in jobs.schema if f.name.startswith(("Job", "Site")) and "Date" in f.name]
    dates += ["SiteReadinessForecast", "refresh_date"]
    parsed = parse_dates(jobs, dates)
    unique = latest_per_key(parsed, ["JobID"], "refresh_date")
    if params.placeholder_crew is not None:
        unique = not_placeholder(unique, "CrewIdBooked", params.placeholder_crew)
    kept = open_jobs(unique)
    return upper_columns(kept, "Market")


def clean_crews(crews: DataFrame) -> DataFrame:
    parsed = parse_dates(crews, ["ValidFrom", "ValidUntil"])
    kept = require(parsed, ["VendorID", "crew_name", "ValidFrom", "ValidUntil"])
    return upper_columns(kept, "Market").withColumnRenamed("region", "Region")


def clean_events(events: DataFrame) -> DataFrame:
    return upper_columns(parse_dates(events, ["ValidFrom", "ValidUntil"]), "Market", "Region")


def row_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns per named stage as one small table."""
    parts = [
        df.agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("stage"), "n_rows", F.lit(len(df.columns)).alias("n_columns")
        )
        for name, df in stages.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


class StageCounts:
    """Rows of named stages, counted while other work reads them, so that nothing is read for the counts alone.

    ``watch`` marks a stage; its figures are there once an action has run over it. Tasks
    that run again after a lost executor may count their rows twice, as Spark's
    accumulators do.
    """

    def __init__(self) -> None:
        self.stages: list[tuple[str, int, Observation]] = []

    def watch(self, stage: str, df: DataFrame, *more: Column) -> DataFrame:
        seen = Observation()
        self.stages.append((stage, len(df.columns), seen))
        return df.observe(seen, F.count(F.lit(1)).alias("n_rows"), *more)

    def figures(self, stage: str) -> dict:
        return next(seen.get for name, _, seen in self.stages if name == stage)

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(stage, seen.get["n_rows"], columns) for stage, columns, seen in self.stages]
        return spark.createDataFrame(rows, "stage string, n_rows long, n_columns int")
