"""Calendar tables, business-day arithmetic and date ranges."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from crewcast.params import Params

HOLIDAY_ROWS = T.StructType([T.StructField("country", T.StringType()), T.StructField("day", T.DateType())])


def parse_date(column: Column) -> Column:
    """ISO day from text; unreadable text gives null."""
    return F.try_to_date(column, "yyyy-MM-dd")


def whole_days(end: Column, start: Column) -> Column:
    return F.datediff(end, start)


def later(left: Column, right: Column) -> Column:
    return F.greatest(left, right)


def day_range(df: DataFrame, start: str, end: str, out: str = "day") -> DataFrame:
    """One row per calendar day from ``start`` to ``end``, both included.

    Rows with a null bound or an empty range are dropped.
    """
    kept = df.where(F.col(start) <= F.col(end))
    return kept.withColumn(out, F.explode(F.sequence(F.col(start), F.col(end))))


def date_parts(df: DataFrame, column: str) -> DataFrame:
    day = F.col(column)
    return df.withColumns({"year": F.year(day), "month": F.month(day), "day": F.dayofmonth(day)})


def no_holidays(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], HOLIDAY_ROWS)


def select_holidays(holidays: DataFrame, country: str, first_year: int, last_year: int) -> DataFrame:
    """Distinct holidays of one country; an empty country code means none."""
    wanted = (F.col("country") == F.lit(country)) & F.year("day").between(first_year, last_year)
    return holidays.where(wanted & F.lit(bool(country))).select("day").distinct()


def business_calendar(spark: SparkSession, params: Params, holidays: DataFrame | None = None) -> DataFrame:
    """``(day, is_business, ord)`` for every day of the planning years.

    ``ord`` numbers the business days; another day carries the number of the next
    business day, which is the roll forward. The table has at most 366 rows per
    planning year whatever the data size, so it may be broadcast.
    """
    first, last = params.calendar_first, params.calendar_last
    days = spark.range((last - first).days + 1).select(
        F.date_add(F.lit(first), F.col("id").cast("int")).alias("day")
    )
    open_on = F.element_at(F.array(*[F.lit(c == "1") for c in params.weekmask]), F.weekday("day") + 1)
    days = days.withColumn("workday", open_on)
    if holidays is None:
        days = days.withColumn("is_business", F.col("workday"))
    else:
        off = select_holidays(holidays, params.country_code, first.year, last.year).withColumn("off", F.lit(True))
        days = days.join(F.broadcast(off), "day", "left").withColumn(
            "is_business", F.col("workday") & F.col("off").isNull()
        )
    is_open = F.col("is_business").cast("int")
    # bounded by the planning years, so a single partition is fine here
    running = F.sum(is_open).over(Window.partitionBy(F.lit(1)).orderBy("day"))
    return days.select("day", "is_business", (running - is_open).cast("int").alias("ord"))


def holiday_days(holidays: DataFrame | None, params: Params) -> list[dt.date]:
    """Holidays as a Python list, over the same years as the calendar; never more than 366 entries per planning year."""
    if holidays is None:
        return []
    chosen = select_holidays(holidays, params.country_code, params.calendar_first.year, params.calendar_last.year)
    return sorted(row["day"] for row in chosen.collect())


def add_business_days(df: DataFrame, start: str, count: Column, out: str, calendar: DataFrame) -> DataFrame:
    """Roll ``start`` forward to a business day, then move ``count`` business days on.

    Two equi-joins against the broadcast calendar. A null start gives null; a day outside
    the calendar stops the job, since its end would be unknown: widen the planning years.
    """
    rolled = F.broadcast(calendar.select(F.col("day").alias("_from"), F.col("ord").alias("_ord")))
    target = F.broadcast(
        calendar.where("is_business").select(F.col("day").alias(out), F.col("ord").alias("_target"))
    )
    outside = F.raise_error(F.concat(F.lit(f"{out}: a day outside the planning calendar, from "), F.col(start).cast("string")))
    want = F.when(F.col(start).isNotNull() & F.col("_ord").isNull(), outside.cast("int")).otherwise(F.col("_ord") + count)
    known = F.when(F.col("_want").isNotNull() & F.col("_target").isNull(), outside.cast("date")).otherwise(F.col(out))
    return (
        df.join(rolled, F.col(start) == F.col("_from"), "left")
        .withColumn("_want", want)
        .join(target, F.col("_want") == F.col("_target"), "left")
        .withColumn(out, known)
        .drop("_from", "_ord", "_want", "_target")
    )
