"""The driver's tables seen as jobs, crews, events, weather and construction records.

Every column is a fixed whole-number formula over the source keys, so the same view can
be written in SQL.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from crewcast.params import Params
from crewcast.plans.allocation import Inputs

# The market segments of the customer table, used as skills.
SKILLS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


@cache
def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The table as a lazy scan; keeping it saves reading the file schema again."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _pick(index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(s) for s in SKILLS]), (index % 5 + 1).cast("int"))


def _days(base: Column, count: Column) -> Column:
    return F.date_add(base, count.cast("int"))


def sites(spark: SparkSession, folder: str) -> DataFrame:
    """One site per customer row; four operators per nation."""
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    return (
        table(spark, folder, "customer")
        .join(table(spark, folder, "nation"), nation == F.col("n_nationkey"))
        .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            key.alias("c_custkey"),
            nation.alias("c_nationkey"),
            F.concat(F.col("n_name"), F.lit("/"), (key % 4).cast("string")).alias("customer_id"),
            F.concat(F.lit("S"), key.cast("string")).alias("SiteCode"),
            (nation * 4 - 50 + (key * 37 % 1000) / 2000).alias("Latitude"),
            (nation * 10 - 120 + (key * 59 % 1000) / 2000).alias("Longitude"),
            F.col("n_name").alias("Market"),
            F.col("r_name").alias("Region"),
            F.col("c_mktsegment").alias("segment"),
        )
    )


def crews(spark: SparkSession, folder: str, params: Params) -> DataFrame:
    """Three crews per supplier."""
    today = F.lit(params.as_of)
    n = F.col("s_suppkey") * 3 + F.col("k")
    held = F.concat_ws(
        " | ", _pick(n), _pick(n + 1), F.when(n % 2 == 0, _pick(n + 2)), F.when(n % 6 == 0, _pick(n + 3))
    )
    return (
        table(spark, folder, "supplier")
        .join(table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(2))))
        .select(
            F.concat(F.lit("V"), (F.col("s_suppkey") % 5).cast("string")).alias("VendorID"),
            F.concat(F.col("s_name"), F.lit("/"), F.col("k").cast("string")).alias("crew_name"),
            F.lower("n_name").alias("Market"),
            F.col("r_name").alias("region"),
            F.when(n % 29 != 28, _days(today, n % 3 * 20 - 30)).alias("ValidFrom"),
            _days(today, 60 + n % 4 * 40).alias("ValidUntil"),
            F.col("s_acctbal").alias("Score"),
            held.alias("Skills1"),
        )
    )


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with their number of lines."""
    lines = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n_lines"))
    orders = table(spark, folder, "orders").withColumn("created", F.to_date("o_orderdate"))
    return orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").withColumn(
        "n_lines", F.coalesce("n_lines", F.lit(0))
    ).drop("l_orderkey")


def _numbered_suppliers(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers with their number ``nth`` within the nation: those of earlier runs of keys, plus the earlier ones of their own run."""
    suppliers = table(spark, folder, "supplier").select(
        "s_nationkey",
        "s_suppkey",
        F.floor(F.col("s_suppkey") / 1000).alias("run"),
        F.col("s_name").alias("booked_name"),
        F.concat(F.lit("V"), (F.col("s_suppkey") % 5).cast("string")).alias("booked_vendor"),
    )
    earlier = Window.partitionBy("s_nationkey").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = suppliers.groupBy("s_nationkey", "run").agg(F.count("*").alias("n"))
    starts = runs.select("s_nationkey", "run", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    inside = F.row_number().over(Window.partitionBy("s_nationkey", "run").orderBy("s_suppkey")) - 1
    numbered = suppliers.withColumn("within", inside).join(starts, ["s_nationkey", "run"])
    return numbered.select("s_nationkey", "booked_name", "booked_vendor", (F.col("start") + F.col("within")).alias("nth"))


def jobs(spark: SparkSession, folder: str, params: Params) -> DataFrame:
    """One job per order at the customer's site."""
    key, created = F.col("o_orderkey"), F.col("created")
    today = F.lit(params.as_of)
    suppliers = _numbered_suppliers(spark, folder)
    base = order_lines(spark, folder).join(sites(spark, folder), F.col("o_custkey") == F.col("c_custkey"))
    counts = suppliers.groupBy(F.col("s_nationkey").alias("cn")).agg(F.count("*").alias("n_suppliers"))
    base = base.join(counts, F.col("c_nationkey") == F.col("cn"), "left").withColumn(
        "pick", F.when(F.col("n_suppliers") > 0, key % F.col("n_suppliers"))
    )
    base = base.join(
        suppliers,
        (F.col("c_nationkey") == F.col("s_nationkey")) & (F.col("pick") == F.col("nth")),
        "left",
    )
    start = _days(created, 10 + key % 20)
    booked = (
        F.when(key % 143 == 0, F.lit(params.placeholder_crew))
        .when(key % 121 == 0, F.lit("Unlisted crew"))
        .when(key % 11 == 0, F.concat(F.col("booked_name"), F.lit("/"), (key % 3).cast("string")))
    )
    vendor = F.when((key % 11 == 0) & (key % 2 == 0), F.col("booked_vendor")).when(
        (key % 11 != 0) & (key % 7 == 0), F.concat(F.lit("V"), (key % 5).cast("string"))
    )
    finish = (
        F.when(key % 97 == 0, _days(start, F.lit(-3)))
        .when(key % 101 == 0, _days(start, F.lit(200)))
        .otherwise(_days(start, 1 + 2 * F.col("n_lines") + key % 4))
    )
    has_forecast = key % 5 != 0
    return base.select(
        key.cast("string").alias("JobID"),
        "customer_id",
        "SiteCode",
        "Latitude",
        "Longitude",
        F.lower("Market").alias("Market"),
        F.when(key % 53 != 0, F.concat_ws("| ", "segment", F.when(key % 4 == 0, _pick(key)))).alias("Skills"),
        vendor.alias("VendorBooked"),
        booked.alias("CrewIdBooked"),
        F.when(key % 10 != 9, F.substring("o_orderpriority", 1, 1).cast("int")).alias("Priority"),
        created.alias("JobCreateDate"),
        F.when(has_forecast, start).alias("JobStartDateForecast"),
        F.when(has_forecast, finish).alias("JobEndDateForecast"),
        F.when(F.col("o_orderstatus") == "F", _days(created, F.lit(12))).alias("JobStartDateActual"),
        F.when((F.col("o_orderstatus") == "F") & (key % 8 != 0), _days(created, F.lit(40))).alias("JobEndDateActual"),
        F.when(key % 3 != 0, _days(created, 5 + key % 9)).alias("SiteReadinessForecast"),
        F.when(key % 6 != 0, key % 40 / 4 + 2).alias("JobDurationML"),
        F.when(key % 4 == 0, (5 + key % 30).cast("int")).alias("JobStartMaxOffset"),
        today.alias("refresh_date"),
    )


def _event_sites(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    rows = table(spark, folder, "events").where(F.col("event_type") == kind)
    rows = rows.withColumn("site_key", F.col("user_id") * 10 + F.col("event_id") % 10)
    return rows.join(sites(spark, folder), F.col("site_key") == F.col("c_custkey"))


def events(spark: SparkSession, folder: str, params: Params) -> DataFrame:
    """Sign-up events; most name one site, some a customer, a place or everybody."""
    m = F.col("event_id") % 50000
    start = _days(F.lit(params.as_of), (F.dayofmonth("ts") - 1) * 3)
    # fixed values: key ranges of the rarer scopes
    any_site = m.between(100, 319) | m.between(500, 704)
    any_customer = m.between(400, 704)
    market = m.between(200, 219) | m.between(310, 319) | m.between(400, 459) | m.between(500, 509) | m.between(605, 609)
    region = m.between(300, 319) | m.between(440, 459) | m.between(600, 609)
    wrong = m.between(310, 319) | m.between(440, 459) | m.between(605, 609)  # no such market
    return _event_sites(spark, folder, "signup").select(
        F.when(~any_customer, F.col("customer_id")).alias("CustomerID"),
        F.when(~any_site, F.col("SiteCode")).alias("SiteCode"),
        F.when(wrong, F.lit("nowhere")).when(market, F.lower("Market")).alias("Market"),
        F.when(region, F.lower("Region")).alias("Region"),
        start.alias("ValidFrom"),
        _days(start, F.col("event_id") % 3).alias("ValidUntil"),
    )


def weather(spark: SparkSession, folder: str, params: Params) -> DataFrame:
    """Error events as bad-weather days."""
    return _event_sites(spark, folder, "error").select(
        F.col("customer_id").alias("CustomerID"),
        F.col("SiteCode").alias("SiteID"),
        _days(F.lit(params.as_of), (F.dayofmonth("ts") - 1) * 3 + F.col("event_id") % 3).alias("Date"),
    )


def inputs(spark: SparkSession, folder: str, params: Params) -> Inputs:
    return Inputs(
        jobs(spark, folder, params),
        crews(spark, folder, params),
        events(spark, folder, params),
        weather(spark, folder, params),
    )


def construction(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as construction records: the part's kind is the work package."""
    key, line = F.col("l_orderkey"), F.col("l_linenumber")
    shipped = F.to_date("l_shipdate")
    length = F.col("l_quantity").cast("int") + F.when(F.col("l_partkey") % 50 == 0, 200).otherwise(F.col("p_size"))
    lines = table(spark, folder, "lineitem").join(
        table(spark, folder, "part").select("p_partkey", "p_type", "p_size"), F.col("l_partkey") == F.col("p_partkey")
    )
    owned = lines.join(table(spark, folder, "orders").select("o_orderkey", "o_custkey"), key == F.col("o_orderkey"))
    full = owned.join(sites(spark, folder), F.col("o_custkey") == F.col("c_custkey"))
    none = F.lit(None).cast("string")
    return full.select(
        F.to_date("l_shipdate").alias("refresh_date"),
        F.concat_ws("-", key.cast("string"), line.cast("string")).alias("id"),
        F.lower("Region").alias("region"),
        F.lower("Market").alias("market"),
        F.col("p_type").alias("package_name"),
        F.col("SiteCode").alias("site"),
        shipped.alias("civil_start"),
        _days(shipped, F.lit(5)).alias("civil_end"),
        _days(shipped, F.lit(6)).alias("tower_start"),
        F.when(key % 41 != 0, _days(shipped, length - F.when(key % 37 == 0, 400).otherwise(0))).alias("tower_end"),
        F.col("customer_id").alias("customer"),
        F.when(key % 43 != 0, F.col("Latitude")).alias("latitude"),
        F.col("Longitude").alias("longitude"),
        F.concat(F.lit("P"), (key % 100).cast("string")).alias("project_name"),
        none.alias("site_type"),
        none.alias("plan_type"),
        none.alias("site_class"),
        none.alias("configuration"),
    )
