"""Which crews qualify for which jobs.

Jobs that share market, booked vendor and required skills form a *pool*; crews that
share market, vendor and held skills form a *class*. Pools are matched to classes, so
the work depends on the distinct combinations and never on jobs times crews.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crewcast.functions.text import contains_all, skill_key, skill_set
from crewcast.operators.clean import first_per_key
from crewcast.operators.joins import join_null_safe
from crewcast.operators.ranking import spread_rank

POOL = ("Market", "VendorBooked", "need_key")


def with_need(jobs: DataFrame) -> DataFrame:
    return jobs.withColumn("need_key", skill_key(F.col("Skills")))


def with_have(crews: DataFrame) -> DataFrame:
    return crews.withColumn("have_key", skill_key(F.col("Skills1")))


def pools_of(jobs: DataFrame) -> DataFrame:
    return jobs.select(*POOL).distinct()


def crew_classes(crews: DataFrame) -> DataFrame:
    listed = crews.where(F.col("Market").isNotNull())
    return listed.groupBy("Market", "VendorID", "have_key").agg(F.count("*").alias("n_crews"))


def skill_pairs(pools: DataFrame, classes: DataFrame) -> DataFrame:
    """``(Market, need_key, have_key)`` where the held set contains the required one.

    Every required set looks only at held sets with its rarest skill of the market,
    then checks the whole set. An empty required set matches every held set.
    """
    needs = pools.select("Market", "need_key").where(F.col("Market").isNotNull()).distinct()
    needs = needs.withColumn("need", skill_set(F.col("need_key")))
    haves = classes.select("Market", "have_key").distinct().withColumn("have", skill_set(F.col("have_key")))

    held = haves.withColumn("skill", F.explode("have"))
    frequency = held.groupBy("Market", "skill").agg(F.count("*").alias("n_sets"))
    rarest = (
        needs.withColumn("skill", F.explode("need"))
        .join(frequency, ["Market", "skill"], "left")
        .groupBy("Market", "need_key")
        .agg(F.min(F.struct(F.coalesce("n_sets", F.lit(0)).alias("n"), "skill"))["skill"].alias("skill"))
        .withColumn("need", skill_set(F.col("need_key")))
    )
    named = rarest.join(held, ["Market", "skill"]).where(contains_all(F.col("have"), F.col("need")))
    free = needs.where(F.size("need") == 0).join(haves, "Market")
    columns = ("Market", "need_key", "have_key")
    return named.select(*columns).unionByName(free.select(*columns))


def pool_matches(pools: DataFrame, classes: DataFrame, right: DataFrame) -> DataFrame:
    """Pool columns plus the matching rows of ``right``.

    ``right`` has ``Market, VendorID, have_key`` and is either the classes or the crews.
    The booked vendor is part of the equi-join key; no booked vendor admits all vendors.
    """
    # a crew is found under its own vendor and under "no vendor booked"
    listed = right.withColumn("VendorBooked", F.explode(F.array(F.lit(None).cast("string"), "VendorID")))
    sets = join_null_safe(skill_pairs(pools, classes), pools, ["Market", "need_key"])
    return join_null_safe(sets, listed, ["Market", "have_key", "VendorBooked"]).drop("have_key")


def count_qualified(jobs: DataFrame, crews: DataFrame) -> DataFrame:
    """Jobs with ``CountQualified``; ``jobs`` carries ``need_key``, ``crews`` ``have_key``."""
    classes = crew_classes(crews)
    pools = pools_of(jobs)
    counts = pool_matches(pools, classes, classes).groupBy(*POOL).agg(F.sum("n_crews").alias("_n"))
    joined = join_null_safe(jobs, counts, POOL, "left")
    return joined.withColumn("CountQualified", F.coalesce("_n", F.lit(0)).cast("int")).drop("_n")


def crews_in_market(jobs: DataFrame, crews: DataFrame) -> DataFrame:
    """Number of crews in each job's market."""
    sizes = crews.groupBy("Market").agg(F.count("*").alias("n_crews"))
    return jobs.join(sizes, "Market").select("JobID", "Market", "n_crews")


def crews_of_vendor(jobs: DataFrame, crews: DataFrame) -> DataFrame:
    """Number of crews of each job's market that its booked vendor, if any, allows."""
    listed = crews.where(F.col("Market").isNotNull())
    by_vendor = listed.groupBy("Market", F.col("VendorID").alias("VendorBooked")).agg(F.count("*").alias("n_crews"))
    by_market = listed.groupBy("Market").agg(F.count("*").alias("n_crews"))
    booked = jobs.select("JobID", "Market", "VendorBooked")
    tied = booked.where("VendorBooked is not null").join(by_vendor, ["Market", "VendorBooked"])
    free = booked.where("VendorBooked is null").join(by_market, "Market")
    columns = ("JobID", "Market", "VendorBooked", "n_crews")
    return tied.select(*columns).unionByName(free.select(*columns))


def crew_order() -> list:
    """Preference among qualified crews."""
    return [F.col(c).desc_nulls_last() for c in ("Score", "VendorID", "crew_name", "ValidFrom", "ValidUntil")]


def qualified_crews(jobs: DataFrame, crews: DataFrame) -> DataFrame:
    """The ordered crew list of every pool, one row per entry, ``rank`` from 0."""
    columns = crews.select("Market", "VendorID", "have_key", "crew_name", "Score", "ValidFrom", "ValidUntil")
    matches = pool_matches(pools_of(jobs), crew_classes(crews), columns)
    return spread_rank(matches, POOL, crew_order(), "rank")


def qualified_per_job(jobs: DataFrame, crews: DataFrame) -> DataFrame:
    """The ordered crew list of every job: each job's pool list, joined by pool."""
    listed = qualified_crews(jobs, crews)
    joined = join_null_safe(jobs.select("JobID", *POOL), listed, POOL)
    return joined.select("JobID", "rank", "VendorID", "crew_name", "Score", "ValidFrom", "ValidUntil")


def crew_list_ends(jobs: DataFrame, crews: DataFrame) -> DataFrame:
    """Length, first and last entry of every job's crew list.

    Each pool's list is summed up before the jobs are joined, so a job meets one row.
    """
    entry = F.struct("Score", "VendorID", "crew_name", "ValidFrom", "ValidUntil")
    listed = crews.where(F.col("Market").isNotNull()).withColumn("entry", entry)
    ends = [F.sum("n").alias("n_crews"), F.max("top").alias("top"), F.min("end").alias("end")]
    groups = listed.groupBy("Market", "VendorID", "have_key").agg(
        F.count("*").alias("n"), F.max("entry").alias("top"), F.min("entry").alias("end")
    )
    pools = pool_matches(pools_of(jobs), crew_classes(crews), groups).groupBy(*POOL).agg(*ends)
    joined = join_null_safe(jobs.select("JobID", *POOL), pools, POOL)
    return joined.select("JobID", "n_crews", F.col("top.crew_name").alias("first_crew"), F.col("end.crew_name").alias("last_crew"))


def best_crew(jobs: DataFrame, crews: DataFrame) -> DataFrame:
    """First entry of every job's crew list, found per class before the join."""
    entry = ("Score", "VendorID", "crew_name", "ValidFrom", "ValidUntil")
    top = first_per_key(crews.where(F.col("Market").isNotNull()), ["Market", "VendorID", "have_key"], crew_order())
    matches = pool_matches(pools_of(jobs), crew_classes(crews), top.select("Market", "have_key", *entry))
    best = first_per_key(matches, POOL, crew_order())
    return join_null_safe(jobs.select("JobID", *POOL), best, POOL).select("JobID", *entry)


def market_regions(crews: DataFrame) -> DataFrame:
    """One region per market."""
    listed = crews.where(F.col("Market").isNotNull())
    return listed.groupBy("Market").agg(F.min("Region").alias("Region"))


def add_region(jobs: DataFrame, crews: DataFrame) -> DataFrame:
    return jobs.join(market_regions(crews), "Market", "left")


def add_recommended_vendor(jobs: DataFrame, crews: DataFrame, shortage: str) -> DataFrame:
    """Vendor of the recommended crew; the shortage message is passed through."""
    vendors = crews.select(
        F.col("crew_name").alias("RecommendedWorker"), F.col("VendorID").alias("RecommendedVendor")
    ).distinct()
    joined = jobs.join(vendors, "RecommendedWorker", "left")
    short = F.col("RecommendedWorker") == shortage
    return joined.withColumn("RecommendedVendor", F.when(short, F.lit(shortage)).otherwise(F.col("RecommendedVendor")))
