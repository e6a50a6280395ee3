"""Candidate slots of open jobs before any placement."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from crewcast.functions.dates import add_business_days, later
from crewcast.operators.joins import join_null_safe
from crewcast.operators.locks import SITE, lock_days, lock_sets
from crewcast.operators.matching import POOL, crew_classes, crew_order, pool_matches, pools_of
from crewcast.operators.ranking import spread_rank
from crewcast.operators.triage import BOOKED, FORECAST
from crewcast.params import Params
from crewcast.session import materialise


def wanted_start(jobs: DataFrame, params: Params) -> DataFrame:
    """Unbooked jobs with their search start ``first_day`` and remaining ``last_offset``."""
    today = F.lit(params.as_of)
    start = F.when(F.col("phase") == FORECAST, F.col("JobStartDateForecast")).otherwise(F.col("JobStart"))
    return (
        jobs.where(F.col("phase") >= FORECAST)
        .withColumn("_start", start)
        .withColumns(
            {
                "last_offset": F.col("JobStartMaxOffset") - F.greatest(F.datediff(today, "_start"), F.lit(0)),
                "first_day": later(F.col("_start"), F.date_add(today, params.job_start_buffer)),
            }
        )
        .drop("_start")
    )


def candidate_slots(jobs: DataFrame, calendar: DataFrame, params: Params) -> DataFrame:
    """One row per job and offset: ``slot_start`` to ``slot_end`` within the planning window.

    Offsets count business days, so there are never more than the days of the window.
    """
    cap = F.least(F.col("last_offset"), F.lit(params.scheduled_backlog_offset))
    offsets = (
        wanted_start(jobs, params)
        .where(F.col("last_offset") >= 0)
        .withColumn("offset", F.explode(F.sequence(F.lit(0), cap)))
    )
    started = add_business_days(offsets, "first_day", F.col("offset"), "slot_start", calendar)
    started = started.where(F.col("slot_start") <= F.lit(params.plan_end))
    return add_business_days(
        started, "slot_start", F.col("JobDuration") + params.job_buffer, "slot_end", calendar
    )


def site_free_slots(jobs: DataFrame, locks: DataFrame, calendar: DataFrame, params: Params) -> DataFrame:
    """Candidate slots without a locked day of the site."""
    # the locks join the jobs, not their many slots; a slot looks up the next locked day in one step
    first = params.as_of + dt.timedelta(days=params.job_start_buffer)
    soonest = next_locked_days(locks, first, params.plan_end)
    # only jobs that have slots carry them; slots start from the first to the last day of the plan
    wanted = jobs.where(F.col("phase") >= FORECAST).join(soonest, list(SITE), "left")
    lock = F.get("next_locked", F.datediff("slot_start", F.lit(first)))
    free = candidate_slots(wanted, calendar, params).where(lock.isNull() | (lock > F.col("slot_end")))
    return free.drop("next_locked")


def run_lengths(held: Column, at: Callable[[Column], Column], value: Callable[[Column], Column], first: int, last: int) -> Column:
    """For each number from ``first`` the ``value`` of the next entry of ``held`` that lies at it or after it.

    ``held`` is sorted by ``at``; of entries at one number the first counts. The result ends at the last entry or at ``last``. Each
    entry fills the numbers since the entry before, so a site costs its entries, not
    entries times days.
    """

    def until(x: Column) -> Column:
        return F.least(at(x), F.lit(last))

    def run(x: Column, i: Column) -> Column:
        before = F.when(i == 0, F.lit(first - 1)).otherwise(until(F.get(held, i - 1)))
        return F.array_repeat(value(x), until(x) - before)

    return F.flatten(F.transform(held, run))


def next_locked_days(locks: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """``(*SITE, next_locked)``: for each day from ``first`` to ``last`` the next locked day at or after it."""
    epoch = dt.date(1970, 1, 1)
    coming = lock_sets(locks).withColumn("held", F.filter("locked_days", lambda d: d >= F.lit(first)))
    filled = run_lengths(F.col("held"), F.unix_date, lambda d: d, (first - epoch).days, (last - epoch).days)
    return coming.select(*SITE, filled.alias("next_locked"))


#: Columns whose crews are alike but for their rank.
GROUP = ("Market", "VendorID", "held", "ValidFrom", "ValidUntil")

#: Days of a bucket in which busy spans and slots meet.
BUCKET_DAYS = 8


def busy_spans(jobs: DataFrame, calendar: DataFrame, params: Params) -> DataFrame:
    """``(VendorID, crew_name, busy_from, busy_to)``: the days on which booked jobs keep their crews, with the time after."""
    booked = jobs.where(F.col("phase") == BOOKED).where("LockVendor IS NOT NULL")
    ended = add_business_days(booked, "JobStart", F.col("JobDuration") + params.job_buffer, "_end", calendar)
    return ended.select(
        F.col("LockVendor").alias("VendorID"),
        F.col("CrewIdBooked").alias("crew_name"),
        F.least("JobStart", "_end").alias("busy_from"),
        F.date_add("_end", params.job_downtime).alias("busy_to"),
    )


def _buckets(first: Column, last: Column) -> Column:
    return F.sequence(F.floor(F.unix_date(first) / BUCKET_DAYS), F.floor(F.unix_date(last) / BUCKET_DAYS))


def busy_crews(slots: DataFrame, ranked: DataFrame, busy: DataFrame, params: Params) -> DataFrame:
    """``(*GROUP, nth, slot_start, slot_end)``: ranked crews that are valid for a slot of their market but busy in it.

    Busy spans and slots are cut into buckets of days and meet by market and bucket; the
    exact overlap is tested on what meets, in the first bucket that both have.
    """
    until = F.date_add("slot_end", params.job_downtime)
    wanted = slots.select("Market", "slot_start", "slot_end").distinct().withColumn("_until", F.greatest(until, F.col("slot_start")))
    wanted = wanted.withColumn("_bucket", F.explode(_buckets(F.col("slot_start"), F.col("_until"))))
    spans = ranked.join(busy, ["VendorID", "crew_name"]).withColumn("_bucket", F.explode(_buckets(F.col("busy_from"), F.col("busy_to"))))
    met = spans.join(wanted, ["Market", "_bucket"])
    met = met.where((F.col("busy_from") <= F.col("_until")) & (F.col("slot_start") <= F.col("busy_to")))
    met = met.where((F.col("slot_start") >= F.col("ValidFrom")) & (F.col("slot_end") <= F.col("ValidUntil")))
    later = F.floor(F.greatest(F.unix_date("busy_from"), F.unix_date("slot_start")) / BUCKET_DAYS)
    return met.where(F.col("_bucket") == later).select(*GROUP, "nth", "slot_start", "slot_end").distinct()


def crew_options(slots: DataFrame, crews: DataFrame, busy: DataFrame | None = None, params: Params | None = None) -> DataFrame:
    """Valid crews per distinct (pool, slot): their number and the preferred one; with ``busy`` spans, of the free ones.

    Crews that a pool may draw on and that are valid over the same days differ only in
    rank, so they enter the join as one row with their number and best crew. Busy crews are
    taken off that number, and the best free one of a group is the first rank that no busy
    crew has.
    """
    slot = [*POOL, "slot_start", "slot_end"]
    wanted = materialise(slots.select(*slot).distinct(), "slots")
    listed = crews.where(F.col("Market").isNotNull())
    valid = (F.col("slot_start") >= F.col("ValidFrom")) & (F.col("slot_end") <= F.col("ValidUntil"))
    rank = F.struct("Score", "VendorID", "crew_name", "ValidFrom", "ValidUntil")
    if busy is None:
        span = ["ValidFrom", "ValidUntil"]
        best, n_crews = F.max("best").alias("best"), F.sum("n_crews").alias("n_crews")
        groups = listed.withColumns({"best": rank, "n_crews": F.lit(1)}).groupBy("Market", "VendorID", "have_key", *span).agg(best, n_crews)
        matches = pool_matches(pools_of(wanted), crew_classes(crews), groups).groupBy(*POOL, *span).agg(best, n_crews)
        free = join_null_safe(wanted, matches, POOL).where(valid)
    else:
        named = listed.select("Market", "VendorID", "have_key", F.col("have_key").alias("held"), "ValidFrom", "ValidUntil", "crew_name", "Score")
        ranked = materialise(spread_rank(named, GROUP, crew_order(), "nth"), "ranked-crews")
        groups = ranked.groupBy("have_key", *GROUP).agg(F.count("*").alias("n_crews"))
        options = join_null_safe(wanted, pool_matches(pools_of(wanted), crew_classes(crews), groups), POOL).where(valid)
        order = Window.partitionBy(*GROUP, "slot_start", "slot_end").orderBy("nth")
        taken = busy_crews(wanted, ranked, busy, params).withColumn("_before", F.row_number().over(order) - 1)
        run = F.sum(F.when(F.col("nth") == F.col("_before"), 1).otherwise(0)).alias("nth")
        taken = taken.groupBy(*GROUP, "slot_start", "slot_end").agg(F.count("*").alias("n_busy"), run)
        options = join_null_safe(options, taken, [*GROUP, "slot_start", "slot_end"], "left")
        options = options.withColumns({"n_crews": F.col("n_crews") - F.coalesce("n_busy", F.lit(0)), "nth": F.coalesce("nth", F.lit(0)).cast("long")})
        tops = ranked.select(*GROUP, F.col("nth").cast("long").alias("nth"), rank.alias("best"))
        free = join_null_safe(options.where("n_crews > 0"), tops, [*GROUP, "nth"])
    found = free.groupBy(*slot).agg(F.max("best").alias("best"), F.sum("n_crews").alias("n_crews"))
    return found.select(*slot, F.col("n_crews").cast("int").alias("n_crews"), "best.VendorID", "best.crew_name")


def crew_reach(jobs: DataFrame, crews: DataFrame, calendar: DataFrame, days: range, params: Params) -> DataFrame:
    """``(*POOL, reach)``: for each business day of ``days`` the last one up to which some crew that is valid then stays so.

    Days are business numbers. A pool's crews enter as one number for each day on which
    their validity starts, so a pool has as many entries as the plan has days at most.
    """
    known = (F.lit(params.calendar_first), F.lit(params.calendar_last))
    spans = crews.where(F.col("Market").isNotNull()).select("Market", "VendorID", "have_key", "ValidFrom", "ValidUntil").distinct()
    spans = spans.where((F.col("ValidFrom") <= known[1]) & (F.col("ValidUntil") >= known[0]))
    spans = spans.withColumns({"ValidFrom": F.greatest("ValidFrom", known[0]), "ValidUntil": F.least("ValidUntil", known[1])})
    first = calendar.select(F.col("day").alias("ValidFrom"), F.col("ord").alias("first"))
    last = calendar.select(F.col("day").alias("ValidUntil"), (F.col("ord") - F.when(F.col("is_business"), 0).otherwise(1)).alias("last"))
    dated = spans.join(F.broadcast(first), "ValidFrom").join(F.broadcast(last), "ValidUntil")
    dated = dated.withColumn("first", F.greatest("first", F.lit(days.start))).where(F.col("first") < days.stop)
    groups = dated.groupBy("Market", "VendorID", "have_key", "first").agg(F.max("last").alias("last"))
    found = pool_matches(pools_of(jobs), crew_classes(crews), groups).groupBy(*POOL, "first").agg(F.max("last").alias("last"))
    listed = found.groupBy(*POOL).agg(F.collect_list(F.struct("first", "last")).alias("spans"))

    def most(day: Column) -> Column:
        return F.array_max(F.transform(F.filter("spans", lambda x: x["first"] <= day), lambda x: x["last"]))

    return listed.select(*POOL, F.transform(_numbers(days), most).alias("reach"))


def _numbers(days: range) -> Column:
    return F.sequence(F.lit(days.start), F.lit(days.stop - 1))


def next_locks(locks: DataFrame, calendar: DataFrame, days: range) -> DataFrame:
    """``(*SITE, next_lock)``: for each business day of ``days`` the next one at or after which the site is locked.

    A lock on a day without work stands between two business days: a slot meets it if it
    starts before and ends after it.
    """
    numbered = calendar.select("day", F.col("ord").alias("to"), (F.col("ord") - F.when(F.col("is_business"), 0).otherwise(1)).alias("from"))
    dated = lock_days(locks).join(F.broadcast(numbered), "day").where(F.col("from") >= days.start)
    listed = dated.groupBy(*SITE).agg(F.array_sort(F.collect_set(F.struct("from", "to"))).alias("held"))
    filled = run_lengths(F.col("held"), lambda x: x["from"], lambda x: x["to"], days.start, days.stop - 1)
    return listed.select(*SITE, filled.alias("next_lock"))


def first_slot(
    jobs: DataFrame, crews: DataFrame, locks: DataFrame, calendar: DataFrame, params: Params
) -> DataFrame:
    """Each job's first feasible slot and crew if nobody else were placed.

    Jobs keep to one row. A pool carries, for each business day of the plan, how far its
    crews reach, and a site its next lock; a day is feasible if the slot that starts there
    ends before the lock and within reach. Crews are looked up for the chosen slots only.
    """
    first = params.as_of + dt.timedelta(days=params.job_start_buffer)
    ends = calendar.where(F.col("day").isin(first, params.plan_end)).select("day", "ord", "is_business").collect()
    known = {r["day"]: r for r in ends}  # two days
    days = range(known[first]["ord"], known[params.plan_end]["ord"] + int(known[params.plan_end]["is_business"]))
    wanted = wanted_start(jobs, params).where(F.col("last_offset") >= 0)
    at = calendar.select(F.col("day").alias("first_day"), F.col("ord").alias("first_ord"))
    dated = wanted.join(F.broadcast(at), "first_day").join(next_locks(locks, calendar, days), list(SITE), "left")
    joined = join_null_safe(dated, crew_reach(wanted, crews, calendar, days, params), POOL)
    length = F.col("JobDuration") + params.job_buffer
    until = F.least(F.col("first_ord") + F.col("last_offset"), F.lit(days.stop - 1))

    def feasible(day: Column) -> Column:
        place = (day - days.start).cast("int")
        lock, reach = F.get("next_lock", place), F.get("reach", place)
        return (F.col("next_lock").isNull() | lock.isNull() | (lock > day + length)) & (reach >= day + length)

    starts = F.when(F.col("first_ord") <= until, F.sequence("first_ord", until))
    chosen = joined.withColumn("_at", F.get(F.filter(starts, feasible), F.lit(0))).where("_at IS NOT NULL")
    chosen = chosen.select("JobID", *POOL, (F.col("_at") - F.col("first_ord")).alias("offset"), "_at", (F.col("_at") + length).alias("_to"))
    for number, name in (("_at", "slot_start"), ("_to", "slot_end")):
        open_days = calendar.where("is_business").select(F.col("day").alias(name), F.col("ord").alias("_ord"))
        chosen = chosen.join(F.broadcast(open_days), F.col(number) == F.col("_ord")).drop("_ord", number)
    chosen = materialise(chosen, "chosen-slots")
    best = crew_options(chosen, crews)
    found = join_null_safe(chosen, best, [*POOL, "slot_start", "slot_end"])
    return found.select("JobID", "offset", "slot_start", "slot_end", "VendorID", "crew_name")
