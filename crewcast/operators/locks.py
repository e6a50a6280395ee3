"""Days on which a site may not be worked on."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crewcast.functions.dates import day_range
from crewcast.params import Params

SITE = ("customer_id", "SiteCode")


def weather_locks(weather: DataFrame) -> DataFrame:
    return (
        weather.select(
            F.col("CustomerID").alias("customer_id"), F.col("SiteID").alias("SiteCode"), F.col("Date").alias("day")
        )
        .dropna()
        .distinct()
    )


def event_days(events: DataFrame, params: Params) -> DataFrame:
    """Distinct scope-days: each event's days within the planning years, both bounds known."""
    clipped = events.dropna(subset=["ValidFrom", "ValidUntil"]).select(
        F.col("CustomerID").alias("x_customer"),
        F.col("SiteCode").alias("x_site"),
        F.col("Market").alias("x_market"),
        F.col("Region").alias("x_region"),
        F.greatest("ValidFrom", F.lit(params.calendar_first)).alias("_from"),
        F.least("ValidUntil", F.lit(params.calendar_last)).alias("_until"),
    )
    scopes = ("x_customer", "x_site", "x_market", "x_region")
    intervals = clipped.select(*scopes, "_from", "_until").distinct()
    return day_range(intervals, "_from", "_until").select(*scopes, "day").distinct()


#: Kinds of places that an event may name besides customer and site; None: no place.
_PLACES = ("market", "region", None)

#: Copies of the keys that name neither a customer nor a site: few rows that most sites look up.
_COPIES = 32


def _kinds() -> list[tuple[bool, bool, str | None]]:
    """(customer named, site named, place): the cases that together make up the scope rule.

    An event names a customer, a site or neither (null is a wildcard), and matches on
    market, on region, or names no place at all. Customer and site both named match
    whatever the place.
    """
    return [(True, True, None)] + [(c, s, p) for c, s in ((True, False), (False, True), (False, False)) for p in _PLACES]


def _key(kind: int, customer: Column | None, site: Column | None, place: Column | None, copy: Column) -> Column:
    none = F.lit(None).cast("string")
    named = {"customer": customer, "site": site, "place": place}
    parts = [F.coalesce(none if c is None else c, F.lit("")).alias(n) for n, c in named.items()]
    return F.struct(F.lit(kind).alias("kind"), *parts, copy.cast("int").alias("copy"))


def event_keys(days: DataFrame) -> DataFrame:
    """``(key, days)``: the day set of every key that events lock, kinds told apart by a tag."""
    keys = []
    for kind, (customer, site, place) in enumerate(_kinds()):
        named = [F.col(f"x_{c}") for c, on in (("customer", customer), ("site", site)) if on]
        if place:
            named.append(F.col(f"x_{place}"))
        nulls = [F.col(f"x_{c}") for c, on in (("customer", customer), ("site", site)) if not on]
        if not place and not (customer and site):
            nulls += [F.col("x_market"), F.col("x_region")]
        fits = reduce(lambda a, b: a & b, [c.isNotNull() for c in named] + [c.isNull() for c in nulls])
        key = _key(kind, F.col("x_customer") if customer else None, F.col("x_site") if site else None, F.col(f"x_{place}") if place else None, F.lit(0))
        keys.append(F.when(fits, key))
    tagged = days.select("day", F.explode(F.array_compact(F.array(*keys))).alias("key"))
    sets = tagged.groupBy("key").agg(F.collect_set("day").alias("days"))  # at most the days of the calendar
    wide = F.col("key.customer").eqNullSafe("") & F.col("key.site").eqNullSafe("") & ~F.col("key.kind").isin(0)
    copies = F.when(wide, F.sequence(F.lit(0), F.lit(_COPIES - 1))).otherwise(F.array(F.lit(0)))
    copied = sets.withColumn("_copy", F.explode(copies))
    return copied.select(F.col("key").withField("copy", F.col("_copy")).alias("key"), "days")


def _event_sets(jobs: DataFrame, events: DataFrame, params: Params) -> DataFrame:
    """``(customer_id, SiteCode, days)``: for each key that locks a site the days it locks.

    Each site is listed under the ten keys that may lock it and joined once with the day
    sets of the keys. The keys that most sites share (a place, or everywhere) are few, so
    each has some copies, and a site looks up one of them by a hash of its own.
    """
    sites = jobs.select(*SITE, "Market", "Region").distinct()
    spread = F.pmod(F.xxhash64(*SITE), F.lit(_COPIES))
    keys = []
    for kind, (customer, site, place) in enumerate(_kinds()):
        named = [F.col(c) for c, on in (("customer_id", customer), ("SiteCode", site)) if on] + ([F.col(place.capitalize())] if place else [])
        fits = reduce(lambda a, b: a & b, [c.isNotNull() for c in named], F.lit(True))
        copy = spread if not customer and not site else F.lit(0)
        key = _key(kind, F.col("customer_id") if customer else None, F.col("SiteCode") if site else None, F.col(place.capitalize()) if place else None, copy)
        keys.append(F.when(fits, key))
    listed = sites.select(*SITE, F.explode(F.array_compact(F.array(*keys))).alias("key"))
    return listed.join(event_keys(event_days(events, params)), "key").select(*SITE, "days")


def _united(sets: DataFrame) -> DataFrame:
    """``(customer_id, SiteCode, locked_days)``: the sets of each site as one, sorted; a site's sets are never spread to a row a day."""
    lists = sets.groupBy(*SITE).agg(F.collect_set("days").alias("sets"))
    return lists.select(*SITE, F.array_sort(F.array_distinct(F.flatten("sets"))).alias("locked_days"))


def event_locks(jobs: DataFrame, events: DataFrame, params: Params) -> DataFrame:
    """``(customer_id, SiteCode, day)`` locked by events."""
    return lock_days(_united(_event_sets(jobs, events, params)))


def site_locks(jobs: DataFrame, events: DataFrame, weather: DataFrame, params: Params) -> DataFrame:
    """All site locks known before placement: one row per site with its sorted ``locked_days``, bounded by the calendar."""
    bad = weather_locks(weather).select(*SITE, F.array("day").alias("days"))
    return _united(_event_sets(jobs, events, params).unionByName(bad))


def lock_table(jobs: DataFrame, events: DataFrame, weather: DataFrame, params: Params) -> DataFrame:
    """The same locks, one row per site and day."""
    return lock_days(site_locks(jobs, events, weather, params))


def lock_days(locks: DataFrame) -> DataFrame:
    """A row per site and day, of such a table or of sets."""
    return locks.select(*SITE, F.explode("locked_days").alias("day")) if "locked_days" in locks.columns else locks


def lock_sets(locks: DataFrame) -> DataFrame:
    """Sorted day set per site, of a table with a row per site and day or of sets, which stay as they are."""
    if "locked_days" in locks.columns:
        return locks
    return locks.groupBy(*SITE).agg(F.array_sort(F.collect_set("day")).alias("locked_days"))


def meets_lock(start: Column, end: Column) -> Column:
    """True when a day of ``locked_days`` lies in the closed interval."""
    return F.coalesce(F.exists("locked_days", lambda d: d.between(start, end)), F.lit(False))
