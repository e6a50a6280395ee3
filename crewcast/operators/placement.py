"""Exact priority-ordered placement of all jobs, in batches of bounded size.

The greedy is sequential only within a component (see ``components``). Components are
placed in parallel: small ones share a task, one with more than ``window_jobs`` jobs or
crews is cut into consecutive windows of its placement order. A round gives a task the next
windows of a component, as many as make up ``ROUND_JOBS`` jobs, and the task goes through them in
order: the number of rounds does not depend on how small a window is. A round sees the locks left
by the earlier rounds through the table of placements, so the result equals one long pass
for every window size, and no task ever holds a whole large component.
"""

from __future__ import annotations

import datetime as dt

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from crewcast.functions.dates import HOLIDAY_ROWS, business_calendar, holiday_days
from crewcast.functions.geo import cell, haversine_km, reachable_cells
from crewcast.operators import greedy
from crewcast.operators.components import component_sizes, components
from crewcast.operators.greedy import EPOCH, ORDER, RESULT_SCHEMA, Rules, place_batch
from crewcast.operators.joins import join_null_safe
from crewcast.operators.locks import SITE, lock_sets
from crewcast.operators.matching import POOL, crew_order, pool_matches, pools_of
from crewcast.operators.neighbours import located_sites
from crewcast.operators.ranking import spread_rank
from crewcast.operators.triage import FORECAST, placement_order
from crewcast.params import Params
from crewcast.session import materialise, scratch_path

# the tasks get this code with the job, so workers need no copy of the package
cloudpickle.register_pickle_by_value(greedy)

#: Jobs of a component that one round places; windows may be smaller, or larger.
ROUND_JOBS = 20_000

CREW = ["VendorID", "crew_name"]
CLASS = ["Market", "VendorID", "have_key"]
JOB_COLUMNS = (
    "JobID", "phase", *SITE, "Market", "VendorBooked", "need_key", "LockVendor", "CrewIdBooked",
    "JobDuration", "JobStartMaxOffset", "start_day", *ORDER[:-1],
)


def batch_rows(jobs: DataFrame) -> DataFrame:
    """The placeable jobs with their search start and placement order as numbers."""
    start = F.when(F.col("phase") == FORECAST, F.col("JobStartDateForecast")).otherwise(F.col("JobStart"))
    order = dict(zip(ORDER, placement_order(), strict=True))
    live = jobs.where(F.col("phase").isNotNull()).withColumn("start_day", F.unix_date(start))
    return live.withColumns({k: v for k, v in order.items() if k != "JobID"}).select(*JOB_COLUMNS)


def crew_state(crews: DataFrame) -> DataFrame:
    return crews.select(
        "comp", "Market", "have_key", "VendorID", "crew_name", "Score",
        F.unix_date("ValidFrom").alias("ValidFrom"),
        F.unix_date("ValidUntil").alias("ValidUntil"),
        F.lit(None).cast("int").alias("busy_from"),
        F.lit(None).cast("int").alias("busy_to"),
    )


def busy_intervals(placed: DataFrame) -> DataFrame:
    """Days on which placed jobs hold their crews."""
    return placed.where("busy_from is not null").select(
        "comp",
        F.col("lock_vendor").alias("VendorID"),
        F.col("lock_crew").alias("crew_name"),
        "busy_from",
        "busy_to",
    )


def _run(jobs: DataFrame, state: DataFrame, keys: list[str], rules: Rules) -> DataFrame:
    def task(left, right):
        return place_batch(left, right, rules)

    # both sides may stem from one table; fresh columns keep the keys apart
    right = state.select(*[F.col(c).alias(c) for c in state.columns])
    return jobs.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(task, RESULT_SCHEMA)


def _place_whole(jobs: DataFrame, crews: DataFrame, sizes: DataFrame, rules: Rules, limit: int) -> DataFrame:
    """Components that fit a task: each on its own, or binned when much smaller."""
    small = max(limit // 8, 1)
    n_rows = F.col("n_jobs") + F.col("n_crews")
    shared = n_rows <= small
    total = sizes.agg(F.sum(F.when(shared, n_rows))).first()[0] or 0
    spread = int(jobs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bins = max(spread, -(-4 * total // limit))
    tasks = sizes.select(
        "comp",
        (~shared).alias("own"),
        F.when(shared, F.pmod(F.xxhash64("comp"), F.lit(bins))).otherwise(F.col("comp")).alias("task"),
    )
    rows = jobs.join(tasks, "comp").withColumn("pos", F.lit(None).cast("long"))
    return _run(rows, crew_state(crews).join(tasks, "comp"), ["own", "task"], rules)


class _Windows:
    """Components with many jobs or crews, placed in rounds of windows."""

    def __init__(self, jobs: DataFrame, crews: DataFrame, params: Params, rules: Rules) -> None:
        self.spark = jobs.sparkSession
        self.params, self.rules, self.limit = params, rules, max(params.window_jobs, ROUND_JOBS)
        self.block = max(self.limit // 16, 1)
        length = F.col("JobDuration") + params.job_buffer
        # days a search needs at least; null for a job that is never given up early
        need = F.when((F.col("phase") > 1) & (length >= 1), length + 1 + params.job_downtime)
        ranked = spread_rank(jobs, ["comp"], list(ORDER), "pos").withColumn("need", need)
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        # files ordered by position, so that a window reads only its own row groups
        self.jobs = materialise(ranked.repartitionByRange(parts, "comp", "pos").sortWithinPartitions("comp", "pos"), "jobs")
        self.crews = self._ranked_crews(crews)
        self.pools = pools_of(self.jobs.where("phase > 1"))
        self.base = scratch_path(self.spark, "placed")
        self.rounds = 0

    def _ranked_crews(self, crews: DataFrame) -> DataFrame:
        """Crews with ``ahead``: how many crews before them in their class can serve any search.

        Such a crew is valid through the whole planning window and listed once. ``n``
        placements touch at most ``n`` crews, so the first ``n + 1`` of them always
        include a free one, and crews with ``ahead > n`` cannot be chosen.
        """
        p = self.params
        last_end = np.busday_offset(
            np.datetime64(p.plan_end, "D"),
            p.job_duration_max + max(p.job_buffer, 0),
            roll="forward",
            weekmask=p.weekmask,
            holidays=np.array(self.rules.holidays, dtype="M8[D]"),
        ).astype(dt.date)
        once = crews.groupBy(*CREW).agg(F.count("*").alias("n_listed"))
        always = (
            (F.col("ValidFrom") <= F.lit(p.as_of))
            & (F.col("ValidUntil") >= F.lit(last_end))
            & (F.col("n_listed") == 1)
        )
        return materialise(
            spread_rank(crews.join(once, CREW), CLASS, crew_order(), "ahead", always), "crews"
        )

    def placed(self) -> DataFrame:
        """Results of the rounds so far."""
        if not self.rounds:
            return self.spark.createDataFrame([], RESULT_SCHEMA)
        paths = [f"{self.base}/{i}" for i in range(self.rounds)]
        return self.spark.read.schema(RESULT_SCHEMA).parquet(*paths)

    def _crew_gaps(self) -> DataFrame:
        """Crews with ``gap``, the longest free stretch a search could still use."""
        busy = busy_intervals(self.placed()).groupBy(*CREW)
        # intervals of one crew never overlap, so the list is bounded by the planned days
        held = busy.agg(F.array_sort(F.collect_list(F.struct("busy_from", "busy_to"))).alias("held"))
        joined = join_null_safe(self.crews, held, CREW, "left")
        low = F.greatest(F.unix_date("ValidFrom"), F.lit(self.rules.today + self.rules.start_buffer))
        high = F.unix_date("ValidUntil") + self.rules.downtime
        none = F.array().cast("array<int>")
        starts = F.concat(F.array(low), F.coalesce(F.transform("held", lambda x: x["busy_to"] + 1), none))
        ends = F.concat(F.coalesce(F.transform("held", lambda x: x["busy_from"] - 1), none), F.array(high))

        def free(a: Column, b: Column) -> Column:
            a, b = F.greatest(a, low), F.least(b, high)
            return F.when(a <= self.rules.plan_end, b - a + 1).otherwise(0)

        return joined.withColumn("gap", F.array_max(F.zip_with(starts, ends, free))).drop("held")

    def _hopeful(self, gaps: DataFrame, first_block: DataFrame) -> DataFrame:
        """Jobs not yet looked at that some crew may still take."""
        classes = gaps.groupBy(*CLASS).agg(F.max("gap").alias("gap"))
        matches = pool_matches(self.pools, classes.withColumn("n_crews", F.lit(0)), classes)
        best = matches.groupBy(*POOL).agg(F.max("gap").alias("pool_gap"))
        rest = self.jobs.withColumn("block", F.floor(F.col("pos") / self.block)).join(first_block, "comp")
        rest = rest.where("block >= next_block")
        tried = join_null_safe(rest, best, POOL, "left")
        return tried.where("need is null or need <= coalesce(pool_gap, 0)").drop("next_block", "pool_gap")

    def _near_days(self, window: DataFrame) -> DataFrame:
        """Days locked at the window's sites by earlier placements nearby."""
        km = self.rules.near_km
        done = self.placed().where("site_from <= site_to")
        done = done.select(
            "customer_id", F.col("SiteCode").alias("s"), F.col("Latitude").alias("y"), F.col("Longitude").alias("x"),
            "site_from", "site_to",
        )
        sites = window.select(*SITE, "Latitude", "Longitude").distinct()
        here = sites.withColumn("cell", F.explode(reachable_cells(F.col("Latitude"), F.col("Longitude"), km)))
        there = done.where("y is not null").withColumn("cell", cell(F.col("y"), F.col("x"), km))
        distance = haversine_km(F.col("Latitude"), F.col("Longitude"), F.col("y"), F.col("x"))
        close = here.join(there, ["customer_id", "cell"]).where(distance < km)
        own = sites.join(done.withColumnRenamed("s", "SiteCode"), list(SITE))
        own = own.select(*SITE, "site_from", "site_to")
        # spans begin and end within the plan, so a site has few different ones however many placements are near
        spans = close.select(*SITE, "site_from", "site_to").unionByName(own).distinct().groupBy(*SITE)
        listed = spans.agg(F.collect_list(F.sequence("site_from", "site_to")).alias("spans"))
        return listed.select(*SITE, F.array_distinct(F.flatten("spans")).alias("near_days"))

    def _state(self, window: DataFrame, gaps: DataFrame, shortest: int | None) -> DataFrame:
        reach = (self.rounds + 1) * self.limit
        kept = gaps.where(F.col("ahead") <= reach)
        if shortest is not None:
            kept = kept.where(F.col("gap") >= shortest)
        booked = window.where("phase = 1").select(
            F.col("LockVendor").alias("VendorID"), F.col("CrewIdBooked").alias("crew_name")
        )
        keys = kept.select(*CREW).unionByName(booked).distinct()
        busy = join_null_safe(busy_intervals(self.placed()), keys, CREW, "left_semi")
        return crew_state(kept).unionByName(busy, allowMissingColumns=True)

    def run(self) -> DataFrame:
        ranges = self.jobs.select("comp").distinct().withColumn("next_block", F.lit(0).cast("long"))
        shortest = self.jobs.agg(F.min("need"), F.count_if(F.expr("phase > 1 and need is null"))).first()
        shortest = None if shortest[1] else shortest[0]
        while True:
            gaps = materialise(self._crew_gaps(), "gaps")
            hopeful = self._hopeful(gaps, ranges)
            blocks = hopeful.groupBy("comp", "block").agg(F.count("*").alias("n"))
            so_far = F.sum("n").over(Window.partitionBy("comp").orderBy("block"))
            chosen = blocks.withColumn("total", so_far).where(F.col("total") <= self.limit)
            upto = materialise(
                chosen.groupBy("comp").agg((F.max("block") + 1).alias("end_block"), F.max("total").alias("n")),
                "window",
            )
            if upto.isEmpty():
                break
            window = hopeful.join(upto.drop("n"), "comp").where("block < end_block").drop("block", "end_block", "need")
            window = materialise(window, "window")
            if self.rules.near_km is not None and self.rounds:
                window = window.join(self._near_days(window), list(SITE), "left").withColumn(
                    "locked_days",
                    F.when(F.col("near_days").isNull(), F.col("locked_days")).otherwise(
                        F.array_union(F.coalesce("locked_days", F.array().cast("array<int>")), F.col("near_days"))
                    ),
                ).drop("near_days")
            state = self._state(window, gaps, shortest)
            _run(window, state, ["comp"], self.rules).write.parquet(f"{self.base}/{self.rounds}")
            self.rounds += 1
            ranges = upto.select("comp", F.col("end_block").alias("next_block"))
        placed = self.placed()
        return placed.unionByName(self._given_up(placed))

    def _given_up(self, placed: DataFrame) -> DataFrame:
        """Jobs that no crew could take: 6 if a tried slot met a locked day, else 4.

        Their slots follow each other without a gap, so one interval test per job is
        enough. Only placements ahead of a job in the order lock sites for it.
        """
        p, rules = self.params, self.rules
        left = self.jobs.join(placed.select("JobID"), "JobID", "left_anti")
        calendar = business_calendar_of(self.spark, p, rules)
        tries = F.col("JobStartMaxOffset") - F.greatest(F.lit(rules.today) - F.col("start_day"), F.lit(0))
        first = F.greatest("start_day", F.lit(rules.today + rules.start_buffer))
        left = left.withColumns({"tries": tries, "first": F.date_from_unix_date(first)})
        at = calendar.select(F.col("day").alias("first"), F.col("ord").alias("at"))
        final = calendar.where(F.col("is_business") & (F.col("day") <= F.lit(p.plan_end))).agg(F.max("ord")).first()[0]
        ordered = left.join(F.broadcast(at), "first", "left").withColumn(
            "final", F.least(F.col("at") + F.col("tries"), F.lit(final))
        )
        length = F.col("JobDuration") + p.job_buffer
        work = calendar.where("is_business").select("ord", F.unix_date("day").alias("d"))
        spans = (
            ordered.join(F.broadcast(work.select(F.col("ord").alias("at"), F.col("d").alias("lo"))), "at", "left")
            .withColumn("_end", F.col("final") + length)
            .join(F.broadcast(work.select(F.col("ord").alias("_end"), F.col("d").alias("hi"))), "_end", "left")
        )
        tried = (F.col("tries") >= 0) & (F.col("at") <= F.col("final"))
        hit = F.exists("locked_days", lambda d: d.between(F.col("lo"), F.col("hi")))
        spans = spans.withColumn("locked", tried & F.coalesce(hit, F.lit(False)))
        if rules.near_km is not None:
            spans = self._near_hits(spans.withColumn("tried", tried), placed)
        status = F.when(F.coalesce("locked", F.lit(False)), 6).otherwise(4)
        empty = {f.name: F.lit(None).cast(f.dataType) for f in placed.schema}
        known = {"comp": F.col("comp"), "pos": F.col("pos"), "JobID": F.col("JobID"), "ResourceStatus": status}
        return spans.select(*[(empty | known)[c].alias(c) for c in placed.columns])

    def _near_hits(self, spans: DataFrame, placed: DataFrame) -> DataFrame:
        km = self.rules.near_km
        done = placed.where("site_from <= site_to").select(
            F.col("comp").alias("_comp"), F.col("pos").alias("_pos"), F.col("customer_id").alias("_cust"),
            F.col("SiteCode").alias("_site"), F.col("Latitude").alias("y"), F.col("Longitude").alias("x"),
            "site_from", "site_to",
        )
        met = (
            (F.col("comp") == F.col("_comp")) & (F.col("customer_id") == F.col("_cust"))
            & (F.col("_pos") < F.col("pos"))
            & (F.col("site_from") <= F.col("hi")) & (F.col("site_to") >= F.col("lo"))
        )
        open_jobs = spans.where("tried and not locked")
        around = done.where("y is not null").withColumn(
            "_cell", F.explode(reachable_cells(F.col("y"), F.col("x"), km))
        )
        distance = haversine_km(F.col("Latitude"), F.col("Longitude"), F.col("y"), F.col("x"))
        close = open_jobs.withColumn("cell", cell(F.col("Latitude"), F.col("Longitude"), km)).join(
            around, met & (F.col("cell") == F.col("_cell")) & (distance < km), "left_semi"
        )
        own = open_jobs.join(done, met & (F.col("SiteCode") == F.col("_site")), "left_semi")
        hits = close.select("JobID").unionByName(own.select("JobID")).distinct().withColumn("near", F.lit(True))
        return spans.join(hits, "JobID", "left").withColumn(
            "locked", F.col("locked") | F.coalesce("near", F.lit(False))
        )


def business_calendar_of(spark: SparkSession, params: Params, rules: Rules) -> DataFrame:
    """Calendar table with the holidays the tasks use."""
    if not rules.holidays:
        return business_calendar(spark, params)
    days = [(params.country_code, EPOCH + dt.timedelta(days=d)) for d in rules.holidays]
    return business_calendar(spark, params, spark.createDataFrame(days, HOLIDAY_ROWS))


def place_jobs(
    jobs: DataFrame, crews: DataFrame, locks: DataFrame, params: Params, holidays: DataFrame | None = None
) -> DataFrame:
    """Status, crew and start of every job that triage left open.

    ``jobs`` is the triaged table with all its rows, ``crews`` carries ``have_key`` and
    ``locks`` is the table of locked site days.
    """
    near = False
    live = batch_rows(jobs)
    sites = None
    if params.site_distance_min is not None:
        sites = materialise(located_sites(jobs), "located")  # looked at three times
        near = sites.limit(2).count() > 1  # a single site locks nothing
    rules = Rules.of(params, holiday_days(holidays, params), near)
    tagged, owned = components(live, crews, sites, params.site_distance_min if near else None)
    days = lock_sets(locks).withColumn("locked_days", F.transform("locked_days", F.unix_date))
    tagged = tagged.join(days, list(SITE), "left")
    if near:
        tagged = tagged.join(sites, list(SITE), "left")
    else:
        unknown = F.lit(None).cast("double")
        tagged = tagged.withColumns({"Latitude": unknown, "Longitude": unknown})
    rows = materialise(tagged, "placeable")
    owned = materialise(owned, "listed")
    sizes = materialise(component_sizes(rows, owned), "sizes")
    limit = params.window_jobs
    one_task = F.greatest("n_jobs", "n_crews") <= limit
    fits, large = sizes.where(one_task), sizes.where(~one_task)
    placed = _place_whole(rows, owned, fits, rules, limit)
    if not large.isEmpty():
        windows = _Windows(
            rows.join(large.select("comp"), "comp"), owned.join(large.select("comp"), "comp"), params, rules
        )
        placed = placed.unionByName(windows.run())
    return materialise(placed, "placements")
