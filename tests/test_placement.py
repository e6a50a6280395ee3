"""The distributed placement against the plain scheduler."""

import dataclasses
import datetime as dt
import random
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from crewcast import Params, views
from crewcast.operators.components import label_nodes
from crewcast.operators.locks import lock_table
from crewcast.operators.clean import clean_events
from crewcast.operators import greedy, placement
from crewcast.operators.placement import place_jobs
from crewcast.plans.allocation import prepared_crews, triaged_jobs
from crewcast.schemas import HOLIDAYS
from tests import naive

TODAY = dt.date(2024, 3, 4)
BASE = Params(as_of=TODAY, calendar_start_year=2023, calendar_end_year=2025, scheduled_backlog_offset=30)

JOB_TYPES = (
    "JobID string, customer_id string, SiteCode string, Latitude double, Longitude double, Market string, "
    "Skills string, VendorBooked string, CrewIdBooked string, Priority int, JobCreateDate date, "
    "JobStartDateForecast date, JobEndDateForecast date, JobStartDateActual date, JobEndDateActual date, "
    "SiteReadinessForecast date, JobDurationML double, JobStartMaxOffset int, refresh_date date"
)
CREW_TYPES = (
    "VendorID string, crew_name string, Market string, region string, ValidFrom date, ValidUntil date, "
    "Score double, Skills1 string"
)


def day(n):
    return TODAY + dt.timedelta(days=n)


def random_case(seed, n_jobs=70, n_crews=9, markets=3, n_events=6):
    r = random.Random(seed)
    maybe = lambda p, v: v if r.random() < p else None
    crews = [
        (
            f"V{r.randrange(3)}", f"crew{i if r.random() < 0.9 else i - 1}", f"m{r.randrange(markets)}", "R",
            day(-r.randrange(40)), day(r.choice([10, 25, 60, 200])), maybe(0.9, float(r.randrange(4))),
            "|".join(r.sample("ABCD", r.randrange(2, 5))),
        )
        for i in range(n_crews)
    ]
    names = [c[1] for c in crews]
    jobs = []
    for i in range(n_jobs):
        start = r.randrange(-15, 25)
        booked = r.random() < 0.2
        forecast = booked or r.random() < 0.6
        site = r.randrange(12)
        located = site != 11
        jobs.append((
            f"j{i:03d}", f"c{site % 2}", f"s{site}",
            40 + site * 0.01 if located else None, 5 + (site % 3) * 0.01 if located else None,
            maybe(0.95, f"M{site % markets}"), maybe(0.9, "|".join(r.sample("ABCD", r.randrange(1, 3)))),
            maybe(0.5 if booked else 0.2, f"V{r.randrange(3)}"), r.choice(names) if booked else None,
            maybe(0.8, r.randrange(1, 4)), day(start - 30),
            day(start) if forecast else None, day(start + r.randrange(0, 6)) if forecast else None,
            None, None, maybe(0.6, day(start - r.randrange(5))), maybe(0.7, r.randrange(1, 20) / 4),
            maybe(0.5, r.randrange(5, 40)), TODAY,
        ))
    events = [
        (maybe(0.6, f"c{r.randrange(2)}"), maybe(0.7, f"s{r.randrange(12)}"), maybe(0.3, f"m{r.randrange(markets)}"),
         maybe(0.1, "r"), day(a := r.randrange(40)), day(a + r.randrange(2)))
        for _ in range(n_events)
    ]
    weather = [(f"c{(s := r.randrange(12)) % 2}", f"s{s}", day(r.randrange(40))) for _ in range(15)]
    return jobs, crews, events, weather


def check(spark, case, params, holidays=()):
    jobs, crews, events, weather = case
    crews_df = prepared_crews(spark.createDataFrame(crews, CREW_TYPES))
    ready = triaged_jobs(spark.createDataFrame(jobs, JOB_TYPES), crews_df, params).cache()
    events_df = spark.createDataFrame(
        events, "CustomerID string, SiteCode string, Market string, Region string, ValidFrom date, ValidUntil date"
    )
    weather_df = spark.createDataFrame(weather, "CustomerID string, SiteID string, Date date")
    locks = lock_table(ready, clean_events(events_df), weather_df, params)
    table = spark.createDataFrame([("XX", d) for d in holidays], HOLIDAYS) if holidays else None
    placed = place_jobs(ready, crews_df, locks, params, table).withColumn(
        "start", F.date_from_unix_date("planned_day")
    )
    rows = [r.asDict() for r in ready.collect()]
    got = {r.JobID: (r.ResourceStatus, r.RecommendedVendor, r.RecommendedWorker, r.start) for r in placed.collect()}
    assert placed.count() == len(got)

    plain_locks = defaultdict(set)
    for c, s, d in weather:
        plain_locks[c, s].add(d)
    for e in events:
        named = dict(zip(events_df.columns, e, strict=True))
        named["Market"] = named["Market"] and named["Market"].upper()
        named["Region"] = named["Region"] and named["Region"].upper()
        for j in rows:
            if naive.event_hits(named, j):
                plain_locks[j["customer_id"], j["SiteCode"]] |= naive.span(e[4], e[5])
    want = naive.schedule(rows, [c.asDict() for c in crews_df.collect()], plain_locks, params, frozenset(holidays))
    assert got == want
    ready.unpersist()
    return got


def test_whole_components(spark):
    got = check(spark, random_case(0), BASE)
    assert {s for s, *_ in got.values()} >= {0}


def test_neighbour_locks(spark):
    check(spark, random_case(10), dataclasses.replace(BASE, site_distance_min=1.6))


def test_windows(spark):
    check(spark, random_case(21, markets=1), dataclasses.replace(BASE, window_jobs=24))


def test_windows_with_neighbour_locks(spark):
    params = dataclasses.replace(BASE, window_jobs=24, site_distance_min=1.6)
    check(spark, random_case(30, markets=1), params)


def test_windows_when_crews_run_out(spark):
    """Most jobs are given up without a task looking at them."""
    params = dataclasses.replace(BASE, window_jobs=24, scheduled_backlog_offset=14, site_distance_min=0.5)
    case = random_case(40, n_jobs=150, n_crews=3, markets=1, n_events=0)
    got = check(spark, case, params)
    assert {0, 4, 6} <= {s for s, *_ in got.values()}


def test_rounds_do_not_depend_on_the_window(spark, monkeypatch):
    """A component of 70 windows is placed in one round; small rounds give the same."""
    rounds, plain = [], placement._Windows.run
    monkeypatch.setattr(placement._Windows, "run", lambda self: (plain(self), rounds.append(self.rounds))[0])
    case, params = random_case(30, markets=1), dataclasses.replace(BASE, window_jobs=1, site_distance_min=1.6)
    once = check(spark, case, params)
    monkeypatch.setattr(placement, "ROUND_JOBS", 24)
    assert check(spark, case, dataclasses.replace(params, window_jobs=24)) == once
    assert rounds[0] == 1 < rounds[1]


def test_a_search_starts_behind_the_crews_that_are_taken():
    """Later jobs of a pool do not look again at crews that were not free, nor do longer ones."""
    pool, looked = greedy.Pool(np.arange(200)), []
    crews = greedy.Crews.__new__(greedy.Crews)
    crews.first, crews.intervals = 0, {}
    crews.key_of, crews.taken = np.arange(200), np.zeros((200, 40), dtype=bool)
    crews.valid_from, crews.valid_until = np.zeros(200, dtype=int), np.full(200, 30)
    for n in range(200):
        row = crews.first_free(pool, 3, 5, 7)
        assert row == n
        crews.take(row, 3, 7)
        looked.append(pool.begin(3, 5))
    assert looked == list(range(200))
    assert crews.first_free(pool, 3, 5, 7) == -1 and pool.begin(3, 5) == pool.begin(3, 9) == 200
    assert crews.first_free(pool, 3, 4, 6) == -1 and crews.first_free(pool, 8, 9, 11) == 0


def test_more_crews_than_a_window(spark):
    """Crews that cannot be reached yet stay out of the task."""
    jobs, _, events, weather = random_case(60, n_jobs=14, markets=1, n_events=0)
    crews = [
        ("V0", f"crew{i}", "m0", "R", day(-9), day(30 if i % 5 == 0 else 300), float(i % 7), "A|B|C|D") for i in range(30)
    ]
    jobs = [(*j[:7], None, None, *j[9:]) for j in jobs]
    params = dataclasses.replace(BASE, window_jobs=6, job_duration_max=20)
    got = check(spark, (jobs, crews, events, weather), params)
    assert len({crew for _, _, crew, _ in got.values()}) > 6


def test_holidays(spark):
    params = dataclasses.replace(BASE, country_code="XX")
    check(spark, random_case(50), params, holidays=[day(2), day(3), day(7), day(20)])


def test_driver_tables(spark, small):
    """Every live job of the small tables gets exactly one row, on a free crew and site."""
    params = Params(site_distance_min=3.0)
    crews = prepared_crews(views.crews(spark, small, params))
    jobs = triaged_jobs(views.jobs(spark, small, params), crews, params).cache()
    locks = lock_table(
        jobs, clean_events(views.events(spark, small, params)), views.weather(spark, small, params), params
    )
    placed = place_jobs(jobs, crews, locks, params)
    live = jobs.where("phase is not null").select("JobID")
    assert placed.count() == live.count() == placed.join(live, "JobID", "left_semi").distinct().count()
    a, b = placed.where("busy_from is not null").alias("a"), placed.where("busy_from is not null").alias("b")
    clash = a.join(
        b,
        F.expr(
            "a.lock_vendor <=> b.lock_vendor and a.lock_crew = b.lock_crew and a.JobID < b.JobID "
            "and a.busy_from <= b.busy_to and b.busy_from <= a.busy_to"
        ),
    )
    assert clash.count() == 0


def test_labels_of_a_long_chain(spark):
    n = 60
    ids = list(range(n))
    random.Random(5).shuffle(ids)
    edges = [(ids[i], ids[i + 1]) for i in range(n - 1)] + [(1000 + i, 1000) for i in range(1, 20)]
    labels = {r.node: r.label for r in label_nodes(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert labels == {i: 0 for i in range(n)} | {1000 + i: 1000 for i in range(20)}
