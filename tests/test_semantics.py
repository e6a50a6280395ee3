"""Small hand-built cases for the rules that are easiest to get wrong."""

import dataclasses
import datetime as dt
import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from crewcast import Params
from crewcast.functions.dates import add_business_days, business_calendar
from crewcast.functions.geo import cell, haversine_km, reachable_cells
from crewcast.functions.text import contains_all, skill_set
from crewcast.operators import capacity, clean, features, locks, matching, neighbours, overlay, slots, triage
from crewcast.operators.ranking import spread_rank
from crewcast.schemas import HOLIDAYS
from tests import naive
from tests.test_placement import CREW_TYPES, JOB_TYPES, day

TODAY = dt.date(2024, 3, 4)
P = Params(as_of=TODAY, calendar_start_year=2023, calendar_end_year=2025, placeholder_crew="Nobody")
JOB = dict.fromkeys([c.split()[0] for c in JOB_TYPES.split(", ")])


def job(name, **values):
    base = JOB | {"JobID": name, "customer_id": "c", "SiteCode": "s", "Market": "m", "JobCreateDate": day(-5)}
    return tuple((base | values).values())


def crew(vendor="v", name="k", market="m", skills="A", score=1.0, first=-10, last=100):
    return (vendor, name, market, "r", day(first), day(last), score, skills)


def coded(spark, jobs, crews, params=P):
    from crewcast.plans.allocation import prepared_crews, triaged_jobs

    ready = prepared_crews(spark.createDataFrame(crews, CREW_TYPES))
    rows = triaged_jobs(spark.createDataFrame(jobs, JOB_TYPES), ready, params).collect()
    return {r.JobID: r for r in rows}


def test_status_codes(spark):
    start, end = {"JobStartDateForecast": day(3)}, {"JobEndDateForecast": day(1)}
    jobs = [
        job("bad order", CrewIdBooked="k", **start, **end),
        job("bad order and late", JobStartDateForecast=day(-50), JobEndDateForecast=day(-60), JobStartMaxOffset=5),
        job("too long", JobDurationML=100.0),
        job("booked without dates", CrewIdBooked="k"),
        job("started unbooked", JobStartDateActual=day(-1)),
        job("unknown crew", CrewIdBooked="nobody", **start),
        job("no crew", Market="elsewhere"),
        job("no market", Market=None),
        job("far away", JobStartDateForecast=day(200)),
        job("fine booked", CrewIdBooked="k", **start),
        job("fine forecast", **start),
        job("fine new"),
        job("no start", JobCreateDate=None),
        job("placeholder", CrewIdBooked=P.placeholder_crew, **start),
        job("closed", JobEndDateActual=day(-1)),
        job("needs skill", Skills="B"),
    ]
    got = {k: (r.ResourceStatus, r.phase) for k, r in coded(spark, jobs, [crew()]).items()}
    assert got == {
        "bad order": (5, None),
        "bad order and late": (9, None),
        "too long": (5, None),
        "booked without dates": (5, None),
        "started unbooked": (5, None),
        "unknown crew": (8, None),
        "no crew": (3, None),
        "no market": (3, None),
        "far away": (9, None),
        "fine booked": (None, 1),
        "fine forecast": (None, 2),
        "fine new": (None, 3),
        "no start": (5, None),
        "needs skill": (3, None),
    }


def test_fills(spark):
    jobs = [
        job("dates", JobStartDateForecast=day(1), JobEndDateForecast=day(4), JobDurationML=9.0, Priority=2),
        job("model", JobDurationML=2.25, SiteReadinessForecast=day(6), JobStartMaxOffset=7),
        job("default"),
        job("actual", JobStartDateActual=day(9), JobStartDateForecast=day(1)),
    ]
    got = coded(spark, jobs, [crew()])
    picked = {k: (r.JobStart, r.JobDuration, r.Priority, r.JobStartMaxOffset) for k, r in got.items()}
    assert picked == {
        "dates": (day(1), 5, 2, 90),
        "model": (day(6), 3, 5, 7),
        "default": (day(25), 10, 5, 90),
        "actual": (day(9), 10, 5, 90),
    }


def test_cleaning(spark):
    df = spark.createDataFrame([("a", None), ("b", "X"), ("c", "Y")], "id string, crew string")
    assert {r.id for r in clean.not_placeholder(df, "crew", "X").collect()} == {"a", "c"}
    text = spark.createDataFrame([("2024-03-04",), ("2024-13-01",), ("x",), (None,)], "d string")
    assert [r.d for r in clean.parse_dates(text, ["d"]).collect()] == [TODAY, None, None, None]
    twice = spark.createDataFrame(
        [(None, day(0), 1), (None, day(1), 0), ("a", day(1), 1), ("a", day(1), 2), ("a", None, 9)],
        "id string, d date, x int",
    )
    assert {(r.id, r.x) for r in clean.latest_per_key(twice, ["id"], "d").collect()} == {(None, 0), ("a", 2)}
    assert "WindowGroupLimit" in clean.latest_per_key(twice, ["id"], "d")._jdf.queryExecution().toString()
    ordered = clean.filter_and_sort(twice, F.lit(True), ["d", "x"]).collect()
    assert [r.x for r in ordered] == [1, 0, 1, 2, 9]


def test_fences(spark):
    values = [(None if g == 2 else f"g{g}", v) for g in range(3) for v in [*range(10, 20), 500]]
    df = spark.createDataFrame(values, "g string, v int")
    for exact in (False, True):
        kept = features.within_fences(df, "v", "g", exact).collect()
        assert len(kept) == 30 and max(r.v for r in kept) == 19
        assert set(kept[0].asDict()) == {"g", "v"}


def test_business_days(spark):
    off = [day(1), day(8), day(9)]
    params = dataclasses.replace(P, country_code="XX")
    holidays = spark.createDataFrame([("XX", d) for d in off] + [("YY", day(2))], HOLIDAYS)
    calendar = business_calendar(spark, params, holidays)
    df = spark.createDataFrame([(day(a), n) for a in range(-3, 12) for n in range(0, 9)], "a date, n int")
    got = add_business_days(df, "a", F.col("n"), "b", calendar).collect()
    for r in got:
        want = np.busday_offset(r.a, r.n, "forward", holidays=off)
        assert r.b == want.astype(dt.date)
    assert len(got) == 15 * 9


def test_weekend_start_rolls_to_monday(spark):
    saturday = dt.date(2024, 3, 9)
    df = spark.createDataFrame([(saturday, 0), (saturday, 1)], "a date, n int")
    out = add_business_days(df, "a", F.col("n"), "b", business_calendar(spark, P)).orderBy("n").collect()
    assert [r.b for r in out] == [dt.date(2024, 3, 11), dt.date(2024, 3, 12)]


def test_skill_sets(spark):
    cases = [("A| B |A", ["A", "B"]), (None, []), ("", [""]), ("B", ["B"])]
    df = spark.createDataFrame([(c[0],) for c in cases], "s string")
    assert [r[0] for r in df.select(skill_set(F.col("s"))).collect()] == [c[1] for c in cases]
    pair = spark.createDataFrame([(["A", "B"], ["A"]), (["A"], ["A", "B"]), ([], [])], "h array<string>, n array<string>")
    assert [r[0] for r in pair.select(contains_all(F.col("h"), F.col("n"))).collect()] == [True, False, True]


def test_crew_lists_match_the_plain_rule(spark):
    r = random.Random(3)
    pool = "ABCDE"
    some = lambda k: "|".join(r.sample(pool, k)) if k else None
    crews = [
        crew(f"v{r.randrange(3)}", f"k{i}", f"m{r.randrange(2)}", some(r.randrange(0, 5)), r.choice([None, 1.0, 2.0]))
        for i in range(25)
    ]
    jobs = [
        job(f"j{i}", Market=r.choice(["m0", "m1", None]), Skills=some(r.randrange(0, 4)),
            VendorBooked=r.choice([None, "v0", "v1", "v9"]))
        for i in range(30)
    ]
    cdf = matching.with_have(spark.createDataFrame(crews, CREW_TYPES))
    jdf = matching.with_need(spark.createDataFrame(jobs, JOB_TYPES))
    listed = matching.qualified_per_job(jdf, cdf).orderBy("JobID", "rank").collect()
    counts = {x.JobID: x.CountQualified for x in matching.count_qualified(jdf, cdf).collect()}
    best = {x.JobID: x.crew_name for x in matching.best_crew(jdf, cdf).collect()}
    crew_dicts = [c.asDict() for c in cdf.collect()]
    for j in jdf.collect():
        want = [c["crew_name"] for c in naive.qualified(j.asDict(), crew_dicts)]
        assert [x.crew_name for x in listed if x.JobID == j.JobID] == want
        assert counts[j.JobID] == len(want)
        assert best.get(j.JobID) == (want[0] if want else None)


def test_event_scope_on_all_combinations(spark):
    """Null or two values in each of the four columns, for events and jobs alike."""
    values = [None, "a", "b"]
    combos = list(itertools.product(values, repeat=4))
    for event in combos:
        assert naive.event_hits(dict(zip(("CustomerID", "SiteCode", "Market", "Region"), event, strict=True)), {
            "customer_id": "a", "SiteCode": "a", "Market": "a", "Region": "a",
        }) in (True, False)
    events = spark.createDataFrame(
        [(*c, day(0) + dt.timedelta(days=i), day(0) + dt.timedelta(days=i)) for i, c in enumerate(combos)],
        "CustomerID string, SiteCode string, Market string, Region string, ValidFrom date, ValidUntil date",
    )
    # the site is the lock's key, so each job combination gets a customer of its own to tell it apart
    jobs = [c for c in combos if c[0] is not None and c[1] is not None]
    for market, region in itertools.product(values, repeat=2):
        rows = [c for c in jobs if c[2:] == (market, region)]
        df = spark.createDataFrame(rows, "customer_id string, SiteCode string, Market string, Region string")
        got = {(r.customer_id, r.SiteCode, (r.day - day(0)).days) for r in locks.event_locks(df, events, P).collect()}
        want = set()
        for j in rows:
            target = dict(zip(("customer_id", "SiteCode", "Market", "Region"), j, strict=True))
            for i, c in enumerate(combos):
                if naive.event_hits(dict(zip(("CustomerID", "SiteCode", "Market", "Region"), c, strict=True)), target):
                    want.add((j[0], j[1], i))
        assert got == want


def test_event_ranges(spark):
    df = spark.createDataFrame(
        [("c", "s", day(0), day(2)), ("c", "s", day(5), day(4)), ("c", "s", None, day(9)), ("c", "s", day(8), None)],
        "CustomerID string, SiteCode string, ValidFrom date, ValidUntil date",
    ).withColumns({"Market": F.lit(None).cast("string"), "Region": F.lit(None).cast("string")})
    assert sorted(r.day for r in locks.event_days(df, P).collect()) == [day(0), day(1), day(2)]


@pytest.mark.parametrize("km", [2.0, 40.0, 3000.0])
def test_grid_reaches_every_near_point(spark, km):
    r = random.Random(7)
    points = [(r.uniform(-90, 90), r.uniform(-180, 180)) for _ in range(60)]
    points += [(90.0, 10.0), (-90.0, 0.0), (0.0, 180.0), (0.0, -180.0), (89.99, -170.0)]
    rows = []
    for la, lo in points:
        for _ in range(6):
            turn, part = r.uniform(0, 2 * math.pi), math.degrees(km / 6373) * r.uniform(0.5, 1.05)
            lb = max(-90.0, min(90.0, la + part * math.cos(turn)))
            scale = max(math.cos(math.radians(lb)), 1e-3)
            rows.append((la, lo, lb, (lo + part * math.sin(turn) / scale + 180) % 360 - 180))
    df = spark.createDataFrame(rows, "la double, lo double, lb double, ob double")
    a, b, c, d = (F.col(x) for x in ("la", "lo", "lb", "ob"))
    checked = df.select(
        haversine_km(a, b, c, d).alias("km"),
        F.array_contains(reachable_cells(a, b, km), cell(c, d, km)).alias("found"),
        F.size(reachable_cells(a, b, km)).alias("n"),
    ).collect()
    near = [r for r in checked if r.km < km]
    assert len(near) > 50 and all(r.found for r in near)


def test_near_sites_per_customer(spark):
    rows = [("c", "a", 0.0, 0.0), ("c", "b", 0.0, 0.01), ("c", "d", 0.0, 0.5), ("x", "a", 0.0, 0.0), ("c", "n", None, 1.0)]
    df = spark.createDataFrame(rows, "customer_id string, SiteCode string, Latitude double, Longitude double")
    got = neighbours.near_sites(neighbours.located_sites(df), 2.0).collect()
    assert [(r.customer_id, r.site_a, r.site_b) for r in got] == [("c", "a", "b")]


def test_crowded_cells_are_cut(spark, monkeypatch):
    """All sites of one customer in one cell: the same pairs, dealt over many keys."""
    monkeypatch.setattr(neighbours, "CELL_SITES", 10)
    r = random.Random(3)
    rows = [("c", f"s{i}", 10 + r.random() / 200, 20 + r.random() / 200) for i in range(120)]
    rows += [("d", f"s{i}", 10 + r.random(), 20 + r.random()) for i in range(40)]
    sites = spark.createDataFrame(rows, "customer_id string, SiteCode string, Latitude double, Longitude double")
    got = {(x.customer_id, x.site_a, x.site_b) for x in neighbours.near_sites(sites, 0.4).collect()}

    def km(a, b):
        p, q = math.radians(a[2]), math.radians(b[2])
        h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[3] - a[3]) / 2) ** 2
        return 2 * 6373 * math.asin(math.sqrt(h))

    want = {(a[0], *sorted((a[1], b[1]))) for a, b in itertools.combinations(rows, 2) if a[0] == b[0] and km(a, b) < 0.4}
    assert got == want and len(want) > 1000
    placed = sites.select("customer_id", cell(F.col("Latitude"), F.col("Longitude"), 0.4).alias("cell"))
    assert neighbours.crowded_cells(placed).agg(F.max("parts")).first()[0] >= 3


def test_busy_crews_leave_the_slots(spark):
    """Counts and best crews of slots against a plain look at every crew."""
    from crewcast.operators import slots
    from crewcast.operators.triage import BOOKED

    r = random.Random(9)
    calendar = business_calendar(spark, P)
    listed = [crew("v%d" % (i % 2), f"k{i}", "M" if i % 7 else "N", "A" if i % 3 else "A|B", float(i % 5), -40 + i % 4 * 20, 60 + i % 3 * 30) for i in range(40)]
    crews = clean.clean_crews(spark.createDataFrame(listed, CREW_TYPES))
    crews = matching.with_have(crews)
    booked = [(f"v{i % 2}" if i % 5 else None, f"k{i % 25}", day(r.randint(-20, 40)), r.randint(1, 15), BOOKED) for i in range(60)]
    jobs = spark.createDataFrame(booked, "LockVendor string, CrewIdBooked string, JobStart date, JobDuration int, phase int")
    spans = slots.busy_spans(jobs, calendar, P).collect()
    wanted = {(v, need, day(a), day(a + n)) for v in (None, "v0") for need in ("A", "A|B") for a in range(2, 40, 3) for n in (1, 9, 30)}
    frame = spark.createDataFrame([("M", *w) for w in wanted], "Market string, VendorBooked string, need_key string, slot_start date, slot_end date")
    got = {tuple(x)[1:5]: (x.n_crews, x.VendorID, x.crew_name) for x in slots.crew_options(frame, crews, slots.busy_spans(jobs, calendar, P), P).collect()}
    want = {}
    for v, need, a, b in wanted:
        free = []
        for vendor, name, market, _, first, last, score, skills in listed:
            if market != "M" or (v and vendor != v) or not set(need.split("|")) <= set(skills.split("|")) or a < first or b > last:
                continue
            until = b + dt.timedelta(days=P.job_downtime)
            if not any(s.VendorID == vendor and s.crew_name == name and s.busy_from <= until and a <= s.busy_to for s in spans):
                free.append((score, vendor, name))
        if free:
            want[v, need, a, b] = (len(free), *max(free)[1:])
    assert got == want and len(want) > 50
    assert any(n < max(m for m, *_ in want.values()) for n, *_ in want.values())


def test_rank_of_a_hot_group(spark):
    df = spark.range(1000).select(
        F.when(F.col("id") % 10 == 0, "cold").when(F.col("id") % 10 == 1, None).otherwise("hot").alias("k"),
        ((F.col("id") * 7919) % 1000).alias("v"),
        (F.col("id") % 3 == 0).alias("flag"),
    )
    got = spread_rank(df, ["k"], [F.col("v").desc()], "pos").collect()
    flagged = {(r.k, r.v): r.ahead for r in spread_rank(df, ["k"], ["v"], "ahead", F.col("flag")).collect()}
    for key in ("hot", "cold", None):
        rows = sorted((r for r in got if r.k == key), key=lambda r: -r.v)
        assert [r.pos for r in rows] == list(range(len(rows)))
        seen = 0
        for r in reversed(rows):
            assert flagged[key, r.v] == seen
            seen += r.flag


def test_known_crew_vendor(spark):
    crews = spark.createDataFrame([crew("v1", "one"), crew("v1", "two"), crew("v2", "two")], CREW_TYPES)
    jobs = spark.createDataFrame(
        [job("a", CrewIdBooked="one"), job("b", CrewIdBooked="two"), job("c", CrewIdBooked="one", VendorBooked="z"),
         job("d", CrewIdBooked="none"), job("e")], JOB_TYPES,
    )
    got = {r.JobID: (r.CrewKnown, r.LockVendor) for r in triage.known_crew(jobs, crews).collect()}
    assert got == {"a": (True, "v1"), "b": (True, None), "c": (True, "z"), "d": (False, None), "e": (False, None)}
    assert [r.JobID for r in triage.unknown_booked_crew(jobs, crews).collect()] == ["d"]


def test_unbooked_jobs_take_no_part_in_the_crew_join(spark):
    """The plan drops them before any exchange; no key is made up for them."""
    crews = spark.createDataFrame([crew("v1", "one")], CREW_TYPES)
    jobs = spark.createDataFrame([job("a", CrewIdBooked="one"), job("e")], JOB_TYPES)
    plan = triage.known_crew(jobs, crews)._jdf.queryExecution().optimizedPlan().toString()
    assert "isnotnull(CrewIdBooked" in plan and "concat" not in plan


def test_next_locked_day_by_runs(spark):
    """Against a plain search: the next locked day, and business number, at or after each day of the plan."""
    params = Params(as_of=TODAY, calendar_start_year=2023, calendar_end_year=2025, scheduled_backlog_offset=20)
    first, days = TODAY + dt.timedelta(days=2), [TODAY + dt.timedelta(days=n) for n in range(-3, 300)]
    held = {"none": [], "early": days[:4], "some": [days[i] for i in (3, 7, 8, 9, 10, 15, 16, 22, 200)], "late": days[60:]}
    locked = spark.createDataFrame([("c", s, v) for s, v in held.items()], "customer_id string, SiteCode string, locked_days array<date>")
    got = {r.SiteCode: r.next_locked for r in slots.next_locked_days(locked, first, params.plan_end).collect()}
    calendar = business_calendar(spark, params)
    ords = {r["day"]: (r["ord"], r["is_business"]) for r in calendar.collect()}
    plan = range(ords[first][0], ords[params.plan_end][0] + 1)
    nexts = {r.SiteCode: r.next_lock for r in slots.next_locks(locked, calendar, plan).collect()}
    for site, listed in held.items():
        for i in range((params.plan_end - first).days + 1):
            want = min((d for d in listed if d >= first + dt.timedelta(days=i)), default=None)
            assert (got[site][i] if i < len(got[site]) else None) == want
        for i, n in enumerate(plan):
            want = min((o for o, b in map(ords.get, listed) if o - (not b) >= n), default=None)
            have = nexts.get(site, [])
            assert (have[i] if i < len(have) else None) == want


def test_overlay_marks(spark):
    df = spark.createDataFrame(
        [("w", None, "nan", None, TODAY, 4, 3), ("x", "v", "k", TODAY, TODAY, 0, 3)],
        "WpId string, VendorId string, CrewId string, PlannedStartDate date, RefreshDate date, "
        "ResourceStatus int, JobDuration int",
    )
    got = {r.WpId: (r.VendorId, r.CrewId, r.PlannedStartDate) for r in overlay.text_overlay(df).collect()}
    assert got == {"w": ("#", "#", "#"), "x": ("v", "k", "2024-03-04")}
    labels = {r.WpId: r.StatusLabel for r in overlay.labelled(df, P).collect()}
    assert labels == {"w": "no free crew or slot", "x": "placed"}


def test_recommended_vendor(spark):
    jobs = spark.createDataFrame([("a", "one"), ("b", "short"), ("c", None)], "JobID string, RecommendedWorker string")
    crews = spark.createDataFrame([crew("v1", "one"), crew("v1", "one", "n")], CREW_TYPES)
    got = {r.JobID: r.RecommendedVendor for r in matching.add_recommended_vendor(jobs, crews, "short").collect()}
    assert got == {"a": "v1", "b": "short", "c": None}


def test_params_are_checked():
    with pytest.raises(ValueError):
        Params(weekmask="0000000")
    with pytest.raises(ValueError):
        Params(calendar_start_year=2030)


def test_calendar_follows_the_plan():
    now = Params(as_of=dt.date(2024, 3, 4))
    assert now.calendar_first <= dt.date(2024, 1, 1) and now.calendar_last > now.plan_end + dt.timedelta(days=366)
    past = Params(as_of=dt.date(1980, 5, 5))
    assert past.calendar_first <= dt.date(1980, 1, 1)
    with pytest.raises(ValueError, match="job_start_buffer"):
        Params(job_start_buffer=-1)


def test_events_and_offsets_of_other_years_count(spark):
    """The same tables, moved by whole weeks, give the same days moved by as much."""
    shift = dt.timedelta(weeks=52 * 27)
    found = []
    for params in (Params(), Params(as_of=Params().as_of + shift)):
        move = params.as_of - Params().as_of
        start = dt.date(1998, 7, 3) + move
        events = spark.createDataFrame(
            [("c", None, None, None, start, start + dt.timedelta(days=2))],
            "CustomerID string, SiteCode string, Market string, Region string, ValidFrom date, ValidUntil date",
        )
        days = sorted(r.day - move for r in locks.event_days(events, params).collect())
        due = add_business_days(
            spark.createDataFrame([(start,)], "d date"), "d", F.lit(7), "due", business_calendar(spark, params)
        ).first()["due"]
        found.append((days, due - move))
    assert found[0] == found[1] and len(found[0][0]) == 3


def test_vendor_columns_come_from_the_data(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "v string")
    assert capacity.column_names(df, "v") == ["a", "b"]
    with pytest.raises(ValueError, match="more than 1"):
        capacity.column_names(df, "v", 1)


def test_locks_are_one_row_per_site(spark):
    """The day sets of all sources are united in a site's row; no row a day is made on the way, and overlaps count once."""
    jobs = spark.createDataFrame([("c", "s", "M", "R"), ("c", "t", "M", "R"), (None, "u", "M", "R")], "customer_id string, SiteCode string, Market string, Region string")
    events = spark.createDataFrame(
        [("c", "s", None, None, day(1), day(2)), ("c", None, None, None, day(2), day(3)), (None, None, "M", None, day(3), day(3))],
        "CustomerID string, SiteCode string, Market string, Region string, ValidFrom date, ValidUntil date",
    )
    weather = spark.createDataFrame([("c", "s", day(3)), ("c", "s", day(0)), ("d", "x", day(5)), ("d", "x", day(5)), ("d", None, day(5))], "CustomerID string, SiteID string, Date date")
    want = {("c", "s"): [0, 1, 2, 3], ("c", "t"): [2, 3], (None, "u"): [3], ("d", "x"): [5]}
    sets = locks.site_locks(jobs, events, weather, P)
    got = {(r.customer_id, r.SiteCode): [(d - day(0)).days for d in r.locked_days] for r in locks.lock_sets(sets).collect()}
    assert got == want and sets.count() == 4
    days = locks.lock_table(jobs, events, weather, P)
    again = {(r.customer_id, r.SiteCode): [(d - day(0)).days for d in r.locked_days] for r in locks.lock_sets(days).collect()}
    assert again == want
    plan = sets._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode(days" not in plan


@pytest.mark.parametrize(("name", "written"), [("saved_group_means", "records"), ("published_versions", "predictions")])
def test_construction_records_are_joined_once(spark, small, monkeypatch, name, written):
    """What both steps of the query read is written once; neither joins the line items again."""
    from crewcast.plans import catalog

    made, joins = [], []
    materialise, construction = catalog.materialise, catalog.views.construction
    monkeypatch.setattr(catalog, "materialise", lambda df, name, *a: made.append(name) or materialise(df, name, *a))
    monkeypatch.setattr(catalog.views, "construction", lambda *a: joins.append(1) or construction(*a))
    assert catalog.QUERIES[name](spark, small).count() > 0
    assert made == [written] and joins == [1]
