"""A plain one-job-at-a-time scheduler, the yardstick for the distributed one."""

from __future__ import annotations

import datetime as dt
import math

DAY = dt.timedelta(days=1)


def business(day, params, holidays):
    return params.weekmask[day.weekday()] == "1" and day not in holidays


def offset(day, n, params, holidays):
    while not business(day, params, holidays):
        day += DAY
    step = 1 if n >= 0 else -1
    for _ in range(abs(n)):
        day += step * DAY
        while not business(day, params, holidays):
            day += step * DAY
    return day


def span(a, b):
    return {a + i * DAY for i in range((b - a).days + 1)}


def km(p, q):
    (la, lo), (lb, ob) = p, q
    la, lo, lb, ob = map(math.radians, (la, lo, lb, ob))
    h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin((ob - lo) / 2) ** 2
    return 2 * 6373 * math.asin(min(1, math.sqrt(h)))


def skills(text):
    return set() if text is None else {s.strip() for s in text.split("|")}


def qualified(job, crews):
    rows = [
        c
        for c in crews
        if job["Market"] is not None
        and c["Market"] == job["Market"]
        and (job["VendorBooked"] is None or job["VendorBooked"] == c["VendorID"])
        and skills(job["Skills"]) <= skills(c["Skills1"])
    ]
    key = lambda c: (
        c["Score"] is not None, c["Score"], c["VendorID"], c["crew_name"], c["ValidFrom"], c["ValidUntil"],
    )
    return sorted(rows, key=key, reverse=True)


def event_hits(event, job):
    """The scope rule as a chain of cases."""
    ec, es, em, er = (event[k] for k in ("CustomerID", "SiteCode", "Market", "Region"))
    place = (
        (em is not None and em == job["Market"])
        or (er is not None and er == job["Region"])
        or (em is None and er is None)
    )
    same_customer = ec is not None and ec == job["customer_id"]
    same_site = es is not None and es == job["SiteCode"]
    if same_customer and same_site:
        return True
    return (same_customer or ec is None) and (same_site or es is None) and place


def last(value):
    return (value is None, value)


def schedule(jobs, crews, site_locks, params, holidays=frozenset()):
    """``jobs``: triaged rows as dicts. Returns JobID -> (status, vendor, crew, start)."""
    locks = {k: set(v) for k, v in site_locks.items()}
    taken = {}
    points = {}
    for j in jobs:
        if j["Latitude"] is not None and j["Longitude"] is not None:
            key = (j["customer_id"], j["SiteCode"])
            point = (j["Latitude"], j["Longitude"])
            points[key] = min(points.get(key, point), point)
    near = params.site_distance_min is not None and len(points) > 1
    lists = {j["JobID"]: qualified(j, crews) for j in jobs}

    def reserve(job, key, d1, d2):
        taken.setdefault(key, set()).update(d2)
        if near:
            here = (job["customer_id"], job["SiteCode"])
            for other in {*points, here}:
                if other[0] == here[0] and (
                    other == here
                    or (here in points and km(points[here], points[other]) < params.site_distance_min)
                ):
                    locks.setdefault(other, set()).update(d1)

    def order(j):
        n = len(lists[j["JobID"]])
        third = {1: j["JobStart"], 2: j["JobStartDateForecast"], 3: None}[j["phase"]]
        return (
            j["phase"], last(j["Priority"]), last(j["SiteReadinessForecast"]), last(third),
            last(j["JobCreateDate"]), 0 if j["phase"] == 1 else n, j["JobID"],
        )

    out = {}
    for j in sorted((j for j in jobs if j["phase"] is not None), key=order):
        here = (j["customer_id"], j["SiteCode"])
        length = j["JobDuration"] + params.job_buffer
        if j["phase"] == 1:
            start = j["JobStart"]
            end = offset(start, length, params, holidays)
            d1 = span(start, end)
            d2 = d1 | span(end, end + params.job_downtime * DAY)
            key = (j["LockVendor"], j["CrewIdBooked"])
            if locks.get(here, set()) & d1:
                out[j["JobID"]] = (6, None, None, None)
            elif taken.get(key, set()) & d2:
                out[j["JobID"]] = (2, None, None, None)
            else:
                reserve(j, key, d1, d2)
                out[j["JobID"]] = (0, None, None, None)
            continue
        start = j["JobStartDateForecast"] if j["phase"] == 2 else j["JobStart"]
        tries = j["JobStartMaxOffset"] - max((params.as_of - start).days, 0)
        start = max(start, params.as_of + params.job_start_buffer * DAY)
        result = (4, None, None, None)
        for n in range(tries + 1):
            first = offset(start, n, params, holidays)
            if first > params.plan_end:
                break
            end = offset(first, length, params, holidays)
            d1 = span(first, end)
            d2 = d1 | span(end, end + params.job_downtime * DAY)
            if locks.get(here, set()) & d1:
                result = (6, None, None, None)
                continue
            free = [
                c
                for c in lists[j["JobID"]]
                if first >= c["ValidFrom"]
                and end <= c["ValidUntil"]
                and not taken.get((c["VendorID"], c["crew_name"]), set()) & d2
            ]
            if free:
                c = free[0]
                reserve(j, (c["VendorID"], c["crew_name"]), d1, d2)
                result = (0, c["VendorID"], c["crew_name"], first)
                break
        out[j["JobID"]] = result
    return out
