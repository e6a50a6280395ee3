"""The order-dependent step: placing one bounded batch of jobs inside a Spark task."""

from __future__ import annotations

import datetime as dt
from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
import pandas as pd

from crewcast.functions.geo import EARTH_KM
from crewcast.params import Params

EPOCH = dt.date(1970, 1, 1)
ORDER = ("o1", "o2", "o3", "o4", "o5", "o6", "JobID")
RANK = ("Score", "VendorID", "crew_name", "ValidFrom", "ValidUntil")

RESULT_SCHEMA = (
    "comp long, pos long, JobID string, ResourceStatus int, RecommendedVendor string, RecommendedWorker string, "
    "planned_day int, lock_vendor string, lock_crew string, busy_from int, busy_to int, "
    "customer_id string, SiteCode string, Latitude double, Longitude double, site_from int, site_to int"
)


def day_number(day: dt.date) -> int:
    return (day - EPOCH).days


@dataclass(frozen=True)
class Rules:
    """What a task needs to know beyond its rows; its size does not depend on the data."""

    today: int
    start_buffer: int
    plan_end: int
    buffer: int
    downtime: int
    weekmask: str
    holidays: tuple[int, ...]
    near_km: float | None  # None: placements lock no sites

    @classmethod
    def of(cls, params: Params, holidays: list[dt.date], near: bool) -> Rules:
        return cls(
            today=day_number(params.as_of),
            start_buffer=params.job_start_buffer,
            plan_end=day_number(params.plan_end),
            buffer=params.job_buffer,
            downtime=params.job_downtime,
            weekmask=params.weekmask,
            holidays=tuple(day_number(d) for d in holidays),
            near_km=params.site_distance_min if near else None,
        )

    def business_days(self, first: int, last: int) -> np.ndarray:
        """Business days from ``first`` to ``last`` as day numbers."""
        days = np.arange(first, last + 1)
        off = np.array(self.holidays, dtype="M8[D]")
        return days[np.is_busday(days.astype("M8[D]"), weekmask=self.weekmask, holidays=off)]


class Calendar:
    """Business-day steps over the days a batch can touch."""

    def __init__(self, rules: Rules, first: int, last: int, longest: int) -> None:
        week = sum(c == "1" for c in rules.weekmask)
        margin = 30 + 7 * (abs(longest) + len(rules.holidays)) // week
        self.days: list[int] = rules.business_days(first - margin, last + margin).tolist()

    def index(self, day: int) -> int:
        """Position of ``day`` after rolling forward."""
        return bisect_left(self.days, day)


def first_end(jobs: pd.DataFrame, rules: Rules, calendar: Calendar) -> int:
    """Earliest day a search can end on; before its start only if a duration is negative."""
    shortest = min(int(jobs["JobDuration"].min()) + rules.buffer, 0)
    return calendar.days[calendar.index(rules.today + rules.start_buffer) + shortest]


def span(first: int, last: int, base: int) -> int:
    """Bit mask of the closed day range; empty when ``last`` is before ``first``."""
    return ((1 << (last - first + 1)) - 1) << (first - base) if last >= first else 0


class Pool:
    """Row numbers of the crews that qualify, best first, and how far each search has got.

    Crews are only ever taken, so a row that was not free for a slot never becomes free, and
    is not free for a longer slot from the same day either: the next search starts behind it.
    """

    def __init__(self, rows: np.ndarray) -> None:
        self.rows = rows
        self.passed: dict[int, dict[int, int]] = {}

    def begin(self, start: int, end: int) -> int:
        """Number of leading rows that are known not to be free from ``start`` to ``end``."""
        known = self.passed.setdefault(start, {})
        if end not in known:
            known[end] = max((n for e, n in known.items() if start <= e <= end), default=0)
        return known[end]


class Crews:
    """Candidate crews in order of preference and the days they are taken.

    ``taken`` covers the days on which the search may place a job; bookings can lie
    anywhere, so they are checked against plain intervals.
    """

    def __init__(self, state: pd.DataFrame, first: int, last: int) -> None:
        self.first, self.width = first, max(last - first + 1, 1)
        by = list(RANK)
        rows = state[state["busy_from"].isna()]
        self.rows = rows.sort_values(by, ascending=False, na_position="last").reset_index(drop=True)
        self.keys: dict[tuple, int] = {}
        pairs = zip(self.rows["VendorID"], self.rows["crew_name"], strict=True)
        self.key_of = np.array([self.key(v, c) for v, c in pairs], dtype=np.int64)
        self.valid_from = self.rows["ValidFrom"].to_numpy(dtype=np.int64)
        self.valid_until = self.rows["ValidUntil"].to_numpy(dtype=np.int64)
        self.taken = np.zeros((len(self.keys), self.width), dtype=bool)
        self.intervals: dict[int, list[tuple[int, int]]] = {}
        self.pools: dict[tuple, Pool] = {}
        busy = state[state["busy_from"].notna()]
        for v, c, a, b in zip(busy["VendorID"], busy["crew_name"], busy["busy_from"], busy["busy_to"], strict=True):
            self.take(self.key(v, c), int(a), int(b))

    def key(self, vendor: str | None, crew: str) -> int:
        return self.keys.setdefault((vendor if isinstance(vendor, str) else None, crew), len(self.keys))

    def _window(self, first: int, last: int) -> slice:
        return slice(max(first - self.first, 0), max(last - self.first + 1, 0))

    def is_taken(self, key: int, first: int, last: int) -> bool:
        return any(a <= last and first <= b for a, b in self.intervals.get(key, ()))

    def take(self, key: int, first: int, last: int) -> None:
        self.intervals.setdefault(key, []).append((first, last))
        if key < len(self.taken):
            self.taken[key, self._window(first, last)] = True

    def pool(self, market: str | None, vendor: str | None, need: str | None) -> Pool:
        """The qualified crews."""
        if not isinstance(vendor, str):
            vendor = None
        if not isinstance(need, str):
            need = None
        name = (market, vendor, need)
        if name not in self.pools:
            ok = (self.rows["Market"] == market).to_numpy()
            if vendor is not None:
                ok &= (self.rows["VendorID"] == vendor).to_numpy()
            wanted = set() if need is None else set(need.split("|"))
            good = {
                h: wanted <= (set(h.split("|")) if isinstance(h, str) else set())
                for h in self.rows["have_key"][ok].unique()
            }
            ok &= self.rows["have_key"].map(lambda h: good.get(h, False)).to_numpy(dtype=bool)
            self.pools[name] = Pool(np.flatnonzero(ok))
        return self.pools[name]

    def first_free(self, pool: Pool, start: int, end: int, last: int) -> int:
        """First row valid from ``start`` to ``end`` and free to ``last``; -1 if none."""
        rows, at, size = pool.rows, pool.begin(start, end), 64
        window = self._window(min(start, end), last)
        while at < len(rows):
            part = rows[at : at + size]
            ok = (self.valid_from[part] <= start) & (self.valid_until[part] >= end)
            ok[ok] = ~self.taken[self.key_of[part[ok]], window].any(axis=1)
            hit = int(ok.argmax())
            if ok[hit]:
                pool.passed[start][end] = at + hit
                return int(part[hit])
            at, size = at + size, 4 * size
        pool.passed[start][end] = len(rows)
        return -1


class Sites:
    """Locked days per site, as bit masks."""

    def __init__(self, jobs: pd.DataFrame, base: int, near_km: float | None) -> None:
        self.base = base
        self.near_km = near_km
        sites = jobs.drop_duplicates(["customer_id", "SiteCode"]).reset_index(drop=True)
        names = list(zip(sites["customer_id"], sites["SiteCode"], strict=True))
        self.number = {name: i for i, name in enumerate(names)}
        self.locked = [sum(1 << (int(d) - base) for d in days if d >= base) if days is not None else 0
                       for days in sites["locked_days"]]
        self.lat = np.radians(sites["Latitude"].to_numpy(dtype=float))
        self.lon = np.radians(sites["Longitude"].to_numpy(dtype=float))
        owners = sites["customer_id"].to_numpy()
        self.of_customer = {c: np.flatnonzero(owners == c) for c in pd.unique(owners)} if near_km is not None else {}
        self.near: dict[int, list[int]] = {}

    def around(self, site: int, customer: str) -> list[int]:
        """The site itself and the customer's sites nearer than the limit."""
        if site not in self.near:
            others = self.of_customer[customer]
            h = (
                np.sin((self.lat[others] - self.lat[site]) / 2) ** 2
                + np.cos(self.lat[site]) * np.cos(self.lat[others]) * np.sin((self.lon[others] - self.lon[site]) / 2) ** 2
            )
            km = 2 * EARTH_KM * np.arcsin(np.sqrt(np.minimum(h, 1.0)))
            self.near[site] = sorted({site, *others[km < self.near_km].tolist()})
        return self.near[site]

    def lock_around(self, site: int, customer: str, days: int) -> None:
        if self.near_km is not None:
            for s in self.around(site, customer):
                self.locked[s] |= days


def place_batch(jobs: pd.DataFrame, state: pd.DataFrame, rules: Rules) -> pd.DataFrame:
    """Place the jobs one after the other.

    ``state`` holds crew rows (``busy_from`` null) and the busy intervals of earlier
    batches; ``locked_days`` of a job holds its site's locked days.
    """
    if jobs.empty:
        return pd.DataFrame()
    jobs = jobs.sort_values(list(ORDER)).reset_index(drop=True)
    longest = int(jobs["JobDuration"].abs().max()) + abs(rules.buffer)
    first = min(int(jobs["start_day"].min()), rules.today)
    last = max(int(jobs["start_day"].max()), rules.today + rules.start_buffer, rules.plan_end)
    calendar = Calendar(rules, first, last, longest)
    days = calendar.days
    base = first - 1
    last_end = days[calendar.index(rules.plan_end) + longest] + rules.downtime
    crews = Crews(state, min(rules.today + rules.start_buffer, first_end(jobs, rules, calendar)), last_end)
    sites = Sites(jobs, base, rules.near_km)
    out = []

    for job in jobs.itertuples(index=False):
        site = sites.number[job.customer_id, job.SiteCode]
        length = job.JobDuration + rules.buffer
        vendor = crew = None
        chosen = None
        if job.phase == 1:
            start = job.start_day
            end = days[calendar.index(start) + length]
            key = crews.key(job.LockVendor, job.CrewIdBooked)
            busy_first = min(start, end)
            if sites.locked[site] & span(start, end, base):
                status = 6
            elif crews.is_taken(key, busy_first, end + rules.downtime):
                status = 2
            else:
                status = 0
                chosen = (job.LockVendor, job.CrewIdBooked, key, busy_first, start, end)
        else:
            status = 4
            pool = crews.pool(job.Market, job.VendorBooked, job.need_key)
            tries = job.JobStartMaxOffset - max(rules.today - job.start_day, 0)
            at = calendar.index(max(job.start_day, rules.today + rules.start_buffer))
            for i in range(at, at + tries + 1):
                start = days[i]
                if start > rules.plan_end:
                    break
                end = days[i + length]
                if sites.locked[site] & span(start, end, base):
                    status = 6
                    continue
                row = crews.first_free(pool, start, end, end + rules.downtime)
                if row >= 0:
                    status = 0
                    vendor, crew = crews.rows["VendorID"].iat[row], crews.rows["crew_name"].iat[row]
                    chosen = (vendor, crew, int(crews.key_of[row]), min(start, end), start, end)
                    break
        line = [job.comp, job.pos, job.JobID, status, vendor, crew, None if crew is None else start]
        if chosen is None:
            line += [None] * 10
        else:
            lock_vendor, lock_crew, key, busy_first, start, end = chosen
            crews.take(key, busy_first, end + rules.downtime)
            sites.lock_around(site, job.customer_id, span(start, end, base))
            line += [lock_vendor, lock_crew, busy_first, end + rules.downtime,
                     job.customer_id, job.SiteCode, job.Latitude, job.Longitude, start, end]
        out.append(line)

    names = [c.split()[0] for c in RESULT_SCHEMA.split(", ")]
    result = pd.DataFrame(out, columns=names)
    ints = ["ResourceStatus", "planned_day", "busy_from", "busy_to", "site_from", "site_to"]
    return result.astype({c: "Int32" for c in ints} | {"pos": "Int64"})
