"""The catalog's queries as DuckDB SQL over the same tables."""

from __future__ import annotations

import re

SITES = """
sites AS (
  SELECT c_custkey, c_nationkey, n_name || '/' || CAST(c_custkey % 4 AS VARCHAR) AS customer_id,
    'S' || CAST(c_custkey AS VARCHAR) AS SiteCode,
    c_nationkey * 4 - 50 + CAST(c_custkey * 37 % 1000 AS DOUBLE) / 2000 AS Latitude,
    c_nationkey * 10 - 120 + CAST(c_custkey * 59 % 1000 AS DOUBLE) / 2000 AS Longitude,
    n_name AS Market, r_name AS Region, c_mktsegment AS segment
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""

SEGMENTS = "['AUTOMOBILE','BUILDING','FURNITURE','HOUSEHOLD','MACHINERY']"


def pick(index: str) -> str:
    return f"{SEGMENTS}[(({index}) % 5) + 1]"


def skills(text: str) -> str:
    return f"list_sort(list_distinct(list_transform(string_split({text}, '|'), lambda s: trim(s))))"


CREWS_RAW = f"""
crews_raw AS (
  SELECT 'V' || CAST(s_suppkey % 5 AS VARCHAR) AS VendorID, s_name || '/' || CAST(k AS VARCHAR) AS crew_name,
    upper(n_name) AS Market, r_name AS Region,
    CASE WHEN n % 29 <> 28 THEN DATE '1998-06-01' + CAST(n % 3 * 20 - 30 AS INT) END AS ValidFrom,
    DATE '1998-06-01' + CAST(60 + n % 4 * 40 AS INT) AS ValidUntil, s_acctbal AS Score,
    array_to_string(list_filter([{pick('n')}, {pick('n + 1')}, CASE WHEN n % 2 = 0 THEN {pick('n + 2')} END,
      CASE WHEN n % 6 = 0 THEN {pick('n + 3')} END], lambda x: x IS NOT NULL), ' | ') AS Skills1
  FROM (SELECT *, s_suppkey * 3 + k AS n FROM supplier, (SELECT unnest([0, 1, 2]) AS k))
    JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""

CREWS = f"""
crews AS (
  SELECT *, {skills('Skills1')} AS have, array_to_string({skills('Skills1')}, '|') AS have_key
  FROM crews_raw WHERE ValidFrom IS NOT NULL AND ValidUntil IS NOT NULL
)"""

JOBS_RAW = f"""
nation_suppliers AS (
  SELECT s_nationkey, s_name AS booked_name, 'V' || CAST(s_suppkey % 5 AS VARCHAR) AS booked_vendor,
    row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1 AS nth,
    count(*) OVER (PARTITION BY s_nationkey) AS n_suppliers
  FROM supplier
),
order_lines AS (
  SELECT o.*, CAST(o_orderdate AS DATE) AS created, o_orderkey AS k, coalesce(n, 0) AS n_lines
  FROM orders o LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey
),
jobs_raw AS (
  SELECT CAST(k AS VARCHAR) AS JobID, customer_id, SiteCode, Latitude, Longitude, upper(Market) AS Market,
    CASE WHEN k % 53 <> 0 THEN segment || CASE WHEN k % 4 = 0 THEN '| ' || {pick('k')} ELSE '' END END AS Skills,
    CASE WHEN k % 11 = 0 AND k % 2 = 0 THEN booked_vendor
      WHEN k % 11 <> 0 AND k % 7 = 0 THEN 'V' || CAST(k % 5 AS VARCHAR) END AS VendorBooked,
    CASE WHEN k % 143 = 0 THEN 'No real crew' WHEN k % 121 = 0 THEN 'Unlisted crew'
      WHEN k % 11 = 0 THEN booked_name || '/' || CAST(k % 3 AS VARCHAR) END AS CrewIdBooked,
    CASE WHEN k % 10 <> 9 THEN CAST(substr(o_orderpriority, 1, 1) AS INT) END AS Priority,
    created AS JobCreateDate,
    CASE WHEN k % 5 <> 0 THEN created + CAST(10 + k % 20 AS INT) END AS JobStartDateForecast,
    CASE WHEN k % 5 <> 0 THEN created + CAST(10 + k % 20 AS INT) + CAST(CASE WHEN k % 97 = 0 THEN -3
      WHEN k % 101 = 0 THEN 200 ELSE 1 + 2 * n_lines + k % 4 END AS INT) END AS JobEndDateForecast,
    CASE WHEN o_orderstatus = 'F' THEN created + 12 END AS JobStartDateActual,
    CASE WHEN o_orderstatus = 'F' AND k % 8 <> 0 THEN created + 40 END AS JobEndDateActual,
    CASE WHEN k % 3 <> 0 THEN created + CAST(5 + k % 9 AS INT) END AS SiteReadinessForecast,
    CASE WHEN k % 6 <> 0 THEN CAST(k % 40 AS DOUBLE) / 4 + 2 END AS JobDurationML,
    CASE WHEN k % 4 = 0 THEN CAST(5 + k % 30 AS INT) END AS JobStartMaxOffset,
    DATE '1998-06-01' AS refresh_date
  FROM order_lines JOIN sites ON o_custkey = c_custkey
    LEFT JOIN nation_suppliers ON s_nationkey = c_nationkey AND nth = k % n_suppliers
)"""

JOBS = f"""
jobs AS (
  SELECT *, CASE WHEN Skills IS NULL THEN CAST([] AS VARCHAR[]) ELSE {skills('Skills')} END AS need,
    array_to_string({skills('Skills')}, '|') AS need_key
  FROM jobs_raw WHERE CrewIdBooked IS DISTINCT FROM 'No real crew' AND JobEndDateActual IS NULL
),
filled AS (
  SELECT * REPLACE (coalesce(Priority, 5) AS Priority, coalesce(JobStartMaxOffset, 90) AS JobStartMaxOffset),
    coalesce(JobStartDateActual, JobStartDateForecast, SiteReadinessForecast, JobCreateDate + 30) AS JobStart,
    CAST(coalesce(JobEndDateForecast - JobStartDateForecast + 1 + 1, ceil(JobDurationML), 10) AS INT) AS JobDuration
  FROM jobs
)"""

REGIONAL = """
regions AS (SELECT Market, min(Region) AS Region FROM crews GROUP BY 1),
regional AS (SELECT jobs.*, regions.Region FROM jobs LEFT JOIN regions USING (Market))"""

QUALIFIED = """
pools AS (SELECT DISTINCT Market, VendorBooked, need_key, need FROM jobs),
matches AS (
  SELECT p.Market, p.VendorBooked, p.need_key, c.VendorID, c.crew_name, c.Score, c.ValidFrom, c.ValidUntil
  FROM pools p JOIN crews c ON p.Market = c.Market AND (p.VendorBooked IS NULL OR p.VendorBooked = c.VendorID)
    AND list_has_all(c.have, p.need)
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY Market, VendorBooked, need_key ORDER BY Score DESC NULLS LAST,
    VendorID DESC, crew_name DESC, ValidFrom DESC, ValidUntil DESC) - 1 AS "rank" FROM matches
),
counts AS (SELECT Market, VendorBooked, need_key, count(*) AS n FROM matches GROUP BY ALL)"""

SAME_POOL = (
    "f.Market IS NOT DISTINCT FROM {0}.Market AND f.VendorBooked IS NOT DISTINCT FROM {0}.VendorBooked "
    "AND f.need_key IS NOT DISTINCT FROM {0}.need_key"
)

TRIAGED = f"""
names AS (SELECT crew_name, CASE WHEN min(VendorID) = max(VendorID) THEN min(VendorID) END AS only_vendor
  FROM crews GROUP BY 1),
joined AS (
  SELECT f.*, coalesce(n, 0) AS CountQualified, names.crew_name IS NOT NULL AS CrewKnown,
    CASE WHEN CrewIdBooked IS NOT NULL THEN coalesce(f.VendorBooked, only_vendor) END AS LockVendor
  FROM filled f LEFT JOIN counts q ON {SAME_POOL.format('q')}
    LEFT JOIN names ON names.crew_name = f.CrewIdBooked
),
coded AS (
  SELECT *, CASE
    WHEN CrewIdBooked IS NULL AND (DATE '1998-06-01' - JobStart > JobStartMaxOffset
      OR JobStart - DATE '1998-06-01' > 90) THEN 9
    WHEN coalesce(JobStartDateForecast > JobEndDateForecast, false) OR coalesce(JobDuration > 60, false)
      OR (CrewIdBooked IS NOT NULL AND JobStartDateActual IS NULL AND JobStartDateForecast IS NULL)
      OR (CrewIdBooked IS NULL AND coalesce(JobStartDateActual <= DATE '1998-06-01', false))
      OR JobStart IS NULL THEN 5
    WHEN CrewIdBooked IS NOT NULL AND NOT CrewKnown THEN 8
    WHEN CrewIdBooked IS NULL AND CountQualified = 0 THEN 3 END AS ResourceStatus
  FROM joined
),
triaged AS (
  SELECT *, CASE WHEN ResourceStatus IS NOT NULL THEN NULL WHEN CrewIdBooked IS NOT NULL THEN 1
    WHEN JobStartDateForecast IS NOT NULL THEN 2 ELSE 3 END AS phase FROM coded
)"""

EVENTS = """
event_sites AS (
  SELECT e.*, s.*, CAST(extract(day FROM ts) AS INT) AS d, event_id % 50000 AS m
  FROM events e JOIN sites s ON user_id * 10 + event_id % 10 = c_custkey
),
special AS (
  SELECT CASE WHEN NOT (m BETWEEN 400 AND 704) THEN customer_id END AS x_customer,
    CASE WHEN NOT (m BETWEEN 100 AND 319 OR m BETWEEN 500 AND 704) THEN SiteCode END AS x_site,
    CASE WHEN m BETWEEN 310 AND 319 OR m BETWEEN 440 AND 459 OR m BETWEEN 605 AND 609 THEN 'NOWHERE'
      WHEN m BETWEEN 200 AND 219 OR m BETWEEN 400 AND 459 OR m BETWEEN 500 AND 509 THEN upper(Market) END AS x_market,
    CASE WHEN m BETWEEN 300 AND 319 OR m BETWEEN 440 AND 459 OR m BETWEEN 600 AND 609 THEN upper(Region) END AS x_region,
    DATE '1998-06-01' + (d - 1) * 3 AS a, DATE '1998-06-01' + (d - 1) * 3 + CAST(event_id % 3 AS INT) AS b
  FROM event_sites WHERE event_type = 'signup'
),
weather AS (
  SELECT DISTINCT customer_id, SiteCode, DATE '1998-06-01' + (d - 1) * 3 + CAST(event_id % 3 AS INT) AS day
  FROM event_sites WHERE event_type = 'error'
),
event_days AS (
  SELECT DISTINCT x_customer, x_site, x_market, x_region,
    CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS day FROM special
)"""

LOCKS = """
event_locks AS (
  SELECT DISTINCT customer_id, SiteCode, day
  FROM (SELECT DISTINCT customer_id, SiteCode, Market, Region FROM regional) y JOIN event_days x ON
    (x_customer = customer_id AND x_site = SiteCode)
    OR ((x_customer = customer_id OR x_customer IS NULL) AND (x_site = SiteCode OR x_site IS NULL)
      AND (x_market = Market OR x_region = Region OR (x_market IS NULL AND x_region IS NULL)))
),
locks AS (SELECT * FROM event_locks UNION SELECT * FROM weather)"""

CALENDAR = """
days AS (SELECT CAST(unnest(generate_series(DATE '1990-01-01', DATE '2010-12-31', INTERVAL 1 DAY)) AS DATE) AS day),
calendar AS (
  SELECT day, isodow(day) <= 5 AS is_business,
    CAST(sum(CAST(isodow(day) <= 5 AS INT)) OVER (ORDER BY day) - CAST(isodow(day) <= 5 AS INT) AS INT) AS ord
  FROM days
),
workdays AS (SELECT day, ord FROM calendar WHERE is_business),
open_days AS (
  SELECT day, CAST(isodow(day) <= 5 AND NOT (day(day) IN (1, 15)
    AND day IN (SELECT CAST(o_orderdate AS DATE) FROM orders)) AS INT) AS o FROM days
)"""

SLOTS = """
wanted AS (
  SELECT *, greatest(CASE WHEN phase = 2 THEN JobStartDateForecast ELSE JobStart END, DATE '1998-06-03') AS first_day,
    JobStartMaxOffset - greatest(DATE '1998-06-01' - CASE WHEN phase = 2 THEN JobStartDateForecast ELSE JobStart END, 0)
      AS last_offset
  FROM triaged WHERE phase >= 2
),
slots AS (
  SELECT w.*, CAST(t."offset" AS INT) AS "offset", s.day AS slot_start, e.day AS slot_end
  FROM wanted w, LATERAL (SELECT unnest(generate_series(0, least(last_offset, 90))) AS "offset") t
    JOIN calendar c ON c.day = first_day JOIN workdays s ON s.ord = c.ord + t."offset"
    LEFT JOIN workdays e ON e.ord = s.ord + JobDuration + 1
  WHERE s.day <= DATE '1998-08-30'
)"""

BUSY = """
busy AS (
  SELECT LockVendor AS v, CrewIdBooked AS c, least(JobStart, e.day) AS a, e.day + 2 AS b
  FROM triaged t JOIN calendar c ON c.day = t.JobStart JOIN workdays e ON e.ord = c.ord + t.JobDuration + 1 WHERE phase = 1
)"""

FREE = """
free AS (
  SELECT * FROM slots s WHERE NOT EXISTS (SELECT 1 FROM locks l WHERE l.customer_id = s.customer_id
    AND l.SiteCode = s.SiteCode AND l.day BETWEEN s.slot_start AND s.slot_end)
)"""

CONSTRUCTION = """
construction AS (
  SELECT CAST(l_shipdate AS DATE) AS refresh_date, CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS id,
    lower(Region) AS region, lower(Market) AS market, p_type AS package_name, SiteCode AS site,
    CAST(l_shipdate AS DATE) AS civil_start, CAST(l_shipdate AS DATE) + 5 AS civil_end,
    CASE WHEN l_orderkey % 41 <> 0 THEN CAST(l_shipdate AS DATE) + CAST(CAST(l_quantity AS INT)
      + CASE WHEN l_partkey % 50 = 0 THEN 200 ELSE p_size END
      - CASE WHEN l_orderkey % 37 = 0 THEN 400 ELSE 0 END AS INT) END AS tower_end,
    customer_id AS customer, CASE WHEN l_orderkey % 43 <> 0 THEN Latitude END AS latitude, Longitude AS longitude
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
    JOIN sites ON o_custkey = c_custkey
),
base AS (
  SELECT * EXCLUDE (rn) REPLACE (upper(region) AS region, upper(market) AS market) FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY refresh_date DESC NULLS LAST, region DESC NULLS LAST,
      market DESC NULLS LAST, package_name DESC NULLS LAST, site DESC NULLS LAST, civil_start DESC NULLS LAST,
      civil_end DESC NULLS LAST, refresh_date DESC, tower_end DESC NULLS LAST, customer DESC NULLS LAST,
      latitude DESC NULLS LAST, longitude DESC NULLS LAST) AS rn FROM construction) WHERE rn = 1
),
labelled AS (SELECT *, tower_end - civil_start AS label FROM base WHERE tower_end - civil_start >= 0),
complete AS (SELECT * FROM labelled WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND region IS NOT NULL
  AND market IS NOT NULL AND package_name IS NOT NULL),
fences AS (SELECT package_name AS g, quantile_disc(label, 0.25) AS q1, quantile_disc(label, 0.75) AS q3
  FROM complete GROUP BY 1),
training AS (SELECT complete.* FROM complete JOIN fences ON package_name = g
  WHERE label BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))"""

FOLDED = """
folded AS (SELECT *, CAST(CAST('0x' || substr(md5('123:' || id), 1, 8) AS BIGINT) % 10 AS INT) AS fold FROM training)"""

FITS = """
fits AS (
  SELECT f.fold, avg(latitude) AS mx, avg(longitude) AS mz, avg(label) AS my, stddev_pop(latitude) AS dx, stddev_pop(longitude) AS dz,
    stddev_pop(label) AS dy, corr(latitude, longitude) AS c, corr(latitude, label) AS rx, corr(longitude, label) AS rz
  FROM (SELECT DISTINCT fold FROM folded) f JOIN folded r ON r.fold <> f.fold GROUP BY 1
)"""

CAPACITY = """
capacity AS (
  SELECT d.day, c.crew_name, CAST(-count(b.JobID) AS INT) AS capacity
  FROM (SELECT DISTINCT crew_name FROM crews) c
    CROSS JOIN (SELECT CAST(unnest(generate_series(DATE '1998-06-01', DATE '1998-06-30', INTERVAL 1 DAY)) AS DATE) AS day) d
    LEFT JOIN filled b ON b.CrewIdBooked = c.crew_name
      AND d.day BETWEEN JobStartDateForecast AND JobStartDateForecast + JobDuration - 1 + 2
  GROUP BY 1, 2
)"""



def _placed(name: str, near: str) -> str:
    """The greedy, one job of each market a step: busy crews and held sites travel along as lists.

    ``near`` gives a job's site with those that its placement locks as well.
    """
    return f"""
{name}_options AS (
  SELECT s.JobID, list({{'a': s.slot_start, 'b': s.slot_end, 'locked': f.JobID IS NULL}} ORDER BY s."offset") AS options
  FROM slots s LEFT JOIN free f ON f.JobID = s.JobID AND f."offset" = s."offset" GROUP BY 1
  UNION ALL
  SELECT JobID, [{{'a': JobStart, 'b': e.day, 'locked': EXISTS (SELECT 1 FROM locks l WHERE l.customer_id = t.customer_id
    AND l.SiteCode = t.SiteCode AND l.day BETWEEN t.JobStart AND e.day)}}]
  FROM triaged t JOIN calendar c ON c.day = t.JobStart JOIN workdays e ON e.ord = c.ord + t.JobDuration + 1 WHERE phase = 1
),
{name}_lists AS (
  SELECT Market, VendorBooked, need_key,
    list({{'v': VendorID, 'c': crew_name, 'f': ValidFrom, 'u': ValidUntil}} ORDER BY "rank") AS crews FROM ranked GROUP BY ALL
),
{name}_jobs AS (
  SELECT t.JobID, t.phase, t.Market, {near} AS near, t.customer_id || '#' || t.SiteCode AS site,
    coalesce(o.options, []) AS options,
    CASE WHEN phase = 1 THEN [{{'v': LockVendor, 'c': CrewIdBooked, 'f': DATE '1000-01-01', 'u': DATE '9999-12-31'}}]
      ELSE f.crews END AS crews,
    row_number() OVER (PARTITION BY t.Market ORDER BY phase, Priority NULLS LAST, SiteReadinessForecast NULLS LAST,
      CASE phase WHEN 1 THEN JobStart WHEN 2 THEN JobStartDateForecast END NULLS LAST, JobCreateDate NULLS LAST,
      CASE WHEN phase > 1 THEN CountQualified END NULLS LAST, t.JobID) AS n
  FROM triaged t LEFT JOIN {name}_options o ON o.JobID = t.JobID LEFT JOIN {name}_lists f ON {SAME_POOL.format('t')}
  WHERE phase IS NOT NULL
),
{name} AS (
  SELECT Market, CAST(0 AS BIGINT) AS n, CAST([] AS STRUCT(v VARCHAR, c VARCHAR, a DATE, b DATE)[]) AS busy,
    CAST([] AS STRUCT(k VARCHAR, a DATE, b DATE)[]) AS held, CAST(NULL AS VARCHAR) AS JobID, CAST(NULL AS INT) AS status,
    CAST(NULL AS VARCHAR) AS vendor, CAST(NULL AS VARCHAR) AS crew, CAST(NULL AS DATE) AS start
  FROM (SELECT DISTINCT Market FROM {name}_jobs)
  UNION ALL
  SELECT Market, n,
    CASE WHEN good IS NULL THEN busy
      ELSE list_append(busy, {{'v': good.crew.v, 'c': good.crew.c, 'a': good.a, 'b': good.b + 2}}) END,
    CASE WHEN good IS NULL THEN held ELSE list_append(held, {{'k': site, 'a': good.a, 'b': good.b}}) END,
    JobID,
    CASE WHEN good IS NOT NULL THEN 0 WHEN len(list_filter(tried, lambda x: x.bad)) > 0 THEN 6
      WHEN phase = 1 THEN 2 ELSE 4 END,
    CASE WHEN phase > 1 THEN good.crew.v END, CASE WHEN phase > 1 THEN good.crew.c END,
    CASE WHEN phase > 1 THEN good.a END
  FROM (
    SELECT *, list_filter(tried, lambda x: NOT x.bad AND x.crew IS NOT NULL)[1] AS good FROM (
      SELECT j.*, w.busy, w.held, list_transform(j.options, lambda x: {{'a': x.a, 'b': x.b,
        'bad': x.locked OR len(list_filter(w.held, lambda h: list_contains(j.near, h.k) AND h.a <= x.b AND h.b >= x.a)) > 0,
        'crew': list_filter(j.crews, lambda c: c.f <= x.a AND c.u >= x.b AND len(list_filter(w.busy, lambda y:
          y.v IS NOT DISTINCT FROM c.v AND y.c = c.c AND y.a <= x.b + 2 AND y.b >= x.a)) = 0)[1]}}) AS tried
      FROM {name} w JOIN {name}_jobs j ON j.Market = w.Market AND j.n = w.n + 1))
)"""


PLACED = _placed("placed", "CAST([] AS VARCHAR[])")  # without a distance placements lock no site
PLACED_NEAR = """
near_lists AS (
  SELECT customer_id, site, list(customer_id || '#' || other) AS sites FROM (
    SELECT a.customer_id, a.SiteCode AS site, b.SiteCode AS other FROM (@POINTS) a JOIN (@POINTS) b
      ON a.customer_id = b.customer_id AND a.SiteCode <> b.SiteCode WHERE @KM < 3.0) GROUP BY 1, 2
),""" + _placed(
    "placed_near",
    """list_append(coalesce((SELECT sites FROM near_lists q WHERE q.customer_id = t.customer_id AND q.site = t.SiteCode), []),
      t.customer_id || '#' || t.SiteCode)""",
)

# every block with the blocks it needs
BLOCKS: dict[str, tuple[str, tuple[str, ...]]] = {
    "sites": (SITES, ()),
    "crews": (CREWS_RAW + "," + CREWS, ()),
    "jobs_raw": (JOBS_RAW, ("sites",)),
    "jobs": (JOBS, ("jobs_raw",)),
    "regional": (REGIONAL, ("jobs", "crews")),
    "qualified": (QUALIFIED, ("jobs", "crews")),
    "triaged": (TRIAGED, ("qualified",)),
    "events": (EVENTS, ("sites",)),
    "locks": (LOCKS, ("regional", "events")),
    "calendar": (CALENDAR, ()),
    "slots": (SLOTS, ("triaged", "calendar")),
    "busy": (BUSY, ("triaged", "calendar")),
    "free": (FREE, ("slots", "locks")),
    "placed": (PLACED, ("free",)),
    "placed_near": (PLACED_NEAR, ("free",)),
    "construction": (CONSTRUCTION, ("sites",)),
    "folded": (FOLDED, ("construction",)),
    "fits": (FITS, ("folded",)),
    "capacity": (CAPACITY, ("jobs", "crews")),
}


def with_blocks(names: str, select: str) -> str:
    order: list[str] = []

    def add(name: str) -> None:
        for need in BLOCKS[name][1]:
            add(need)
        if name not in order:
            order.append(name)

    for name in names.split():
        add(name)
    parts = [BLOCKS[n][0].strip() for n in order]
    walks = any(n.startswith("placed") for n in order)
    return ("WITH " + "RECURSIVE " * walks + ",\n".join(parts) + "\n" if parts else "") + re.sub(r"\n\s+", "\n", select.strip())


def haversine(a: str, b: str, c: str, d: str) -> str:
    return (
        f"2 * 6373.0 * asin(sqrt(least(1.0, pow(sin((radians({c}) - radians({a})) / 2), 2) + cos(radians({a})) "
        f"* cos(radians({c})) * pow(sin((radians({d}) - radians({b})) / 2), 2))))"
    )


LABELS = (
    "CASE ResourceStatus WHEN 9 THEN 'outside planning window' WHEN 5 THEN 'bad data' "
    "WHEN 8 THEN 'unknown booked crew' WHEN 3 THEN 'no qualified crew' END"
)
POINTS = """(SELECT customer_id, SiteCode, min(Latitude) AS Latitude, min(Longitude) AS Longitude FROM jobs_raw GROUP BY 1, 2)"""
QUARTILES = """(SELECT event_type AS g, quantile_disc(value, 0.25) AS q1, quantile_disc(value, 0.75) AS q3 FROM events GROUP BY 1)"""

BLOCKS["placed_near"] = (
    PLACED_NEAR.replace("(@POINTS)", POINTS).replace("@KM", haversine("a.Latitude", "a.Longitude", "b.Latitude", "b.Longitude")),
    BLOCKS["placed_near"][1],
)


def _overlay(placed: str, text: bool) -> str:
    """Every job with its status and, where it was planned, vendor, crew and start."""
    mark = (lambda c: f"coalesce(CAST({c} AS VARCHAR), '#')") if text else (lambda c: c)
    return f"""SELECT t.JobID AS WpId, {mark('p.vendor')} AS VendorId, {mark('p.crew')} AS CrewId, {mark('p.start')} AS PlannedStartDate,
        refresh_date AS RefreshDate, CAST(coalesce(p.status, t.ResourceStatus) AS INT) AS ResourceStatus, JobDuration
        FROM triaged t LEFT JOIN {placed} p ON p.JobID = t.JobID"""


QUERIES: dict[str, tuple[str, str]] = {
    "allocate_jobs": ("placed", _overlay("placed", False)),
    "allocation_text": ("placed", _overlay("placed", True)),
    "allocate_with_neighbours": ("placed_near", _overlay("placed_near", False)),
    "allocate_in_windows": ("placed_near", _overlay("placed_near", False)),
    "clean_jobs": ("jobs", "SELECT JobID, customer_id, Market, VendorBooked, CrewIdBooked, JobCreateDate, SiteReadinessForecast FROM jobs"),
    "clean_crews": ("crews", "SELECT VendorID, crew_name, Market, Region, ValidFrom, ValidUntil, have_key FROM crews"),
    "parse_dates": ("", """SELECT o_orderkey, CASE WHEN o_orderkey % 17 = 0 OR o_orderkey % 19 = 0 OR o_orderkey % 23 = 0
        THEN NULL ELSE CAST(o_orderdate AS DATE) END AS created FROM orders"""),
    "dedupe_latest": ("", """SELECT * EXCLUDE (rn, l_shipdate) FROM (SELECT *, CAST(l_shipdate AS DATE) AS shipped,
        row_number() OVER (PARTITION BY l_orderkey ORDER BY CAST(l_shipdate AS DATE) DESC NULLS LAST, l_partkey DESC NULLS LAST,
        l_suppkey DESC NULLS LAST, l_linenumber DESC NULLS LAST, l_quantity DESC, l_extendedprice DESC, l_discount DESC,
        l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn FROM lineitem) WHERE rn = 1"""),
    "filter_and_sort": ("jobs", """SELECT JobID, Priority, SiteReadinessForecast, JobStart, JobCreateDate FROM filled
        WHERE CrewIdBooked IS NOT NULL"""),
    "stage_counts": ("jobs crews events", """SELECT 'raw jobs' AS stage, count(*) AS n_rows, CAST(19 AS INT) AS n_columns FROM jobs_raw
        UNION ALL SELECT 'clean jobs', count(*), 19 FROM jobs UNION ALL SELECT 'clean crews', count(*), 9 FROM crews
        UNION ALL SELECT 'clean events', count(*), 6 FROM special
        UNION ALL SELECT 'event markets', count(DISTINCT x_market), 1 FROM special"""),
    "duration_label": ("construction", "SELECT id, CAST(label AS INT) AS label FROM labelled"),
    "quantiles_by_group": ("", f"SELECT g AS event_type, q1, q3 FROM {QUARTILES}"),
    "sketched_quartiles": ("", """SELECT event_type, count(value) AS n_rows, true AS q1_near, true AS q3_near FROM events GROUP BY 1"""),
    "outlier_fences": ("", f"""SELECT event_id, event_type, value FROM events JOIN {QUARTILES} ON event_type = g
        WHERE value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)"""),
    "training_rows": ("construction", """SELECT id, region, market, package_name, latitude, longitude,
        CAST(label AS INT) AS label FROM training"""),
    "scoring_rows": ("construction", "SELECT id, region, market, site, customer FROM base"),
    "fold_sizes": ("folded", "SELECT fold, count(*) AS n_rows, CAST(sum(label) AS BIGINT) AS days FROM folded GROUP BY 1"),
    "code_correlations": ("construction", """SELECT a.k AS name_a, a.v AS value_a, b.k AS name_b, b.v AS value_b, p.s AS n_rows,
          round((p.s / n - a.s / n * b.s / n) / sqrt(a.s / n * (1 - a.s / n) * (b.s / n) * (1 - b.s / n)), 9) AS correlation
        FROM (SELECT 'region' AS ka, region AS va, 'market' AS kb, market AS vb, count(*) AS s FROM training GROUP BY ALL
          UNION ALL SELECT 'region', region, 'package_name', package_name, count(*) FROM training GROUP BY ALL
          UNION ALL SELECT 'market', market, 'package_name', package_name, count(*) FROM training GROUP BY ALL) p
        JOIN (SELECT 'region' AS k, region AS v, CAST(count(*) AS DOUBLE) AS s FROM training GROUP BY ALL
          UNION ALL SELECT 'market', market, count(*) FROM training GROUP BY ALL) a ON a.k = ka AND a.v = va
        JOIN (SELECT 'market' AS k, market AS v, CAST(count(*) AS DOUBLE) AS s FROM training GROUP BY ALL
          UNION ALL SELECT 'package_name', package_name, count(*) FROM training GROUP BY ALL) b ON b.k = kb AND b.v = vb,
        (SELECT CAST(count(*) AS DOUBLE) AS n FROM training)"""),
    "cv_ridge_two_numbers": ("fits", """SELECT r.fold, reg AS "regParam",
          round(avg(abs(label - my - bx * dy / dx * (latitude - mx) - bz * dy / dz * (longitude - mz))), 6) AS mae
        FROM (SELECT *, ((1 + reg / dy) * rx - c * rz) / ((1 + reg / dy) ** 2 - c ** 2) AS bx,
            ((1 + reg / dy) * rz - c * rx) / ((1 + reg / dy) ** 2 - c ** 2) AS bz
          FROM fits, (SELECT unnest([0.1::DOUBLE, 0.3::DOUBLE]) AS reg)) m JOIN folded r USING (fold) GROUP BY 1, 2"""),
    "cv_elastic_net_one_number": ("fits", """SELECT r.fold, reg AS "regParam", alpha AS "elasticNetParam",
          round(avg(abs(label - my - b * dy / dx * (latitude - mx))), 6) AS mae
        FROM (SELECT *, sign(rx) * greatest(abs(rx) - reg / dy * alpha, 0) / (1 + reg / dy * (1 - alpha)) AS b
          FROM fits, (SELECT unnest([0.1::DOUBLE, 0.3::DOUBLE, 5.0::DOUBLE]) AS reg),
            (SELECT unnest([0.0::DOUBLE, 0.3::DOUBLE, 0.5::DOUBLE, 0.8::DOUBLE, 1.0::DOUBLE]) AS alpha)) m
          JOIN folded r USING (fold) GROUP BY 1, 2, 3"""),
    "saved_group_means": ("construction", """SELECT id AS "JobID", region, market, package_name, refresh_date,
          round(coalesce(m, (SELECT avg(label) FROM training)), 6) AS "JobDurationML"
        FROM base LEFT JOIN (SELECT package_name AS g, avg(label) AS m FROM training GROUP BY 1) ON package_name = g"""),
    "mae_by_group": ("construction", """SELECT market, round(avg(abs(m - label)), 6) AS mae FROM training
        JOIN (SELECT market AS g, avg(label) AS m FROM training GROUP BY 1) ON market = g GROUP BY 1"""),
    "job_start": ("jobs", "SELECT JobID, JobStart FROM filled"),
    "job_duration": ("jobs", "SELECT JobID, JobDuration FROM filled"),
    "job_defaults": ("jobs", "SELECT JobID, Priority, JobStartMaxOffset FROM filled"),
    "booked_crew_unknown": ("jobs crews", """SELECT JobID, CrewIdBooked FROM jobs WHERE CrewIdBooked IS NOT NULL
        AND NOT EXISTS (SELECT 1 FROM crews WHERE crew_name = CrewIdBooked)"""),
    "lock_vendor": ("triaged", "SELECT JobID, CrewKnown, LockVendor FROM joined"),
    "triage_codes": ("triaged", f"SELECT JobID, ResourceStatus, {LABELS} AS StatusLabel, phase FROM triaged"),
    "phase_split": ("triaged", """SELECT phase, count(*) AS n_jobs, CAST(sum(JobDuration) AS BIGINT) AS days,
        min(JobStart) AS first_start FROM triaged GROUP BY 1"""),
    "market_match": ("jobs crews", """SELECT JobID, j.Market, n_crews FROM jobs j
        JOIN (SELECT Market, count(*) AS n_crews FROM crews GROUP BY 1) c ON j.Market = c.Market"""),
    "vendor_match": ("jobs crews", """SELECT JobID, j.Market, VendorBooked, sum(n)::BIGINT AS n_crews FROM jobs j
        JOIN (SELECT Market, VendorID, count(*) AS n FROM crews GROUP BY 1, 2) c
        ON j.Market = c.Market AND (VendorBooked IS NULL OR VendorBooked = VendorID) GROUP BY 1, 2, 3"""),
    "skill_match": ("qualified", """SELECT DISTINCT p.Market, need_key, have_key FROM pools p
        JOIN crews c ON p.Market = c.Market AND list_has_all(c.have, p.need)"""),
    "qualified_counts": ("triaged", "SELECT JobID, CAST(CountQualified AS INT) AS CountQualified FROM joined"),
    "qualified_crews": ("qualified", """SELECT Market, VendorBooked, need_key, "rank", VendorID, crew_name, Score,
        ValidFrom, ValidUntil FROM ranked"""),
    "qualified_per_job": ("qualified", f"""SELECT JobID, count(*) AS n_crews, arg_min(crew_name, "rank") AS first_crew,
        arg_max(crew_name, "rank") AS last_crew FROM jobs f JOIN ranked r ON {SAME_POOL.format("r")} GROUP BY 1"""),
    "best_crew": ("qualified", f"""SELECT JobID, Score, VendorID, crew_name, ValidFrom, ValidUntil
        FROM jobs f JOIN ranked r ON {SAME_POOL.format("r")} WHERE "rank" = 0"""),
    "market_region": ("regional", "SELECT JobID, Market, Region FROM regional"),
    "vendor_lookup": ("jobs_raw crews", """SELECT JobID, RecommendedWorker,
        CASE WHEN RecommendedWorker = 'Resource shortage' THEN 'Resource shortage' ELSE VendorID END AS RecommendedVendor
        FROM (SELECT JobID, CASE WHEN CAST(JobID AS BIGINT) % 7 = 0 THEN 'Resource shortage'
          WHEN CAST(JobID AS BIGINT) % 11 = 0 THEN CrewIdBooked END AS RecommendedWorker FROM jobs_raw)
        LEFT JOIN (SELECT DISTINCT crew_name, VendorID FROM crews) ON crew_name = RecommendedWorker"""),
    "weather_locks": ("events", "SELECT * FROM weather"),
    "event_days": ("events", "SELECT * FROM event_days"),
    "event_lock_days": ("locks", "SELECT * FROM event_locks"),
    "site_lock_sets": ("locks", """SELECT customer_id, SiteCode, string_agg(CAST(day AS VARCHAR), ',' ORDER BY day) AS locked_days
        FROM locks GROUP BY 1, 2"""),
    "business_calendar_load": ("calendar", """SELECT c.*, n_orders FROM calendar c JOIN (
        SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n_orders FROM orders GROUP BY 1) o ON c.day = o.day"""),
    "business_offset": ("calendar", """SELECT o_orderkey, created, w.day AS due
        FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS created FROM orders) JOIN calendar c ON c.day = created
        JOIN workdays w ON w.ord = c.ord + o_orderkey % 15"""),
    "forecast_days": ("jobs", """SELECT CAST(day AS DATE) AS day, count(*) AS n_jobs FROM (
        SELECT unnest(generate_series(JobStartDateForecast, JobEndDateForecast, INTERVAL 1 DAY)) AS day FROM jobs
        WHERE JobStartDateForecast <= JobEndDateForecast) GROUP BY 1"""),
    "site_distance": ("jobs_raw", f"""SELECT customer_id, SiteCode,
        round({haversine('Latitude', 'Longitude', '10.0', '20.0')}, 6) AS km FROM {POINTS}"""),
    "near_sites": ("jobs_raw", f"""SELECT * FROM (SELECT a.customer_id, a.SiteCode AS site_a, b.SiteCode AS site_b,
        round({haversine('a.Latitude', 'a.Longitude', 'b.Latitude', 'b.Longitude')}, 6) AS km FROM {POINTS} a
        JOIN {POINTS} b ON a.customer_id = b.customer_id AND a.SiteCode < b.SiteCode) WHERE km < 3.0"""),
    "candidate_slots": ("slots", 'SELECT JobID, "offset", slot_start, slot_end FROM slots'),
    "site_free_slots": ("free", 'SELECT JobID, "offset", slot_start, slot_end FROM free'),
    "crew_free_slots": ("slots busy", """SELECT f.Market, f.VendorBooked, f.need_key, slot_start, slot_end,
        CAST(count(*) AS INT) AS n_crews, arg_min(VendorID, "rank") AS VendorID, arg_min(crew_name, "rank") AS crew_name
        FROM (SELECT DISTINCT Market, VendorBooked, need_key, slot_start, slot_end FROM slots) f JOIN ranked r ON """
        + SAME_POOL.format("r") + """ AND slot_start >= ValidFrom AND slot_end <= ValidUntil
        WHERE NOT EXISTS (SELECT 1 FROM busy WHERE v = VendorID AND c = crew_name AND a <= slot_end + 2 AND slot_start <= b)
        GROUP BY 1, 2, 3, 4, 5"""),
    "valid_crew_slots": ("slots", """SELECT f.Market, f.VendorBooked, f.need_key, slot_start, slot_end,
        CAST(count(*) AS INT) AS n_crews, arg_min(VendorID, "rank") AS VendorID, arg_min(crew_name, "rank") AS crew_name
        FROM (SELECT DISTINCT Market, VendorBooked, need_key, slot_start, slot_end FROM slots) f JOIN ranked r ON """
        + SAME_POOL.format("r") + """ AND slot_start >= ValidFrom AND slot_end <= ValidUntil GROUP BY 1, 2, 3, 4, 5"""),
    "busy_crew_days": ("busy", """SELECT v AS VendorID, c AS crew_name, count(DISTINCT day) AS n_days, min(day) AS first_day, max(day) AS last_day
        FROM (SELECT v, c, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS day FROM busy WHERE v IS NOT NULL) GROUP BY 1, 2"""),
    "first_slot": ("free", """SELECT JobID, "offset", slot_start, slot_end, VendorID, crew_name FROM (
        SELECT JobID, "offset", slot_start, slot_end, r.VendorID, r.crew_name,
          row_number() OVER (PARTITION BY JobID ORDER BY "offset", "rank") AS rn
        FROM free f JOIN ranked r ON """ + SAME_POOL.format("r") + """
          AND slot_start >= ValidFrom AND slot_end <= ValidUntil) WHERE rn = 1"""),
    "crew_capacity": ("capacity", "SELECT * FROM capacity"),
    "vendor_capacity_matrix": ("capacity", "SELECT day, " + ", ".join(
        f"CAST(sum(capacity) FILTER (VendorID = 'V{i}') AS BIGINT) AS V{i}" for i in range(5))
        + " FROM capacity JOIN (SELECT DISTINCT crew_name, VendorID FROM crews) USING (crew_name) GROUP BY 1"),
    "coded_overlay": ("triaged", """SELECT JobID AS WpId, '#' AS VendorId, '#' AS CrewId, '#' AS PlannedStartDate,
        refresh_date AS RefreshDate, ResourceStatus, JobDuration FROM triaged WHERE ResourceStatus IS NOT NULL"""),
    "placement_audit": ("placed_near", """SELECT 'jobs' AS stage, count(*) AS n_rows FROM triaged
        UNION ALL SELECT 'placed jobs', count(*) FROM @HELD WHERE phase > 1
        UNION ALL SELECT 'jobs without status', count(*) FROM triaged t LEFT JOIN placed_near p ON p.JobID = t.JobID
          WHERE coalesce(p.status, t.ResourceStatus) IS NULL
        UNION ALL SELECT 'placements on a wrong crew', count(*) FROM @HELD WHERE phase > 1 AND NOT EXISTS (SELECT 1 FROM crews k
          WHERE k.Market = h.Market AND k.VendorID = h.v AND k.crew_name = h.c AND (h.VendorBooked IS NULL OR h.VendorBooked = k.VendorID)
          AND list_has_all(k.have, h.need) AND a >= ValidFrom AND b <= ValidUntil)
        UNION ALL SELECT 'placements on a locked day', count(*) FROM @HELD WHERE phase > 1 AND EXISTS (SELECT 1 FROM locks l
          WHERE l.customer_id = h.customer_id AND l.SiteCode = h.SiteCode AND l.day BETWEEN h.a AND h.b)
        UNION ALL SELECT 'crews booked twice', count(*) FROM (
          SELECT b + 2 AS free, lead(a) OVER (PARTITION BY v, c ORDER BY a) AS ahead FROM @HELD) WHERE ahead <= free""".replace(
        "@HELD", """(SELECT t.*, CASE WHEN phase = 1 THEN LockVendor ELSE vendor END AS v,
          CASE WHEN phase = 1 THEN CrewIdBooked ELSE crew END AS c, coalesce(p.start, t.JobStart) AS a, e.day AS b
          FROM triaged t JOIN placed_near p ON p.JobID = t.JobID AND p.status = 0
          JOIN calendar d ON d.day = coalesce(p.start, t.JobStart) JOIN workdays e ON e.ord = d.ord + t.JobDuration + 1) h""")),
    "predictions_to_jobs": ("jobs_raw", """SELECT JobID, CASE WHEN JobDurationML IS NOT NULL THEN m END AS JobDurationML
        FROM jobs_raw LEFT JOIN (SELECT Market, round(avg(JobDurationML), 6) AS m FROM jobs_raw GROUP BY 1) USING (Market)"""),
    "predictions_by_day": ("construction", """SELECT CAST(year(refresh_date) AS INT) AS "year",
        CAST(month(refresh_date) AS INT) AS "month", CAST(day(refresh_date) AS INT) AS "day", count(*) AS n_rows,
        min(id) AS first_id FROM base GROUP BY 1, 2, 3"""),
    "published_table": ("construction", """SELECT CAST(year(refresh_date) AS INT) AS "year", CAST(month(refresh_date) AS INT) AS "month",
        CAST(day(refresh_date) AS INT) AS "day", market, count(*) AS n_rows FROM base GROUP BY 1, 2, 3, 4"""),
    "overlay_file": ("triaged", """SELECT CAST(ResourceStatus AS VARCHAR) AS ResourceStatus, '#' AS VendorId,
        count(*) AS n_rows FROM triaged WHERE ResourceStatus IS NOT NULL GROUP BY 1"""),
    "published_versions": ("construction", """SELECT CAST(year(refresh_date) AS INT) AS "year", CAST(month(refresh_date) AS INT) AS "month",
          CAST(day(refresh_date) AS INT) AS "day", count(*) AS n_rows,
          CAST(sum(civil_end - civil_start + CASE WHEN day(refresh_date) % 3 = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS days, min(id) AS first_id
        FROM base WHERE day(refresh_date) % 3 = 0 OR month(refresh_date) <= 6 GROUP BY 1, 2, 3"""),
    "newest_of_drops": ("jobs_raw", """SELECT JobID, customer_id, JobDurationML + CASE WHEN k % 3 < 2 THEN 1 WHEN k % 2 = 0 THEN 2 ELSE 0 END AS JobDurationML,
          DATE '1998-06-01' - CASE WHEN k % 3 < 2 THEN 0 WHEN k % 2 = 0 THEN 1 ELSE 2 END AS refresh_date
        FROM (SELECT *, CAST(JobID AS BIGINT) AS k FROM jobs_raw)"""),
    "construction_csv": ("construction", "SELECT id, market, civil_start, tower_end, latitude FROM construction"),
    "planner_files": ("jobs_raw crews events", """SELECT 'jobs' AS stage, count(*) AS n_rows FROM jobs_raw
        UNION ALL SELECT 'crews', count(*) FROM crews_raw UNION ALL SELECT 'events', count(*) FROM special
        UNION ALL SELECT 'weather', count(*) FROM event_sites WHERE event_type = 'error'"""),
    "holidays_of_country": ("", """SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders
        WHERE day(CAST(o_orderdate AS DATE)) IN (1, 15) AND year(CAST(o_orderdate AS DATE)) BETWEEN 1993 AND 1996"""),
    "holiday_offset": ("calendar", """SELECT o_orderkey, created, w.day AS due
        FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS created FROM orders)
        JOIN (SELECT day, CAST(sum(o) OVER (ORDER BY day) - o AS INT) AS ord FROM open_days) c ON c.day = created
        JOIN (SELECT day, row_number() OVER (ORDER BY day) - 1 AS ord FROM open_days WHERE o = 1) w
          ON w.ord = c.ord + o_orderkey % 15"""),
    "archived_files": ("construction", "SELECT id, market, civil_start FROM construction"),
    "latest_planner_files": ("jobs_raw crews events", """SELECT 'jobs' AS stage, JobID AS key, customer_id || '|' || SiteCode || '|' || Market
          || '|' || JobCreateDate || '|' || coalesce(CAST(JobStartDateForecast AS VARCHAR), '') AS row FROM jobs_raw
        UNION ALL SELECT 'crews', crew_name, VendorID || '|' || Market || '|' || coalesce(CAST(ValidFrom AS VARCHAR), '') || '|' || ValidUntil
          || '|' || Skills1 FROM crews_raw
        UNION ALL SELECT 'events', coalesce(x_customer, ''), coalesce(x_site, '') || '|' || coalesce(x_market, '') || '|'
          || coalesce(x_region, '') || '|' || a || '|' || b FROM special
        UNION ALL SELECT 'weather', customer_id, SiteCode || '|' || CAST(DATE '1998-06-01' + (d - 1) * 3 + CAST(event_id % 3 AS INT) AS DATE)
          FROM event_sites WHERE event_type = 'error'"""),
    "ingest_drops": ("jobs", "SELECT JobID, Market, JobCreateDate, CrewIdBooked, JobDurationML FROM jobs"),
}


#: The split of one category's codes that lowers the squared error most, of each fold's training rows.
ONE_SPLIT = """SELECT r.fold, round(avg(abs(label - CASE WHEN region = g THEN m1 ELSE m0 END)), 6) AS mae
  FROM (SELECT c.fold, g, s / n AS m1, (all_s - s) / (all_n - n) AS m0,
      row_number() OVER (PARTITION BY c.fold ORDER BY s * s / n + (all_s - s) * (all_s - s) / (all_n - n) DESC) AS nth
    FROM (SELECT f.fold, region AS g, count(*)::DOUBLE AS n, sum(label)::DOUBLE AS s,
        sum(count(*)::DOUBLE) OVER (PARTITION BY f.fold) AS all_n, sum(sum(label)::DOUBLE) OVER (PARTITION BY f.fold) AS all_s
      FROM (SELECT DISTINCT fold FROM folded) f JOIN folded r ON r.fold <> f.fold GROUP BY 1, 2) c) b
    JOIN folded r ON r.fold = b.fold WHERE nth = 1 GROUP BY 1"""

#: The business calendar without the holidays of one country.
HOLIDAY_CALENDAR = """
days AS (SELECT CAST(unnest(generate_series(DATE '1990-01-01', DATE '2010-12-31', INTERVAL 1 DAY)) AS DATE) AS day),
open_days AS (
  SELECT day, CAST(isodow(day) <= 5 AND NOT (day(day) IN (1, 15)
    AND day IN (SELECT CAST(o_orderdate AS DATE) FROM orders)) AS INT) AS o FROM days
),
calendar AS (SELECT day, o = 1 AS is_business, CAST(sum(o) OVER (ORDER BY day) - o AS INT) AS ord FROM open_days),
workdays AS (SELECT day, ord FROM calendar WHERE is_business)"""

#: Planner jobs whose predicted duration is the mean label of their market.
PREDICTED_JOBS = JOBS_RAW.strip().replace("jobs_raw AS (", "jobs_given AS (") + """,
jobs_raw AS (
  SELECT g.* REPLACE (round(coalesce(m, w), 6) AS JobDurationML) FROM jobs_given g
    LEFT JOIN (SELECT market AS mk, avg(label) AS m FROM training GROUP BY 1) ON mk = Market,
    (SELECT avg(label) AS w FROM training)
)"""


def sql() -> dict[str, str]:
    found = {name: with_blocks(blocks, select) for name, (blocks, select) in QUERIES.items()}
    placed = with_blocks("construction placed", _overlay("placed", False))
    found |= dict.fromkeys(("cv_forest_of_one_split", "cv_boosting_of_one_split"), with_blocks("folded", ONE_SPLIT))
    found["allocate_with_holidays"] = placed.replace(CALENDAR.strip(), HOLIDAY_CALENDAR.strip())
    found["allocate_predicted"] = placed.replace(JOBS_RAW.strip(), PREDICTED_JOBS)
    return found
