"""Input and output schemas, with fixed column names and types."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(**columns: str) -> T.StructType:
    kinds = {
        "string": T.StringType(),
        "date": T.DateType(),
        "double": T.DoubleType(),
        "int": T.IntegerType(),
    }
    return T.StructType([T.StructField(name, kinds[kind]) for name, kind in columns.items()])


CONSTRUCTION = _schema(
    refresh_date="date",
    id="string",
    region="string",
    market="string",
    package_name="string",
    site="string",
    civil_start="date",
    civil_end="date",
    tower_start="date",
    tower_end="date",
    customer="string",
    latitude="double",
    longitude="double",
    project_name="string",
    site_type="string",
    plan_type="string",
    site_class="string",
    configuration="string",
)

# The planner files carry dates as text; see operators.clean.parse_dates.
JOB_SITE = _schema(
    JobID="string",
    customer_id="string",
    SiteCode="string",
    Latitude="double",
    Longitude="double",
    Market="string",
    Skills="string",
    VendorBooked="string",
    CrewIdBooked="string",
    Priority="int",
    JobCreateDate="string",
    JobStartDateForecast="string",
    JobEndDateForecast="string",
    JobStartDateActual="string",
    JobEndDateActual="string",
    SiteReadinessForecast="string",
    JobDurationML="double",
    JobStartMaxOffset="int",
    refresh_date="string",
)
JOB_SITE_DATES = (
    "JobCreateDate",
    "JobStartDateForecast",
    "JobEndDateForecast",
    "JobStartDateActual",
    "JobEndDateActual",
    "SiteReadinessForecast",
    "refresh_date",
)

VENDOR_CREW = _schema(
    VendorID="string",
    crew_name="string",
    Market="string",
    region="string",
    ValidFrom="string",
    ValidUntil="string",
    Score="double",
    Skills1="string",
)
VENDOR_CREW_DATES = ("ValidFrom", "ValidUntil")

EVENTS = _schema(
    CustomerID="string",
    SiteCode="string",
    Market="string",
    Region="string",
    ValidFrom="string",
    ValidUntil="string",
)
EVENT_DATES = ("ValidFrom", "ValidUntil")

WEATHER = _schema(CustomerID="string", SiteID="string", Date="string")
WEATHER_DATES = ("Date",)

HOLIDAYS = _schema(country="string", day="date")

FORECAST_DROPPED = ("configuration", "plan_type", "site_type", "site_class")
