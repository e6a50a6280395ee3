"""Crew allocation from cleaned inputs to the overlay."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crewcast.operators.clean import clean_crews, clean_events, clean_jobs, parse_dates
from crewcast.operators.locks import site_locks
from crewcast.operators.matching import add_region, count_qualified, with_have, with_need
from crewcast.operators.overlay import text_overlay, typed_overlay, with_placements
from crewcast.operators.placement import place_jobs
from crewcast.operators.triage import fill_defaults, known_crew, triage
from crewcast.params import Params
from crewcast.session import materialise


@dataclass(frozen=True)
class Inputs:
    jobs: DataFrame
    crews: DataFrame
    events: DataFrame
    weather: DataFrame
    holidays: DataFrame | None = None

    def __post_init__(self) -> None:
        missing = [n for n in ("jobs", "crews", "events", "weather") if getattr(self, n) is None]
        if missing:
            raise ValueError(f"missing input tables: {', '.join(missing)}")


def prepared_crews(crews: DataFrame) -> DataFrame:
    return with_have(clean_crews(crews))


def triaged_jobs(jobs: DataFrame, crews: DataFrame, params: Params) -> DataFrame:
    """Cleaned jobs with filled columns, qualified crew count, status code and phase."""
    cleaned = add_region(with_need(clean_jobs(jobs, params)), crews)
    # read twice below, for the pools and for the rows
    filled = materialise(fill_defaults(cleaned, params), "filled")
    return triage(known_crew(count_qualified(filled, crews), crews), params)


def to_place(jobs: DataFrame) -> DataFrame:
    """The triaged jobs that are still to be placed: only their sites need locks."""
    return jobs.where(F.col("phase").isNotNull())


def allocate(inputs: Inputs, params: Params) -> DataFrame:
    """Every open job with its status, crew and planned start."""
    crews = materialise(prepared_crews(inputs.crews), "crews")
    jobs = materialise(triaged_jobs(inputs.jobs, crews, params), "triaged")
    weather = parse_dates(inputs.weather, ["Date"])
    locks = site_locks(to_place(jobs), clean_events(inputs.events), weather, params)
    placed = place_jobs(jobs, crews, locks, params, inputs.holidays)
    return with_placements(jobs, placed)


def allocation_overlay(inputs: Inputs, params: Params) -> DataFrame:
    return text_overlay(typed_overlay(allocate(inputs, params)))
