"""Named queries over the driver's tables, one per operator."""

from __future__ import annotations

import dataclasses
import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from crewcast import schemas, views
from crewcast.functions.dates import add_business_days, business_calendar, day_range, select_holidays
from crewcast.operators import capacity, clean, features, locks, matching, neighbours, overlay, slots, triage
from crewcast.operators.joins import join_null_safe
from crewcast.params import Params
from crewcast.plans import forecast, moments
from crewcast.plans.allocation import Inputs, allocate, allocation_overlay, prepared_crews, to_place, triaged_jobs
from crewcast.session import materialise, scratch_path
from crewcast.sources.readers import load_model, read_csv, read_holidays, read_planner_inputs
from crewcast.sources.writers import (
    archive,
    drop_files,
    publish_days,
    publish_table,
    publish_view,
    read_whole,
    save_model,
    write_csv,
    write_named_csv,
    write_overlay,
    write_predictions,
)
from crewcast.streaming.drops import drop_stream, latest_rows, newest_rows, run_on_drops, table_handler

PARAMS = Params(placeholder_crew="No real crew")
NEAR_KM = 3.0
NEAR = dataclasses.replace(PARAMS, site_distance_min=NEAR_KM)
WINDOWED = dataclasses.replace(NEAR, window_jobs=40)
CAPACITY_DAYS = (dt.date(1998, 6, 1), dt.date(1998, 6, 30))

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _crews(spark, folder) -> DataFrame:
    return prepared_crews(views.crews(spark, folder, PARAMS))


def _cleaned(spark, folder) -> DataFrame:
    return clean.clean_jobs(views.jobs(spark, folder, PARAMS), PARAMS)


def _needing(spark, folder) -> DataFrame:
    return matching.with_need(_cleaned(spark, folder))


def _filled(spark, folder) -> DataFrame:
    return triage.fill_defaults(_cleaned(spark, folder), PARAMS)


def _triaged(spark, folder, crews=None) -> DataFrame:
    crews = materialise(_crews(spark, folder), "crews") if crews is None else crews
    return triaged_jobs(views.jobs(spark, folder, PARAMS), crews, PARAMS)


def _regional(spark, folder) -> DataFrame:
    return matching.add_region(_cleaned(spark, folder), _crews(spark, folder))


def _events(spark, folder) -> DataFrame:
    return clean.clean_events(views.events(spark, folder, PARAMS))


def _locks(spark, folder, jobs=None) -> DataFrame:
    jobs = _regional(spark, folder) if jobs is None else jobs
    return locks.site_locks(jobs, _events(spark, folder), views.weather(spark, folder, PARAMS), PARAMS)


# cleaning


@query
def clean_jobs(spark, folder):
    return _cleaned(spark, folder).select(
        "JobID", "customer_id", "Market", "VendorBooked", "CrewIdBooked", "JobCreateDate", "SiteReadinessForecast"
    )


@query
def clean_crews(spark, folder):
    return _crews(spark, folder).select("VendorID", "crew_name", "Market", "Region", "ValidFrom", "ValidUntil", "have_key")


@query
def parse_dates(spark, folder):
    key = F.col("o_orderkey")
    text = (
        F.when(key % 17 == 0, "n/a")
        .when(key % 19 == 0, "1998-02-30")
        .when(key % 23 == 0, "")
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    )
    raw = views.table(spark, folder, "orders").select("o_orderkey", text.alias("created"))
    return clean.parse_dates(raw, ["created"])


@query
def dedupe_latest(spark, folder):
    lines = views.table(spark, folder, "lineitem").withColumn("shipped", F.to_date("l_shipdate")).drop("l_shipdate")
    return clean.latest_per_key(lines, ["l_orderkey"], "shipped")


@query
def filter_and_sort(spark, folder):
    jobs = _filled(spark, folder)
    picked = clean.filter_and_sort(
        jobs, F.col("CrewIdBooked").isNotNull(), ["Priority", "SiteReadinessForecast", "JobStart", "JobCreateDate", "JobID"]
    )
    return picked.select("JobID", "Priority", "SiteReadinessForecast", "JobStart", "JobCreateDate")


@query
def stage_counts(spark, folder):
    """Rows and columns of the inputs and of what cleaning keeps, and the markets that events name: counted on the way."""
    counts = clean.StageCounts()
    raw = counts.watch("raw jobs", views.jobs(spark, folder, PARAMS))
    kept = counts.watch("clean jobs", clean.clean_jobs(raw, PARAMS))
    crews = counts.watch("clean crews", _crews(spark, folder))
    events = counts.watch("clean events", _events(spark, folder), F.collect_set("Market").alias("markets"))
    for name, df in {"jobs": kept, "crews": crews, "events": events}.items():
        materialise(df, f"clean-{name}")
    markets = [("event markets", len(counts.figures("clean events")["markets"]), 1)]
    found = counts.table(spark)
    return found.unionByName(spark.createDataFrame(markets, found.schema))


# forecasting


@query
def duration_label(spark, folder):
    return features.add_label(features.base_features(views.construction(spark, folder))).select("id", "label")


@query
def quantiles_by_group(spark, folder):
    return features.group_quantiles(views.table(spark, folder, "events"), "value", "event_type")


@query
def outlier_fences(spark, folder):
    rows = views.table(spark, folder, "events").select("event_id", "event_type", "value")
    return features.within_fences(rows, "value", "event_type")


@query
def sketched_quartiles(spark, folder):
    """Quartiles from daily sketches: the last day's is added to those stored, and no old row is read again."""
    rows = views.table(spark, folder, "events")
    day = F.to_date("ts")
    last = rows.agg(F.max(day).alias("d")).first()["d"]
    path = scratch_path(spark, "sketches")
    for part in (rows.where(day < F.lit(last)), rows.where(day == F.lit(last))):
        features.day_sketches(part, "value", "event_type", day).write.mode("append").parquet(path)
    found = features.sketched_quantiles(spark.read.parquet(path), "event_type")
    named = rows.join(found.select(F.col("event_type").alias("_g"), "n_rows", "q1", "q3"), F.col("event_type") == F.col("_g"))
    below = [F.avg(F.when(F.col("value") <= F.col(q), 1.0).otherwise(0.0)) for q in ("q1", "q3")]
    near = [(F.abs(share - wanted) < 0.02).alias(f"{q}_near") for share, wanted, q in zip(below, (0.25, 0.75), ("q1", "q3"))]
    return named.groupBy("event_type").agg(F.max("n_rows").alias("n_rows"), *near)


@query
def training_rows(spark, folder):
    rows = features.training_rows(views.construction(spark, folder), PARAMS)
    return rows.select("id", "region", "market", "package_name", "latitude", "longitude", "label")


@query
def scoring_rows(spark, folder):
    return features.scoring_rows(views.construction(spark, folder)).select("id", "region", "market", "site", "customer")


@query
def mae_by_group(spark, folder):
    rows = materialise(features.training_rows(views.construction(spark, folder), PARAMS), "training")
    rows = forecast.group_mean_prediction(rows, "market")
    scored = forecast.mean_absolute_error(rows, "prediction", "label", "market")
    return scored.select("market", F.round("mae", 6).alias("mae"))


def _trained(spark, folder, model):
    params = dataclasses.replace(PARAMS, model=model)
    rows = features.training_rows(views.construction(spark, folder), params)
    return forecast.train(rows, params), params


def _metrics(spark, folder, model):
    """Errors of the model's whole grid over all folds."""
    fitted, _ = _trained(spark, folder, model)
    return forecast.fold_metrics(fitted, views.table(spark, folder, "region"))


@query
def fold_sizes(spark, folder):
    """Rows and labels of each cross-validation fold."""
    rows = moments.folded(features.training_rows(views.construction(spark, folder), PARAMS), PARAMS)
    return rows.groupBy(F.col(moments.FOLD).alias("fold")).agg(F.count("*").alias("n_rows"), F.sum("label").alias("days"))


@query
def code_correlations(spark, folder):
    """Standardised codes: correlation of each pair of category values, from sums of pairs."""
    rows = moments.folded(features.training_rows(views.construction(spark, folder), PARAMS), PARAMS)
    return moments.correlations(moments.cells(rows, PARAMS), PARAMS).select(
        "name_a", "value_a", "name_b", "value_b", "n_rows", F.round("correlation", 9).alias("correlation")
    )


def _numbers_only(*names):
    return dataclasses.replace(PARAMS, model="elastic_net", categorical_cols=(), numerical_cols=names, use_numeric=True)


def _point_errors(spark, folder, params, grid):
    rows = features.training_rows(views.construction(spark, folder), PARAMS)
    return forecast.point_errors(forecast.train(rows, params, {"k": [None]} | grid), views.table(spark, folder, "region"))


@query
def cv_ridge_two_numbers(spark, folder):
    """Errors by fold of ridge regressions on the site's coordinates."""
    found = _point_errors(spark, folder, _numbers_only("latitude", "longitude"), {"elasticNetParam": [0.0]})
    return found.select("fold", "regParam", F.round("mae", 6).alias("mae"))


@query
def cv_elastic_net_one_number(spark, folder):
    """Errors by fold of every elastic net of the grid on one coordinate; stronger ones, too, that leave nothing of it."""
    grid = {"regParam": [0.1, 0.3, 5.0], "elasticNetParam": forecast.GRIDS["elastic_net"]["elasticNetParam"]}
    found = _point_errors(spark, folder, _numbers_only("latitude"), grid)
    return found.select("fold", "regParam", "elasticNetParam", F.round("mae", 6).alias("mae"))


def _stump_errors(spark, folder, model, grid):
    params = dataclasses.replace(PARAMS, model=model, categorical_cols=("region",))
    rows = features.training_rows(views.construction(spark, folder), PARAMS)
    found = forecast.point_errors(forecast.train(rows, params, grid), views.table(spark, folder, "region"))
    return found.select("fold", F.round("mae", 6).alias("mae"))


@query
def cv_forest_of_one_split(spark, folder):
    """Errors by fold of a forest of one tree with one split, on the codes of one category; all rows grow it."""
    return _stump_errors(spark, folder, "random_forest", {"maxDepth": [1], "numTrees": [1], "bootstrap": [False]})


@query
def cv_boosting_of_one_split(spark, folder):
    """Errors by fold of one boosting step with one split, which is the same tree."""
    return _stump_errors(spark, folder, "gradient_boosting", {"maxDepth": [1], "maxIter": [1]})


@query
def saved_group_means(spark, folder):
    """Open rows scored by a saved and reloaded model, the mean of the work package."""
    base = features.scoring_rows(views.construction(spark, folder))
    # joined once for training and scoring, in the columns that these read
    base = materialise(base.select("id", *PARAMS.categorical_cols, *PARAMS.numerical_cols, "refresh_date", "civil_start", "tower_end"), "records")
    path = scratch_path(spark, "model")
    save_model(forecast.group_mean_model(features.training_rows_of(base, PARAMS), "package_name"), path)
    scored = forecast.score(load_model(path), base, PARAMS)
    return scored.select("JobID", "region", "market", "package_name", "refresh_date", F.round("JobDurationML", 6).alias("JobDurationML"))


@query
def cv_elastic_net(spark, folder):
    return _metrics(spark, folder, "elastic_net")


@query
def cv_decision_tree(spark, folder):
    return _metrics(spark, folder, "decision_tree")


@query
def cv_random_forest(spark, folder):
    return _metrics(spark, folder, "random_forest")


@query
def cv_gradient_boosting(spark, folder):
    return _metrics(spark, folder, "gradient_boosting")


@query
def train_score(spark, folder):
    """Open rows scored by the saved and reloaded best model."""
    fitted, params = _trained(spark, folder, "random_forest")
    path = scratch_path(spark, "model")
    save_model(fitted, path)
    return forecast.score(load_model(path), features.scoring_rows(views.construction(spark, folder)), params)


# job defaults and triage


@query
def job_start(spark, folder):
    return _filled(spark, folder).select("JobID", "JobStart")


@query
def job_duration(spark, folder):
    return _filled(spark, folder).select("JobID", "JobDuration")


@query
def job_defaults(spark, folder):
    return _filled(spark, folder).select("JobID", "Priority", "JobStartMaxOffset")


@query
def booked_crew_unknown(spark, folder):
    return triage.unknown_booked_crew(_cleaned(spark, folder), _crews(spark, folder)).select("JobID", "CrewIdBooked")


@query
def lock_vendor(spark, folder):
    return triage.known_crew(_cleaned(spark, folder), _crews(spark, folder)).select("JobID", "CrewKnown", "LockVendor")


@query
def triage_codes(spark, folder):
    jobs = overlay.labelled(_triaged(spark, folder), PARAMS)
    return jobs.select("JobID", "ResourceStatus", "StatusLabel", "phase")


@query
def phase_split(spark, folder):
    return _triaged(spark, folder).groupBy("phase").agg(
        F.count("*").alias("n_jobs"), F.sum("JobDuration").alias("days"), F.min("JobStart").alias("first_start")
    )


# qualification


@query
def market_match(spark, folder):
    """Crews in each job's market."""
    return matching.crews_in_market(_cleaned(spark, folder), _crews(spark, folder))


@query
def vendor_match(spark, folder):
    """Crews of each job's market that its booked vendor, if any, allows."""
    return matching.crews_of_vendor(_cleaned(spark, folder), _crews(spark, folder))


@query
def skill_match(spark, folder):
    """Required and held skill sets that fit together, per market."""
    classes = matching.crew_classes(_crews(spark, folder))
    return matching.skill_pairs(matching.pools_of(_needing(spark, folder)), classes)


@query
def qualified_counts(spark, folder):
    jobs, crews = materialise(_needing(spark, folder), "jobs"), materialise(_crews(spark, folder), "crews")
    return matching.count_qualified(jobs, crews).select("JobID", "CountQualified")


@query
def qualified_crews(spark, folder):
    listed = matching.qualified_crews(_needing(spark, folder), materialise(_crews(spark, folder), "crews"))
    return listed.select(*matching.POOL, "rank", "VendorID", "crew_name", "Score", "ValidFrom", "ValidUntil")


@query
def qualified_per_job(spark, folder):
    """Crew list of every job, summarised: its length and its first and last entry."""
    jobs, crews = materialise(_needing(spark, folder), "jobs"), materialise(_crews(spark, folder), "crews")
    return matching.crew_list_ends(jobs, crews)


@query
def best_crew(spark, folder):
    jobs, crews = materialise(_needing(spark, folder), "jobs"), materialise(_crews(spark, folder), "crews")
    return matching.best_crew(jobs, crews)


@query
def market_region(spark, folder):
    return _regional(spark, folder).select("JobID", "Market", "Region")


@query
def vendor_lookup(spark, folder):
    key = F.col("JobID").cast("long")
    worker = F.when(key % 7 == 0, PARAMS.resource_shortage_msg).when(key % 11 == 0, F.col("CrewIdBooked"))
    jobs = views.jobs(spark, folder, PARAMS).select("JobID", worker.alias("RecommendedWorker"))
    return matching.add_recommended_vendor(jobs, _crews(spark, folder), PARAMS.resource_shortage_msg).select(
        "JobID", "RecommendedWorker", "RecommendedVendor"
    )


# locks and calendar


@query
def weather_locks(spark, folder):
    return locks.weather_locks(views.weather(spark, folder, PARAMS))


@query
def event_days(spark, folder):
    return locks.event_days(_events(spark, folder), PARAMS)


@query
def event_lock_days(spark, folder):
    return locks.event_locks(_regional(spark, folder), _events(spark, folder), PARAMS)


@query
def site_lock_sets(spark, folder):
    sets = locks.lock_sets(_locks(spark, folder))
    return sets.select(*locks.SITE, F.concat_ws(",", F.transform("locked_days", lambda d: d.cast("string"))).alias("locked_days"))


@query
def business_calendar_load(spark, folder):
    """Orders per day with the day's business number."""
    calendar = business_calendar(spark, PARAMS)
    per_day = views.table(spark, folder, "orders").groupBy(F.to_date("o_orderdate").alias("day"))
    return per_day.agg(F.count("*").alias("n_orders")).join(F.broadcast(calendar), "day")


@query
def business_offset(spark, folder):
    orders = views.table(spark, folder, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("created"))
    return add_business_days(
        orders, "created", (F.col("o_orderkey") % 15).cast("int"), "due", business_calendar(spark, PARAMS)
    )


@query
def forecast_days(spark, folder):
    """Jobs under way per calendar day."""
    spans = _cleaned(spark, folder).select("JobStartDateForecast", "JobEndDateForecast")
    return day_range(spans, "JobStartDateForecast", "JobEndDateForecast").groupBy("day").agg(F.count("*").alias("n_jobs"))


@query
def site_distance(spark, folder):
    located = neighbours.located_sites(views.jobs(spark, folder, PARAMS))
    return neighbours.distance_to(located, 10.0, 20.0).select("customer_id", "SiteCode", F.round("km", 6).alias("km"))


@query
def near_sites(spark, folder):
    located = neighbours.located_sites(views.jobs(spark, folder, PARAMS))
    return neighbours.near_sites(located, NEAR_KM).withColumn("km", F.round("km", 6))


# slots and capacity


@query
def candidate_slots(spark, folder):
    found = slots.candidate_slots(_triaged(spark, folder), business_calendar(spark, PARAMS), PARAMS)
    return found.select("JobID", "offset", "slot_start", "slot_end")


@query
def site_free_slots(spark, folder):
    jobs = materialise(_triaged(spark, folder), "triaged")
    found = slots.site_free_slots(jobs, _locks(spark, folder, to_place(jobs)), business_calendar(spark, PARAMS), PARAMS)
    return found.select("JobID", "offset", "slot_start", "slot_end")


@query
def crew_free_slots(spark, folder):
    """Crews free in each pool's slots: valid, and not kept by a booked job."""
    crews, calendar = materialise(_crews(spark, folder), "crews"), business_calendar(spark, PARAMS)
    jobs = materialise(_triaged(spark, folder, crews), "triaged")
    found = slots.candidate_slots(jobs, calendar, PARAMS)
    return slots.crew_options(found, crews, slots.busy_spans(jobs, calendar, PARAMS), PARAMS)


@query
def valid_crew_slots(spark, folder):
    """Crews valid in each pool's slots, whether booked or not."""
    crews = materialise(_crews(spark, folder), "crews")
    found = slots.candidate_slots(_triaged(spark, folder, crews), business_calendar(spark, PARAMS), PARAMS)
    return slots.crew_options(found, crews)


@query
def busy_crew_days(spark, folder):
    """Days on which booked jobs keep each crew."""
    jobs = materialise(_triaged(spark, folder), "triaged")
    spans = slots.busy_spans(jobs, business_calendar(spark, PARAMS), PARAMS)
    days = day_range(spans, "busy_from", "busy_to").groupBy("VendorID", "crew_name")
    return days.agg(F.count_distinct("day").alias("n_days"), F.min("day").alias("first_day"), F.max("day").alias("last_day"))


@query
def first_slot(spark, folder):
    crews = materialise(_crews(spark, folder), "crews")
    jobs = materialise(_triaged(spark, folder, crews), "triaged")
    return slots.first_slot(
        jobs, crews, _locks(spark, folder, to_place(jobs)), business_calendar(spark, PARAMS), PARAMS
    )


@query
def crew_capacity(spark, folder):
    return capacity.crew_capacity(_crews(spark, folder), _filled(spark, folder), *CAPACITY_DAYS, PARAMS)


@query
def vendor_capacity_matrix(spark, folder):
    """Bookings per day and vendor, pivoted."""
    long = capacity.crew_capacity(_crews(spark, folder), _filled(spark, folder), *CAPACITY_DAYS, PARAMS)
    vendors = materialise(_crews(spark, folder).select("crew_name", "VendorID").distinct(), "vendors")
    named = long.join(vendors, "crew_name").select("day", F.col("VendorID").alias("crew_name"), "capacity")
    return capacity.capacity_matrix(named, capacity.column_names(vendors, "VendorID"))


# allocation


@query
def allocate_jobs(spark, folder):
    placed = allocate(views.inputs(spark, folder, PARAMS), PARAMS)
    return overlay.typed_overlay(placed)


@query
def allocate_with_neighbours(spark, folder):
    """Placements also lock the customer's sites nearby."""
    return overlay.typed_overlay(allocate(views.inputs(spark, folder, NEAR), NEAR))


@query
def allocate_in_windows(spark, folder):
    """The same result with small windows."""
    return overlay.typed_overlay(allocate(views.inputs(spark, folder, WINDOWED), WINDOWED))


@query
def allocation_text(spark, folder):
    return allocation_overlay(views.inputs(spark, folder, PARAMS), PARAMS)


@query
def allocate_with_holidays(spark, folder):
    """Placements that also pass over the holidays of a country."""
    params = dataclasses.replace(PARAMS, country_code="AA")
    inputs = dataclasses.replace(views.inputs(spark, folder, params), holidays=materialise(_holidays(spark, folder), "holidays"))
    return overlay.typed_overlay(allocate(inputs, params))


@query
def allocate_predicted(spark, folder):
    """The whole way: a model trained on construction records, saved and reloaded, scores the planner's jobs, which are then placed."""
    rows = features.training_rows(views.construction(spark, folder), PARAMS)
    path = scratch_path(spark, "model")
    save_model(forecast.group_mean_model(rows, "market"), path)
    jobs, none = materialise(views.jobs(spark, folder, PARAMS), "jobs"), F.lit(None).cast("string")
    to_score = jobs.select(
        F.col("JobID").alias("id"), none.alias("region"), F.upper("Market").alias("market"), none.alias("package_name"),
        F.col("Latitude").alias("latitude"), F.col("Longitude").alias("longitude"), "refresh_date",
    )
    scored = forecast.score(load_model(path), to_score, PARAMS).withColumn("JobDurationML", F.round("JobDurationML", 6))
    inputs = dataclasses.replace(views.inputs(spark, folder, PARAMS), jobs=overlay.with_predictions(jobs, scored))
    return overlay.typed_overlay(allocate(inputs, PARAMS))


@query
def coded_overlay(spark, folder):
    """The overlay rows that triage settles alone."""
    jobs = _triaged(spark, folder).where("ResourceStatus is not null")
    none = F.lit(None)
    jobs = jobs.withColumns(
        {
            "RecommendedVendor": none.cast("string"),
            "RecommendedWorker": none.cast("string"),
            "PlannedJobStart": none.cast("date"),
        }
    )
    return overlay.text_overlay(overlay.typed_overlay(jobs))


@query
def placement_audit(spark, folder):
    """Number of jobs, and rule breaks of the placements over their whole length, of which there must be none."""
    jobs = materialise(allocate(views.inputs(spark, folder, NEAR), NEAR), "placed")
    crews = materialise(_crews(spark, folder), "crews")
    calendar = business_calendar(spark, NEAR)
    start = F.when(F.col("phase") == 1, F.col("JobStart")).otherwise(F.col("PlannedJobStart"))
    held = jobs.where("ResourceStatus = 0").withColumn("slot_start", start)
    held = add_business_days(held, "slot_start", F.col("JobDuration") + NEAR.job_buffer, "slot_end", calendar)
    placed = held.where("PlannedJobStart is not null")
    fits = matching.pool_matches(
        matching.pools_of(placed), matching.crew_classes(crews),
        crews.select("Market", "VendorID", "have_key", "crew_name", "ValidFrom", "ValidUntil"),
    )
    fits = fits.where("VendorBooked is null or VendorBooked = VendorID").withColumnsRenamed(
        {"VendorID": "RecommendedVendor", "crew_name": "RecommendedWorker"}
    )
    listed = join_null_safe(placed, fits, [*matching.POOL, "RecommendedVendor", "RecommendedWorker"])
    listed = listed.where("slot_start >= ValidFrom and slot_end <= ValidUntil")
    vendor, crew = (F.when(F.col("phase") == 1, F.col(b)).otherwise(F.col(p)) for b, p in (("LockVendor", "RecommendedVendor"), ("CrewIdBooked", "RecommendedWorker")))
    busy = held.select("JobID", vendor.alias("v"), crew.alias("c"), "slot_start", F.date_add("slot_end", NEAR.job_downtime).alias("free"))
    ahead = F.lead("slot_start").over(Window.partitionBy("v", "c").orderBy("slot_start"))
    locked = placed.join(locks.lock_sets(_locks(spark, folder, to_place(jobs))), list(locks.SITE)).where(
        locks.meets_lock(F.col("slot_start"), F.col("slot_end"))
    )
    checks = {
        "jobs": jobs,
        "placed jobs": placed,
        "jobs without status": jobs.where("ResourceStatus is null"),
        "placements on a wrong crew": placed.join(listed, "JobID", "left_anti"),
        "placements on a locked day": locked,
        "crews booked twice": busy.withColumn("ahead", ahead).where("ahead <= free"),
    }
    return clean.row_counts(checks).drop("n_columns")


# inputs and outputs


@query
def predictions_to_jobs(spark, folder):
    """Predicted durations joined to planner jobs; here the prediction is the market's mean."""
    jobs = views.jobs(spark, folder, PARAMS).where("JobDurationML is not null")
    means = jobs.groupBy("Market").agg(F.round(F.avg("JobDurationML"), 6).alias("JobDurationML"))
    scored = jobs.select("JobID", "Market").join(means, "Market")
    return overlay.with_predictions(views.jobs(spark, folder, PARAMS), scored).select("JobID", "JobDurationML")


def _predictions(spark, folder):
    return features.base_features(views.construction(spark, folder)).select(
        "region", "market", "package_name", F.col("id").alias("JobID"),
        F.datediff("civil_end", "civil_start").cast("double").alias("JobDurationML"), "refresh_date",
    )


@query
def predictions_by_day(spark, folder):
    """Predictions written by day and read back."""
    path = scratch_path(spark, "predictions")
    write_predictions(_predictions(spark, folder), path)
    back = spark.read.parquet(path)
    return back.groupBy("year", "month", "day").agg(F.count("*").alias("n_rows"), F.min("JobID").alias("first_id"))


@query
def published_table(spark, folder):
    """The written predictions as an external table."""
    path = scratch_path(spark, "published")
    rows = _predictions(spark, folder)
    write_predictions(rows, path)
    name = "published_predictions"
    publish_table(spark, name, path, rows)
    return spark.table(name).groupBy("year", "month", "day", "market").agg(F.count("*").alias("n_rows"))


@query
def published_versions(spark, folder):
    """Two versions of a published table: the second replaces some days and adds others, the rest stays."""
    root, name = scratch_path(spark, "versions"), "published_versions_of_days"
    rows = materialise(_predictions(spark, folder), "predictions")
    publish_days(rows.where(F.month("refresh_date") <= 6), root, "refresh_date")
    publish_view(spark, name, root)
    later = rows.where(F.dayofmonth("refresh_date") % 3 == 0)
    publish_days(later.withColumn("JobDurationML", F.col("JobDurationML") + 1), root, "refresh_date")
    publish_view(spark, name, root)
    found = spark.table(name).groupBy("year", "month", "day")
    return found.agg(F.count("*").alias("n_rows"), F.sum("JobDurationML").alias("days"), F.min("JobID").alias("first_id"))


@query
def overlay_file(spark, folder):
    """The settled overlay rows written as CSV and read back as text."""
    path = scratch_path(spark, "overlay")
    write_overlay(coded_overlay(spark, folder), path, PARAMS.as_of, "csv")
    back = spark.read.option("header", True).csv(path)
    return back.groupBy("ResourceStatus", "VendorId").agg(F.count("*").alias("n_rows"))


def _write_drop(df: DataFrame, schema, path: str) -> None:
    write_csv(df.select(*[F.col(f.name).cast(f.dataType) for f in schema]), path)


@query
def construction_csv(spark, folder):
    """Construction records through CSV with the fixed schema."""
    path = scratch_path(spark, "construction")
    _write_drop(views.construction(spark, folder), schemas.CONSTRUCTION, path)
    return read_csv(spark, path, schemas.CONSTRUCTION).select("id", "market", "civil_start", "tower_end", "latitude")


@query
def planner_files(spark, folder):
    """The four planner tables through CSV files of many parts and back, as row counts."""
    root = scratch_path(spark, "planner")
    made = views.inputs(spark, folder, PARAMS)
    tables = {
        "job_site": (made.jobs, schemas.JOB_SITE),
        "vendor_crew": (made.crews, schemas.VENDOR_CREW),
        "events": (made.events, schemas.EVENTS),
        "weather": (made.weather, schemas.WEATHER),
    }
    for name, (df, schema) in tables.items():
        _write_drop(df, schema, f"{root}/{name}")
    found = read_planner_inputs_of_parts(spark, root)
    return clean.row_counts(
        {"jobs": found.jobs, "crews": found.crews, "events": found.events, "weather": found.weather}
    ).drop("n_columns")


def read_planner_inputs_of_parts(spark, root):
    """Spark names its files itself, so each table is found by folder and file pattern."""
    parts = {
        "jobs": ("job_site", schemas.JOB_SITE, schemas.JOB_SITE_DATES),
        "crews": ("vendor_crew", schemas.VENDOR_CREW, schemas.VENDOR_CREW_DATES),
        "events": ("events", schemas.EVENTS, schemas.EVENT_DATES),
        "weather": ("weather", schemas.WEATHER, schemas.WEATHER_DATES),
    }
    return Inputs(
        **{
            k: clean.parse_dates(read_csv(spark, f"{root}/{name}", schema, "*.csv"), dates)
            for k, (name, schema, dates) in parts.items()
        }
    )


@query
def ingest_drops(spark, folder):
    """Two job drops streamed once each; a job in both is there once, and read files are archived."""
    root = scratch_path(spark, "drops")
    jobs = views.jobs(spark, folder, PARAMS)

    def handle(batch: DataFrame, number: int) -> None:
        kept = clean.clean_jobs(clean.parse_dates(batch, schemas.JOB_SITE_DATES), PARAMS)
        kept.write.mode("overwrite").parquet(f"{root}/out/batch={number}")

    for drop in (jobs.where("JobID % 3 > 0"), jobs.where("JobID % 3 < 2")):
        _write_drop(drop, schemas.JOB_SITE, f"{root}/new")
        drop_files(spark, f"{root}/new", f"{root}/in")
        stream = drop_stream(spark, f"{root}/in", schemas.JOB_SITE, archive=f"{root}/done")
        run_on_drops(stream, handle, f"{root}/state").awaitTermination()
    found = latest_rows(spark, f"{root}/out", "JobID")
    return found.select("JobID", "Market", "JobCreateDate", "CrewIdBooked", "JobDurationML")


@query
def newest_of_drops(spark, folder):
    """Three job drops, the stream started anew for each: the newest row of every job, the third drop's being late for many."""
    root = scratch_path(spark, "newest")
    key = F.col("JobID").cast("long")

    def drop(kept, days_ago, more):
        jobs = views.jobs(spark, folder, PARAMS).where(kept)
        return jobs.withColumns({"JobDurationML": F.col("JobDurationML") + more, "refresh_date": F.date_sub(F.lit(PARAMS.as_of), days_ago)})

    for rows in (drop(key % 3 > 0, 2, 0), drop(key % 3 < 2, 0, 1), drop(key % 2 == 0, 1, 2)):
        _write_drop(rows, schemas.JOB_SITE, f"{root}/new")
        drop_files(spark, f"{root}/new", f"{root}/in")
        stream = newest_rows(drop_stream(spark, f"{root}/in", schemas.JOB_SITE), "JobID", "refresh_date")
        run_on_drops(stream, table_handler(f"{root}/table"), f"{root}/state", mode="complete").awaitTermination()
    found = clean.parse_dates(read_whole(spark, f"{root}/table"), schemas.JOB_SITE_DATES)
    return found.select("JobID", "customer_id", "JobDurationML", F.col("refresh_date").cast("date").alias("refresh_date"))


def _holidays(spark, folder):
    """Two made-up countries' holidays: some days of a month on which orders came in."""
    days = views.table(spark, folder, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    country = F.when(F.dayofmonth("day").isin(1, 15), "AA").when(F.dayofmonth("day") == 20, "BB")
    return days.select(country.alias("country"), "day").dropna()


@query
def holidays_of_country(spark, folder):
    """Holidays through their CSV file: those of one country within some years."""
    path = scratch_path(spark, "holidays")
    _write_drop(_holidays(spark, folder), schemas.HOLIDAYS, path)
    listed = clean.parse_dates(read_holidays(spark, path), ["day"])
    return select_holidays(listed, "AA", 1993, 1996)


@query
def holiday_offset(spark, folder):
    """Business offsets that also pass over holidays."""
    params = dataclasses.replace(PARAMS, country_code="AA")
    orders = views.table(spark, folder, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("created"))
    calendar = business_calendar(spark, params, materialise(_holidays(spark, folder), "holidays"))
    return add_business_days(orders, "created", (F.col("o_orderkey") % 15).cast("int"), "due", calendar)


@query
def archived_files(spark, folder):
    """Construction files moved to an archive under dated names, and read there."""
    root = scratch_path(spark, "archive")
    _write_drop(views.construction(spark, folder), schemas.CONSTRUCTION, f"{root}/in")
    archive(spark, f"{root}/in", f"{root}/done", PARAMS.as_of)
    rows = read_csv(spark, f"{root}/done", schemas.CONSTRUCTION, f"*_{PARAMS.as_of.isoformat()}.csv")
    return rows.select("id", "market", "civil_start")


@query
def latest_planner_files(spark, folder):
    """The four planner tables by file name: of two files of a name the newer is read, and all must be there."""
    root = scratch_path(spark, "latest")
    made = views.inputs(spark, folder, PARAMS)
    tables = {
        "job_site": (made.jobs, schemas.JOB_SITE),
        "vendor_crew": (made.crews, schemas.VENDOR_CREW),
        "events": (made.events, schemas.EVENTS),
        "weather": (made.weather, schemas.WEATHER),
    }
    for name, (df, schema) in tables.items():
        typed = df.select(*[F.col(f.name).cast(f.dataType) for f in schema])
        write_named_csv(typed.limit(3), f"{root}/old/{name}.csv")
        write_named_csv(typed, f"{root}/new/{name}.csv")
    found = read_planner_inputs(spark, root)

    def rows(stage, df, key, *columns):
        texts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
        return df.select(F.lit(stage).alias("stage"), F.coalesce(F.col(key), F.lit("")).alias("key"), F.concat_ws("|", *texts).alias("row"))

    parts = [
        rows("jobs", found.jobs.withColumn("Market", F.upper("Market")), "JobID", "customer_id", "SiteCode", "Market", "JobCreateDate", "JobStartDateForecast"),
        rows("crews", found.crews.withColumn("Market", F.upper("Market")), "crew_name", "VendorID", "Market", "ValidFrom", "ValidUntil", "Skills1"),
        rows("events", found.events.withColumns({c: F.upper(c) for c in ("Market", "Region")}), "CustomerID", "SiteCode", "Market", "Region", "ValidFrom", "ValidUntil"),
        rows("weather", found.weather, "CustomerID", "SiteID", "Date"),
    ]
    return reduce(DataFrame.unionByName, parts)
