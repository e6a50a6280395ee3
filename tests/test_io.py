"""Readers, writers, publishing, archiving and file-drop streams."""

import dataclasses
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crewcast import Params, schemas, views
from crewcast.operators import clean, features
from crewcast.plans import forecast
from crewcast.sources import readers, writers
from crewcast.streaming import drops
from tests.test_placement import CREW_TYPES, JOB_TYPES
from tests.test_semantics import P, crew, day, job

D = dt.date(2024, 3, 4)


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


HOLIDAY_HEAD = "country,day\n"


def test_csv_schema_is_enforced_by_name(spark, tmp_path):
    put(f"{tmp_path}/a/good.csv", HOLIDAY_HEAD + "XX,2024-01-01\nXX,not a day\n")
    got = [tuple(r) for r in readers.read_holidays(spark, f"{tmp_path}/a").collect()]
    assert got == [("XX", dt.date(2024, 1, 1)), ("XX", None)]
    put(f"{tmp_path}/b/swapped.csv", "day,country\n2024-01-01,XX\n")
    with pytest.raises(Exception, match="CSV header"):
        readers.read_holidays(spark, f"{tmp_path}/b").collect()


def test_latest_file_of_a_name(spark, tmp_path):
    put(f"{tmp_path}/one/h.csv", HOLIDAY_HEAD + "OLD,2024-01-01\n")
    put(f"{tmp_path}/two/h.csv", HOLIDAY_HEAD + "NEW,2024-01-01\n")
    put(f"{tmp_path}/two/other.csv", HOLIDAY_HEAD + "NO,2024-01-01\n")
    os.utime(f"{tmp_path}/one/h.csv", (1, 1))
    got = readers.read_latest(spark, str(tmp_path), "h.csv", schemas.HOLIDAYS)
    assert [r.country for r in got.collect()] == ["NEW"]
    assert readers.read_latest(spark, str(tmp_path), "absent.csv", schemas.HOLIDAYS) is None


def planner_folder(root, *, crews=True):
    head = ",".join(schemas.JOB_SITE.names)
    row = dict.fromkeys(schemas.JOB_SITE.names, "")
    jobs = []
    for i in range(3):
        jobs.append(row | {"JobID": f"j{i}", "customer_id": "c", "SiteCode": f"s{i}", "Market": "m", "Skills": "A",
                           "JobCreateDate": "2024-02-01", "JobStartDateForecast": "2024-03-11",
                           "JobEndDateForecast": "2024-03-12", "refresh_date": "2024-03-04"})
    put(f"{root}/job_site.csv", "\n".join([head, *[",".join(j.values()) for j in jobs]]) + "\n")
    if crews:
        put(f"{root}/vendor_crew.csv", "VendorID,crew_name,Market,region,ValidFrom,ValidUntil,Score,Skills1\n"
            "v,k,M,r,2024-01-01,2024-12-31,1.0,A|B\n")  # fmt: skip
    put(f"{root}/events.csv", "CustomerID,SiteCode,Market,Region,ValidFrom,ValidUntil\nc,s2,,,2024-03-01,2024-12-31\n")
    put(f"{root}/weather.csv", "CustomerID,SiteID,Date\nc,s0,2024-03-11\n")


def test_planner_inputs_and_gate(spark, tmp_path):
    planner_folder(f"{tmp_path}/full")
    found = readers.read_planner_inputs(spark, f"{tmp_path}/full")
    assert (found.jobs.count(), found.crews.count(), found.events.count(), found.weather.count()) == (3, 1, 1, 1)
    assert dict(found.jobs.dtypes)["JobCreateDate"] == "date"
    planner_folder(f"{tmp_path}/part", crews=False)
    with pytest.raises(ValueError, match="crews"):
        readers.read_planner_inputs(spark, f"{tmp_path}/part")


def test_day_partitions_replace_only_their_days(spark, tmp_path):
    path = f"{tmp_path}/p"
    df = spark.createDataFrame([("a", dt.date(2024, 1, 9)), ("b", dt.date(2024, 1, 10))], "JobID string, refresh_date date")
    writers.write_predictions(df, path)
    assert os.path.isdir(f"{path}/year=2024/month=1/day=9")
    writers.write_predictions(df.where("JobID = 'b'").withColumn("JobID", F.lit("c")), path)
    writers.write_predictions(df.limit(0), path)
    assert {r.JobID for r in spark.read.parquet(path).collect()} == {"a", "c"}
    writers.publish_table(spark, "published_days", path, df)
    assert spark.table("published_days").where("day = 10").count() == 1
    spark.sql("DROP TABLE published_days")
    assert spark.read.parquet(path).count() == 2


def test_overlay_of_one_day_is_replaced(spark, tmp_path):
    df = spark.createDataFrame([("a", "#")], "WpId string, VendorId string")
    for _ in range(2):
        writers.write_overlay(df, f"{tmp_path}/o", D)
    assert spark.read.parquet(f"{tmp_path}/o").count() == 1
    assert os.path.isdir(f"{tmp_path}/o/year=2024/month=3")


def test_archive_moves_and_stamps(spark, tmp_path):
    put(f"{tmp_path}/in/a.csv", "x\n")
    put(f"{tmp_path}/in/b.txt", "x\n")
    assert writers.archive(spark, f"{tmp_path}/in", f"{tmp_path}/done", D) == ["a_2024-03-04.csv", "b.txt"]
    assert [f for f in os.listdir(f"{tmp_path}/in") if not f.startswith(".")] == []


def test_each_drop_runs_once(spark, tmp_path):
    planner_folder(f"{tmp_path}/static")
    jobs = f"{tmp_path}/jobs"
    planner_folder(f"{tmp_path}/first")
    os.makedirs(jobs)
    os.rename(f"{tmp_path}/first/job_site.csv", f"{jobs}/one.csv")
    out, state = f"{tmp_path}/out", f"{tmp_path}/state"

    def start(static):
        stream = drops.drop_stream(spark, jobs, schemas.JOB_SITE)
        drops.run_on_drops(stream, drops.allocation_handler(static, P, out), state).awaitTermination()

    with pytest.raises(Exception, match="crew table is missing"):
        start(lambda: None)
    inputs = lambda: readers.read_planner_inputs(spark, f"{tmp_path}/static")
    start(inputs)
    start(inputs)
    got = {r.WpId: (r.CrewId, str(r.PlannedStartDate), r.ResourceStatus) for r in spark.read.parquet(f"{out}/batch=0").collect()}
    assert got == {"j0": ("k", "2024-03-12", 0), "j1": ("k", "2024-03-21", 0), "j2": ("#", "#", 6)}
    assert not os.path.exists(f"{out}/batch=1")


@pytest.fixture(scope="module")
def rows(spark, small):
    return features.training_rows(views.construction(spark, small), Params()).cache()


QUICK = Params(folds=2, parallelism=2)


def test_forest_is_repeatable_saved_and_scores_unseen_values(spark, rows, tmp_path):
    grid = {"maxDepth": [3], "numTrees": [4]}
    first, second = (forecast.train(rows, QUICK, grid) for _ in range(2))
    assert first.avgMetrics == second.avgMetrics
    writers.save_model(first, f"{tmp_path}/model")
    model = readers.load_model(f"{tmp_path}/model")
    new = rows.limit(5).withColumns({"package_name": F.lit("never seen"), "region": F.lit(None).cast("string")})
    got = forecast.score(model, new, QUICK)
    assert got.columns == ["region", "market", "package_name", "latitude", "longitude", "JobID", "JobDurationML", "refresh_date"]
    assert got.where("JobDurationML is not null").count() == 5
    handle = drops.scoring_handler(f"{tmp_path}/model", QUICK, f"{tmp_path}/predictions")
    handle(new, 0)
    assert spark.read.parquet(f"{tmp_path}/predictions").count() == 5
    table = forecast.fold_metrics(first, rows).collect()
    assert table[0].settings == "maxBins=10, maxDepth=3, numTrees=4" and table[0].mae > 0


@pytest.mark.parametrize(("name", "points"), [("random_forest", 3), ("gradient_boosting", 2), ("elastic_net", 30), ("decision_tree", 9)])
def test_grids(name, points):
    params = dataclasses.replace(Params(), model=name)
    assert len(forecast.grid_points(params)) == points
    assert (params.folds, params.parallelism, params.seed) == (10, 3, 123)


SMALL_GRIDS = {
    "random_forest": {"maxDepth": [2, 4], "numTrees": [3]},
    "gradient_boosting": {"maxDepth": [2], "maxIter": [2]},
    "elastic_net": {"k": [2, 40], "regParam": [0.1], "elasticNetParam": [0.5]},
    "decision_tree": {"k": [2, 10], "maxDepth": [5]},
}


@pytest.mark.parametrize("name", SMALL_GRIDS)
def test_each_model_fits_again_and_again(spark, rows, name):
    params = dataclasses.replace(QUICK, model=name)
    first = forecast.train(rows, params, SMALL_GRIDS[name])
    again = forecast.train(rows.repartition(7), params, SMALL_GRIDS[name])
    assert first.errors.shape == (2, len(first.points)) and (first.errors > 0).all()
    if "k" in SMALL_GRIDS[name]:  # trees on equal rows in another order may differ in ties
        assert first.avgMetrics == pytest.approx(again.avgMetrics, rel=0.05)
    assert forecast.best_stage(first).startswith(forecast._REGRESSORS[params.model].__name__.removesuffix("or")[:6])


def test_components_are_those_of_the_codes(spark):
    import numpy as np

    data = [("a", "x", None), ("a", "y", "p"), ("b", "x", "p"), ("b", "z", "it's"), ("c", "z", "p")] * 3
    df = spark.createDataFrame(data, "region string, market string, package_name string")
    stage = forecast.principal_components(df, Params(), 3)
    got = np.array(stage.transform(df).select("pc0", "pc1", "pc2").collect())
    codes = np.array([[v == r[i] for i, known in enumerate(["abc", "xyz", ["it's", "p"]]) for v in known] for r in data], float)
    z = (codes - codes.mean(0)) / codes.std(0, ddof=1)
    values = np.sort(np.linalg.eigvalsh(z.T @ z / (len(z) - 1)))[::-1][:3]
    assert np.allclose(got.var(0, ddof=1), values) and np.allclose(got.mean(0), 0)
    new = spark.createDataFrame([(None, "unseen", None)], df.schema)
    assert stage.transform(new).where("pc0 is null").count() == 0


def test_model_beats_the_mean(spark):
    df = spark.range(600).select(
        F.concat(F.lit("p"), (F.col("id") % 3).cast("string")).alias("package_name"),
        F.lit("R").alias("region"), F.lit("M").alias("market"), F.lit(0.0).alias("latitude"), F.lit(0.0).alias("longitude"),
        (F.col("id") % 3 * 20 + F.col("id") % 7).cast("double").alias("label"),
    )
    fitted = forecast.train(df, QUICK, {"maxDepth": [5], "numTrees": [5]})
    mean = df.agg(F.avg("label")).first()[0]
    flat = forecast.mean_absolute_error(df.withColumn("prediction", F.lit(mean)), "prediction", "label").first().mae
    assert fitted.avgMetrics[0] < flat / 2


def test_job_dates_as_text_or_dates(spark):
    typed = spark.createDataFrame([job("a", JobStartDateForecast=day(1))], JOB_TYPES)
    text = typed.select(*[F.col(f.name).cast(f.dataType) for f in schemas.JOB_SITE])
    assert [r.asDict() for r in clean.clean_jobs(text, P).collect()] == [r.asDict() for r in clean.clean_jobs(typed, P).collect()]
    crews = clean.clean_crews(spark.createDataFrame([crew(), (None, *crew()[1:])], CREW_TYPES))
    assert crews.count() == 1 and "Region" in crews.columns


def test_later_drops_add_to_a_day_and_the_latest_row_counts(spark, rows, tmp_path):
    model = forecast.train(rows, QUICK, {"maxDepth": [2], "numTrees": [2]})
    writers.save_model(model, f"{tmp_path}/model")
    handle = drops.scoring_handler(f"{tmp_path}/model", QUICK, f"{tmp_path}/out")
    day = views.construction(spark, "/root/testdata/sf0.001").withColumn("refresh_date", F.lit(D))
    ids = [r["id"] for r in day.select("id").distinct().orderBy("id").limit(4).collect()]
    first, second = day.where(F.col("id").isin(ids[:3])), day.where(F.col("id").isin(ids[2:]))
    for number, drop in ((0, first), (1, second), (1, second)):  # a batch that runs again replaces itself
        handle(drop, number)
    got = drops.latest_predictions(spark, f"{tmp_path}/out")
    assert sorted(r.JobID for r in got.collect()) == ids
    assert spark.read.parquet(f"{tmp_path}/out").where("day = 4").count() == 5


def test_planning_day_moves_with_the_batches(spark, tmp_path):
    planner_folder(f"{tmp_path}/static")
    days = iter([D, D + dt.timedelta(days=1)])
    handle = drops.allocation_handler(
        lambda: readers.read_planner_inputs(spark, f"{tmp_path}/static"), lambda: dataclasses.replace(P, as_of=next(days)), f"{tmp_path}/out"
    )
    batch = readers.read_csv(spark, f"{tmp_path}/static/job_site.csv", schemas.JOB_SITE)
    for number in (0, 1):
        handle(batch, number)
    written = {(r.batch, str(r.run_day)) for r in spark.read.parquet(f"{tmp_path}/out").select("batch", "run_day").distinct().collect()}
    assert written == {(0, D.isoformat()), (1, (D + dt.timedelta(days=1)).isoformat())}


def test_read_files_go_to_the_archive(spark, tmp_path):
    os.makedirs(f"{tmp_path}/in")
    for n in range(3):
        planner_folder(f"{tmp_path}/made{n}")
        os.rename(f"{tmp_path}/made{n}/job_site.csv", f"{tmp_path}/in/{n}.csv")
        stream = drops.drop_stream(spark, f"{tmp_path}/in", schemas.JOB_SITE, archive=f"{tmp_path}/done")
        drops.run_on_drops(stream, lambda batch, number: None, f"{tmp_path}/state").awaitTermination()
    moved = [f for _, _, files in os.walk(f"{tmp_path}/done") for f in files if f.endswith(".csv")]
    assert moved and {*moved, *[f for f in os.listdir(f"{tmp_path}/in") if f.endswith(".csv")]} == {"0.csv", "1.csv", "2.csv"}


def days_frame(spark, rows):
    return spark.createDataFrame([(dt.date(2024, 3, d), v) for d, v in rows], "refresh_date date, v int")


def test_a_reader_sees_the_old_or_the_new_version(spark, tmp_path):
    root = f"{tmp_path}/table"
    writers.publish_days(days_frame(spark, [(1, 10), (2, 20), (2, 21)]), root, "refresh_date")
    writers.publish_view(spark, "seen_versions", root)
    before = spark.table("seen_versions").select("day", "v")
    old_files = {f for _, _, names in os.walk(root) for f in names}
    values = lambda df: sorted(tuple(r) for r in df.collect())
    # the second version's data is there, its manifest not yet
    switch, seen = writers._switch, []
    try:
        writers._switch = lambda *a: seen.append(values(writers.read_published(spark, root).select("day", "v"))) or switch(*a)
        writers.publish_days(days_frame(spark, [(2, 99), (3, 30)]), root, "refresh_date")
    finally:
        writers._switch = switch
    old, new = [(1, 10), (2, 20), (2, 21)], [(1, 10), (2, 99), (3, 30)]
    assert seen == [old] and values(spark.table("seen_versions").select("day", "v")) == old
    writers.publish_view(spark, "seen_versions", root)
    assert values(spark.table("seen_versions").select("day", "v")) == new
    assert values(before) == old and values(writers.read_published(spark, root, 0).select("day", "v")) == old
    assert values(writers.read_published(spark, root).select("day", "v")) == new
    assert old_files <= {f for _, _, names in os.walk(root) for f in names}
    written = {d.split("/")[-1] for d, _, names in os.walk(f"{root}/data/_version=1") if any(n.endswith(".parquet") for n in names)}
    assert written == {"day=2", "day=3"}  # the day that stayed was not written again
    with pytest.raises(OSError, match="somebody else"):
        writers._switch(spark.range(1), root, 1)


def test_versions_without_rows(spark, tmp_path):
    root = f"{tmp_path}/table"
    with pytest.raises(ValueError, match="nothing is published"):
        writers.read_published(spark, root)
    writers.publish_days(days_frame(spark, [(1, 10)]), root, "refresh_date")
    writers.publish_days(days_frame(spark, []), root, "refresh_date")
    assert [r["v"] for r in writers.read_published(spark, root).collect()] == [10]
    for _ in range(4):
        writers.publish_days(days_frame(spark, [(2, 5)]), root, "refresh_date")
        writers.publish_view(spark, "kept_versions", root)
    names = {t.name for t in spark.catalog.listTables() if t.name.startswith("kept_versions")}
    assert names == {"kept_versions", "kept_versions__v4", "kept_versions__v5"}


def test_newest_rows_over_restarts_and_late_rows(spark, tmp_path):
    schema = T.StructType.fromDDL("JobID string, refresh_date string, note string")
    drops_of = [
        [("a", "2024-01-02", "first"), ("b", "2024-01-02", "first"), ("b", "2024-01-02", "later in order")],
        [("a", "2024-01-03", "second"), ("c", None, "no day"), ("b", "2024-01-01", "late")],
        [("a", "2024-01-02", "late"), ("c", "2023-01-01", "old but known"), ("d", "2024-01-05", "new")],
    ]
    os.makedirs(f"{tmp_path}/in")
    for n, rows in enumerate(drops_of):
        put(f"{tmp_path}/in/{n}.csv", "\n".join(["JobID,refresh_date,note", *[",".join(x or "" for x in r) for r in rows]]) + "\n")
        for _ in range(2):  # the second start finds nothing new
            stream = drops.newest_rows(drops.drop_stream(spark, f"{tmp_path}/in", schema), "JobID", "refresh_date")
            drops.run_on_drops(stream, drops.table_handler(f"{tmp_path}/out"), f"{tmp_path}/state", mode="complete").awaitTermination()
        os.remove(f"{tmp_path}/in/{n}.csv")  # no later batch can read it
    got = {r.JobID: r.note for r in writers.read_whole(spark, f"{tmp_path}/out").collect()}
    assert got == {"a": "second", "b": "later in order", "c": "old but known", "d": "new"}


def test_intermediates_can_be_discarded(spark):
    from crewcast.session import discard_intermediates, materialise

    kept = materialise(spark.range(3), "gone")
    folder = os.path.dirname(kept.inputFiles()[0].removeprefix("file://"))
    assert os.path.isdir(folder)
    assert discard_intermediates(spark) >= 1
    assert not os.path.exists(folder)


def test_what_led_to_a_result_can_be_discarded(spark):
    from crewcast.session import discard_intermediates, materialise, written_so_far

    before = materialise(spark.range(2), "before")
    mark = written_so_far()
    steps = [materialise(spark.range(n), f"step-{n}") for n in (3, 4, 5)]
    assert discard_intermediates(spark, mark, keep_last=True) == 2
    assert steps[2].count() == 5 and before.count() == 2 and written_so_far() == mark + 1
    assert discard_intermediates(spark, mark, keep_last=True) == 0
