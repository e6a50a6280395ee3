"""Writers, table publishing and archiving."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.ml.util import MLWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crewcast.functions.dates import date_parts


def write_by_day(df: DataFrame, path: str, day_column: str, form: str = "parquet") -> None:
    """Write into ``year=/month=/day=`` taken from each row's own date.

    Only the days present are replaced; an empty input writes nothing. Rows are
    gathered by day, and a day too large for one task is split, so that files are
    neither tiny nor huge.
    """
    dated = date_parts(df, day_column).hint("rebalance", "year", "month", "day")
    (
        dated.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("header", True)
        .partitionBy("year", "month", "day")
        .format(form)
        .save(path)
    )


def write_predictions(predictions: DataFrame, path: str, form: str = "parquet") -> None:
    write_by_day(predictions, path, "refresh_date", form)


def write_overlay(overlay: DataFrame, path: str, run_day: dt.date, form: str = "parquet") -> None:
    """Overlay of one run under ``year=/month=``; a second run of that day replaces the first."""
    stamped = overlay.withColumns(
        {"year": F.lit(run_day.year), "month": F.lit(run_day.month), "run_day": F.lit(run_day.isoformat())}
    )
    (
        stamped.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("header", True)
        .partitionBy("year", "month", "run_day")
        .format(form)
        .save(path)
    )


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def save_model(model: MLWritable, path: str) -> None:
    model.write().overwrite().save(path)


def publish_table(spark: SparkSession, name: str, path: str, sample: DataFrame) -> None:
    """External table over partitioned Parquet; dropping it never deletes the files."""
    parts = [("year", "int"), ("month", "int"), ("day", "int")]
    skipped = {p for p, _ in parts}
    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in sample.schema if f.name not in skipped]
    columns += [f"`{c}` {t}" for c, t in parts]
    place = path.replace("'", "\\'")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE {name} ({', '.join(columns)}) USING parquet "
        f"PARTITIONED BY ({', '.join(p for p, _ in parts)}) LOCATION '{place}'"
    )
    spark.sql(f"MSCK REPAIR TABLE {name}")


def _names(spark: SparkSession, folder: str) -> list[str]:
    files, place = _files(spark, folder)
    return [s.getPath().getName() for s in files.listStatus(place(folder))] if files.exists(place(folder)) else []


def current_version(spark: SparkSession, root: str) -> int | None:
    """Number of the newest version that is complete: the one whose manifest is there."""
    known = [int(n.removeprefix("v=")) for n in _names(spark, f"{root}/manifest") if n.startswith("v=")]
    return max(known, default=None)


def _switch(df: DataFrame, root: str, version: int) -> None:
    """Write the manifest beside its place and move it there: one step, from which on readers see the version."""
    spark = df.sparkSession
    made, final = f"{root}/manifest/.new-{uuid.uuid4().hex}", f"{root}/manifest/v={version}"
    df.coalesce(1).write.parquet(made)  # a row for each day
    files, place = _files(spark, root)
    if files.exists(place(final)) or not files.rename(place(made), place(final)):
        files.delete(place(made), True)
        raise OSError(f"version {version} of {root} was published by somebody else")


DAYS = ("year", "month", "day")


def publish_days(df: DataFrame, root: str, day_column: str) -> int:
    """Publish a version in which the days of ``df`` are its rows and all other days stay as they were.

    Only the days present are written, into a folder of the new version. A manifest lists
    which version holds each day; it is written last and moved to its name in one step, so
    a reader sees the old or the new version, whole. Older versions stay readable.
    """
    spark = df.sparkSession
    before = current_version(spark, root)
    version = 0 if before is None else before + 1
    data = f"{root}/data/_version={version}"
    dated = date_parts(df, day_column).where(F.col(day_column).isNotNull())
    dated.hint("rebalance", *DAYS).write.mode("overwrite").partitionBy(*DAYS).parquet(data)
    new = spark.read.schema("year int, month int, day int").parquet(data).select(*DAYS).distinct().withColumn("_version", F.lit(version))
    if before is not None:
        old = spark.read.parquet(f"{root}/manifest/v={before}")
        new = new.unionByName(old.join(new.select(*DAYS), list(DAYS), "left_anti"))
    _switch(new.select("_version", *DAYS), root, version)
    return version


def _day_folders(spark: SparkSession, root: str, version: int) -> list[str]:
    days = spark.read.parquet(f"{root}/manifest/v={version}").orderBy(*DAYS).collect()  # a row for each day
    return [f"{root}/data/_version={r['_version']}/year={r['year']}/month={r['month']}/day={r['day']}" for r in days]


def read_published(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The rows of a version (of the newest one), with ``year``, ``month`` and ``day``."""
    version = current_version(spark, root) if version is None else version
    if version is None:
        raise ValueError(f"nothing is published in {root}")
    folders = _day_folders(spark, root, version)
    if not folders:
        return spark.read.parquet(f"{root}/data/_version={version}")
    return spark.read.option("basePath", f"{root}/data").parquet(*folders).drop("_version")


def publish_view(spark: SparkSession, name: str, root: str, keep: int = 2) -> int:
    """Let the table ``name`` show the newest version.

    The version gets a table of its own whose partitions are those of the manifest, in one
    statement and without listing a file. Then the view ``name`` is replaced, in one step.
    Of the versions' tables the last ``keep`` stay for queries under way; files stay.
    """
    version = current_version(spark, root)
    if version is None:
        raise ValueError(f"nothing is published in {root}")
    own, rows = f"{name}__v{version}", read_published(spark, root, version)
    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name not in DAYS]
    columns += [f"`{c}` int" for c in DAYS]
    quoted = root.replace("'", "\\'")
    spark.sql(f"DROP TABLE IF EXISTS {own}")
    spark.sql(f"CREATE TABLE {own} ({', '.join(columns)}) USING parquet PARTITIONED BY ({', '.join(DAYS)}) LOCATION '{quoted}/data'")
    folders = [f.replace("'", "\\'") for f in _day_folders(spark, root, version)]
    parts = [f"PARTITION ({f[f.index('year='):].replace('/', ', ')}) LOCATION '{f}'" for f in folders]
    if parts:
        spark.sql(f"ALTER TABLE {own} ADD {' '.join(parts)}")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {own}")
    for old in range(version - keep + 1):
        spark.sql(f"DROP TABLE IF EXISTS {name}__v{old}")
    return version


def publish_whole(df: DataFrame, root: str, version: int) -> None:
    """Publish a table as a whole under a given number; one that is there already stays."""
    spark = df.sparkSession
    if current_version(spark, root) is not None and version <= current_version(spark, root):
        return
    df.write.mode("overwrite").parquet(f"{root}/data/_version={version}")
    _switch(spark.range(1).select(F.lit(version).alias("_version")), root, version)


def read_whole(spark: SparkSession, root: str) -> DataFrame:
    version = current_version(spark, root)
    if version is None:
        raise ValueError(f"nothing is published in {root}")
    return spark.read.parquet(f"{root}/data/_version={version}")


def write_named_csv(df: DataFrame, path: str) -> None:
    """CSV under the given name: a folder of part files, written by as many tasks as there are."""
    write_csv(df, path)


def drop_files(spark: SparkSession, source: str, folder: str) -> None:
    """Move the data files of one folder into a watched folder."""
    archive(spark, source, folder)


def _files(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return place(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def archive(spark: SparkSession, source: str, target: str, stamp: dt.date | None = None) -> list[str]:
    """Move the files of a folder below ``target``, with an optional date before ``.csv``.

    Call it after the results are written, so that a failed run leaves its input alone.
    """
    files, path_of = _files(spark, source)
    files.mkdirs(path_of(target))
    moved = []
    for status in files.listStatus(path_of(source)):
        name = status.getPath().getName()
        if not status.isFile() or name.startswith((".", "_")):
            continue
        new = name.removesuffix(".csv") + f"_{stamp.isoformat()}.csv" if stamp and name.endswith(".csv") else name
        if not files.rename(status.getPath(), path_of(f"{target}/{new}")):
            raise OSError(f"could not move {name} to {target}")
        moved.append(new)
    return sorted(moved)
