"""Session helpers."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder that all executors see, taken from ``spark.checkpoint.dir``.

    Only a local-mode session without the setting gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    return _local_folder()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="crewcast-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


_written: list[str] = []


def written_so_far() -> int:
    """How many tables ``materialise`` has written: a mark for ``discard_intermediates``."""
    return len(_written)


def discard_intermediates(spark: SparkSession, since: int = 0, keep_last: bool = False) -> int:
    """Delete the tables that ``materialise`` has written since a mark; call it once results are stored.

    With ``keep_last`` the last one stays, such as the result that the others led to.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    last = [_written.pop()] if keep_last and len(_written) > since else []
    done = 0
    while len(_written) > since:
        path = jvm.org.apache.hadoop.fs.Path(_written.pop())
        done += bool(path.getFileSystem(conf).delete(path, True))
    _written.extend(last)
    return done


def materialise(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Cuts the lineage, survives lost executors and, unlike a checkpoint, keeps
    column pruning and filter pushdown for later reads.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    _written.append(path)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is run inside deletes its shuffle files when it ends, not when the driver collects garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)
