"""Vectors that take part in searches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def finite_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v): rows with an id and a vector of finite numbers only, components as doubles; rows that repeat an id stay."""
    v = F.col(vector_col).cast("array<double>")
    rows = df.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where("id IS NOT NULL AND v IS NOT NULL")
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(~odd)


def one_of_each_id(rows: DataFrame) -> DataFrame:
    """Queries: of rows that repeat an id the one with the largest vector asks."""
    return rows.groupBy("id").agg(F.max("v").alias("v"))
