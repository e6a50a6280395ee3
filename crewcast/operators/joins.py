"""Equi-joins whose keys may be null."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, null matching null, keeping the left side's key columns."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    condition = F.col(keys[0]).eqNullSafe(F.col(f"_right_{keys[0]}"))
    for k in keys[1:]:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_right_{k}"))
    joined = left.join(renamed, condition, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_right_{k}" for k in keys])
