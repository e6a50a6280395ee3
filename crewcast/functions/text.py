"""Skill lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def skill_set(column: Column) -> Column:
    """Sorted distinct trimmed entries of a pipe-delimited list; null gives an empty set."""
    parts = F.transform(F.split(column, r"\|"), lambda s: F.trim(s))
    return F.coalesce(F.array_sort(F.array_distinct(parts)), F.array().cast("array<string>"))


def skill_key(column: Column) -> Column:
    """The skill set as one comparable string; null for the empty set."""
    return F.when(column.isNotNull(), F.array_join(skill_set(column), "|"))


def contains_all(have: Column, need: Column) -> Column:
    """True when every entry of ``need`` is in ``have``."""
    return F.size(F.array_except(need, have)) == 0
