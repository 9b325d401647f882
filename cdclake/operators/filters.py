"""Predicates on change rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def not_commit() -> Column:
    """Keeps row changes and drops commit markers (the lake's default)."""
    return F.col("operation") != "commit"


def filter_changes(changes: DataFrame, *predicates: Column) -> DataFrame:
    """Changes for which every predicate holds; all of them without one."""
    if not predicates:
        return changes
    return changes.filter(reduce(Column.__and__, predicates))
