"""Stacking tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stacked(tables: Sequence[DataFrame]) -> DataFrame:
    """Union by name; columns missing from a table are null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def stacked_strict(tables: Sequence[DataFrame]) -> DataFrame:
    """Union of tables that must have the same columns."""
    if len({frozenset(t.columns) for t in tables}) > 1:
        raise ValueError("the tables differ in their columns")
    return reduce(DataFrame.unionByName, tables)


def tagged(tables: Mapping[str, DataFrame], label: str = "source") -> DataFrame:
    """Union with the name of the branch as a column."""
    return stacked([t.withColumn(label, F.lit(name)) for name, t in tables.items()])
