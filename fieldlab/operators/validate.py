"""Validation reports: conversion profiles, failed values, keys and references."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlab.functions.numbers import to_number
from fieldlab.operators.aggregates import counts, keep_first
from fieldlab.operators.reshape import to_long


def conversion_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: rows, values, values that are numbers, failures and two verdicts.

    ``numeric`` needs more than half of all rows to convert; ``plottable`` needs at least 80 %
    of the values (and one) to convert. One aggregate row is computed and then stacked, so rows
    are not multiplied by columns.
    """
    one = lambda c: F.struct(
        F.lit(c).alias("variable"),
        F.count(F.lit(1)).alias("n"),
        F.count(c).alias("present"),
        F.count(to_number(c)).alias("converted"),
    )
    table = df.agg(F.array(*[one(c) for c in columns]).alias("_rows")).select(F.inline("_rows"))
    return table.select(
        "*",
        (F.col("present") - F.col("converted")).alias("failed"),
        (F.col("converted") > 0.5 * F.col("n")).alias("numeric"),
        ((F.col("converted") > 0) & (F.col("converted") >= 0.8 * F.col("present"))).alias("plottable"),
    )


def failed_values(
    df: DataFrame, ids: list[str], columns: list[str], order: list[str] = (), first: int | None = None
) -> DataFrame:
    """Values that are present but not numbers, with their ids; optionally the first few per column."""
    long = to_long(df, list(dict.fromkeys([*ids, *order])), columns)
    failed = long.filter(F.col("value").isNotNull() & to_number("value").isNull())
    if first is not None:
        failed = keep_first(failed, ["variable"], [*order, "value"], first)
    return failed.select(*ids, "variable", "value")


def values_by_day(df: DataFrame, day: str, columns: list[str]) -> DataFrame:
    """Rows per column, date and value.

    Each column is read and counted on its own: a task's table then holds the values of one column, not of all at once, and a
    value is compared with those of its column only. Of a stored table only the date is read repeatedly.
    """
    def one(c: str) -> DataFrame:
        n = counts(df.select(day, F.col(c).cast("string").alias("value")), day, "value")
        return n.select(F.lit(c).alias("variable"), day, "value", "n")

    return reduce(DataFrame.unionByName, [one(c) for c in columns])


def key_audit(df: DataFrame, keys: list[str]) -> DataFrame:
    """Number of keys that occur more than once, rows beyond the first, and rows with a null part."""
    missing = reduce(lambda a, b: a | b, (F.col(c).isNull() for c in keys))
    n = counts(df, *keys)
    return n.agg(
        F.sum("n").alias("n_rows"),
        F.coalesce(F.sum(F.when(~missing & (F.col("n") > 1), 1)), F.lit(0)).cast("long").alias("repeated_keys"),
        F.coalesce(F.sum(F.when(~missing, F.col("n") - 1)), F.lit(0)).cast("long").alias("extra_rows"),
        F.coalesce(F.sum(F.when(missing, F.col("n"))), F.lit(0)).cast("long").alias("null_key_rows"),
    )


def orphan_report(references: list[tuple[str, DataFrame, list[str], DataFrame, list[str]]]) -> DataFrame:
    """Per reference (name, child, child keys, parent, parent keys): orphan keys and child rows.

    Child rows are counted per key before the anti-join, so a hot orphan key is one row.
    """
    parts = []
    for name, child, child_keys, parent, parent_keys in references:
        n = counts(child.select(*child_keys).dropna(), *child_keys)
        known = parent.select(*[F.col(p).alias(c) for c, p in zip(child_keys, parent_keys)])
        orphans = n.join(known, child_keys, "left_anti")
        parts.append(
            orphans.agg(
                F.lit(name).alias("reference"),
                F.count(F.lit(1)).alias("orphan_keys"),
                F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows"),
            )
        )
    return reduce(DataFrame.unionByName, parts)
