"""Numbering, run ids, collision spreading, surrogate keys and filling, as lazy ordered scans (see ``skew``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldlab.functions.times import plus_minutes
from fieldlab.operators.skew import carried, numbered, running


def renumber_within(df: DataFrame, day: str, order: list[str], into: str, counts: DataFrame | None = None) -> DataFrame:
    """Number surveys 1..n inside each date, in source order; ``counts`` as for ``numbered``."""
    return numbered(df, [day], order, into, counts=counts)


def run_ids(df: DataFrame, day: str, into: str) -> DataFrame:
    """Id of the run of equal dates in date order: 0 for the first date, 1 for the next, ...

    Only distinct calendar dates are ordered in one task: the calendar bounds them (3,652,059 days at most, a few thousand per
    decade). They are then looked up by date; adaptive execution splits hot dates. Missing dates have no run.
    """
    days = df.select(F.to_date(day).alias("_day")).dropna().distinct()
    runs = days.withColumn(into, (F.dense_rank().over(Window.orderBy("_day")) - 1).cast("long"))
    keyed = df.withColumn("_day", F.to_date(day))
    return keyed.join(runs, "_day", "left").drop("_day")


def spread_collisions(
    df: DataFrame, moment: str, order: list[str], minutes: int = 5, into: str | None = None, source: DataFrame | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Shift the k-th row with one timestamp by ``(k - 1) * minutes``; a single pass.

    A shifted row can meet another one; ``spread_apart`` leaves no two rows of a day together. ``source`` is a
    cheaper frame whose rows have the same moments and order, if there is one; ``counts`` as for ``numbered``.
    """
    spread = numbered(df, [moment], order, "_k", source, counts)
    moved = plus_minutes(moment, (F.col("_k") - 1) * minutes)
    return spread.withColumn(into or moment, moved).drop("_k")


def spread_apart(
    df: DataFrame, day: str | Column, moment: str, order: list[str], minutes: int = 5, into: str | None = None
) -> DataFrame:
    """Move rows of a day so that each comes ``minutes`` after the one before it at least, in the order of time, then ``order``.

    The k-th row gets ``minutes * k + max(t_j - minutes * j)`` over the rows j up to k, so no shifted row meets another one. Rows
    far enough from the one before stay. Rows without a time stay without; so do rows without a day.
    """
    there = F.col(moment).isNotNull()
    keyed = df.withColumn("_day", F.when(there, F.to_date(day) if isinstance(day, str) else day))
    placed = numbered(keyed, ["_day"], [moment, *order], "_k")
    free = plus_minutes(moment, -F.col("_k") * minutes)
    least = running(placed.withColumn("_free", free), ["_day"], ["_k"], {"_least": ("max", "_free")})
    moved = F.when(F.col("_day").isNotNull(), plus_minutes("_least", F.col("_k") * minutes)).otherwise(F.col(moment))
    return least.withColumn(into or moment, moved).drop("_day", "_k", "_free", "_least")


def surrogate_keys(df: DataFrame, order: list[str], into: str, after: int | Column = 0) -> DataFrame:
    """Ids ``after + 1, after + 2, ...`` over a total order of all rows."""
    keyed = numbered(df, [], order, into)
    return keyed.withColumn(into, F.col(into) + (after if isinstance(after, Column) else F.lit(after)))


def next_keys(df: DataFrame, target: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Ids for a batch that continue from the largest id already stored, compared as a number.

    The ids have the type of the stored column. The largest id is a scalar sub-query of the same plan.
    """
    largest = F.coalesce(target.agg(F.max(F.col(key).cast("long"))).scalar(), F.lit(0).cast("long"))
    keyed = surrogate_keys(df, order, key, largest)
    return keyed.withColumn(key, F.col(key).cast(target.schema[key].dataType))


def fill_down(df: DataFrame, columns: list[str], order: list[str], by: list[str] = ()) -> DataFrame:
    """Carry the last known value forward."""
    return carried(df, list(by), order, columns, ("down",))


def fill_down_up(df: DataFrame, columns: list[str], order: list[str], by: list[str] = ()) -> DataFrame:
    """Carry forward, then fill what is still missing from later rows of the same key."""
    return carried(df, list(by), order, columns, ("down", "up"))
