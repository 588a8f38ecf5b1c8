"""Row filters driven by user choices, and duplicate listing."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlab.operators.skew import numbered


def between_dates(
    df: DataFrame, column: str, first: dt.date | str | None = None, last: dt.date | str | None = None
) -> DataFrame:
    """Keep rows from ``first`` to ``last``, both included; an open bound keeps everything.

    The bounds are literals of the column's own type, so they reach the Parquet scan.
    """
    kind = df.schema[column].dataType
    if first is not None:
        df = df.filter(F.col(column) >= F.lit(str(first)).cast(kind))
    if last is not None:
        day_after = dt.date.fromisoformat(str(last)) + dt.timedelta(days=1)
        df = df.filter(F.col(column) < F.lit(str(day_after)).cast(kind))
    return df


def facet_filter(df: DataFrame, chosen: Mapping[str, Iterable]) -> DataFrame:
    """For every column with chosen values keep those values; an empty choice does not filter."""
    active = {c: list(v) for c, v in chosen.items() if c in df.columns and v}
    return reduce(lambda d, item: d.filter(F.col(item[0]).isin(item[1])), active.items(), df)


def any_present(df: DataFrame, columns: list[str]) -> DataFrame:
    """Keep rows in which at least one of the columns has a value."""
    return df.dropna("all", subset=columns)


def repeated_rows(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Second and later rows of every key, in source order. Null keys compare as equal."""
    return numbered(df, keys, order, "_copy").filter("_copy > 1").drop("_copy")
