"""Tolerant numeric parsing and null-as-zero arithmetic on columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_number(c: Column | str) -> Column:
    """Text to double; anything that is not a plain number gives null.

    The pattern is checked first because Spark's own cast also accepts suffixes (``1d``, ``2f``).
    """
    text = F.trim(as_column(c).cast("string"))
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def zero_if_null(c: Column | str) -> Column:
    return F.coalesce(as_column(c), F.lit(0))


def row_sum(columns: list[Column | str]) -> Column:
    """Sum across columns of one row, nulls counted as 0."""
    return reduce(lambda a, b: a + b, (zero_if_null(c) for c in columns))


def tolerant_sum(c: Column | str) -> Column:
    """Aggregate: sum of what converts to a number; 0 where nothing does."""
    return F.coalesce(F.sum(to_number(c)), F.lit(0.0))


def whole_hours(c: Column | str) -> Column:
    """Hours cut to whole hours, towards zero."""
    return as_column(c).cast("int")


def percent(part: Column, whole: Column, digits: int | None = None) -> Column:
    share = part / whole * 100
    return share if digits is None else F.round(share, digits)
