"""Wide to long, long to wide, and splitting cells."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlab.functions.numbers import as_column
from fieldlab.functions.text import strip


def to_long(
    df: DataFrame, ids: list[str], columns: list[str], key: str = "variable", value: str = "value",
    kind: str = "string",
) -> DataFrame:
    """One row per id and column, values cast to one type."""
    cast = df.select(*ids, *[F.col(c).cast(kind).alias(c) for c in columns])
    return cast.unpivot(ids, columns, key, value)


def to_long_split(
    df: DataFrame, ids: list[str], columns: list[str], pattern: str, names: Sequence[str],
    value: str = "value", kind: str = "double",
) -> DataFrame:
    """Wide to long where groups of the column-name pattern become columns of their own."""
    long = to_long(df, ids, columns, "_name", value, kind)
    parts = [F.regexp_extract("_name", pattern, i + 1).alias(n) for i, n in enumerate(names)]
    return long.select(*ids, *parts, value)


def to_wide(
    df: DataFrame, keys: list[str], name: str, value: str, order: str,
    names: list[str] | None = None,
) -> DataFrame:
    """Long to wide; where a cell has several values the first known one by ``order`` wins.

    Without ``names`` the distinct values of ``name`` are read once: they are the result's columns.
    """
    if names is None:
        names = [r[0] for r in df.select(name).dropna().distinct().orderBy(name).collect()]
    return df.groupBy(*keys).pivot(name, names).agg(
        F.min_by(value, F.when(F.col(value).isNotNull(), F.col(order)))
    )


def chosen_tables(matrix: DataFrame, display_name: str | None = None, id_column: str = "TableName") -> DataFrame:
    """Physical tables marked ``X`` in a look-up matrix, for one display name or for all."""
    names = [c for c in matrix.columns if c != id_column]
    if display_name is not None:
        matrix = matrix.filter(F.col(id_column) == display_name)
    long = to_long(matrix, [id_column], names, "name", "mark")
    return long.filter(F.col("mark") == "X").select(id_column, "name")


def split_rows(df: DataFrame, column: str, separator: str = ",") -> DataFrame:
    """One row per non-blank, trimmed part of a delimited cell; the separator is plain text."""
    parts = F.explode(F.split(F.col(column), re.escape(separator)))
    return df.withColumn(column, parts).withColumn(column, strip(column)).filter(F.col(column) != "")


def split_columns(df: DataFrame, column: str, separator: str, into: Sequence[str]) -> DataFrame:
    """Columns from the parts of a delimited cell; the separator is plain text."""
    parts = F.split(F.col(column), re.escape(separator))
    return df.withColumns({name: F.get(parts, F.lit(i)) for i, name in enumerate(into)})


def recoded(c: str | Column, labels: dict) -> Column:
    """Labels for codes; codes without a label stay."""
    pairs = [F.lit(x) for pair in labels.items() for x in pair]
    return F.coalesce(F.element_at(F.create_map(*pairs), as_column(c)), as_column(c))
