"""Column naming, choosing, ordering and typing."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldlab.functions.numbers import to_number


def fix_header(name: str) -> str:
    """One header as lower snake case: ``#`` reads as "no", other symbols become ``_``."""
    name = re.sub(r"([a-z])([A-Z])", r"\1_\2", name.strip().replace("#", " no "))
    return re.sub(r"[^0-9a-z]+", "_", name.lower()).strip("_") or "x"


def fix_headers(names: list[str], repeats: tuple[str, ...] = ()) -> list[str]:
    """Headers of one sheet as unique names.

    Where a sheet prints a header twice that ends in the first of ``repeats``, the n-th copy takes
    the n-th ending (caught ``_c`` comes before retained ``_r``). Other copies get the next free
    number; names that stand in the sheet as they are keep their place.
    """
    wanted = [fix_header(name) for name in names]
    taken, seen = set(), {}
    fixed = []
    for name in wanted:
        k = seen.get(name, 0)
        seen[name] = k + 1
        made = name
        if 0 < k < len(repeats) and name.endswith(f"_{repeats[0]}"):
            made = name.removesuffix(repeats[0]) + repeats[k]
        number = k + 1
        while made in taken or (made != name and made in wanted):
            made = f"{name}_{max(2, number)}"
            number += 1
        taken.add(made)
        fixed.append(made)
    return fixed


def between_names(df: DataFrame, first: str, last: str) -> list[str]:
    """Names of the columns from ``first`` to ``last`` in table order."""
    names = df.columns
    return names[names.index(first) : names.index(last) + 1]


def in_front(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*names, *[c for c in df.columns if c not in names])


def move_before(df: DataFrame, names: list[str], anchor: str) -> DataFrame:
    """Move a block of columns in front of ``anchor``."""
    rest = [c for c in df.columns if c not in names]
    at = rest.index(anchor)
    return df.select(*rest[:at], *names, *rest[at:])


def coalesce_synonyms(df: DataFrame, synonyms: dict[str, list[str]]) -> DataFrame:
    """Fill each target from drifted spellings of its header, then drop the spellings.

    A target of which no spelling is there becomes null text.
    """
    for target, names in synonyms.items():
        present = [c for c in dict.fromkeys([target, *names]) if c in df.columns]
        value = F.coalesce(*present) if present else F.lit(None).cast("string")
        df = df.withColumn(target, value).drop(*[c for c in present if c != target])
    return df


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Drop columns without any value; one aggregate pass reads all columns."""
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns]).first()
    return df.select(*[c for c in df.columns if counts[c]])


def as_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the columns of ``schema`` with tolerant casts; text that does not fit gives null."""

    def cast(field: T.StructField) -> Column:
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            return to_number(field.name).cast(field.dataType)
        if isinstance(field.dataType, T.IntegralType):
            text = F.trim(F.col(field.name).cast("string"))
            return F.when(text.rlike("^[+-]?[0-9]+$"), text.try_cast(field.dataType))
        return F.col(field.name).try_cast(field.dataType)

    return df.select(*[cast(f).alias(f.name) for f in schema.fields])


def only_allowed(df: DataFrame, allowed: list[str]) -> DataFrame:
    """Keep listed columns only, so personal data cannot slip into storage."""
    return df.select(*[c for c in df.columns if c in set(allowed)])


def matching(df: DataFrame, pattern: str) -> list[str]:
    """Names of columns in which the pattern is found."""
    return [c for c in df.columns if re.search(pattern, c)]
