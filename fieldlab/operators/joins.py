"""Natural, outer and look-up joins with field-table semantics.

In natural and full joins a missing key matches a missing key. Whether a side is broadcast is
left to Spark, which checks its size; hot keys of inner and left joins are split at run time by
adaptive execution.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlab.operators.aggregates import keep_first
from fieldlab.operators.shape import as_text, in_front
from fieldlab.operators.skew import null_safe_join


def shared_columns(left: DataFrame, right: DataFrame) -> list[str]:
    return [c for c in left.columns if c in right.columns]


def natural_join(left: DataFrame, right: DataFrame, how: str = "left") -> DataFrame:
    """Join on all equally named columns."""
    on = shared_columns(left, right)
    if not on:
        raise ValueError("the tables share no column")
    return join_on(left, right, on, how)


def _suffixed(left: list[str], right: list[str], on: list[str], suffixes: tuple[str, str]) -> tuple[dict, dict]:
    """New names of the columns that two tables share beside the keys; suffixes are repeated until the names are free."""
    clash = [c for c in left if c in right and c not in on]
    taken = {*left, *right}

    def renamed(suffix: str) -> dict[str, str]:
        names = {}
        for c in clash:
            made = c + suffix
            while made in taken:
                made += suffix
            taken.add(made)
            names[c] = made
        return names

    return renamed(suffixes[0]), renamed(suffixes[1])


def join_on(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "left",
    suffixes: tuple[str, str] = ("_x", "_y"),
) -> DataFrame:
    """Null-safe join keeping one copy of the keys; other equal names get suffixes, repeated until they are free."""
    own, other = _suffixed(left.columns, right.columns, on, suffixes)
    left, right = left.withColumnsRenamed(own), right.withColumnsRenamed(other)
    return in_front(null_safe_join(left, right, on, how), *on)


def natural_join_all(tables: Sequence[DataFrame], how: str = "left") -> DataFrame:
    """Left-to-right natural joins over the tables as text."""
    return reduce(lambda a, b: natural_join(a, b, how), map(as_text, tables))


def full_join_all(tables: Sequence[DataFrame], on: list[str], suffixes: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    """Full outer join of any number of tables on fixed keys, named as left-to-right joins name their columns.

    Every table must hold one row per key; a key with several rows fails the job. All tables share one exchange (see
    ``stacked_groups``).
    """
    return stacked_groups([(t, None) for t in tables], on, suffixes)


def stacked_groups(parts: Sequence[tuple[DataFrame, Column | str | None]], on: list[str], suffixes: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    """One row per key of any part, beside it the columns of all parts: their full join, in a single exchange.

    The parts are stacked, each with columns of its own, and grouped by the keys. Partial sums on the map side leave a row per
    key and task, so a key with very many rows is no hot one. A part comes with an order: each of its columns is then the first
    known value in that order; an order given by name is not shown. Without an order the part has to have one row per key, or
    the job fails. Null keys are equal.
    """

    def shown(df: DataFrame, order: Column | str | None) -> list[str]:
        return [c for c in df.columns if c not in on and not (isinstance(order, str) and c == order)]

    names: list[list[str]] = []
    for part in parts:
        mine = shown(*part)
        earlier = [c for own in names for c in own]
        left, right = _suffixed(earlier, mine, on, suffixes)
        names = [[left.get(c, c) for c in own] for own in names] + [[right.get(c, c) for c in mine]]
    rows, sums, picked, guards = [], [], [], []
    for i, (df, order) in enumerate(parts):
        mine = shown(df, order)
        packed = F.struct(*[F.col(c).alias(f"c{k}") for k, c in enumerate(mine)]) if mine else F.struct(F.lit(1).alias("c"))
        if order is None:
            rows.append(df.select(*on, packed.alias(f"_v{i}")))
            sums += [F.first(f"_v{i}", ignorenulls=True).alias(f"_v{i}"), F.count(f"_v{i}").alias(f"_n{i}")]
            guards.append(F.when(F.col(f"_n{i}") > 1, F.raise_error(F.lit(f"part {i} of a full join has several rows of one key"))))
            picked += [F.col(f"_v{i}.c{k}").alias(name) for k, name in enumerate(names[i])]
        else:
            rows.append(df.select(*on, packed.alias(f"_v{i}"), (F.col(order) if isinstance(order, str) else order).alias(f"_o{i}")))
            for k, name in enumerate(names[i]):
                value = F.col(f"_v{i}.c{k}")
                sums.append(F.min_by(value, F.when(value.isNotNull(), F.col(f"_o{i}"))).alias(f"_v{i}_{k}"))
                picked.append(F.col(f"_v{i}_{k}").alias(name))
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    grouped = stacked.groupBy(*on).agg(*sums) if sums else stacked.select(*on).distinct()
    if guards:
        grouped = grouped.where(F.coalesce(*[g.cast("boolean") for g in guards], F.lit(True)))
    return grouped.select(*on, *picked)


def natural_full_join_all(tables: Sequence[DataFrame], without: Sequence[str] = ("time",), unique: bool = True) -> DataFrame:
    """Full outer natural joins after removing columns that must not act as keys.

    Tables that all share the same columns, with one row per key, meet in one exchange. Tables with other columns in common
    from step to step, or (``unique=False``) several rows per key, are joined one after the other.
    """
    bare = [t.drop(*without) for t in tables]
    shared = [c for c in bare[0].columns if all(c in t.columns for t in bare[1:])]
    pairs = {c for i, a in enumerate(bare) for b in bare[i + 1 :] for c in shared_columns(a, b)}
    if unique and shared and pairs == set(shared):
        return full_join_all(bare, shared)
    return reduce(lambda a, b: natural_join(a, b, "full"), bare)


def lookup(left: DataFrame, table: DataFrame, left_key: str, table_key: str) -> DataFrame:
    """Left join to a look-up table whose key has another name; the table's key is dropped."""
    return left.join(table, left[left_key] == table[table_key], "left").drop(table[table_key])


def merge_inner(
    left: DataFrame, right: DataFrame, key: str, suffixes: tuple[str, str] = ("_x", "_y")
) -> DataFrame:
    """Inner join on one id with suffixes on other equal names; missing ids never match."""
    clash = [c for c in shared_columns(left, right) if c != key]
    left = left.filter(F.col(key).isNotNull()).withColumnsRenamed({c: c + suffixes[0] for c in clash})
    right = right.filter(F.col(key).isNotNull()).withColumnsRenamed({c: c + suffixes[1] for c in clash})
    return left.join(right, key)


def mapped_once(
    observed: DataFrame, registries: Sequence[DataFrame], key: str, order: list[str]
) -> DataFrame:
    """Attach registry data to observations, one registry row per key.

    ``registries`` are stacked in order of trust; the first row of a key wins, then ``order``
    decides inside one registry.
    """
    ranked = [r.withColumn("_trust", F.lit(i)) for i, r in enumerate(registries)]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), ranked)
    chosen = keep_first(stacked, [key], ["_trust", *order]).drop("_trust")
    return observed.join(chosen, key, "left")


def coverage(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Number of distinct keys found on both sides, only left, only right."""
    a = left.select(key).dropna().distinct().withColumn("_l", F.lit(True))
    b = right.select(key).dropna().distinct().withColumn("_r", F.lit(True))
    side = F.when(F.col("_l") & F.col("_r"), "matched").when(F.col("_l"), "left_only")
    return (
        a.join(b, key, "full")
        .groupBy(side.otherwise("right_only").alias("coverage"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def registry_join(registry: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Full join of a registry with the distinct rows observed for its key.

    Observations are made distinct before the join, so one much-seen key is one row, not a
    hot partition that a full join could not split.
    """
    return registry.join(seen.distinct(), key, "full")
