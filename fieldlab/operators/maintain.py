"""Table maintenance as functions from stored table and batch to new table state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldlab.operators.aggregates import counts, keep_first
from fieldlab.operators.shape import typed
from fieldlab.operators.windows import next_keys


class KeyConflict(ValueError):
    """A batch repeats a key or holds one that is already stored."""


def key_conflicts(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of the batch that are stored already or occur more than once in it."""
    known = [F.col(c).isNotNull() for c in keys]
    batch_keys = batch.select(*keys)
    for k in known:
        batch_keys = batch_keys.filter(k)
    n = counts(batch_keys, *keys)
    stored = n.join(target.select(*keys), keys, "left_semi").select(*keys)
    return stored.unionByName(n.filter("n > 1").select(*keys)).distinct()


def append_unique(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Target plus batch; the whole batch is refused on any key conflict."""
    if not key_conflicts(target, batch, keys).isEmpty():
        raise KeyConflict(f"batch conflicts with stored keys {keys}")
    return target.unionByName(batch, allowMissingColumns=True)


def new_rows(target: DataFrame, batch: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Batch rows whose key is not stored, first row per key; a missing key part never conflicts."""
    keyless = F.lit(False)
    for c in keys:
        keyless = keyless | F.col(c).isNull()
    keyed = keep_first(batch.filter(~keyless), keys, order)
    fresh = keyed.join(target.select(*keys), keys, "left_anti").select(*batch.columns)
    return fresh.unionByName(batch.filter(keyless))


def insert_or_ignore(target: DataFrame, batch: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Target plus those batch rows whose key it does not hold yet."""
    return target.unionByName(new_rows(target, batch, keys, order), allowMissingColumns=True)


def with_added_columns(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Stack a batch that brings new columns; older rows get null there."""
    return target.unionByName(batch, allowMissingColumns=True)


def update_where(df: DataFrame, predicate: Column, values: dict[str, Column]) -> DataFrame:
    """Set columns where the predicate is true; unknown counts as not true."""
    hit = F.coalesce(predicate, F.lit(False))
    return df.withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in values.items()})


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """Drop rows for which the predicate is true; unknown keeps the row."""
    return df.filter(~F.coalesce(predicate, F.lit(False)))


def register_new(
    registry: DataFrame, seen: DataFrame, text: str, key: str
) -> DataFrame:
    """Registry plus texts not registered yet; their ids continue from the largest id."""
    fresh = seen.select(text).dropna().distinct().join(registry.select(text), text, "left_anti")
    return registry.select(key, text).unionByName(
        next_keys(fresh, registry, key, [text]).select(key, text)
    )


def load_check(staged: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Staged keys, how many of them are stored now, and how many are missing."""
    distinct = staged.select(*keys).distinct()
    found = stored.select(*keys).distinct().withColumn("_found", F.lit(1))
    return distinct.join(found, keys, "left").agg(
        F.count(F.lit(1)).alias("staged"),
        F.count("_found").alias("stored"),
        (F.count(F.lit(1)) - F.count("_found")).alias("missing"),
    )


def load(
    target: DataFrame, df: DataFrame, keys: list[str], schema: T.StructType | None = None
) -> tuple[DataFrame, DataFrame]:
    """A loader for any table: the target with the batch, and the check that every staged key is stored.

    Columns of the batch are brought to the target's (or the given) types; other columns are left out. The whole batch
    is refused on any key conflict.
    """
    staged = typed(df, schema or target.schema)
    stored = append_unique(target, staged, keys)
    return stored, load_check(staged, stored, keys)
