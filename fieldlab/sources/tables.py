"""Reading stored tables and looking across them."""

from __future__ import annotations

import re
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Store:
    """Parquet tables of one folder as attributes, read lazily: ``store.orders``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.table(name)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}.parquet")

    def register(self, *names: str) -> None:
        """Make tables available to SQL as temporary views."""
        for name in names:
            self.table(name).createOrReplaceTempView(name)


def tables_like(spark: SparkSession, pattern: str) -> dict[str, DataFrame]:
    """Every table or view of the session whose name matches, by name."""
    names = sorted(t.name for t in spark.catalog.listTables() if re.search(pattern, t.name))
    return {name: spark.table(name) for name in names}


def profile_tables(tables: Mapping[str, DataFrame], distinct: str | None = None) -> DataFrame:
    """Rows and nulls per table and column, one pass per table.

    ``distinct`` adds the number of different values: ``approx`` by sketches, or ``exact``. The exact form makes a row of
    (table, column, digest of the value) for each cell; equal ones are counted on the map side before the only shuffle, which
    all tables share. Every table is read once.
    """
    if distinct == "exact":
        return _exact_profile(tables)

    def one(name: str, df: DataFrame) -> DataFrame:
        rows = []
        for c in df.columns:
            fields = [
                F.lit(name).alias("table_name"),
                F.lit(c).alias("column_name"),
                F.count(F.lit(1)).alias("n_rows"),
                (F.count(F.lit(1)) - F.count(F.col(c))).alias("nulls"),
            ]
            if distinct:
                fields.append(F.approx_count_distinct(F.col(c)).alias("distinct_values"))
            rows.append(F.struct(*fields))
        return df.agg(F.array(*rows).alias("_rows")).select(F.inline("_rows"))

    return reduce(DataFrame.unionByName, [one(n, d) for n, d in tables.items()])


def _digest(df: DataFrame, name: str) -> Column:
    """128 bits that tell values apart; null for null. Zero has one sign."""
    column = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        column = column + F.lit(0.0).cast(df.schema[name].dataType)
    text = F.hex(column) if isinstance(df.schema[name].dataType, T.BinaryType) else column.cast("string")
    return F.unhex(F.md5(text))


def _exact_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    spark = next(iter(tables.values())).sparkSession
    names = [(t, c) for t, df in tables.items() for c in df.columns]
    places = {pair: i for i, pair in enumerate(names)}
    cells = [
        df.select(F.inline(F.array(*[F.struct(F.lit(places[t, c]).alias("_i"), _digest(df, c).alias("_d")) for c in df.columns])))
        for t, df in tables.items()
    ]
    counted = reduce(DataFrame.union, cells).groupBy("_i", "_d").agg(F.count(F.lit(1)).alias("_n"))
    # A table without rows still has its columns.
    listed = spark.createDataFrame([(i, t, c) for (t, c), i in places.items()], "_i int, table_name string, column_name string")
    sums = counted.groupBy("_i").agg(
        F.sum("_n").alias("n_rows"), F.sum(F.when(F.col("_d").isNull(), F.col("_n")).otherwise(0)).alias("nulls"),
        F.count("_d").alias("distinct_values"),
    )
    return listed.join(sums, "_i", "left").drop("_i").fillna(0, ["n_rows", "nulls", "distinct_values"])


def tables_holding(tables: Mapping[str, DataFrame], column: str) -> dict[str, DataFrame]:
    return {name: df for name, df in tables.items() if column in df.columns}


def key_sightings(tables: Mapping[str, DataFrame], column: str) -> DataFrame:
    """Where each value of a key occurs: table, value (as text) and number of rows."""
    parts = [
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("string").alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(name).alias("table_name"), "value", "n")
        for name, df in tables_holding(tables, column).items()
    ]
    return reduce(DataFrame.unionByName, parts)
