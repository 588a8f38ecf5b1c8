"""Counts, shares, totals, reconciliation and first-value collapses.

All of these combine on the map side, so a hot group costs each task one row per group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldlab.functions.numbers import as_column, row_sum, tolerant_sum, to_number
from fieldlab.functions.text import STOP_WORDS, words
from fieldlab.operators.skew import numbered, sort_columns


def counts(df: DataFrame, *by: str | Column, name: str = "n") -> DataFrame:
    """Rows per group; null is a group."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(name))


def ranked_counts(df: DataFrame, by: str, name: str = "n") -> DataFrame:
    """Rows per group, most frequent first, ties by value."""
    return counts(df, by, name=name).orderBy(F.desc(name), F.col(by).asc_nulls_last())


def shares(
    df: DataFrame, *by: str, scale: float = 100.0, digits: int | None = None, name: str = "percent"
) -> DataFrame:
    """Count per group and its share of all rows.

    The total is a scalar sub-query over the grouped counts, not a window without keys.
    """
    n = counts(df, *by)
    share = F.col("n") / n.agg(F.sum("n")).scalar() * scale
    return n.withColumn(name, share if digits is None else F.round(share, digits))


def tolerant_totals(df: DataFrame, columns: list[str], by: list[str] = (), prefix: str = "sum_") -> DataFrame:
    """Per group, the sum of every listed column over values that are numbers; 0 if none is."""
    return df.groupBy(*by).agg(*[tolerant_sum(c).alias(prefix + c) for c in columns])


def reconcile(
    df: DataFrame, components: list[str], reported: str, by: list[str] = ()
) -> DataFrame:
    """Component sums against a reported total and their difference."""
    return (
        df.groupBy(*by)
        .agg(
            F.coalesce(F.sum(row_sum([to_number(c) for c in components])), F.lit(0.0)).alias("component_total"),
            tolerant_sum(reported).alias("reported_total"),
        )
        .withColumn("difference", F.col("component_total") - F.col("reported_total"))
    )


def catch_totals(df: DataFrame, caught: str | Column, retained: str | Column, by: list = ()) -> DataFrame:
    """Caught, retained and released (caught minus retained)."""
    return (
        df.groupBy(*by)
        .agg(
            F.coalesce(F.sum(caught), F.lit(0)).alias("caught"),
            F.coalesce(F.sum(retained), F.lit(0)).alias("retained"),
        )
        .withColumn("released", F.col("caught") - F.col("retained"))
    )


def first_known(df: DataFrame, keys: list[str], order: str, columns: list[str] | None = None) -> DataFrame:
    """One row per key; each column takes its first non-null value in source order."""
    columns = columns or [c for c in df.columns if c not in keys and c != order]
    return df.groupBy(*keys).agg(
        *[F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in columns]
    )


def first_and_sums(
    df: DataFrame, keys: list[str], order: str, firsts: list[str], sums: list[str]
) -> DataFrame:
    """Per key, the first value of some columns (nulls count) and the sums of others."""
    return df.groupBy(*keys).agg(
        *[F.min_by(c, order).alias(c) for c in firsts],
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums],
    )


def keep_first(df: DataFrame, keys: list[str], order: list[str], k: int = 1) -> DataFrame:
    """The first ``k`` full rows of each key.

    Spark limits each map task to ``k`` rows per key before the shuffle, so hot keys stay small.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*sort_columns(order)))
    return df.withColumn("_place", place).filter(F.col("_place") <= k).drop("_place")


def top_categories(df: DataFrame, by: str, k: int = 6) -> DataFrame:
    return ranked_counts(df, by).limit(k)


def complete_counts(df: DataFrame, a: str, b: str, block: int = 1000) -> DataFrame:
    """Counts for every combination of the values of two columns, 0 where none occurs.

    The levels of ``b`` are numbered and packed into blocks; every level of ``a`` meets each block by its number, then the
    block is written out. A row holds ``block`` levels at most, whatever their number.
    """
    n = counts(df.dropna(subset=[a, b]), a, b)
    levels = numbered(df.select(b).dropna().distinct().withColumn("_one", F.lit(1)), [], [b], "_k")
    blocks = levels.groupBy(F.floor((F.col("_k") - 1) / block).alias("_block")).agg(F.collect_list(b).alias("_levels"))
    last = F.floor((df.select(F.countDistinct(b)).scalar() - 1) / block)
    each = F.when(last >= 0, F.sequence(F.lit(0).cast("long"), last))
    firsts = df.select(a).dropna().distinct().select(a, F.explode(each).alias("_block"))
    grid = firsts.join(blocks, "_block").select(a, F.explode("_levels").alias(b))
    return grid.join(n, [a, b], "left").fillna(0, ["n"])


def facets(df: DataFrame, most: int = 10) -> DataFrame:
    """Columns with 1 to ``most`` distinct values, and those values as text with counts.

    One sketch pass rules out columns that certainly have more: with k distinct values at most
    k registers of the sketch are set, so a small k cannot give a large estimate. Only the
    remaining few-valued columns are counted exactly.
    """
    sure = 64 + 2 * most
    estimate = df.agg(*[F.approx_count_distinct(c, 0.05).alias(c) for c in df.columns]).first()
    few = [c for c in df.columns if 1 <= estimate[c] <= sure]
    if not few:
        return df.sparkSession.createDataFrame([], "variable string, value string, n long")
    long = df.select(*[F.col(c).cast("string").alias(c) for c in few]).unpivot([], few, "variable", "value")
    n = counts(long.dropna(), "variable", "value")
    wanted = n.groupBy("variable").agg(F.count(F.lit(1)).alias("_levels")).filter(F.col("_levels") <= most)
    return n.join(wanted.select("variable"), "variable", "left_semi")


def term_counts(
    df: DataFrame, text: str, shortest: int = 3, least: int = 2, top: int | None = 100
) -> DataFrame:
    """Frequent words of a text column: function words left out, rare words cut, top kept."""
    token = df.select(F.explode(words(text)).alias("word")).filter(F.length("word") >= shortest)
    n = counts(token.filter(~F.col("word").isin(STOP_WORDS)), "word", name="freq")
    n = n.filter(F.col("freq") >= least)
    return n if top is None else n.orderBy(F.desc("freq"), "word").limit(top)


def distance_bins(df: DataFrame, km: str, width: int = 50) -> DataFrame:
    """Rows per distance bin with labels; empty bins do not occur.

    Bins are closed on the left. The last full bin also takes the remainder up to the maximum.
    """
    most = df.agg(F.max(km)).scalar()
    last = F.greatest(F.floor(most / width) - 1, F.lit(0))
    low = (F.least(F.floor(as_column(km) / width), last) * width).cast("long")
    label = F.concat(low.cast("string"), F.lit(" - "), (low + width).cast("string"))
    return counts(df.filter(F.col(km).isNotNull()), low.alias("low"), label.alias("distance_bin"))
