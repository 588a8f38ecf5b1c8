"""Quantiles, box-plot figures, histograms, line fits and density curves.

Quantiles are exact and interpolate between neighbours: position ``(n - 1) * p`` counted from 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlab.operators.reshape import to_long
from fieldlab.operators.skew import null_safe_join, running_sum


QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def quantiles(df: DataFrame, by: list[str], value: str, probs: dict[str, float]) -> DataFrame:
    """Exact quantiles per group, one column per named probability.

    Equal values are counted, the counts are summed up in value order by an ordered scan, so a group's values lie in as many
    pieces as they need, and the values at the wanted positions are picked.
    """
    by = list(by)
    present = df.filter(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("_v"))
    n = present.groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_n"))
    upto = running_sum(n, by, ["_v"], "_n", "_upto", source=present, count=True)
    size = present.groupBy(*by).agg(F.count(F.lit(1)).alias("_size"))
    sized = null_safe_join(upto, size, by, "inner") if by else upto.withColumn("_size", size.scalar())
    picks, wanted = [], F.lit(False)
    for name, p in probs.items():
        h = (F.col("_size") - 1) * F.lit(float(p))
        for side, at in (("lo", F.floor(h)), ("hi", F.ceil(h))):
            here = (F.col("_upto") - F.col("_n") <= at) & (at < F.col("_upto"))
            wanted = wanted | here
            picks.append(F.max(F.when(here, F.col("_v"))).alias(f"_{side}_{name}"))
        picks.append(F.max(h - F.floor(h)).alias(f"_w_{name}"))
    table = sized.filter(wanted).groupBy(*by).agg(*picks)
    blend = [
        (F.col(f"_lo_{q}") + (F.col(f"_hi_{q}") - F.col(f"_lo_{q}")) * F.col(f"_w_{q}")).alias(q)
        for q in probs
    ]
    return table.select(*by, *blend)


def summary(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: count, missing, minimum, quartiles, mean and maximum, as one row each."""

    def one(c):
        x = F.col(c).cast("double")
        return F.struct(
            F.lit(c).alias("variable"),
            F.count(c).alias("n"),
            F.sum(F.col(c).isNull().cast("long")).alias("missing"),
            F.min(x).alias("min"),
            F.avg(x).alias("mean"),
            F.max(x).alias("max"),
        )

    rows = df.agg(F.array(*[one(c) for c in columns]).alias("_rows")).select(F.inline("_rows"))
    long = to_long(df, [], columns, kind="double")
    middle = quantiles(long, ["variable"], "value", QUARTILES)
    return rows.join(middle, "variable", "left").select(
        "variable", "n", "missing", "min", "q1", "median", "mean", "q3", "max"
    )


def box_stats(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Quartiles, whiskers (last values within 1.5 interquartile ranges) and outlier count.

    Whiskers and outliers come from the counts of distinct values, not from the rows again.
    """
    quartile = quantiles(df, by, value, QUARTILES)
    counted = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n"))
    full = null_safe_join(counted, quartile, by, "inner")
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    x = F.col(value)
    inside = (x >= F.col("q1") - reach) & (x <= F.col("q3") + reach)
    return full.groupBy(*by).agg(
        F.sum("_n").alias("n"),
        *[F.max(q).alias(q) for q in QUARTILES],
        F.min(F.when(inside, x)).alias("whisker_low"),
        F.max(F.when(inside, x)).alias("whisker_high"),
        F.sum(F.when(~inside, F.col("_n")).otherwise(0)).alias("outliers"),
    )


def width_histogram(df: DataFrame, value: str, width: float, by: list[str] = ()) -> DataFrame:
    """Counts in bins ``(k*width, (k+1)*width]``; the lowest edge belongs to the first bin."""
    lowest = F.floor(df.agg(F.min(value)).scalar() / width)
    bin_no = F.greatest(F.ceil(F.col(value) / width) - 1, lowest).cast("long")
    return (
        df.filter(F.col(value).isNotNull())
        .groupBy(*by, bin_no.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("low", F.col("bin") * F.lit(float(width)))
    )


def bins_histogram(df: DataFrame, value: str, bins: int = 30, by: list[str] = ()) -> DataFrame:
    """Counts in ``bins`` equal bins, the first centred on the minimum, right edge included.

    All groups share the bins. If all values are equal the bin width is 0.1.
    """
    low, high = df.agg(F.min(value)).scalar(), df.agg(F.max(value)).scalar()
    width = F.when(high > low, (high - low) / (bins - 1)).otherwise(F.lit(0.1))
    bin_no = (F.ceil((F.col(value) - low) / width + 0.5) - 1).cast("long")
    return (
        df.filter(F.col(value).isNotNull())
        .groupBy(*by, bin_no.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("centre", low + F.col("bin") * width)
    )


def line_fit(df: DataFrame, x: str, y: str, by: list[str] = ()) -> DataFrame:
    """Least-squares slope and intercept of ``y`` on ``x`` and the number of pairs."""
    return df.groupBy(*by).agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_count(y, x).alias("pairs"),
    )


def density(df: DataFrame, by: list[str], value: str, grid: int = 512) -> DataFrame:
    """Gaussian density curve per group on ``grid`` equal steps over the range of all rows.

    Each value shares its weight between its two neighbouring grid points, so the data shrink to
    at most ``grid`` weights per group before the kernel is applied. The bandwidth is
    ``0.9 * min(sd, iqr / 1.34) * n ** -0.2``; without spread the size of the group's smallest value takes the place of
    the spread, or 1 for zero. If all values are equal, the grid has the width of one.
    """
    present = df.filter(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("_x"))
    low, high = present.agg(F.min("_x")).scalar(), present.agg(F.max("_x")).scalar()
    step = F.when(high > low, high - low).otherwise(F.lit(1.0)) / (grid - 1)
    iqr = quantiles(present, by, "_x", QUARTILES)
    spread = present.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_n"), F.stddev_samp("_x").alias("_sd"), F.abs(F.min("_x")).alias("_size")
    )
    narrow = F.least(F.col("_sd"), (F.col("q3") - F.col("q1")) / 1.34)
    scale = F.when(narrow > 0, narrow).when(F.col("_sd") > 0, F.col("_sd")).when(F.col("_size") > 0, F.col("_size")).otherwise(F.lit(1.0))
    width = null_safe_join(spread, iqr, by, "inner").select(
        *by, "_n", (scale * 0.9 * F.pow("_n", F.lit(-0.2))).alias("_bw")
    )
    at = (F.col("_x") - low) / step
    cell = F.least(F.floor(at), F.lit(grid - 2)).cast("int")
    placed = present.select(*by, cell.alias("_i"), (at - cell).alias("_w"))
    both = F.array(
        F.struct(F.col("_i").alias("i"), (1 - F.col("_w")).alias("w")),
        F.struct((F.col("_i") + 1).alias("i"), F.col("_w").alias("w")),
    )
    weights = (
        placed.select(*by, F.inline(both))
        .groupBy(*by, "i")
        .agg(F.sum("w").alias("w"))
        .groupBy(*by)
        .agg(F.array_sort(F.collect_list(F.struct("i", "w"))).alias("_points"))
    )
    # At most ``grid`` points per group from here on. The kernel depends on the distance of two grid points only: one table
    # of ``grid`` values per group, then products and sums.
    curve = null_safe_join(weights, width, by, "inner").withColumn("_step", step)
    steps = F.sequence(F.lit(0), F.lit(grid - 1))
    kernel = F.transform(steps, lambda d: F.exp(-0.5 * F.pow(d * F.col("_step") / F.col("_bw"), F.lit(2.0))))

    def mass(kernel: Column) -> Column:
        return F.transform(
            steps,
            lambda j: F.aggregate("_points", F.lit(0.0), lambda total, p: total + p["w"] * F.get(kernel, F.abs(j - p["i"]))),
        )

    # The table is bound by an array of one, so that it is made once per group.
    masses = F.get(F.transform(F.array(kernel), mass), F.lit(0))
    return (
        curve.select(*by, "_n", "_bw", "_step", F.posexplode(masses).alias("point", "_mass"))
        .withColumn("x", low + F.col("point") * F.col("_step"))
        .withColumn("density", F.col("_mass") / (F.col("_n") * F.col("_bw") * (2 * 3.141592653589793) ** 0.5))
        .select(*by, "point", "x", "density")
    )
