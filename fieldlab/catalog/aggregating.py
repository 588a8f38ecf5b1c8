"""Counts, totals, distributions and fits over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldlab.catalog.registry import query
from fieldlab.functions.geo import lonlat_to_utm, padded_box
from fieldlab.functions.numbers import tolerant_sum
from fieldlab.functions.text import STOP_WORDS
from fieldlab.operators import aggregates, reshape, shape, stats, validate


def _rounded(df, digits=6):
    return df.select(*[
        F.round(c, digits).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes
    ])


@query("a1_count_with_null_group", """
SELECT CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS kind, count(*) AS n FROM events GROUP BY 1""")
def count_with_null_group(t):
    kind = F.when(F.col("event_type") != "error", F.col("event_type")).alias("kind")
    return aggregates.counts(t.events, kind)


@query("a2_count_descending", "SELECT user_id, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, user_id")
def count_descending(t):
    return aggregates.ranked_counts(t.events, "user_id")


@query("a3_shares", """
SELECT event_type, count(*) AS n, count(*) * 1.0::DOUBLE / (SELECT count(*) FROM events) * 100 AS percent
FROM events GROUP BY 1""")
def shares(t):
    return aggregates.shares(t.events, "event_type")


_TEXT_COLUMNS = ["l_quantity", "l_discount", "l_tax"]


def text_lines(t):
    """Line items with measures as text; the discount of returned lines is not a number."""
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("date"), F.year("l_shipdate").alias("year"),
        F.col("l_quantity").cast("int").cast("string").alias("l_quantity"),
        F.when(F.col("l_returnflag") == "R", "n/a").otherwise(F.col("l_discount").cast("string")).alias("l_discount"),
        F.when(F.col("l_linestatus") == "O", F.lit(None)).otherwise(F.concat(F.col("l_linenumber").cast("string"), F.lit("f"))).alias("l_tax"),
    )


_TEXT_LINES = """(SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS date, year(l_shipdate) AS year,
  CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS l_quantity,
  CASE WHEN l_returnflag = 'R' THEN 'n/a' ELSE CAST(l_discount AS VARCHAR) END AS l_discount,
  CASE WHEN l_linestatus = 'O' THEN NULL ELSE CAST(l_linenumber AS VARCHAR) || 'f' END AS l_tax FROM lineitem)"""


@query("a4_tolerant_totals_by_year", f"""
SELECT CAST(year AS INTEGER) AS year, COALESCE(sum(try_cast(l_quantity AS DOUBLE)), 0) AS sum_l_quantity,
  round(COALESCE(sum(try_cast(l_discount AS DOUBLE)), 0), 4) AS sum_l_discount,
  COALESCE(sum(try_cast(l_tax AS DOUBLE)), 0) AS sum_l_tax FROM {_TEXT_LINES} GROUP BY 1""")
def tolerant_totals_by_year(t):
    text = text_lines(t)
    columns = shape.matching(text, "^l_(quantity|discount|tax)$")
    return _rounded(aggregates.tolerant_totals(text, columns, ["year"]), 4)


@query("a5_grand_totals", f"""
SELECT sum(try_cast(l_quantity AS DOUBLE)) AS sum_l_quantity,
  round(sum(try_cast(l_discount AS DOUBLE)), 4) AS sum_l_discount FROM {_TEXT_LINES}""")
def grand_totals(t):
    return _rounded(aggregates.tolerant_totals(text_lines(t), ["l_quantity", "l_discount"]), 4)


@query("a6_reconcile", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, round(sum(COALESCE(q, 0) + COALESCE(p, 0)), 2) AS component_total,
  round(sum(o_totalprice), 2) AS reported_total,
  round(sum(COALESCE(q, 0) + COALESCE(p, 0)) - sum(o_totalprice), 2) AS difference
FROM orders LEFT JOIN (SELECT l_orderkey, sum(l_quantity) AS q, sum(l_extendedprice) AS p FROM lineitem GROUP BY 1)
ON l_orderkey = o_orderkey GROUP BY 1""")
def reconcile(t):
    fish = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum("l_quantity").alias("no_q_c"), F.sum("l_extendedprice").alias("no_p_c")
    )
    main = t.orders.join(fish, "o_orderkey", "left").withColumn("year", F.year("o_orderdate"))
    parts = shape.matching(main, "^no_.*_c$")
    return _rounded(aggregates.reconcile(main, parts, "o_totalprice", ["year"]), 2)


@query("a7_catch_totals_by_day", """
SELECT CAST(l_shipdate AS DATE) AS day, sum(l_quantity) AS caught,
  CAST(sum(l_linenumber) AS BIGINT) AS retained, sum(l_quantity) - sum(l_linenumber) AS released FROM lineitem GROUP BY 1""")
def catch_by_day(t):
    return aggregates.catch_totals(t.lineitem, "l_quantity", "l_linenumber", [F.to_date("l_shipdate").alias("day")])


@query("a8_effort_by_year", """
SELECT CAST(year(l_shipdate) AS INTEGER) AS year, sum(l_quantity) AS rods, CAST(sum(l_linenumber) AS BIGINT) AS person_hours
FROM lineitem GROUP BY 1""")
def effort_by_year(t):
    return t.lineitem.groupBy(F.year("l_shipdate").alias("year")).agg(
        F.sum("l_quantity").alias("rods"), F.sum("l_linenumber").alias("person_hours")
    )


@query("a9_hours_per_worker", "SELECT user_id AS surveyor, round(sum(value), 2) AS total_hours FROM events GROUP BY 1")
def hours_per_worker(t):
    return t.events.groupBy(F.col("user_id").alias("surveyor")).agg(F.round(F.sum("value"), 2).alias("total_hours"))


@query("a10_first_and_sums", """
SELECT o_custkey, arg_min(o_orderpriority, o_orderkey) AS o_orderpriority, arg_min(o_orderstatus, o_orderkey) AS o_orderstatus,
  round(sum(o_totalprice), 2) AS o_totalprice FROM orders GROUP BY 1""")
def first_and_sums(t):
    return _rounded(aggregates.first_and_sums(
        t.orders, ["o_custkey"], "o_orderkey", ["o_orderpriority", "o_orderstatus"], ["o_totalprice"]), 2)


@query("a11_survey_days_per_site", """
SELECT o_orderpriority AS site, count(DISTINCT o_orderdate) AS days_surveyed FROM orders GROUP BY 1""")
def survey_days(t):
    return t.orders.groupBy(F.col("o_orderpriority").alias("site")).agg(F.countDistinct("o_orderdate").alias("days_surveyed"))


@query("a12_values_per_period", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(CASE WHEN o_orderstatus <> 'P' THEN o_custkey END) AS not_na
FROM orders GROUP BY 1""")
def values_per_period(t):
    answer = F.when(F.col("o_orderstatus") != "P", F.col("o_custkey"))
    return t.orders.groupBy(F.year("o_orderdate").alias("year")).agg(F.count(answer).alias("not_na"))


@query("a13_bounds", "SELECT max(o_orderkey) AS top, min(o_orderdate) AS first, max(o_orderdate) AS last FROM orders")
def bounds(t):
    return t.orders.agg(
        F.max("o_orderkey").alias("top"), F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last")
    )


@query("a14_conditional_shares", """
SELECT l_returnflag, CAST(count(*) FILTER (d >= 1) AS BIGINT) AS released, CAST(count(*) FILTER (d <= 0) AS BIGINT) AS kept,
  count(*) FILTER (d >= 1) * 1.0::DOUBLE / count(*) * 100 AS released_percent
FROM (SELECT l_returnflag, l_quantity - 4 * l_linenumber AS d FROM lineitem) GROUP BY 1""")
def conditional_shares(t):
    d = F.col("l_quantity") - 4 * F.col("l_linenumber")
    return t.lineitem.groupBy("l_returnflag").agg(
        F.count_if(d >= 1).alias("released"), F.count_if(d <= 0).alias("kept"),
        (F.count_if(d >= 1) / F.count(F.lit(1)) * 100).alias("released_percent"),
    )


@query("a15_distinct_values", "SELECT DISTINCT event_type FROM events")
def distinct_values(t):
    return t.events.select("event_type").distinct()


@query("a16_distinct_pairs", "SELECT DISTINCT user_id, event_type FROM events")
def distinct_pairs(t):
    return t.events.select("user_id", "event_type").distinct()


_SUMMARY = """SELECT '{0}' AS variable, count({0}) AS n, count(*) - count({0}) AS missing, min({0}) AS min,
  round(quantile_cont({0}, 0.25), 6) AS q1, round(quantile_cont({0}, 0.5), 6) AS median, round(avg({0}), 6) AS mean,
  round(quantile_cont({0}, 0.75), 6) AS q3, max({0}) AS max FROM lineitem"""


@query("a17_five_numbers", " UNION ALL ".join(_SUMMARY.format(c) for c in ("l_quantity", "l_extendedprice", "l_tax")))
def five_numbers(t):
    return _rounded(stats.summary(t.lineitem, ["l_quantity", "l_extendedprice", "l_tax"]))


@query("a18_first_known", """
SELECT user_id, CAST(ts AS DATE) AS date, arg_min(value, event_id) FILTER (event_type <> 'view') AS value,
  arg_min(props, event_id) FILTER (value > 50) AS props FROM events GROUP BY 1, 2""")
def first_known(t):
    holes = t.events.select(
        "user_id", F.to_date("ts").alias("date"), "event_id",
        F.when(F.col("event_type") != "view", F.col("value")).alias("value"),
        F.when(F.col("value") > 50, F.col("props")).alias("props"),
    )
    return aggregates.first_known(holes, ["user_id", "date"], "event_id")


@query("a19_keep_first_row", """
SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS k FROM events)
WHERE k = 1""")
def keep_first_row(t):
    return aggregates.keep_first(t.events, ["user_id", "event_type"], ["event_id"])


@query("a20_width_histogram", """
SELECT CAST(greatest(ceil(p_retailprice / 10) - 1, (SELECT floor(min(p_retailprice) / 10) FROM part)) AS BIGINT) AS bin,
  count(*) AS n, greatest(ceil(p_retailprice / 10) - 1, (SELECT floor(min(p_retailprice) / 10) FROM part)) * 10.0::DOUBLE AS low
FROM part GROUP BY 1, 3""")
def width_histogram(t):
    return stats.width_histogram(t.part, "p_retailprice", 10)


@query("a21_bins_histogram", """
WITH r AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem)
SELECT l_returnflag, CAST(ceil((l_extendedprice - lo) / ((hi - lo) / 29) + 0.5) - 1 AS BIGINT) AS bin, count(*) AS n,
  round(lo + (ceil((l_extendedprice - lo) / ((hi - lo) / 29) + 0.5) - 1) * ((hi - lo) / 29), 6) AS centre
FROM lineitem, r GROUP BY 1, 2, 4""")
def bins_histogram(t):
    return _rounded(stats.bins_histogram(t.lineitem, "l_extendedprice", 30, ["l_returnflag"]))


@query("a22_day_and_hour_counts", """
SELECT 'day' AS unit, CAST(CAST(ts AS DATE) AS VARCHAR) AS value, count(*) AS n FROM events GROUP BY 2
UNION ALL SELECT 'hour', CAST(hour(ts) AS VARCHAR), count(*) FROM events GROUP BY 2""")
def day_and_hour(t):
    days = aggregates.counts(t.events, F.to_date("ts").cast("string").alias("value"))
    hours = aggregates.counts(t.events, F.hour("ts").cast("string").alias("value"))
    return days.select(F.lit("day").alias("unit"), "value", "n").unionByName(
        hours.select(F.lit("hour").alias("unit"), "value", "n")
    )


@query("a23_count_matrix", "SELECT event_type, user_id, count(*) AS n FROM events GROUP BY 1, 2")
def count_matrix(t):
    return aggregates.counts(t.events, "event_type", "user_id")


@query("a24_detections_ranked", """
SELECT event_type AS station, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, 1""")
def detections_ranked(t):
    return aggregates.ranked_counts(t.events.select(F.col("event_type").alias("station")), "station")


@query("a25_box_stats", """
WITH q AS (SELECT p_brand, quantile_cont(p_retailprice * p_size, 0.25) AS q1, quantile_cont(p_retailprice * p_size, 0.5) AS median,
  quantile_cont(p_retailprice * p_size, 0.75) AS q3 FROM part GROUP BY 1),
x AS (SELECT p_brand, p_retailprice * p_size AS v, q1, median, q3,
  v >= q1 - 1.5 * (q3 - q1) AND v <= q3 + 1.5 * (q3 - q1) AS inside FROM part JOIN q USING (p_brand))
SELECT p_brand, count(*) AS n, round(max(q1), 6) AS q1, round(max(median), 6) AS median, round(max(q3), 6) AS q3,
  round(min(v) FILTER (inside), 6) AS whisker_low, round(max(v) FILTER (inside), 6) AS whisker_high,
  CAST(count(*) FILTER (NOT inside) AS BIGINT) AS outliers FROM x GROUP BY 1""")
def box_stats(t):
    valued = t.part.select("p_brand", (F.col("p_retailprice") * F.col("p_size")).alias("v"))
    return _rounded(stats.box_stats(valued, ["p_brand"], "v"))


@query("a26_line_fit", """
SELECT l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 6) AS slope,
  round(regr_intercept(l_extendedprice, l_quantity), 6) AS intercept, CAST(regr_count(l_extendedprice, l_quantity) AS BIGINT) AS pairs
FROM lineitem GROUP BY 1""")
def line_fit(t):
    return _rounded(stats.line_fit(t.lineitem, "l_quantity", "l_extendedprice", ["l_returnflag"]))


@query("a27_density", """
WITH r AS (SELECT min(p_retailprice) AS lo, (max(p_retailprice) - min(p_retailprice)) / 127 AS step FROM part),
s AS (SELECT p_type, count(*) AS n, stddev_samp(p_retailprice) AS sd,
  quantile_cont(p_retailprice, 0.75) - quantile_cont(p_retailprice, 0.25) AS iqr FROM part GROUP BY 1),
b AS (SELECT p_type, n, 0.9 * least(sd, iqr / 1.34) * pow(n, -0.2) AS bw FROM s),
p AS (SELECT p_type, least(floor((p_retailprice - lo) / step), 126) AS i,
  (p_retailprice - lo) / step - least(floor((p_retailprice - lo) / step), 126) AS w FROM part, r),
g AS (SELECT p_type, i, sum(w) AS w FROM (SELECT p_type, i, 1 - w AS w FROM p UNION ALL SELECT p_type, i + 1, w FROM p) GROUP BY 1, 2)
SELECT p_type, CAST(j AS INTEGER) AS point, round(lo + j * step, 6) AS x,
  round(sum(w * exp(-0.5 * ((j - i) * step / bw) * ((j - i) * step / bw))) / (n * bw * sqrt(2 * pi())), 9) AS density
FROM g JOIN b USING (p_type), r, range(128) grid(j) GROUP BY p_type, j, n, bw, lo, step""")
def density(t):
    curve = stats.density(t.part, ["p_type"], "p_retailprice", 128)
    return curve.withColumns({"x": F.round("x", 6), "density": F.round("density", 9)})


@query("a28_monthly_counts", """
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS total FROM orders GROUP BY 1""")
def monthly_counts(t):
    return aggregates.counts(t.orders, F.trunc(F.to_date("o_orderdate"), "month").alias("month"), name="total")


@query("a29_distance_bins", """
WITH m AS (SELECT greatest(floor(max(s_acctbal) / 50) - 1, 0) AS last FROM supplier),
b AS (SELECT CAST(least(floor(s_acctbal / 50), last) * 50 AS BIGINT) AS low FROM supplier, m)
SELECT low, CAST(low AS VARCHAR) || ' - ' || CAST(low + 50 AS VARCHAR) AS distance_bin, count(*) AS n FROM b GROUP BY 1, 2""")
def distance_bins(t):
    return aggregates.distance_bins(t.supplier, "s_acctbal")


@query("a30_contingency", "SELECT lang, source, count(*) AS n FROM documents GROUP BY 1, 2")
def contingency(t):
    return aggregates.counts(t.documents, "lang", "source")


@query("a31_complete_counts", """
SELECT a AS o_custkey, b AS o_orderpriority, count(o_orderkey) AS n
FROM (SELECT DISTINCT o_custkey AS a FROM orders), (SELECT DISTINCT o_orderpriority AS b FROM orders)
LEFT JOIN orders ON o_custkey = a AND o_orderpriority = b GROUP BY 1, 2""")
def complete_counts(t):
    return aggregates.complete_counts(t.orders, "o_custkey", "o_orderpriority")


@query("a32_facets", """
SELECT 'o_orderstatus' AS variable, o_orderstatus AS value, count(*) AS n FROM orders GROUP BY 2
UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders GROUP BY 2
UNION ALL SELECT 'year', CAST(year(o_orderdate) AS VARCHAR), count(*) FROM orders GROUP BY 2""")
def facets(t):
    return aggregates.facets(t.orders.withColumn("year", F.year("o_orderdate")))


_LONG = "SELECT date, unnest(['l_quantity', 'l_discount', 'l_tax']) AS variable, unnest([l_quantity, l_discount, l_tax]) AS value FROM " + _TEXT_LINES


@query("a33_conversion_profile", f"""
SELECT variable, n, present, converted, present - converted AS failed, converted > 0.5 * n AS numeric,
  converted > 0 AND converted >= 0.8 * present AS plottable
FROM (SELECT variable, count(*) AS n, count(value) AS present, count(try_cast(value AS DOUBLE)) AS converted FROM ({_LONG}) GROUP BY 1)""")
def conversion_profile(t):
    return validate.conversion_profile(text_lines(t), _TEXT_COLUMNS)


@query("a34_failed_values", f"""
SELECT date, variable, value FROM ({_LONG}) WHERE value IS NOT NULL AND try_cast(value AS DOUBLE) IS NULL""")
def failed_values(t):
    return validate.failed_values(text_lines(t), ["date"], _TEXT_COLUMNS)


@query("a35_values_by_day", f"SELECT variable, date, value, count(*) AS n FROM ({_LONG}) GROUP BY 1, 2, 3")
def values_by_day(t):
    return validate.values_by_day(text_lines(t), "date", _TEXT_COLUMNS)


@query("a36_term_counts", f"""
SELECT word, count(*) AS freq FROM (
  SELECT unnest(regexp_split_to_array(regexp_replace(lower(text), '[!-/:-@\\[-`{{-~0-9]', '', 'g'), '\\s+')) AS word FROM documents)
WHERE length(word) >= 3 AND word NOT IN ({', '.join(repr(w) for w in STOP_WORDS)})
GROUP BY 1 HAVING count(*) >= 2 ORDER BY freq DESC, word LIMIT 100""")
def term_counts(t):
    return aggregates.term_counts(t.documents, "text")


@query("a38_yearly_totals_long", f"""
SELECT CAST(year AS INTEGER) AS year, variable AS metric, round(COALESCE(sum(try_cast(value AS DOUBLE)), 0), 4) AS total FROM (
  SELECT year, unnest(['sum_l_quantity', 'sum_l_discount']) AS variable, unnest([l_quantity, l_discount]) AS value
  FROM {_TEXT_LINES}) GROUP BY 1, 2""")
def yearly_totals_long(t):
    wide = aggregates.tolerant_totals(text_lines(t), ["l_quantity", "l_discount"], ["year"])
    long = reshape.to_long(wide, ["year"], ["sum_l_quantity", "sum_l_discount"], "metric", "total", "double")
    return _rounded(long, 4)


@query("a39_totals_by_species_and_type", """
SELECT species, type, round(sum(v), 2) AS total FROM (
  SELECT unnest(['Smallmouth bass', 'Smallmouth bass', 'Kokanee salmon', 'Kokanee salmon']) AS species,
    unnest(['c', 'r', 'c', 'r']) AS type, unnest([l_quantity, l_discount, l_tax, 0]) AS v FROM lineitem) GROUP BY 1, 2""")
def totals_by_species(t):
    wide = t.lineitem.select(
        F.col("l_quantity").alias("NoSMBc"), F.col("l_discount").alias("NoSMBr"), F.col("l_tax").alias("NoKOc"),
        F.lit(None).cast("double").alias("NoKOr"),
    )
    long = reshape.to_long_split(wide, [], wide.columns, "^(No.*)(r|c)$", ["species", "type"])
    totals = long.groupBy("species", "type").agg(F.round(F.coalesce(F.sum("value"), F.lit(0.0)), 2).alias("total"))
    names = {"NoSMB": "Smallmouth bass", "NoKO": "Kokanee salmon"}
    return totals.withColumn("species", reshape.recoded("species", names))


@query("a40_sexed_share", """
SELECT l_linestatus, count(*) AS n, count(*) FILTER (l_returnflag IN ('A', 'R')) * 1.0::DOUBLE / count(*) AS sexed
FROM lineitem GROUP BY 1""")
def sexed_share(t):
    known = F.col("l_returnflag").isin("A", "R")
    return t.lineitem.groupBy("l_linestatus").agg(F.count("*").alias("n"), (F.count_if(known) / F.count(F.lit(1))).alias("sexed"))


_UTM = """
WITH pts AS ({points}),
k AS (SELECT *, 2 * sqrt(n) / (1 + n) AS e, 0.9996 * 6378137.0::DOUBLE / (1 + n) * (1 + n*n/4 + n*n*n*n/64) AS ka,
  n/2 - 2*n*n/3 + 5*n*n*n/16 + 41*n*n*n*n/180 AS a1, 13*n*n/48 - 3*n*n*n/5 + 557*n*n*n*n/1440 AS a2,
  61*n*n*n/240 - 103*n*n*n*n/140 AS a3, 49561*n*n*n*n/161280 AS a4 FROM
  (SELECT (1/298.257223563::DOUBLE) / (2 - 1/298.257223563::DOUBLE) AS n)),
p AS (SELECT id, sin(radians(lat)) AS sp, radians(lon + 123.0) AS lam FROM pts),
q AS (SELECT id, lam, sinh(atanh(sp) - e * atanh(e * sp)) AS tt FROM p, k),
u AS (SELECT id, atan2(tt, cos(lam)) AS xi, atanh(sin(lam) / sqrt(1 + tt * tt)) AS eta FROM q),
utm AS (SELECT id,
  500000.0 + ka * (eta + a1*cos(2*xi)*sinh(2*eta) + a2*cos(4*xi)*sinh(4*eta) + a3*cos(6*xi)*sinh(6*eta) + a4*cos(8*xi)*sinh(8*eta)) AS easting,
  ka * (xi + a1*sin(2*xi)*cosh(2*eta) + a2*sin(4*xi)*cosh(4*eta) + a3*sin(6*xi)*cosh(6*eta) + a4*sin(8*xi)*cosh(8*eta)) AS northing FROM u, k)
"""


def utm_sql(points: str) -> str:
    """WITH clause giving ``utm(id, easting, northing)`` for points ``(id, lon, lat)``."""
    return _UTM.format(points=points)


POINTS = "SELECT c_custkey AS id, -123.5 + c_acctbal / 10000 AS lon, 48 + (c_custkey % 1000) / 500.0::DOUBLE AS lat FROM customer"


def points(t):
    return t.customer.select(
        F.col("c_custkey").alias("id"), (F.lit(-123.5) + F.col("c_acctbal") / 10000).alias("lon"),
        (48 + (F.col("c_custkey") % 1000) / 500).alias("lat"),
    )


@query("a37_padded_box", utm_sql(POINTS) + """
SELECT round(min(easting) - 1000, 3) AS xmin, round(min(northing) - 1000, 3) AS ymin,
  round(max(easting) + 1000, 3) AS xmax, round(max(northing) + 1000, 3) AS ymax FROM utm""")
def padded_bounding_box(t):
    east, north = lonlat_to_utm("lon", "lat")
    projected = points(t).select(east.alias("x"), north.alias("y"))
    return _rounded(projected.agg(*padded_box("x", "y")), 3)
