"""Filters, ordering and top-k over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldlab.catalog.registry import BLANKS, query
from fieldlab.functions.text import fragments
from fieldlab.operators import aggregates, filters
from fieldlab.operators.skew import sort_columns


@query("f1_key_present", """
SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE user_id END AS tag FROM events
WHERE event_type <> 'error'""")
def key_present(t):
    tagged = t.events.select("event_id", F.when(F.col("event_type") != "error", F.col("user_id")).alias("tag"))
    return tagged.filter(F.col("tag").isNotNull())


@query("f2_date_bound", "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01'")
def date_bound(t):
    return t.orders.filter(F.col("o_orderdate") > F.lit("1998-01-01").cast("timestamp_ntz")).select(
        "o_orderkey", "o_orderdate"
    )


@query("f3_date_slider", """
SELECT o_orderkey, o_orderdate FROM orders
WHERE o_orderdate >= TIMESTAMP '1996-03-01' AND o_orderdate < TIMESTAMP '1997-04-01'""")
def date_slider(t):
    return filters.between_dates(t.orders, "o_orderdate", "1996-03-01", "1997-03-31").select("o_orderkey", "o_orderdate")


@query("f4_date_between_sql", """
SELECT o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-07-01' AND DATE '1997-07-31'""")
def date_between(t):
    t.register("orders")
    return t.spark.sql(
        "SELECT o_orderkey FROM orders WHERE DATE(o_orderdate) BETWEEN '1997-07-01' AND '1997-07-31'"
    )


@query("f5_membership", """
SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH')""")
def membership(t):
    return t.orders.filter(
        (F.col("o_orderstatus") == "F") & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    ).select("o_orderkey")


@query("f6_facet_filter", """
SELECT * FROM orders WHERE o_orderstatus IN ('F', 'P') AND o_orderpriority IN ('5-LOW')""")
def facets_chosen(t):
    return filters.facet_filter(
        t.orders, {"o_orderstatus": ["F", "P"], "o_orderpriority": ["5-LOW"], "o_custkey": [], "gone": ["x"]}
    )


@query("f7_text_pattern", r"""
SELECT doc_id FROM documents WHERE regexp_matches(text, '(?i)nd?est|the w|couldn.?t')""")
def text_pattern(t):
    return t.documents.filter(F.col("text").rlike("(?i)nd?est|the w|couldn.?t")).select("doc_id")


@query("f8_outliers", """
SELECT p_type, CAST(count(*) FILTER (p_size > 40) AS BIGINT) AS wide,
  CAST(count(*) FILTER (p_retailprice > 950) AS BIGINT) AS deep FROM part GROUP BY 1""")
def outliers(t):
    return t.part.groupBy("p_type").agg(
        F.count_if(F.col("p_size") > 40).alias("wide"), F.count_if(F.col("p_retailprice") > 950).alias("deep")
    )


_SPARSE = """SELECT event_id, CASE WHEN event_type = 'click' THEN user_id END AS a,
  CASE WHEN user_id % 2 = 0 THEN value END AS b FROM events"""


def _sparse(t):
    return t.events.select(
        "event_id",
        F.when(F.col("event_type") == "click", F.col("user_id")).alias("a"),
        F.when(F.col("user_id") % 2 == 0, F.col("value")).alias("b"),
    )


@query("f9_complete_rows", f"SELECT * FROM ({_SPARSE}) WHERE a IS NOT NULL AND b IS NOT NULL")
def complete_rows(t):
    return _sparse(t).dropna("any")


@query("f10_any_value", f"SELECT * FROM ({_SPARSE}) WHERE a IS NOT NULL OR b IS NOT NULL")
def any_value(t):
    return filters.any_present(_sparse(t), ["a", "b"])


@query("f11_not_both_zero", f"""
SELECT event_id, a0, b0 FROM (SELECT event_id, CASE WHEN a % 3 = 0 THEN 0 ELSE a END AS a0,
  CASE WHEN b < 100 THEN 0 ELSE b END AS b0 FROM ({_SPARSE})) WHERE NOT (a0 = 0 AND b0 = 0)""")
def not_both_zero(t):
    zeros = _sparse(t).select(
        "event_id",
        F.when(F.col("a") % 3 == 0, F.lit(0).cast("long")).otherwise(F.col("a")).alias("a0"),
        F.when(F.col("b") < 100, F.lit(0.0)).otherwise(F.col("b")).alias("b0"),
    )
    return zeros.filter(~((F.col("a0") == 0) & (F.col("b0") == 0)))


@query("f12_no_blank_parts", f"""
SELECT doc_id, count(*) AS parts FROM (
  SELECT doc_id, trim(unnest(string_split(text, '.')), {BLANKS}) AS part FROM documents) WHERE part <> '' GROUP BY 1""")
def no_blank_parts(t):
    return t.documents.select("doc_id", F.size(fragments("text")).cast("long").alias("parts")).filter("parts > 0")


@query("f13_either_measure", f"SELECT event_id FROM ({_SPARSE}) WHERE a IS NOT NULL OR b IS NOT NULL")
def either_measure(t):
    return _sparse(t).filter(F.col("a").isNotNull() | F.col("b").isNotNull()).select("event_id")


LINE_ORDER = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
              "l_returnflag", "l_linestatus", "l_shipdate"]


@query("f14_repeated_keys", f"""
SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY {', '.join(LINE_ORDER)}) AS k FROM lineitem) WHERE k > 1""")
def repeated_keys(t):
    return filters.repeated_rows(t.lineitem, ["l_orderkey", "l_linenumber"], LINE_ORDER)


@query("f15_without_category", """
SELECT event_type, count(*) AS n FROM events WHERE event_type <> 'error' GROUP BY 1""")
def without_category(t):
    return aggregates.counts(t.events.filter(F.col("event_type") != "error"), "event_type")


@query("t1_order_nulls_last", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate END AS date FROM orders
ORDER BY date NULLS LAST, o_orderkey""")
def order_nulls_last(t):
    dated = t.orders.select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("date")
    )
    return dated.orderBy(*sort_columns(["date", "o_orderkey"]))


@query("t2_top_categories", """
SELECT user_id, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, user_id LIMIT 6""")
def top_categories(t):
    return aggregates.top_categories(t.events, "user_id", 6)


@query("t3_first_rows_per_group", """
SELECT event_id, user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type
  ORDER BY event_id) AS k FROM events) WHERE k <= 3""")
def first_rows(t):
    picked = t.events.select("event_id", "user_id", "event_type")
    return aggregates.keep_first(picked, ["user_id", "event_type"], ["event_id"], 3)


@query("t4_row_of_maximum", "SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1")
def row_of_maximum(t):
    return t.orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(1)


@query("t5_latest_dates", """
SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders ORDER BY date DESC LIMIT 3""")
def latest_dates(t):
    return t.orders.select(F.to_date("o_orderdate").alias("date")).distinct().orderBy(F.desc("date")).limit(3)
