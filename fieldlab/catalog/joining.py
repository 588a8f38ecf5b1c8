"""Joins over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldlab.catalog.registry import query
from fieldlab.operators import aggregates, joins
from fieldlab.operators.skew import ranked

_ANGLERS = """
anglers AS (SELECT c_custkey AS custkey, c_name AS name,
  CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_nationkey END AS nationkey FROM customer),
places AS (SELECT nullif(n_nationkey, 0) AS nationkey, n_name FROM nation)"""


def angler_tables(t):
    """Orders, customers and nations with equally named keys; some nation keys are missing."""
    orders = t.orders.select(
        F.col("o_orderkey").alias("orderkey"), F.col("o_custkey").alias("custkey"), F.col("o_orderstatus").alias("status")
    )
    anglers = t.customer.select(
        F.col("c_custkey").alias("custkey"), F.col("c_name").alias("name"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_nationkey")).alias("nationkey"),
    )
    places = t.nation.select(
        F.when(F.col("n_nationkey") != 0, F.col("n_nationkey")).alias("nationkey"), "n_name"
    )
    return orders, anglers, places


@query("j1_natural_join_all", f"""
WITH {_ANGLERS}
SELECT CAST(a.nationkey AS VARCHAR) AS nationkey, CAST(o_custkey AS VARCHAR) AS custkey,
  CAST(o_orderkey AS VARCHAR) AS orderkey, o_orderstatus AS status, name, n_name
FROM orders LEFT JOIN anglers a ON o_custkey = a.custkey
LEFT JOIN places p ON a.nationkey IS NOT DISTINCT FROM p.nationkey""")
def natural_join_all(t):
    return joins.natural_join_all(angler_tables(t))


@query("j2_inner_one_key", """
SELECT o_orderkey, o_custkey, o_totalprice, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey""")
def inner_one_key(t):
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "o_custkey", "o_totalprice", "c_name", "c_mktsegment"
    )


@query("j3_inner_two_keys", """
SELECT day, site, n, total FROM
  (SELECT CAST(o_orderdate AS DATE) AS day, o_orderpriority AS site, count(*) AS n FROM orders GROUP BY 1, 2)
JOIN (SELECT CAST(o_orderdate AS DATE) AS day, o_orderpriority AS site, round(sum(o_totalprice), 2) AS total
  FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2) USING (day, site)""")
def inner_two_keys(t):
    keyed = t.orders.select(
        F.to_date("o_orderdate").alias("day"), F.col("o_orderpriority").alias("site"), "o_orderstatus", "o_totalprice"
    )
    shifts = aggregates.counts(keyed, "day", "site")
    catch = keyed.filter("o_orderstatus = 'F'").groupBy("day", "site").agg(
        F.round(F.sum("o_totalprice"), 2).alias("total")
    )
    return shifts.join(catch, ["day", "site"])


@query("j4_lookup", "SELECT n_nationkey, n_name, n_regionkey, r_name FROM nation LEFT JOIN region ON n_regionkey = r_regionkey")
def lookup(t):
    return joins.lookup(t.nation, t.region, "n_regionkey", "r_regionkey")


@query("j5_left_chain", """
SELECT o_orderkey, o_custkey, l_linenumber, l_quantity, c_name FROM orders
LEFT JOIN lineitem ON l_orderkey = o_orderkey LEFT JOIN customer ON c_custkey = o_custkey""")
def left_chain(t):
    fish = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_quantity")
    anglers = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name")
    surveys = t.orders.select("o_orderkey", "o_custkey")
    return surveys.join(fish, "o_orderkey", "left").join(anglers, "o_custkey", "left")


@query("j6_registry_full_join", """
SELECT COALESCE(s_suppkey, k) AS suppkey, s_name, l_linestatus FROM supplier
FULL JOIN (SELECT DISTINCT l_suppkey + 5 AS k, l_linestatus FROM lineitem) ON s_suppkey = k""")
def registry_full_join(t):
    registry = t.supplier.select(F.col("s_suppkey").alias("suppkey"), "s_name")
    seen = t.lineitem.select((F.col("l_suppkey") + 5).alias("suppkey"), "l_linestatus")
    return joins.registry_join(registry, seen, "suppkey")


_DAILY = "SELECT CAST(ts AS DATE) AS day, nullif(user_id, 7) AS tag, count(*) AS n FROM events WHERE event_type = '{}' GROUP BY 1, 2"
_DAILY_SUM = """SELECT CAST(ts AS DATE) AS day, nullif(user_id, 7) AS tag, round(sum(value), 2) AS total
  FROM events WHERE event_type = 'error' GROUP BY 1, 2"""


def daily_tables(t):
    keyed = t.events.select(
        F.to_date("ts").alias("day"), F.when(F.col("user_id") != 7, F.col("user_id")).alias("tag"), "event_type", "value"
    )
    of = lambda kind: keyed.filter(F.col("event_type") == kind)
    total = of("error").groupBy("day", "tag").agg(F.round(F.sum("value"), 2).alias("total"))
    return aggregates.counts(of("click"), "day", "tag"), aggregates.counts(of("purchase"), "day", "tag"), total


@query("j7_full_join_suffixes", f"""
SELECT COALESCE(ab.day, c.day) AS day, CASE WHEN ab.day IS NULL THEN c.tag ELSE ab.tag END AS tag, n_x, n_y, total
FROM (SELECT COALESCE(a.day, b.day) AS day, CASE WHEN a.day IS NULL THEN b.tag ELSE a.tag END AS tag,
    a.n AS n_x, b.n AS n_y
  FROM ({_DAILY.format('click')}) a FULL JOIN ({_DAILY.format('purchase')}) b
  ON a.day = b.day AND COALESCE(a.tag, -1) = COALESCE(b.tag, -1)) ab
FULL JOIN ({_DAILY_SUM}) c ON ab.day = c.day AND COALESCE(ab.tag, -1) = COALESCE(c.tag, -1)""")
def full_join_suffixes(t):
    return joins.full_join_all(daily_tables(t), ["day", "tag"])


@query("j8_natural_full_join", f"""
SELECT COALESCE(a.day, c.day) AS day, CASE WHEN a.day IS NULL THEN c.tag ELSE a.tag END AS tag, clicks, total
FROM (SELECT day, tag, n AS clicks FROM ({_DAILY.format('click')})) a
FULL JOIN ({_DAILY_SUM}) c ON a.day = c.day AND COALESCE(a.tag, -1) = COALESCE(c.tag, -1)""")
def natural_full_join(t):
    clicks, _, total = daily_tables(t)
    timed = clicks.withColumnRenamed("n", "clicks").withColumn("time", F.lit("08:00"))
    return joins.natural_full_join_all([timed, total.withColumn("time", F.lit("09:00"))])


@query("j9_merge_suffixes", """
SELECT m.user_id, m.event_id AS event_id_x, m.ts AS ts_x, r.event_id AS event_id_y, r.ts AS ts_y
FROM (SELECT user_id, min(event_id) AS event_id, arg_min(ts, event_id) AS ts FROM events GROUP BY 1) m
JOIN events r ON m.user_id = r.user_id WHERE r.event_type = 'purchase'""")
def merge_suffixes(t):
    rows = t.events.select("user_id", "event_id", "ts")
    marks = aggregates.keep_first(rows, ["user_id"], ["event_id"])
    recaptures = t.events.filter("event_type = 'purchase'").select("user_id", "event_id", "ts")
    return joins.merge_inner(marks, recaptures, "user_id")


@query("j10_sql_join_with_dates", """
SELECT o_orderkey, o_custkey, l_linenumber, l_partkey FROM orders JOIN lineitem ON o_orderkey = l_orderkey
  AND o_orderdate <= l_shipdate WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-07-01' AND DATE '1996-12-31'""")
def sql_join(t):
    t.register("orders", "lineitem")
    return t.spark.sql("""
        SELECT o_orderkey, o_custkey, l_linenumber, l_partkey
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey AND o_orderdate <= l_shipdate
        WHERE DATE(o_orderdate) BETWEEN '1996-07-01' AND '1996-12-31'""")


@query("j11_join_ranked", """
SELECT l_orderkey, l_linenumber, l_quantity, ranking FROM lineitem
JOIN (SELECT o_orderkey, rank() OVER (ORDER BY o_totalprice DESC) AS ranking FROM orders) ON o_orderkey = l_orderkey""")
def join_ranked(t):
    ranking = ranked(t.orders.select("o_orderkey", "o_totalprice"), [], "-o_totalprice", "ranking")
    fish = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
    return fish.join(ranking.select(F.col("o_orderkey").alias("l_orderkey"), "ranking"), "l_orderkey")


@query("j12_join_not_null", """
SELECT l_orderkey, l_partkey, p_name, p_size FROM lineitem JOIN part ON l_partkey = p_partkey AND l_linenumber = p_size
WHERE p_brand IS NOT NULL""")
def join_not_null(t):
    match = (F.col("l_partkey") == F.col("p_partkey")) & (F.col("l_linenumber") == F.col("p_size"))
    return t.lineitem.join(t.part.filter(F.col("p_brand").isNotNull()), match).select(
        "l_orderkey", "l_partkey", "p_name", "p_size"
    )


@query("j13_semi_join", "SELECT o_orderkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)")
def semi_join(t):
    big = t.lineitem.filter("l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey"))
    return t.orders.select("o_orderkey").join(big, "o_orderkey", "left_semi")


@query("j14_anti_join", "SELECT item_id FROM benchmark WHERE text NOT IN (SELECT text FROM conversations WHERE text IS NOT NULL)")
def anti_join(t):
    return t.benchmark.join(t.conversations.select("text"), "text", "left_anti").select("item_id")


@query("j15_not_in_latest", """
SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate NOT IN
  (SELECT o_orderdate FROM (SELECT DISTINCT o_orderdate FROM orders) ORDER BY o_orderdate DESC LIMIT 3)""")
def not_in_latest(t):
    latest = t.orders.select("o_orderdate").distinct().orderBy(F.desc("o_orderdate")).limit(3)
    return t.orders.select("o_orderkey", "o_orderdate").join(latest, "o_orderdate", "left_anti")


@query("j17_registry_rows_once", """
WITH r AS (SELECT s_suppkey AS tag, s_name AS name, NULL AS segment, 0 AS trust FROM supplier
  UNION ALL SELECT c_custkey, c_name, c_mktsegment, 1 FROM customer),
one AS (SELECT tag, arg_min(name, trust) AS name, CASE WHEN min(trust) = 1 THEN max(segment) END AS segment FROM r GROUP BY 1)
SELECT event_id, user_id AS tag, name, segment FROM events LEFT JOIN one ON one.tag = user_id""")
def registry_rows_once(t):
    seen = t.events.select("event_id", F.col("user_id").alias("tag"))
    newest = t.supplier.select(F.col("s_suppkey").alias("tag"), F.col("s_name").alias("name"))
    older = t.customer.select(
        F.col("c_custkey").alias("tag"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    return joins.mapped_once(seen, [newest, older], "tag", ["name"])


@query("j18_coverage", """
WITH l AS (SELECT DISTINCT s_suppkey AS k FROM supplier), r AS (SELECT DISTINCT l_suppkey + 5 AS k FROM lineitem)
SELECT CASE WHEN l.k IS NULL THEN 'right_only' WHEN r.k IS NULL THEN 'left_only' ELSE 'matched' END AS coverage,
  count(*) AS n FROM l FULL JOIN r ON l.k = r.k GROUP BY 1""")
def coverage(t):
    registry = t.supplier.select(F.col("s_suppkey").alias("k"))
    return joins.coverage(registry, t.lineitem.select((F.col("l_suppkey") + 5).alias("k")), "k")
