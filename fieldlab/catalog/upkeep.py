"""Table maintenance and audits over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldlab.catalog.registry import query
from fieldlab.operators import maintain, validate
from fieldlab.session import fresh_path
from fieldlab.sources.versions import StoredTable

@query("d2_append_unique", "SELECT o_orderkey, o_orderstatus FROM orders")
def append_unique(t):
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    done = F.col("o_orderstatus") == "F"
    return maintain.append_unique(rows.filter(~done), rows.filter(done), ["o_orderkey"])


@query("d2_load", """
SELECT 'stored' AS what, CAST(o_orderkey AS VARCHAR) AS survey, o_totalprice AS total, NULL::BIGINT AS n FROM orders
UNION ALL SELECT 'staged', NULL, NULL, count(*) FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT 'missing', NULL, NULL, 0""")
def load(t):
    done = F.col("o_orderstatus") == "F"
    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    text = rows.filter(done).select(F.concat(F.lit(" "), F.col("o_orderkey")).alias("o_orderkey"), F.col("o_totalprice").cast("string"), "o_orderstatus")
    stored, check = maintain.load(rows.filter(~done).drop("o_orderstatus"), text, ["o_orderkey"])
    found = stored.select(
        F.lit("stored").alias("what"), F.col("o_orderkey").cast("string").alias("survey"), F.col("o_totalprice").alias("total"),
        F.lit(None).cast("long").alias("n"),
    )
    told = check.select(F.inline(F.array(*[F.struct(F.lit(c).alias("what"), F.col(c).alias("n")) for c in ("staged", "missing")])))
    return found.unionByName(told, allowMissingColumns=True)


@query("d3_insert_or_ignore", """
WITH target AS (SELECT user_id, event_type, min(event_id) AS event_id FROM events WHERE event_type <> 'view' GROUP BY 1, 2),
batch AS (SELECT CASE WHEN value > 100 THEN NULL ELSE user_id END AS user_id, event_type, event_id FROM events WHERE value > 20)
SELECT * FROM target
UNION ALL SELECT * FROM batch WHERE user_id IS NULL
UNION ALL SELECT user_id, event_type, min(event_id) FROM batch b WHERE user_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM target t WHERE t.user_id = b.user_id AND t.event_type = b.event_type) GROUP BY 1, 2""")
def insert_or_ignore(t):
    target = (
        t.events.filter("event_type <> 'view'").groupBy("user_id", "event_type")
        .agg(F.min("event_id").alias("event_id"))
    )
    batch = t.events.filter("value > 20").select(
        F.when(F.col("value") <= 100, F.col("user_id")).alias("user_id"), "event_type", "event_id"
    )
    return maintain.insert_or_ignore(target, batch, ["user_id", "event_type"], ["event_id"])


@query("d4_added_columns", """
SELECT n_nationkey, n_name, NULL::INTEGER AS n_regionkey FROM nation WHERE n_regionkey < 2
UNION ALL SELECT n_nationkey, n_name, n_regionkey FROM nation WHERE n_regionkey >= 2""")
def added_columns(t):
    old = t.nation.filter("n_regionkey < 2").drop("n_regionkey")
    return maintain.with_added_columns(old, t.nation.filter("n_regionkey >= 2"))


@query("d5_update_where", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'alevin' ELSE o_orderstatus END AS o_orderstatus FROM orders""")
def update_where(t):
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    return maintain.update_where(rows, F.col("o_orderstatus") == "P", {"o_orderstatus": F.lit("alevin")})


@query("d6_delete_where", """
SELECT event_id, tag FROM (SELECT event_id, CASE WHEN event_type = 'view' THEN NULL ELSE user_id END AS tag FROM events)
WHERE (tag > 75) IS NOT TRUE""")
def delete_where(t):
    tagged = t.events.select("event_id", F.when(F.col("event_type") != "view", F.col("user_id")).alias("tag"))
    return maintain.delete_where(tagged, F.col("tag") > 75)


@query("d5_update_stored", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'alevin' ELSE o_orderstatus END AS o_orderstatus FROM orders""")
def update_stored(t):
    """The update stored over the table that it reads."""
    table = StoredTable(t.spark, fresh_path(t.spark)).replace(t.orders.select("o_orderkey", "o_orderstatus"))
    return table.update_where(F.col("o_orderstatus") == "P", {"o_orderstatus": F.lit("alevin")}).read()


@query("d6_delete_stored", """
SELECT event_id, tag FROM (SELECT event_id, CASE WHEN event_type = 'view' THEN NULL ELSE user_id END AS tag FROM events)
WHERE (tag > 75) IS NOT TRUE""")
def delete_stored(t):
    """The deletion stored over the table that it reads, then older versions removed."""
    tagged = t.events.select("event_id", F.when(F.col("event_type") != "view", F.col("user_id")).alias("tag"))
    table = StoredTable(t.spark, fresh_path(t.spark)).replace(tagged).delete_where(F.col("tag") > 75)
    table.vacuum()
    return table.read()


@query("d8_register_new", """
WITH fresh AS (SELECT DISTINCT text FROM conversations WHERE text IS NOT NULL AND text NOT IN (SELECT text FROM benchmark))
SELECT item_id, text FROM benchmark
UNION ALL SELECT (SELECT max(item_id) FROM benchmark) + row_number() OVER (ORDER BY text), text FROM fresh""")
def register_new(t):
    return maintain.register_new(t.benchmark.select("item_id", "text"), t.conversations, "text", "item_id")


@query("d9_key_audit", """
SELECT CAST(sum(n) AS BIGINT) AS n_rows, CAST(count(*) FILTER (k IS NOT NULL AND n > 1) AS BIGINT) AS repeated_keys,
  CAST(sum(n - 1) FILTER (k IS NOT NULL) AS BIGINT) AS extra_rows, CAST(sum(n) FILTER (k IS NULL) AS BIGINT) AS null_key_rows
FROM (SELECT CASE WHEN l_returnflag <> 'R' THEN l_orderkey END AS k, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2)""")
def key_audit(t):
    keyed = t.lineitem.select(
        F.when(F.col("l_returnflag") != "R", F.col("l_orderkey")).alias("l_orderkey"), "l_linenumber"
    )
    return validate.key_audit(keyed, ["l_orderkey", "l_linenumber"])


@query("d10_orphans", """
SELECT 'fish without survey' AS reference, count(DISTINCT l_orderkey) AS orphan_keys, count(*) AS orphan_rows FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')
UNION ALL SELECT 'survey without angler', count(DISTINCT o_custkey), count(*) FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')""")
def orphans(t):
    return validate.orphan_report([
        ("fish without survey", t.lineitem, ["l_orderkey"], t.orders.filter("o_orderstatus <> 'P'"), ["o_orderkey"]),
        ("survey without angler", t.orders, ["o_custkey"], t.customer.filter("c_mktsegment <> 'BUILDING'"), ["c_custkey"]),
    ])


@query("d11_load_check", """
SELECT count(*) AS staged, CAST(count(*) FILTER (o_orderstatus <> 'P') AS BIGINT) AS stored,
  CAST(count(*) FILTER (o_orderstatus = 'P') AS BIGINT) AS missing FROM orders""")
def load_check(t):
    return maintain.load_check(t.orders, t.orders.filter("o_orderstatus <> 'P'"), ["o_orderkey"])
