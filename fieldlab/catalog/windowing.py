"""Numbering, ranks, keys and filling over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldlab.catalog.filtering import LINE_ORDER
from fieldlab.catalog.registry import query
from fieldlab.operators import windows
from fieldlab.operators.skew import ranked


@query("w1_renumber_within_date", """
SELECT o_orderkey, o_orderdate, row_number() OVER (PARTITION BY o_orderdate ORDER BY o_orderkey) AS survey_number FROM orders""")
def renumber(t):
    return windows.renumber_within(
        t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate", ["o_orderkey"], "survey_number"
    )


@query("w2_run_ids", """
SELECT event_id, dense_rank() OVER (ORDER BY CAST(ts AS DATE)) - 1 AS date_group FROM events""")
def run_ids(t):
    return windows.run_ids(t.events.select("event_id", "ts"), "ts", "date_group").drop("ts")


@query("w3_spread_collisions", """
SELECT event_id, date_trunc('hour', ts) + to_minutes(5 * (row_number() OVER (PARTITION BY date_trunc('hour', ts)
  ORDER BY event_id) - 1)) AS time FROM events""")
def spread_collisions(t):
    hourly = t.events.select("event_id", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("time"))
    return windows.spread_collisions(hourly, "time", ["event_id"])


@query("w4_rank", "SELECT o_orderkey, o_totalprice, rank() OVER (ORDER BY o_totalprice DESC) AS ranking FROM orders")
def rank(t):
    return ranked(t.orders.select("o_orderkey", "o_totalprice"), [], "-o_totalprice", "ranking")


@query("w5_surrogate_keys", f"""
SELECT l_orderkey, l_linenumber, {', '.join(LINE_ORDER)}, (SELECT max(o_orderkey) FROM orders)
  + row_number() OVER (ORDER BY l_orderkey, l_linenumber, {', '.join(LINE_ORDER)}) AS fish_id FROM lineitem""")
def surrogate_keys(t):
    stored = t.orders.select(F.col("o_orderkey").alias("fish_id"))
    return windows.next_keys(t.lineitem, stored, "fish_id", ["l_orderkey", "l_linenumber", *LINE_ORDER])


_NOTES = "SELECT event_id, user_id, ts, CASE WHEN event_type = 'error' THEN props END AS notes FROM events"


def _notes(t):
    return t.events.select(
        "event_id", "user_id", "ts", F.when(F.col("event_type") == "error", F.col("props")).alias("notes")
    )


@query("w6_fill_down", f"""
SELECT event_id, user_id, ts, last_value(notes IGNORE NULLS) OVER (ORDER BY ts, event_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS notes FROM ({_NOTES})""")
def fill_down(t):
    return windows.fill_down(_notes(t), ["notes"], ["ts", "event_id"])


@query("w7_fill_down_up", f"""
SELECT event_id, user_id, ts, COALESCE(
  last_value(notes IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(notes IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
) AS notes FROM ({_NOTES})""")
def fill_down_up(t):
    return windows.fill_down_up(_notes(t), ["notes"], ["ts", "event_id"], ["user_id"])
