"""Ordered scans must give what one plain window gives, on groups of any size, from plans that start no job."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import values
from fieldlab.operators import skew, stats
from fieldlab.operators.aggregates import complete_counts
from fieldlab.operators.filters import repeated_rows
from fieldlab.operators.maintain import register_new
from fieldlab.operators.windows import fill_down_up, run_ids, spread_apart, spread_collisions, surrogate_keys


@pytest.fixture(scope="module")
def skewed(store):
    """Events with a third of all rows under one key and a third without key."""
    kind = F.col("event_type")
    return store.events.select(
        "event_id", "ts", "value",
        F.when(kind.isin("click", "view"), 1).when(kind == "signup", F.col("user_id")).alias("tag"),
        F.round("value", -1).alias("coarse"),
        F.when(F.col("event_id") % 9 == 0, F.col("value")).alias("sparse"),
    ).cache()


def same(a, b):
    assert a.columns == b.columns
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def plain(by, order):
    return Window.partitionBy(*by).orderBy(*skew.sort_columns(order))


@pytest.mark.parametrize("by", [[], ["tag"], ["tag", "coarse"]])
@pytest.mark.parametrize("order", [["event_id"], ["-ts", "event_id"], ["coarse", "-event_id"], ["-sparse", "event_id"]])
def test_numbered(skewed, by, order):
    want = skewed.withColumn("n", F.row_number().over(plain(by, order)).cast("long"))
    same(skew.numbered(skewed, by, order, "n"), want)


def test_a_large_group_spans_many_pieces(skewed):
    pieces = skew.with_pieces(skewed, ["tag", "event_id"])
    most = skew.piece_count(skewed)
    sizes = [r["count"] for r in pieces.groupBy("_piece").count().collect()]
    assert most // 2 <= len(sizes) <= most and max(sizes) < 6 * skewed.count() / most
    assert pieces.where("tag IS NULL").select("_piece").distinct().count() > 2
    key = skew.ordered_key(skewed, ["tag", "event_id"])
    low = pieces.groupBy("_piece").agg(F.min(F.expr(key)).alias("a"), F.max(F.expr(key)).alias("b"))
    ends = [(tuple(r["a"]), tuple(r["b"])) for r in low.orderBy("_piece").collect()]
    assert all((x[1][0], x[1][1] or 0, *x[1][2:]) < (y[0][0], y[0][1] or 0, *y[0][2:]) for x, y in zip(ends, ends[1:]))


def test_no_job_starts_while_a_plan_is_built(spark, skewed):
    skewed.count()
    spark.sparkContext.setJobGroup("building", "plans only")
    try:
        registry = skewed.select(F.col("event_id").cast("string").alias("name"), F.col("event_id").alias("id"))
        plans = [
            skew.numbered(skewed, ["tag"], ["event_id"], "n"), skew.ranked(skewed, [], "-value", "r"), repeated_rows(skewed, ["tag"], ["event_id"]),
            fill_down_up(skewed, ["sparse"], ["event_id"], ["tag"]), stats.box_stats(skewed, ["tag"], "value"), stats.density(skewed, ["tag"], "value", 16),
            surrogate_keys(skewed, ["event_id"], "id"), spread_apart(skewed, "ts", "ts", ["event_id"]), run_ids(skewed, "ts", "run"),
            register_new(registry, registry.select("name"), "name", "id"), complete_counts(skewed, "tag", "coarse"),
        ]
        assert len(plans) == 11 and not spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_plan_does_not_depend_on_size(spark):
    def shape(n):
        df = spark.range(n).select("id", (F.col("id") % 7).alias("k"))
        return [line.strip(" +-:").split(" ")[0] for line in skew.numbered(df, ["k"], ["id"], "n")._jdf.queryExecution().optimizedPlan().toString().splitlines()]

    assert shape(10) == shape(10_000_000)


def test_copies_fill_many_pieces(skewed):
    copies = skewed.select("tag", F.lit("x").alias("same"))
    for by, order in (([], ["same", "tag"]), (["tag"], ["same"])):
        want = copies.withColumn("n", F.row_number().over(plain(by, order)).cast("long"))
        same(skew.numbered(copies, by, order, "n"), want)


def test_copies_are_written_in_chunks(skewed, monkeypatch):
    monkeypatch.setattr(skew, "_CHUNK", 7)
    copies = skewed.select(F.lit("x").alias("same"))
    got = sorted(r["n"] for r in skew.numbered(copies, [], ["same"], "n").collect())
    assert got == list(range(1, len(got) + 1)) and len(got) == skewed.count()


def test_empty_tables(skewed):
    none = skewed.limit(0)
    assert skew.numbered(none, ["tag"], ["event_id"], "n").count() == 0 and skew.ranked(none, [], "value", "r").count() == 0
    assert fill_down_up(none, ["sparse"], ["event_id"]).count() == 0 and stats.quantiles(none, ["tag"], "value", stats.QUARTILES).count() == 0


def test_repeated_rows_of_copies(skewed):
    copies = skewed.select(F.lit(1).alias("k"), F.lit("x").alias("v"))
    assert repeated_rows(copies, ["k"], ["v"]).count() == copies.count() - 1


@pytest.mark.parametrize("by", [[], ["tag"]])
@pytest.mark.parametrize("order", ["coarse", "-coarse"])
def test_ranked(skewed, by, order):
    same(skew.ranked(skewed, by, order, "r"), skewed.withColumn("r", F.rank().over(plain(by, [order])).cast("long")))


@pytest.mark.parametrize("by", [[], ["tag"]])
def test_fill_down_up(skewed, by):
    w = plain(by, ["event_id"])
    down = F.last("sparse", True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    up = F.first("sparse", True).over(w.rowsBetween(0, Window.unboundedFollowing))
    same(fill_down_up(skewed, ["sparse"], ["event_id"], by), skewed.withColumn("sparse", F.coalesce(down, up)))


def test_running_values(skewed):
    whole = skewed.withColumn("one", F.col("event_id") % 5)
    rows = plain(["tag"], ["event_id"]).rowsBetween(Window.unboundedPreceding, 0)
    same(skew.running_sum(whole, ["tag"], ["event_id"], "one", "s"), whole.withColumn("s", F.sum("one").over(rows)))
    several = {"s": ("sum", "one"), "m": ("max", "value"), "x": ("bit_xor", "event_id")}
    want = whole.withColumns({"s": F.sum("one").over(rows), "m": F.max("value").over(rows), "x": F.bit_xor("event_id").over(rows)})
    same(skew.running(whole, ["tag"], ["event_id"], several), want)


@pytest.mark.parametrize("by", [[], ["tag"]])
def test_quantiles(skewed, by):
    want = skewed.groupBy(*by).agg(*[F.round(F.percentile("value", F.lit(p)), 9).alias(q) for q, p in stats.QUARTILES.items()])
    got = stats.quantiles(skewed, by, "value", stats.QUARTILES)
    same(got.select(*by, *[F.round(q, 9).alias(q) for q in stats.QUARTILES]), want.where("q1 IS NOT NULL"))


def test_density_against_the_plain_sum(frame):
    df = frame("g string, x double", *[(g, float(x)) for g in "ab" for x in (1, 2, 2, 5, 9, 9.5)], ("c", 3.0))
    got = values(stats.density(df, ["g"], "x", 32), "g", "point")
    import math

    import numpy as np

    for g, xs in {"a": [1, 2, 2, 5, 9, 9.5], "c": [3.0]}.items():
        q1, q3 = np.quantile(xs, 0.25), np.quantile(xs, 0.75)
        sd = np.std(xs, ddof=1) if len(xs) > 1 else 0
        bw = 0.9 * (min(sd, (q3 - q1) / 1.34) or sd or abs(min(xs))) * len(xs) ** -0.2
        step = 8.5 / 31
        for name, point, x, density in (r for r in got if r[0] == g):
            total = 0.0
            for v in xs:
                at = (v - 1) / step
                i = min(int(at), 30)
                for cell, w in ((i, 1 - (at - i)), (i + 1, at - i)):
                    total += w * math.exp(-0.5 * ((point - cell) * step / bw) ** 2)
            assert x == pytest.approx(1 + point * step) and density == pytest.approx(total / (len(xs) * bw * math.sqrt(2 * math.pi)))


def test_windows_on_large_groups(skewed):
    hourly = skewed.select("event_id", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("time"))
    k = F.row_number().over(plain(["time"], ["event_id"]))
    want = hourly.withColumn("time", F.col("time") + F.make_dt_interval(F.lit(0), F.lit(0), (k - 1) * 5))
    same(spread_collisions(hourly, "time", ["event_id"]), want)
    days = F.dense_rank().over(Window.orderBy(F.to_date("ts"))) - 1
    same(run_ids(skewed, "ts", "run"), skewed.withColumn("run", days.cast("long")))
    keyed = surrogate_keys(skewed, ["event_id"], "id", 1000)
    assert keyed.agg(F.min("id"), F.max("id"), F.countDistinct("id")).first() == (1001, 2000, 1000)


def test_spread_apart_makes_no_new_collisions(spark, skewed):
    close = skewed.select("event_id", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("time"))
    close = close.unionByName(close.select((F.col("event_id") + 10_000).alias("event_id"), (F.col("time") + F.expr("INTERVAL 5 MINUTES")).alias("time")))
    close = close.unionByName(spark.createDataFrame([(-1, None)], close.schema)).withColumn("day", F.to_date("time"))
    got = spread_apart(close, "day", "time", ["event_id"], into="moved")
    assert got.where("time IS NULL AND moved IS NULL").count() == 1
    rows = [r for r in got.collect() if r["time"] is not None]
    assert len({(r["day"], r["moved"]) for r in rows}) == len(rows)
    by_day = {}
    for r in sorted(rows, key=lambda r: (r["time"], r["event_id"])):
        last = by_day.get(r["day"])
        want = r["time"] if last is None else max(r["time"], last + __import__("datetime").timedelta(minutes=5))
        assert r["moved"] == want
        by_day[r["day"]] = want


def test_grid_of_many_levels(spark, skewed):
    df = spark.range(3000).select((F.col("id") % 3).alias("a"), F.col("id").cast("string").alias("b"))
    got = complete_counts(df, "a", "b", block=100)
    assert got.count() == 9000 and got.agg(F.sum("n")).first()[0] == 3000
    assert complete_counts(df.limit(0), "a", "b").count() == 0


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from([None, "a", "b"]), st.integers(0, 5)), min_size=1, max_size=60))
def test_numbers_are_complete(spark, rows):
    df = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(rows)], "k string, v int, i int")
    got = skew.numbered(df, ["k"], ["v", "i"], "n").collect()
    for key in {k for k, _ in rows}:
        group = sorted((r["n"], r["v"], r["i"]) for r in got if r["k"] == key)
        assert [n for n, _, _ in group] == list(range(1, len(group) + 1))
        assert [x[1:] for x in group] == sorted(x[1:] for x in group)


@pytest.mark.parametrize("order", ["t", "-t"])
def test_texts_that_begin_alike(spark, order):
    alike = "same beginning " * 20
    df = spark.range(600).selectExpr(f"concat(IF(id % 2 = 0, '', '{alike}'), lpad(id * 7 % 600, 4, '0'), repeat('é', 50)) AS t", "id")
    got = skew.numbered(df, [], [order], "k")
    want = df.withColumn("k", F.row_number().over(plain([], [order])).cast("long"))
    assert values(got.select("id", "k")) == values(want.select("id", "k"))
    two = skew.numbered(df.withColumn("u", F.col("id") % 2), ["u"], [order, "id"], "k")
    same(two, df.withColumn("u", F.col("id") % 2).withColumn("k", F.row_number().over(plain(["u"], [order, "id"])).cast("long")))
    grouped = df.withColumn("t", F.concat(F.left("t", F.lit(302)), (F.col("id") % 3).cast("string")))
    same(skew.numbered(grouped, ["t"], ["id"], "k"), grouped.withColumn("k", F.row_number().over(plain(["t"], ["id"])).cast("long")))


@pytest.mark.parametrize("kind", ["int", "long", "double", "decimal(10,2)", "date", "timestamp", "timestamp_ntz", "boolean", "binary"])
def test_orders_of_every_type(spark, kind):
    id_ = F.col("id")
    made = {"date": F.date_add(F.lit("2024-01-01"), (id_ % 50).cast("int")), "boolean": id_ % 2 == 0, "binary": F.encode((id_ % 50).cast("string"), "utf-8"),
            "timestamp": F.timestamp_seconds(id_ % 50 * 1000), "timestamp_ntz": F.timestamp_seconds(id_ % 50 * 1000).cast("timestamp_ntz"),
            "double": F.when(id_ % 50 == 3, F.lit("NaN").cast("double")).otherwise((id_ % 50 - 25).cast("double"))}
    df = spark.range(400).select("id", F.when(id_ % 11 > 0, made.get(kind, (id_ % 50 - 25).cast(kind))).alias("v"))
    for order in (["v", "id"], ["-v", "id"]) if kind != "binary" else (["v", "id"],):
        same(skew.numbered(df, [], order, "n"), df.withColumn("n", F.row_number().over(plain([], order)).cast("long")))
