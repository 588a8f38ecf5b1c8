"""Operators on small fixtures, including the corner cases of the field data."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import values
from fieldlab.operators import aggregates, filters, joins, maintain, reshape, sets, shape, stats, validate, windows


def test_headers():
    assert shape.fix_headers(["Survey #", "# SMB c", "# SMB c", "Total Retained", "Air temp (C)"], ("c", "r")) == [
        "survey_no", "no_smb_c", "no_smb_r", "total_retained", "air_temp_c"]
    assert shape.fix_headers(["Notes", "Notes", ""]) == ["notes", "notes_2", "x"]


def test_personal_data_is_dropped(frame):
    claims = frame("tag string, name string, address string, phone string, email string, year int", ("1", "a", "b", "c", "d", 2024))
    assert shape.only_allowed(claims, ["year", "tag", "harvested"]).columns == ["tag", "year"]


def test_typed_is_tolerant(frame):
    schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("x", T.DoubleType()), T.StructField("d", T.DateType())])
    df = frame("d string, x string, n string", ("2024-05-01", "1.5", " 7 "), ("soon", "2f", "7.5"))
    assert values(shape.typed(df, schema)) == sorted([(7, 1.5, dt.date(2024, 5, 1)), (None, None, None)], key=str)


def test_null_keys_match_in_natural_joins(frame):
    left = frame("k string, a int", ("x", 1), (None, 2))
    right = frame("k string, b int", ("x", 10), (None, 20))
    assert values(joins.natural_join(left, right)) == sorted([("x", 1, 10), (None, 2, 20)], key=str)
    full = joins.natural_full_join_all([left, right, frame("k string, c int, time string", ("z", 5, "8:00"))])
    assert values(full) == sorted([("x", 1, 10, None), (None, 2, 20, None), ("z", None, None, 5)], key=str)
    with pytest.raises(ValueError):
        joins.natural_join(left, frame("q int", (1,)))


def test_natural_join_is_text_and_keeps_fan_out(frame):
    got = joins.natural_join_all([frame("k int", (1,), (2,)), frame("k int, v int", (1, 5), (1, 6))])
    assert values(got) == sorted([("1", "5"), ("1", "6"), ("2", None)], key=str)


def test_full_join_suffixes(frame):
    a, b, c = (frame("d int, s int, n int", *rows) for rows in ([(1, 1, 5)], [(1, 1, 6), (2, 1, 7)], [(3, 1, 8)]))
    got = joins.full_join_all([a, b, c], ["d", "s"])
    assert got.columns == ["d", "s", "n_x", "n_y", "n"]
    assert values(got) == sorted([(1, 1, 5, 6, None), (2, 1, None, 7, None), (3, 1, None, None, 8)], key=str)


def test_merge_drops_missing_ids(frame):
    marks = frame("pit string, d int", ("a", 1), (None, 2))
    recaptures = frame("pit string, d int", ("a", 3), ("a", 4), (None, 5))
    got = joins.merge_inner(marks, recaptures, "pit")
    assert got.columns == ["pit", "d_x", "d_y"] and values(got) == [("a", 1, 3), ("a", 1, 4)]


def test_first_known_takes_first_value_per_column(frame):
    rows = frame("k int, a string, b int, _seq int", (1, None, 5, 1), (1, "x", None, 2), (1, "y", 6, 3), (None, "z", None, 4))
    assert values(aggregates.first_known(rows, ["k"], "_seq")) == sorted([(1, "x", 5), (None, "z", None)], key=str)


def test_collisions_spread_once(frame):
    t = dt.datetime(2024, 5, 25, 7, 0)
    df = frame("t timestamp_ntz, i int", (t, 1), (t, 2), (t, 3), (t + dt.timedelta(minutes=5), 4), (None, 5))
    got = [r["t"] for r in windows.spread_collisions(df, "t", ["i"]).orderBy("i").collect()]
    assert got == [t + dt.timedelta(minutes=m) for m in (0, 5, 10, 5)] + [None]


def test_run_ids(frame):
    df = frame("d string, i int", ("2024-05-02", 1), ("2024-05-01", 2), ("2024-05-02", 3), (None, 4))
    assert values(windows.run_ids(df, "d", "run").select("i", "run")) == [(1, 1), (2, 0), (3, 1), (4, None)]


def test_three_valued_filter(frame):
    df = frame("a int, b int", (0, 0), (None, None), (None, 0), (1, 0), (None, 1))
    assert values(df.filter(~((F.col("a") == 0) & (F.col("b") == 0)))) == sorted([(1, 0), (None, 1)], key=str)


def test_date_bounds_are_inclusive(frame):
    day = lambda n: dt.datetime(2024, 5, n, 23, 59)
    df = frame("t timestamp_ntz", (day(1),), (day(2),), (day(3),))
    assert filters.between_dates(df, "t", "2024-05-02", "2024-05-02").count() == 1
    assert filters.between_dates(df, "t").count() == 3
    assert filters.facet_filter(df, {"t": [], "gone": ["x"]}).count() == 3


def test_reconcile_finds_the_known_difference(frame):
    df = frame("a_c string, b_c string, total string", ("1", "2", "5"), ("x", None, "1"), ("3", "", None))
    assert values(aggregates.reconcile(df, ["a_c", "b_c"], "total")) == [(6.0, 6.0, 0.0)]
    assert values(aggregates.reconcile(df.limit(1), ["a_c"], "total")) == [(1.0, 5.0, -4.0)]
    assert values(aggregates.tolerant_totals(df.filter("false"), ["a_c"])) == [(0.0,)]


def test_shares_sum_to_one(store):
    got = aggregates.shares(store.events, "event_type", scale=1.0).agg(F.sum("percent")).first()[0]
    assert got == pytest.approx(1)


def test_complete_counts_zero_fill(frame):
    df = frame("a string, b string", ("x", "p"), ("x", "p"), ("y", "q"), (None, "p"))
    assert values(aggregates.complete_counts(df, "a", "b")) == [("x", "p", 2), ("x", "q", 0), ("y", "p", 0), ("y", "q", 1)]


def test_complete_counts_of_many_levels(spark):
    df = spark.range(10_001).selectExpr("id % 2 AS a", "CAST(id AS STRING) AS b")
    assert values(aggregates.complete_counts(df, "a", "b").groupBy("n").count()) == [(0, 10_001), (1, 10_001)]


def test_facets_limits(frame):
    rows = [(i % 10, i % 11, i, None) for i in range(500)]
    df = frame("ten int, eleven int, many int, none string", *rows)
    assert {r["variable"] for r in aggregates.facets(df).collect()} == {"ten"}


def test_distance_bins_last_bin_takes_rest(frame):
    df = frame("km double", (0.0,), (49.9,), (50.0,), (140.0,), (None,))
    assert values(aggregates.distance_bins(df, "km"), "low") == [(0, "0 - 50", 2), (50, "50 - 100", 2)]


def test_terms(frame):
    df = frame("t string", ("The nest, nest! 12 fry",), ("fry's nest of BASS",), (None,))
    assert values(aggregates.term_counts(df, "t"), F.desc("freq"), "word") == [("nest", 3)]
    assert values(aggregates.term_counts(df, "t", least=1, top=None)) == [("bass", 1), ("fry", 1), ("frys", 1), ("nest", 3)]


def test_histogram_edges(frame):
    df = frame("x double", (0.0,), (10.0,), (10.5,), (20.0,), (None,))
    assert values(stats.width_histogram(df, "x", 10), "bin") == [(0, 2, 0.0), (1, 2, 10.0)]
    assert [r["n"] for r in stats.bins_histogram(df, "x", 3).orderBy("bin").collect()] == [1, 2, 1]
    assert values(stats.bins_histogram(frame("x double", (3.0,), (3.0,)), "x")) == [(0, 2, 3.0)]


def test_density_matches_direct_kernel(frame):
    import numpy as np

    x = np.array([1.0, 2.0, 2.5, 4.0, 7.0, 7.5, 9.0])
    df = frame("g string, x double", *[("a", float(v)) for v in x])
    got = stats.density(df, ["g"], "x", 512).orderBy("point").collect()
    q1, q3 = np.percentile(x, [25, 75])
    bw = 0.9 * min(x.std(ddof=1), (q3 - q1) / 1.34) * len(x) ** -0.2
    grid = np.linspace(x.min(), x.max(), 512)
    direct = np.exp(-0.5 * ((grid[:, None] - x) / bw) ** 2).sum(1) / (len(x) * bw * np.sqrt(2 * np.pi))
    assert np.allclose([r["density"] for r in got], direct, atol=1e-4)


def test_long_wide_round_trip(store):
    lines = store.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority")
    long = reshape.to_long(lines, ["o_orderkey"], lines.columns[1:])
    wide = reshape.to_wide(long.withColumn("_seq", F.lit(1)), ["o_orderkey"], "variable", "value", "_seq")
    assert wide.select(lines.columns).exceptAll(lines).count() == 0 and wide.count() == lines.count()


def test_split_rows_drop_blanks(frame):
    df = frame("id int, s string", (1, "bass, trout ,,"), (2, " "), (3, None))
    assert values(reshape.split_rows(df, "s")) == [(1, "bass"), (1, "trout")]


def test_chosen_tables(frame):
    matrix = frame("TableName string, a string, b string", ("Nests", "X", None), ("Tags", "", "X"))
    assert values(reshape.chosen_tables(matrix, "Nests").select("name")) == [("a",)]


def test_stacking(frame):
    a, b = frame("x int", (1,)), frame("x int, y int", (2, 3))
    assert values(sets.stacked([a, b])) == sorted([(1, None), (2, 3)], key=str)
    with pytest.raises(ValueError):
        sets.stacked_strict([a, b])


def test_insert_or_ignore_is_idempotent(frame):
    target = frame("d string, t string, v int", ("1", "8:00", 0))
    batch = frame("d string, t string, v int", ("1", "8:00", 9), ("2", "8:00", 1), ("2", "8:00", 2), (None, "8:00", 3))
    once = maintain.insert_or_ignore(target, batch, ["d", "t"], ["v"])
    assert values(once) == sorted([("1", "8:00", 0), ("2", "8:00", 1), (None, "8:00", 3)], key=str)
    keyed = batch.dropna(subset=["d"])
    assert maintain.new_rows(once, keyed, ["d", "t"], ["v"]).count() == 0


def test_append_unique_refuses_whole_batch(frame):
    target = frame("k int, v int", (1, 1))
    assert maintain.append_unique(target, frame("k int, v int", (2, 1), (None, 1), (None, 2)), ["k"]).count() == 4
    for bad in ([(1, 5), (3, 5)], [(4, 1), (4, 2)]):
        with pytest.raises(maintain.KeyConflict):
            maintain.append_unique(target, frame("k int, v int", *bad), ["k"])


def test_ids_continue_from_numeric_maximum(frame):
    stored = frame("id string, q string", ("99", "a"), ("100", "b"))
    got = maintain.register_new(stored, frame("q string", ("c",), ("a",), ("d",), ("c",)), "q", "id")
    assert values(got.filter("q in ('c', 'd')")) == [("101", "c"), ("102", "d")]


def test_update_delete_unknown_is_not_true(frame):
    df = frame("s string", ("egg",), (None,), ("eggs",))
    assert values(maintain.update_where(df, F.col("s") == "egg", {"s": F.lit("eggs")})) == sorted([("eggs",), (None,), ("eggs",)], key=str)
    assert values(maintain.delete_where(df, F.col("s") == "egg")) == sorted([(None,), ("eggs",)], key=str)


def test_conversion_profile(frame):
    df = frame("d int, a string, b string", (1, "1", "x"), (2, "2", "3"), (3, None, None), (4, "5 mm", None))
    got = {r["variable"]: tuple(r)[1:] for r in validate.conversion_profile(df, ["a", "b"]).collect()}
    assert got == {"a": (4, 3, 2, 1, False, False), "b": (4, 2, 1, 1, False, False)}
    assert values(validate.failed_values(df, ["d"], ["a", "b"])) == [(1, "b", "x"), (4, "a", "5 mm")]
    assert validate.failed_values(df, ["d"], ["a", "b"], ["d"], 1).count() == 2


def test_audits(frame):
    df = frame("k int, f int", (1, 1), (1, 2), (2, 9), (None, 9))
    assert values(validate.key_audit(df, ["k"])) == [(4, 1, 1, 1)]
    parent = frame("id int", (1,), (2,))
    assert values(validate.orphan_report([("f", df, ["f"], parent, ["id"])])) == [("f", 1, 2)]
    assert values(maintain.load_check(df.dropna(), parent.withColumnRenamed("id", "k"), ["k"])) == [(2, 2, 0)]


def test_density_of_one_value(frame):
    curve = stats.density(frame("g string, v double", ("a", 4.0), ("a", 4.0), ("b", 4.0)), ["g"], "v", 8)
    assert curve.count() == 16 and curve.filter("density IS NULL OR x < 4 OR x > 5").count() == 0


def test_join_names_stay_unique(frame):
    parts = [frame("k int, n int", (1, i)) for i in range(5)]
    got = joins.full_join_all(parts, ["k"])
    assert len(set(got.columns)) == 6 and sorted(got.first()[1:]) == [0, 1, 2, 3, 4]


def test_many_pivoted_names(spark):
    long = spark.range(201).selectExpr("1 AS k", "concat('n', id) AS name", "id AS value")
    assert len(reshape.to_wide(long, ["k"], "name", "value", "value").columns) == 202


def test_separators_are_plain_text(frame):
    df = frame("t string", ("a.b",))
    assert values(reshape.split_rows(df, "t", ".")) == [("a",), ("b",)]
    assert values(reshape.split_columns(df, "t", ".", ["x", "y"]).select("x", "y")) == [("a", "b")]


def test_headers_and_synonyms(frame):
    assert shape.fix_headers(["Air Temp", "Air Temp", "# SMB c", "# SMB c", "a", "a", "a_2"], ("c", "r")) == [
        "air_temp", "air_temp_2", "no_smb_c", "no_smb_r", "a", "a_3", "a_2"]
    assert shape.coalesce_synonyms(frame("x int", (1,)), {"y": ["z"]}).first().asDict() == {"x": 1, "y": None}


def test_full_join_in_one_exchange(spark, frame):
    parts = [spark.range(50).select((F.col("id") % 50).alias("k"), (F.col("id") + i).alias("n")).where(F.col("id") % (i + 2) == 0) for i in range(6)]
    parts.append(frame("k long, m string", (None, "no key"), (7, None), (90, "z")))
    got = joins.full_join_all(parts, ["k"])
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    chain = parts[0]
    for part in parts[1:]:
        chain = joins.join_on(chain, part, ["k"], "full")
    assert got.columns == chain.columns and values(got) == values(chain)
    with pytest.raises(Exception, match="several rows of one key"):
        joins.full_join_all([parts[0], parts[1].union(parts[1])], ["k"]).collect()
    several = joins.natural_full_join_all([frame("k int, a int", (1, 1), (1, 2)), frame("k int, b int", (1, 3))], unique=False)
    assert several.count() == 2


def test_stacked_groups_of_a_hot_key(spark):
    many = spark.range(20_000).select(F.lit(1).alias("k"), F.when(F.col("id") > 10, F.col("id")).alias("v"), "id")
    few = spark.range(3).select(F.col("id").cast("int").alias("k"), (F.col("id") * 2).alias("v"))
    got = joins.stacked_groups([(many, "id"), (few, None)], ["k"])
    assert got.columns == ["k", "v_x", "v_y"] and values(got) == [(0, None, 0), (1, 11, 2), (2, None, 4)]


def test_values_by_day_count_one_column_at_a_time(frame):
    df = frame("day string, a int, b string", ("d", 1, "1"), ("d", 1, None), (None, None, "x"), (None, None, "x"))
    got = validate.values_by_day(df, "day", ["a", "b"])
    assert values(got) == sorted(
        [("a", "d", "1", 2), ("a", None, None, 2), ("b", "d", "1", 1), ("b", "d", None, 1), ("b", None, "x", 2)], key=str
    )
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 2 and "Expand" not in plan
