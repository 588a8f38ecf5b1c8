"""User-level reports on small fixtures."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import values
from fieldlab.plans import anglers, checks, detections, interviews, nests, species, views

RAW = "survey_number string, date string, time string, shift string, wind string, air_temp string, mean_air_temp string, _seq int"


def raw(frame):
    return frame(
        RAW,
        ("10", "45292", "45292.5", "1: 8:00-14:00", "45787", None, "12", 1),
        ("2", "45292", "45292.5", None, "calm", "9", None, 2),
        ("2", "45292", "45292.5", "22:00-02:00", None, None, "8", 3),
        ("1", None, "0.5", "x", "x", "x", "x", 4),
        ("1", "45293", None, "late", None, None, None, 5),
    )


def test_clean_main(frame):
    got = interviews.clean_main(raw(frame), synonyms={"air_temp": ["mean_air_temp"]})
    noon = dt.datetime(2024, 1, 1, 12)
    rows = values(got.select("date", "survey_number", "time", "shift", "wind", "air_temp", "hours_worked"), "date", "survey_number")
    assert rows == [
        (dt.date(2024, 1, 1), 1, noon, "22:00-02:00", "calm", "9", -20.0),
        (dt.date(2024, 1, 1), 2, noon + dt.timedelta(minutes=5), "1: 8:00-14:00", "5-10", "12", 6.0),
        (dt.date(2024, 1, 2), 1, None, "late", None, None, None),
    ]
    start = got.filter("wind = '5-10'").select("shift_start_time").first()[0]
    assert start == dt.datetime(2024, 1, 1, 8)


def test_questions_and_answers(frame):
    df = frame("survey int, q_a string, q_b string", (1, "yes", None))
    assert values(interviews.question_table(df, ["q_a", "q_b"])) == [(1, "q_a"), (2, "q_b")]
    assert values(interviews.answer_table(df, ["survey"], ["q_a", "q_b"])) == sorted([(1, 1, "yes"), (1, 2, None)], key=str)


def test_interview_view_does_not_fan_out(frame):
    a = frame("date int, survey int, caught int", (1, 1, 5), (1, 2, 0))
    b = frame("date int, survey int, caught int", (1, 1, 6), (2, 1, 1))
    no_keys = frame("x int", (1,))
    questions = frame("question_id int, question string", (1, "Why?"), (2, "Again?"))
    answers = frame("date int, survey int, question_id int, answer string, _seq int",
                    (1, 1, 1, None, 1), (1, 1, 1, "near", 2), (1, 1, 1, "later", 3), (1, 1, 2, "yes", 4))
    got = views.interview_view([a, b, no_keys], ["date", "survey"], questions, answers)
    assert got.columns == ["date", "survey", "caught_x", "caught_y", "Again?", "Why?"]
    assert values(got) == sorted([(1, 1, 5, 6, "yes", "near"), (1, 2, 0, None, None, None), (2, 1, None, 1, None, None)], key=str)
    assert views.interview_view([no_keys], ["date", "survey"]) is None


def test_table_view_pivots(frame):
    matrix = frame("TableName string, raw string, names string", ("Scale aging", "X", "X"))
    tables = {
        "raw": frame("fish int, ageType string, result int", (1, "a", 4), (1, "b", 5), (2, "a", 3)),
        "names": frame("ageType string, detailed string", ("a", "age"), ("b", "annuli")),
    }
    wide = dict(keys=["fish"], name="detailed", value="result", order="ageType")
    got = views.table_view(tables, matrix, "Scale aging", wide=wide)
    assert got.columns == ["fish", "age", "annuli"] and values(got) == sorted([("1", "4", "5"), ("2", "3", None)], key=str)


def test_species_ranking(frame):
    df = frame("p string", ("SMB; pikeminow",), ("bass and trout",), ("not an angler",), (None,), ("rb, ,ct",))
    assert species.species_ranking(df, "p", 1).collect() == [("smallmouth bass", 2)]
    assert species.species_ranking(df, "p", None).count() == 5


def test_coordinate_repair_keeps_every_row(frame):
    seen = frame("id int, receiver string, latitude double, longitude double",
                 (1, "VR2W-7", 49.0, -130.0), (2, "VR2W-8", 49.0, -130.0), (3, "VR2W-7", 49.0, -123.0),
                 (4, "VR2W-7", 49.0, None), (5, "VR2W", 49.0, 121.9))
    stations = frame("station_label string, station_lat string, station_lon string", ("7", "49 30.0 N", "121 30.0 W"))
    got = {r["id"]: (r["latitude"], r["longitude"]) for r in detections.repair_coordinates(seen, stations).collect()}
    assert got == {1: (49.5, -121.5), 2: (49.0, -130.0), 3: (49.0, -123.0), 4: (49.5, -121.5), 5: (49.0, -121.9)}


def test_repeated_stations_do_not_multiply(frame):
    seen = frame("id int, receiver string, latitude double, longitude double", (1, "VR2W-7", 49.0, -130.0), (2, "VR2W-7", 49.0, -122.0))
    stations = frame("station_label string, station_lat string, station_lon string", ("7", "49 30.0 N", "121 30.0 W"), ("7", "49 40.0 N", "121 0.0 W"))
    got = detections.repair_coordinates(seen, stations)
    assert values(got.select("id", "latitude")) == [(1, 49.5), (2, 49.0)]


def test_pairs_with_missing_parts_stay_apart(frame):
    seen = frame("at timestamp_ntz, s string, t string", (None, None, "7"), (None, "7", None))
    pairs = detections.activity(seen, "at", "s", "t").filter("report = 'station_transmitter'")
    assert values(pairs.select("value", "transmitter", "n")) == [("7", None, 1), (None, "7", 1)]


def test_interview_parts_do_not_multiply(frame):
    fish = frame("survey int, date int, species string", (1, 1, "a"), (1, 1, "b"), (1, 1, "c"))
    people = frame("survey int, date int, sex string, _seq int", (1, 1, "m", 2), (1, 1, "f", 1))
    assert values(views.interview_view([fish, people], ["date", "survey"])) == [(1, 1, "a", "f")]
    answers = frame("survey int, date int, question_id int, answer string, _seq int", (1, 1, 1, "x", 1))
    assert views.interview_view([], ["date", "survey"], answers=answers).count() == 1
    assert views.interview_view([], ["date", "survey"], questions=frame("question_id int", (1,))).count() == 1


def test_older_splits(frame):
    main = frame("survey int, shift string, wind string, vessel string, number_smb_c string, comments string", (1, "a", "b", "c", "d", "e"))
    got = interviews.older_main_splits(main, "survey")
    assert {k: v.columns[1:] for k, v in got.items()} == {"shifts": ["shift"], "weather": ["wind"], "fishing_details": ["vessel"], "catch": ["number_smb_c"]}


def test_recaptures(frame):
    marks = frame("pit string, day int", ("a", 2), ("a", 1), (None, 1), ("b", 1))
    seen = frame("pit string, day int", ("a", 5), ("a", 6), (None, 7), ("c", 8))
    got = detections.recaptured(marks, seen, "pit", ["day"])
    assert values(got) == [("a", 1, 5), ("a", 1, 6)]
    assert detections.times_seen(got, "pit").collect() == [("a", 2)]


def test_nests(frame):
    df = frame("id int, latitude string, longitude string", (1, "49.05", "-122.0"), (2, "5434567", "574321"), (3, None, None))
    got = {r["id"]: r for r in nests.normalise_nests(df).collect()}
    assert got[1]["easting"] == pytest.approx(573107, abs=200) and got[1]["northing"] == pytest.approx(5433500, abs=2000)
    assert (got[2]["easting"], got[2]["northing"]) == (574321.0, 5434567.0)
    assert (got[3]["kind"], got[3]["easting"]) == ("blank", None)
    notes = frame("activity string, comments string", ("Nest not destroyed. No fry captured.", "x"), ("Nest destroyed.", "Old nest"), ("Checked", None))
    labelled = nests.outcome_status(notes, "activity")
    assert values(nests.outcome_reasons(labelled, "comments", "activity").select("status", "reason")) == [
        ("Destroyed", "Old Nest"), ("Not Destroyed", "No Fry Captured")]


def test_origin(frame):
    people = frame("s int, k int, post_code string", (1, 1, "v2r"), (1, 2, "zzz"), (2, 1, "V2R"), (3, 1, "x0x"), (4, 1, None))
    codes = frame("post_code string, lat double, lon double", ("V2R", 49.1, -121.9), ("ZZZ", 50.0, -120.0), ("X0X", None, None))
    got = anglers.origin_distances(people, ["s"], ["k"], codes)
    assert [r["post_code"] for r in got.collect()] == ["V2R"]


def test_age_structure_and_shares(frame):
    fish = frame("age int, length double, sex string", *[(a, 100.0 * a + i, "MF"[i % 2]) for a in (1, 2) for i in range(6)])
    got = anglers.age_structure(fish, "age", "length", "sex", 16)
    assert values(got["ages"]) == [(1, 6, 0.5), (2, 6, 0.5)]
    assert got["density"].count() == 32 and got["length_at_age"].count() == 2
    asked = frame("q int, a string", (7, "yes"), (7, "no"), (7, "yes"), (8, "no"))
    assert values(anglers.answer_shares(asked, "q", 7, "a")) == [("no", 1, 33.3), ("yes", 2, 66.7)]


def test_column_report(frame):
    report = checks.column_report(frame("d int, a string", (1, "1"), (1, "x"), (2, "1")), ["a"], "d")
    assert values(report["failed"]) == [(1, "a", "x")]
    assert values(report["by_day"]) == [("a", 1, "1", 1), ("a", 1, "x", 1), ("a", 2, "1", 1)]
    assert report["profile"].select(F.col("converted")).first()[0] == 2


def test_sheet_texts_are_read_once_and_counted_once(frame):
    """A hot date, hot times, repeated texts and texts that are no date, against a plain window; each use of the sheet reads its texts once."""
    texts = ["45292.25"] * 40 + ["45292.5"] * 30 + ["45293.25", "45293", " 45294 ", "x", "", None, "1e9", "-5.5"]
    raw = frame("species string, date_time string, _seq int", *[("smb", text, i) for i, text in enumerate(texts)])
    got = interviews.clean_sheet(raw)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    # The rows, their counts, and the bounds and totals of the large groups of either numbering; a filter on what was read doubled each.
    assert plan.count("RLIKE") == plan.count("explode(") and "isnotnull(get(" not in plan
    kinds = {line.split("Aggregate ")[1].split("]")[0].split("#")[0] for line in plan.splitlines() if "count(1) AS _rows" in line}
    assert kinds == {"[date"}
    rows = values(got.select("_seq", "date", "survey_number", "time"))
    first, second, third = (dt.date(2024, 1, day) for day in (1, 2, 3))
    at = lambda day, hour, place: dt.datetime(day.year, day.month, day.day, hour) + dt.timedelta(minutes=5 * place)
    told = [(i, first, i + 1, at(first, 6, i)) for i in range(40)] + [(i, first, i + 1, at(first, 12, i - 40)) for i in range(40, 70)]
    told += [(70, second, 1, at(second, 6, 0)), (71, second, 2, at(second, 0, 0)), (72, third, 1, at(third, 0, 0))]
    before = dt.date(1899, 12, 24)
    assert rows == sorted([*told, (77, before, 1, at(before, 12, 0))], key=str)


def test_interview_lines_are_dealt_out(spark, tmp_path):
    """The rows of one file are spread over the tasks that sort them, whatever the size of a split."""
    from fieldlab.catalog.reports import interview_view
    from fieldlab.sources.tables import Store

    day = "timestamp_ntz'1996-01-02 00:00:00'"
    parts = {
        "orders": f"id AS o_orderkey; {day} AS o_orderdate; concat('p', id % 3) AS o_orderpriority; 'O' AS o_orderstatus",
        "lineitem": "id DIV 4 AS l_orderkey; CAST(id % 4 + 1 AS INT) AS l_linenumber; id AS l_partkey; id % 7 AS l_suppkey; 1.0D AS l_extendedprice; "
        "CAST(id % 5 AS DOUBLE) AS l_quantity; 0.1D AS l_tax; CAST(id % 4 AS STRING) AS l_returnflag",
        "supplier": "id AS s_suppkey", "region": "CAST(id AS INT) AS r_regionkey",
    }
    for name, columns in parts.items():
        rows = {"orders": 50, "lineitem": 200, "supplier": 7, "region": 5}[name]
        spark.range(0, rows, 1, 1).selectExpr(*columns.split("; ")).write.parquet(f"{tmp_path}/{name}.parquet")
    got = interview_view(Store(spark, str(tmp_path)))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    dealt = [line.split("Repartition")[1] for line in plan.splitlines() if "Repartition" in line]
    assert len(dealt) == 5 and all("8" in line for line in dealt)
    rows = values(got.select("survey", "site", "species", "person", "caught", "Why this location", "Clean, drain, dry"), "survey")
    assert rows == [(i, f"p{i % 3}", 4 * i, (4 * i + 3) % 7, float(sum((4 * i + k) % 5 for k in range(4))), "0", "2") for i in range(50)]
