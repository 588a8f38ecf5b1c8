"""User-level views and reports over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldlab.catalog.aggregating import _TEXT_LINES, _rounded, text_lines, utm_sql
from fieldlab.catalog.joining import _ANGLERS, angler_tables
from fieldlab.catalog.registry import query
from fieldlab.catalog.scalars import NEST_PLACES, NEST_SQL, SHIFT_SQL, nest_codes, nest_places, shift_text
from fieldlab.catalog.shaping import _CELLS, _HEADERS, _sheet_cells
from fieldlab.functions import text
from fieldlab.functions.geo import LAKE_LAT, LAKE_LON
from fieldlab.operators import aggregates, shape
from fieldlab.operators.sets import tagged
from fieldlab.session import fresh_path
from fieldlab.sources.versions import StoredTable
from fieldlab.plans import anglers, checks, detections, interviews, nests, species, views


@query("q1_table_view", f"""
WITH {_ANGLERS}
SELECT CAST(o_orderdate AS DATE) AS date, CAST(a.nationkey AS VARCHAR) AS nationkey, CAST(o_custkey AS VARCHAR) AS custkey,
  CAST(o_orderkey AS VARCHAR) AS orderkey, o_orderstatus AS status, name, n_name
FROM orders LEFT JOIN anglers a ON o_custkey = a.custkey LEFT JOIN places p ON a.nationkey IS NOT DISTINCT FROM p.nationkey
WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1998-12-31' AND o_orderstatus IN ('F', 'P')""")
def table_view(t):
    orders, people, places = angler_tables(t)
    dated = t.orders.select(F.col("o_orderkey").alias("orderkey"), F.col("o_orderdate").alias("date"))
    main = orders.join(dated, "orderkey")
    # One display name per region; the mark says which tables it shows.
    matrix = t.region.select(
        F.col("r_name").alias("TableName"), F.lit("X").alias("interviews"), F.lit("X").alias("people"),
        F.lit("X").alias("places"), F.lit("").alias("spare"),
    )
    tables = {"interviews": main, "people": people, "places": places, "spare": t.supplier}
    return views.table_view(
        tables, matrix, "AFRICA", "date", "1996-01-01", "1998-12-31", {"status": ["F", "P"], "name": []}
    )


@query("q1_table_view_wide", """
SELECT CAST(user_id AS VARCHAR) AS user_id, min(CAST(event_id AS VARCHAR)) FILTER (event_type = 'click') AS is_click,
  min(CAST(event_id AS VARCHAR)) FILTER (event_type = 'error') AS is_error, min(CAST(event_id AS VARCHAR)) FILTER (event_type = 'purchase') AS is_purchase,
  min(CAST(event_id AS VARCHAR)) FILTER (event_type = 'signup') AS is_signup, min(CAST(event_id AS VARCHAR)) FILTER (event_type = 'view') AS is_view
FROM events GROUP BY 1""")
def table_view_wide(t):
    matrix = t.region.select(F.col("r_name").alias("TableName"), F.lit("X").alias("raw"), F.lit("X").alias("names"))
    tables = {
        "raw": t.events.select("user_id", "event_type", "event_id"),
        "names": t.events.select("event_type", F.concat(F.lit("is_"), "event_type").alias("detailed")).distinct(),
    }
    wide = {"keys": ["user_id"], "name": "detailed", "value": "event_id", "order": "event_id"}
    return views.table_view(tables, matrix, "ASIA", wide=wide)


@query("q2_interview_view", """
WITH s AS (SELECT o_orderkey AS survey, CAST(o_orderdate AS DATE) AS date, o_orderpriority AS site, o_orderstatus AS time FROM orders),
f AS (SELECT o_orderkey AS survey, CAST(o_orderdate AS DATE) AS date,
  arg_min(l_partkey, (l_linenumber, l_partkey, l_suppkey, l_extendedprice)) AS species,
  arg_min(l_quantity, (l_linenumber, l_partkey, l_suppkey, l_extendedprice)) AS time,
  arg_min(l_suppkey, (-l_linenumber, l_partkey, l_suppkey, l_extendedprice)) AS person,
  arg_min(l_tax, (-l_linenumber, l_partkey, l_suppkey, l_extendedprice)) AS person_time, sum(l_quantity) AS caught
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2),
a AS (SELECT o_orderkey AS survey, CAST(o_orderdate AS DATE) AS date,
  arg_min(l_returnflag, (l_linenumber, l_partkey, l_suppkey, l_extendedprice)) FILTER (l_linenumber <= 2) AS "Why this location",
  arg_min(l_returnflag, (l_linenumber, l_partkey, l_suppkey, l_extendedprice)) FILTER (l_linenumber > 2) AS "Clean, drain, dry"
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2)
SELECT survey, date, site, s.time AS time_x, species, f.time AS time_y, person, person_time AS time_x_x, caught AS caught, 'n' || caught AS time_y_y,
  "Why this location", "Clean, drain, dry" FROM s LEFT JOIN f USING (survey, date) LEFT JOIN a USING (survey, date)""")
def interview_view(t):
    on = ["survey", "date"]
    surveys = t.orders.select(
        F.col("o_orderkey").alias("survey"), F.to_date("o_orderdate").alias("date"), F.col("o_orderpriority").alias("site"),
        F.col("o_orderstatus").alias("time"),
    )
    # Several fish, persons and answers per survey; all sheets have a time. Dealt out to a fixed number of tasks, as splits of files and
    # merged partitions are cut by compressed bytes: one of them can hold many millions of such rows, which one task then sorts. The
    # surveys go in turn: dealt by key as well, all parts would meet in one task without the exchange that leaves a row per key.
    tasks = int(t.lineitem.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = t.lineitem.repartition(tasks, "l_orderkey")
    lines = dealt.withColumnRenamed("l_orderkey", "survey").join(surveys.select(*on), "survey")
    place = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").alias("_seq")
    back = F.struct(-F.col("l_linenumber"), "l_partkey", "l_suppkey", "l_extendedprice").alias("_seq")
    fish = lines.select(*on, F.col("l_partkey").alias("species"), F.col("l_quantity").alias("time"), place)
    people = lines.select(*on, F.col("l_suppkey").alias("person"), F.col("l_tax").alias("time"), back)
    caught = lines.groupBy(*on).agg(F.sum("l_quantity").alias("caught")).withColumn(
        "time", F.concat(F.lit("n"), F.col("caught").cast("string"))
    )
    answers = lines.select(
        *on, F.when(F.col("l_linenumber") <= 2, 1).otherwise(2).alias("question_id"), F.col("l_returnflag").alias("answer"), place
    )
    names = ["Why this location", "Clean, drain, dry"]
    questions = t.region.filter("r_regionkey IN (1, 2)").select(
        F.col("r_regionkey").alias("question_id"),
        F.when(F.col("r_regionkey") == 1, names[0]).otherwise(names[1]).alias("question"),
    )
    return views.interview_view([surveys.repartition(tasks), fish, people, caught, t.supplier], on, questions, answers, names=names)


# Raw main sheet built from orders: serial dates, fractional times, several rows per survey.
_RAW = f"""SELECT CAST(o_custkey % 3 + 9 AS VARCHAR) AS survey_number, CAST(o_orderdate AS DATE) AS date,
  o_orderkey % 4 AS q, {SHIFT_SQL} AS shift, o_orderkey AS seq,
  CASE WHEN o_orderstatus = 'F' THEN '5-10' WHEN o_orderstatus = 'O' THEN 'calm' END AS wind,
  CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS vessel FROM orders"""


def raw_main(t):
    serial = F.date_diff(F.to_date("o_orderdate"), F.lit("1899-12-30").cast("date")).cast("string")
    return t.orders.select(
        (F.col("o_custkey") % 3 + 9).cast("string").alias("survey_number"),
        serial.alias("date"),
        F.concat(serial, F.lit("."), ((F.col("o_orderkey") % 4) * 25).cast("string")).alias("time"),
        shift_text().alias("shift"),
        F.when(F.col("o_orderstatus") == "F", "45787").when(F.col("o_orderstatus") == "O", "calm").alias("wind"),
        F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderstatus")).alias("vessel"),
        F.col("o_orderkey").alias("_seq"),
    )


@query("q3_clean_main", f"""
WITH one AS (SELECT survey_number, date, q, arg_min(shift, seq) FILTER (shift IS NOT NULL) AS shift,
    arg_min(wind, seq) FILTER (wind IS NOT NULL) AS wind, arg_min(vessel, seq) FILTER (vessel IS NOT NULL) AS vessel
  FROM ({_RAW}) GROUP BY 1, 2, 3),
num AS (SELECT * EXCLUDE (survey_number), row_number() OVER (PARTITION BY date
  ORDER BY CAST(survey_number AS INTEGER), q) AS survey_number FROM one),
spr AS (SELECT * EXCLUDE (q), date + to_seconds(q * 21600) + to_minutes(5 * (row_number() OVER (PARTITION BY date, q ORDER BY survey_number) - 1)) AS time FROM num),
cut AS (SELECT *, CASE shift WHEN '1: 8:00-14:00' THEN 28800 WHEN '08:00:00-14:30:00' THEN 28800 WHEN '22:00-02:00' THEN 79200 END AS s0,
  CASE shift WHEN '1: 8:00-14:00' THEN 50400 WHEN '08:00:00-14:30:00' THEN 52200 WHEN '22:00-02:00' THEN 7200 END AS s1 FROM spr)
SELECT survey_number, date, time, shift, wind, vessel, date + to_seconds(s0) AS shift_start_time,
  date + to_seconds(s1) AS shift_end_time, (s1 - s0) / 3600.0::DOUBLE AS hours_worked FROM cut""")
def clean_main(t):
    return interviews.clean_main(raw_main(t))


@query("q3_clean_fish_sheet", """
WITH f AS (SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS date, l_linenumber % 4 AS q, l_returnflag AS species,
    (l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS seq FROM lineitem),
n AS (SELECT *, row_number() OVER (PARTITION BY date ORDER BY seq) AS survey_number FROM f)
SELECT l_orderkey, l_linenumber, date, species, survey_number,
  date + to_seconds(q * 21600) + to_minutes(5 * (row_number() OVER (PARTITION BY date, q ORDER BY survey_number) - 1)) AS time FROM n""")
def clean_fish_sheet(t):
    serial = F.date_diff(F.to_date("l_shipdate"), F.lit("1899-12-30").cast("date")).cast("string")
    raw = t.lineitem.select(
        "l_orderkey", "l_linenumber", F.col("l_returnflag").alias("spp"),
        F.concat(serial, F.lit("."), ((F.col("l_linenumber") % 4) * 25).cast("string")).alias("date_time"),
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").alias("_seq"),
    )
    return interviews.clean_sheet(raw, synonyms={"species": ["spp"]}).drop("_seq")


@query("q5_catch_reconciliation", """
WITH f AS (SELECT l_orderkey, sum(l_quantity) AS a, sum(l_linenumber) AS b FROM lineitem GROUP BY 1)
SELECT 'caught' AS kind, CAST(year(o_orderdate) AS INTEGER) AS year, sum(COALESCE(a, 0)) + sum(COALESCE(b, 0))::DOUBLE AS component_total,
  sum(o_custkey)::DOUBLE AS reported_total, sum(COALESCE(a, 0)) + sum(COALESCE(b, 0)) - sum(o_custkey)::DOUBLE AS difference
FROM orders LEFT JOIN f ON l_orderkey = o_orderkey GROUP BY 2
UNION ALL SELECT 'retained', CAST(year(o_orderdate) AS INTEGER), sum(COALESCE(b, 0))::DOUBLE, sum(o_orderkey)::DOUBLE,
  sum(COALESCE(b, 0))::DOUBLE - sum(o_orderkey)::DOUBLE FROM orders LEFT JOIN f ON l_orderkey = o_orderkey GROUP BY 2""")
def catch_reconciliation(t):
    fish = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum("l_quantity").alias("number_smb_c"), F.sum("l_linenumber").alias("number_kok_r")
    )
    main = t.orders.join(fish, "o_orderkey", "left").withColumns(
        {"year": F.year("o_orderdate"), "number_kok_c": F.col("number_kok_r")}
    )
    return interviews.catch_reconciliation(
        main, (shape.matching(main, "^number.*_c$"), "o_custkey"), (shape.matching(main, "^number.*_r$"), "o_orderkey"), ["year"]
    )


_REPORT_PART = """SELECT '{0}' AS sheet, variable, count(*) AS n, count(value) AS present, count(try_cast(value AS DOUBLE)) AS converted
FROM ({1}) GROUP BY 2"""
#: All columns of the four sheets and the type in which they become text, if not their own.
_SHEET_COLUMNS = {
    "main": ("orders", "o_orderdate", {"o_orderkey": "", "o_custkey": "", "o_orderstatus": "", "o_totalprice": "DECIMAL(18, 2)", "o_orderdate": "DATE", "o_orderpriority": ""}),
    "demography": ("customer", None, {"c_custkey": "", "c_name": "", "c_nationkey": "", "c_acctbal": "DECIMAL(18, 2)", "c_mktsegment": ""}),
    "fish": ("lineitem", "l_shipdate", {
        "l_orderkey": "", "l_partkey": "", "l_suppkey": "", "l_linenumber": "", "l_quantity": "DECIMAL(18, 2)", "l_extendedprice": "DECIMAL(18, 2)",
        "l_discount": "", "l_tax": "", "l_returnflag": "", "l_linestatus": "", "l_shipdate": "DATE"}),
    "counts": ("events", "ts", {"event_id": "", "ts": "DATE", "user_id": "", "event_type": "", "value": "DECIMAL(18, 4)", "props": ""}),
}
#: Cells of the fish sheet that are not as they should be: the discount of returned lines, taxes of closed ones.
_ODD_CELLS = {
    "l_discount": "CASE WHEN l_returnflag = 'R' THEN 'n/a' ELSE CAST(l_discount AS {0}) END",
    "l_tax": "CASE WHEN l_linestatus = 'O' THEN NULL ELSE concat(CAST(l_linenumber AS {0}), 'f') END",
}


def _cell(column: str, kind: str, text: str) -> str:
    """SQL of a cell as text, for Spark (STRING) and for the oracle (VARCHAR)."""
    return _ODD_CELLS.get(column, f"CAST({f'CAST({column} AS {kind})' if kind else column} AS {{0}})").format(text)


_SHEETS = {
    sheet: f"SELECT {f'CAST(CAST({day} AS DATE) AS VARCHAR)' if day else 'NULL::VARCHAR'} AS date, unnest({list(columns)}) AS variable, "
    f"unnest([{', '.join(_cell(c, kind, 'VARCHAR') for c, kind in columns.items())}]) AS value FROM {source}"
    for sheet, (source, day, columns) in _SHEET_COLUMNS.items()
}


def _sheets(t):
    """The four sheets as text with all their columns, and the names of these."""
    return {
        sheet: (
            t.table(source).select(
                F.to_date(day).cast("string").alias("date") if day else F.lit(None).cast("string").alias("date"),
                *[F.expr(_cell(c, kind, "STRING")).alias(c) for c, kind in columns.items()],
            ),
            list(columns),
        )
        for sheet, (source, day, columns) in _SHEET_COLUMNS.items()
    }


def _reports(t, part):
    return tagged({name: checks.column_report(df, columns, "date")[part] for name, (df, columns) in _sheets(t).items()}, "sheet")


@query("q6_column_reports", f"""
SELECT sheet, variable, n, present, converted, present - converted AS failed, converted > 0.5 * n AS numeric,
  converted > 0 AND converted >= 0.8 * present AS plottable
FROM ({' UNION ALL '.join(_REPORT_PART.format(k, v) for k, v in _SHEETS.items())})""")
def column_reports(t):
    return _reports(t, "profile")


@query("q6_all_failed_values", f"""
SELECT * FROM ({' UNION ALL '.join(f"SELECT '{k}' AS sheet, date, variable, value FROM ({v})" for k, v in _SHEETS.items())})
WHERE value IS NOT NULL AND try_cast(value AS DOUBLE) IS NULL""")
def all_failed_values(t):
    return _reports(t, "failed")


@query("q6_values_by_day", f"""
SELECT sheet, variable, date, value, count(*) AS n FROM (
  {' UNION ALL '.join(f"SELECT '{k}' AS sheet, * FROM ({v})" for k, v in _SHEETS.items())}) GROUP BY ALL""")
def all_values_by_day(t):
    return _reports(t, "by_day")


@query("q6_failed_values_first_50", f"""
SELECT date, variable, value FROM (SELECT *, row_number() OVER (PARTITION BY variable
    ORDER BY date, l_orderkey, l_linenumber, value) AS k FROM (
  SELECT CAST(date AS VARCHAR) AS date, l_orderkey, l_linenumber, unnest(['l_quantity', 'l_discount', 'l_tax']) AS variable,
    unnest([l_quantity, l_discount, l_tax]) AS value FROM {_TEXT_LINES})
  WHERE value IS NOT NULL AND try_cast(value AS DOUBLE) IS NULL) WHERE k <= 50""")
def failed_first_50(t):
    sheet = text_lines(t).withColumn("date", F.col("date").cast("string"))
    columns = ["l_quantity", "l_discount", "l_tax"]
    return checks.column_report(sheet, columns, "date", ["date", "l_orderkey", "l_linenumber"], 50)["failed"]


_SPELLING_CASE = "CASE s " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in text.SPECIES_SPELLINGS.items()) + " ELSE s END"


@query("q7_species_ranking", f"""
SELECT species, count(*) AS n FROM (SELECT {_SPELLING_CASE} AS species FROM (
  SELECT trim(unnest(string_split(regexp_replace(lower(CASE p_type WHEN 'SMALL' THEN 'SMB; ' WHEN 'LARGE' THEN 'pikeminow and bass or '
    WHEN 'PROMO' THEN 'not an angler,' ELSE '' END || p_name), ';|\\band\\b|\\bor\\b', ',', 'g'), ','))) AS s FROM part) WHERE s <> '')
WHERE species <> 'non-angler' GROUP BY 1 ORDER BY n DESC, species LIMIT 6""")
def species_ranking(t):
    lead = (
        F.when(F.col("p_type") == "SMALL", "SMB; ").when(F.col("p_type") == "LARGE", "pikeminow and bass or ")
        .when(F.col("p_type") == "PROMO", "not an angler,").otherwise("")
    )
    return species.species_ranking(t.part.select(F.concat(lead, "p_name").alias("preferred")), "preferred")


_DETECTIONS = """SELECT event_id, 'VR2W-' || user_id AS receiver, 49.05::DOUBLE AS latitude,
  CASE event_type WHEN 'error' THEN -130.5 WHEN 'view' THEN 121.97 WHEN 'signup' THEN -123.0 WHEN 'purchase' THEN -121.95 END::DOUBLE AS longitude FROM events"""


@query("q8_repair_coordinates", f"""
WITH st AS (SELECT CAST(s_suppkey AS VARCHAR) AS label, 49 + (s_suppkey % 60 + 0.25) / 60.0::DOUBLE AS lat, -(121 + (s_suppkey % 60 + 0.5) / 60.0::DOUBLE) AS lon FROM supplier)
SELECT split_part(receiver, '-', 2) AS receiver_name, event_id, receiver,
  round(CASE WHEN longitude IS NULL OR longitude < -123 THEN COALESCE(lat, latitude) ELSE latitude END, 9) AS latitude,
  round(-abs(CASE WHEN longitude IS NULL OR longitude < -123 THEN COALESCE(lon, longitude) ELSE longitude END), 9) AS longitude
FROM ({_DETECTIONS}) LEFT JOIN st ON label = split_part(receiver, '-', 2)""")
def repair_coordinates(t):
    return _rounded(detections.repair_coordinates(*_seen_and_stations(t)), 9)


def _seen_and_stations(t):
    kind = F.col("event_type")
    seen = t.events.select(
        "event_id", F.concat(F.lit("VR2W-"), F.col("user_id").cast("string")).alias("receiver"), F.lit(49.05).alias("latitude"),
        F.when(kind == "error", -130.5).when(kind == "view", 121.97).when(kind == "signup", -123.0)
        .when(kind == "purchase", -121.95).alias("longitude"),
    )
    minutes = (F.col("s_suppkey") % 60).cast("string")
    stations = t.supplier.select(
        F.col("s_suppkey").cast("string").alias("station_label"),
        F.concat(F.lit("49 "), minutes, F.lit(".25 N")).alias("station_lat"),
        F.concat(F.lit("121 "), minutes, F.lit(".5 W")).alias("station_lon"),
    )
    return seen, stations


@query("q8_rebuild", f"""
WITH st AS (SELECT CAST(s_suppkey AS VARCHAR) AS label, 49 + (s_suppkey % 60 + 0.25) / 60.0::DOUBLE AS lat, -(121 + (s_suppkey % 60 + 0.5) / 60.0::DOUBLE) AS lon FROM supplier)
SELECT event_id, receiver,
  round(CASE WHEN longitude IS NULL OR longitude < -123 THEN COALESCE(lat, latitude) ELSE latitude END, 9) AS latitude,
  round(-abs(CASE WHEN longitude IS NULL OR longitude < -123 THEN COALESCE(lon, longitude) ELSE longitude END), 9) AS longitude
FROM ({_DETECTIONS}) LEFT JOIN st ON label = split_part(receiver, '-', 2)""")
def rebuild_detections(t):
    """The stored detections, repaired and stored over themselves."""
    seen, stations = _seen_and_stations(t)
    table = StoredTable(t.spark, fresh_path(t.spark)).replace(seen)
    table.replace(detections.repair_coordinates(table.read(), stations).select(*seen.columns), since=table.version)
    return _rounded(table.read(), 9)


@query("q9_tag_registry", _CELLS + """,
reg AS (SELECT a AS transmitter, b AS serial_no, c AS tag_family, DATE '1899-12-30' + CAST(45000 + l_suppkey AS INTEGER) AS date_sold,
  row_number() OVER (PARTITION BY a ORDER BY CAST(l_suppkey AS VARCHAR), r) AS k FROM src)
SELECT transmitter, serial_no, tag_family, date_sold FROM (SELECT DISTINCT CAST(user_id AS VARCHAR) AS transmitter FROM events)
LEFT JOIN (SELECT * FROM reg WHERE k = 1) USING (transmitter)""")
def tag_registry(t):
    sheet = detections.sale_sheet(_sheet_cells(t), 2, _HEADERS)
    table = sheet.drop("sheet").withColumnRenamed("vue_tag_id", "transmitter")
    seen = t.events.select(F.col("user_id").cast("string").alias("transmitter"))
    return detections.tag_registry([table], seen, "transmitter", ["file", "row"]).drop("file", "row")


@query("q10_normalised_nests", utm_sql(f"""SELECT p_partkey AS id, CAST(longitude AS DOUBLE) AS lon, CAST(latitude AS DOUBLE) AS lat
  FROM ({NEST_PLACES}) WHERE latitude LIKE '49.%'""") + f"""
SELECT p_partkey, CASE WHEN latitude IS NULL THEN 'blank' WHEN latitude LIKE '49.%' THEN 'degrees' ELSE 'utm' END AS kind,
  round(CASE WHEN latitude LIKE '49.%' THEN easting WHEN length(latitude) = 7 THEN CAST(longitude AS DOUBLE) ELSE CAST(latitude AS DOUBLE) END, 3) AS easting,
  round(CASE WHEN latitude LIKE '49.%' THEN northing WHEN length(latitude) = 7 THEN CAST(latitude AS DOUBLE) ELSE CAST(longitude AS DOUBLE) END, 3) AS northing
FROM ({NEST_PLACES}) LEFT JOIN utm ON id = p_partkey""")
def normalised_nests(t):
    return _rounded(nests.normalise_nests(nest_places(t)), 3)


@query("q10_nests_appended", """
SELECT p_partkey, CASE WHEN p_size < 25 THEN p_name ELSE p_name || ' ' || p_brand || CASE WHEN p_type = 'PROMO' THEN '' ELSE '. Substrate: ' || p_type END END AS comments,
  CASE WHEN p_size >= 25 AND p_type <> 'PROMO' THEN p_type END AS substrate, CASE WHEN p_size >= 25 AND p_size % 2 = 0 THEN 'snail' END AS ais
FROM part""")
def nests_appended(t):
    stored = t.part.filter("p_size < 25").select("p_partkey", F.col("p_name").alias("comments"))
    batch = t.part.filter("p_size >= 25").select(
        "p_partkey", F.col("p_name").alias("comments"), F.col("p_brand").alias("location"),
        F.when(F.col("p_type") != "PROMO", F.col("p_type")).alias("substrate"), F.when(F.col("p_size") % 2 == 0, F.lit("snail")).alias("ais"),
    )
    return nests.append_nests(stored, nests.with_place_comments(batch, "location", "substrate"))


@query("q11_recaptured_tags", """
SELECT m.user_id, m.event_id AS event_id_x, r.event_id AS event_id_y FROM
  (SELECT user_id, min(event_id) AS event_id FROM events WHERE event_type = 'signup' GROUP BY 1) m
JOIN events r ON m.user_id = r.user_id WHERE r.event_type = 'purchase'""")
def recaptured_tags(t):
    rows = t.events.select("user_id", "event_id", "event_type")
    marks = rows.filter("event_type = 'signup'").drop("event_type")
    seen = rows.filter("event_type = 'purchase'").drop("event_type")
    return detections.recaptured(marks, seen, "user_id", ["event_id"])


@query("q11_times_seen", """
SELECT user_id, count(*) AS times FROM events WHERE event_type = 'purchase'
  AND user_id IN (SELECT user_id FROM events WHERE event_type = 'signup') GROUP BY 1 ORDER BY times DESC, user_id""")
def times_seen(t):
    return detections.times_seen(recaptured_tags(t), "user_id")


@query("q12_angler_origin", f"""
WITH codes AS (SELECT DISTINCT 'V' || c_nationkey || 'A' || (c_custkey % 40) AS post_code FROM customer WHERE c_mktsegment <> 'BUILDING'),
look AS (SELECT 'V' || n_nationkey || 'A' || k AS post_code, 49 + n_nationkey / 10.0::DOUBLE AS lat, -122 - k / 5.0::DOUBLE AS lon FROM nation, range(39) t(k)),
d AS (SELECT 2 * 6378.137::DOUBLE * asin(least(1, sqrt(pow(sin((radians(lat) - radians({LAKE_LAT}::DOUBLE)) / 2), 2) +
  cos(radians(lat)) * cos(radians({LAKE_LAT}::DOUBLE)) * pow(sin((radians(lon) - radians({LAKE_LON}::DOUBLE)) / 2), 2)))) AS km FROM codes JOIN look USING (post_code)),
b AS (SELECT CAST(least(floor(km / 50), greatest(floor((SELECT max(km) FROM d) / 50) - 1, 0)) * 50 AS BIGINT) AS low FROM d)
SELECT low, CAST(low AS VARCHAR) || ' - ' || CAST(low + 50 AS VARCHAR) AS distance_bin, count(*) AS n FROM b GROUP BY 1, 2""")
def angler_origin(t):
    people = t.customer.select(
        "c_custkey",
        F.when(
            F.col("c_mktsegment") != "BUILDING",
            F.concat(F.lit("v"), F.col("c_nationkey").cast("string"), F.lit("a"), (F.col("c_custkey") % 40).cast("string")),
        ).alias("post_code"),
    )
    k = F.explode(F.sequence(F.lit(0), F.lit(38))).alias("k")
    postcodes = t.nation.select("n_nationkey", k).select(
        F.concat(F.lit("V"), F.col("n_nationkey").cast("string"), F.lit("A"), F.col("k").cast("string")).alias("post_code"),
        (49 + F.col("n_nationkey") / 10).alias("lat"), (-122 - F.col("k") / 5).alias("lon"),
    )
    return anglers.origin_bins(people, ["c_custkey"], ["c_custkey"], postcodes)


@query("q13_detection_activity", """
SELECT *, rank() OVER (PARTITION BY report ORDER BY n DESC) AS rank FROM (
  SELECT 'station' AS report, event_type AS value, NULL::VARCHAR AS transmitter, count(*) AS n FROM events GROUP BY 2
  UNION ALL SELECT 'day', CAST(CAST(ts AS DATE) AS VARCHAR), NULL, count(*) FROM events GROUP BY 2
  UNION ALL SELECT 'hour', CAST(hour(ts) AS VARCHAR), NULL, count(*) FROM events GROUP BY 2
  UNION ALL SELECT 'transmitter', CAST(user_id AS VARCHAR), NULL, count(*) FROM events GROUP BY 2
  UNION ALL SELECT 'station_transmitter', event_type, CAST(user_id AS VARCHAR), count(*) FROM events GROUP BY 2, 3)""")
def detection_activity(t):
    return detections.activity(t.events, "ts", "event_type", "user_id")


@query("q14_nest_fragments", f"""
SELECT fragment, count(*) AS n FROM (SELECT trim(unnest(string_split(activity, '.'))) AS fragment FROM ({NEST_SQL})) WHERE fragment <> '' GROUP BY 1""")
def nest_fragments(t):
    described = nests.describe_activity(nest_codes(t), "destroyed", "fry")
    return nests.fragment_counts(described, "activity")


@query("q14_nest_outcomes", f"""
SELECT status, reason, count(*) AS n FROM (
  SELECT CASE WHEN contains(activity, 'Nest not destroyed') THEN 'Not Destroyed' WHEN contains(activity, 'Nest destroyed') THEN 'Destroyed' END AS status,
    CASE WHEN l_linenumber = 1 THEN 'Couldn''t Locate' WHEN l_linenumber = 2 THEN 'Old Nest' ELSE 'Other' END AS reason FROM ({NEST_SQL}))
WHERE status IS NOT NULL GROUP BY 1, 2""")
def nest_outcomes(t):
    described = nests.describe_activity(nest_codes(t), "destroyed", "fry").withColumn(
        "comments",
        F.when(F.col("l_linenumber") == 1, "COULDN'T locate it").when(F.col("l_linenumber") == 2, "an Old nest").otherwise("fine"),
    )
    labelled = nests.outcome_status(described, "activity")
    return aggregates.counts(nests.outcome_reasons(labelled, "comments", "activity"), "status", "reason")


@query("q14_nest_depths", """
WITH s AS (SELECT l_tax + l_discount AS depth, CASE l_returnflag WHEN 'A' THEN 'Destroyed' WHEN 'N' THEN 'Not Destroyed' END AS status FROM lineitem
  WHERE l_returnflag <> 'R'), r AS (SELECT min(depth) AS lo, max(depth) AS hi FROM s)
SELECT status, CAST(ceil((depth - lo) / ((hi - lo) / 29) + 0.5) - 1 AS BIGINT) AS bin, count(*) AS n,
  round(lo + (ceil((depth - lo) / ((hi - lo) / 29) + 0.5) - 1) * ((hi - lo) / 29), 6) AS centre FROM s, r GROUP BY 1, 2, 4""")
def nest_depths(t):
    rows = t.lineitem.select(
        F.when(F.col("l_returnflag") == "A", "Nest destroyed.").when(F.col("l_returnflag") == "N", "Nest not destroyed.").alias("activity"),
        (F.col("l_tax") + F.col("l_discount")).alias("depth"), F.col("l_linestatus").alias("substrate"),
    )
    labelled = nests.outcome_status(rows, "activity")
    return _rounded(nests.outcome_report(labelled, "status", "substrate", "depth")["depth"])


@query("q14_nest_substrates", """
SELECT l_linestatus AS substrate, CASE l_returnflag WHEN 'A' THEN 'Destroyed' ELSE 'Not Destroyed' END AS status, count(*) AS n
FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1, 2""")
def nest_substrates(t):
    rows = t.lineitem.select(
        F.when(F.col("l_returnflag") == "A", "Nest destroyed.").when(F.col("l_returnflag") == "N", "Nest not destroyed.").alias("activity"),
        F.col("l_linestatus").alias("substrate"), (F.col("l_tax") + F.col("l_discount")).alias("depth"),
    )
    return nests.outcome_report(nests.outcome_status(rows, "activity"), "status", "substrate", "depth")["substrate"]


def _fish(t):
    return t.lineitem.select(F.col("l_linenumber").alias("age"), "l_extendedprice", "l_returnflag")


@query("q15_sexes", "SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1")
def sexes(t):
    return anglers.age_structure(_fish(t), "age", "l_extendedprice", "l_returnflag", 64)["sexes"]


@query("q15_length_density", """
WITH r AS (SELECT min(l_extendedprice) AS lo, (max(l_extendedprice) - min(l_extendedprice)) / 63 AS step FROM lineitem),
s AS (SELECT l_returnflag, count(*) AS n, stddev_samp(l_extendedprice) AS sd,
  quantile_cont(l_extendedprice, 0.75) - quantile_cont(l_extendedprice, 0.25) AS iqr FROM lineitem GROUP BY 1),
b AS (SELECT l_returnflag, n, 0.9 * least(sd, iqr / 1.34) * pow(n, -0.2) AS bw FROM s),
p AS (SELECT l_returnflag, least(floor((l_extendedprice - lo) / step), 62) AS i,
  (l_extendedprice - lo) / step - least(floor((l_extendedprice - lo) / step), 62) AS w FROM lineitem, r),
g AS (SELECT l_returnflag, i, sum(w) AS w FROM (SELECT l_returnflag, i, 1 - w AS w FROM p UNION ALL SELECT l_returnflag, i + 1, w FROM p) GROUP BY 1, 2)
SELECT l_returnflag, CAST(j AS INTEGER) AS point, round(lo + j * step, 6) AS x,
  round(sum(w * exp(-0.5 * ((j - i) * step / bw) * ((j - i) * step / bw))) / (n * bw * sqrt(2 * pi())), 9) AS density
FROM g JOIN b USING (l_returnflag), r, range(64) grid(j) GROUP BY l_returnflag, j, n, bw, lo, step""")
def length_density(t):
    curve = anglers.age_structure(_fish(t), "age", "l_extendedprice", "l_returnflag", 64)["density"]
    return curve.withColumns({"x": F.round("x", 6), "density": F.round("density", 9)})


@query("q15_age_shares", """
SELECT l_linenumber AS age, count(*) AS n, count(*) * 1.0::DOUBLE / (SELECT count(*) FROM lineitem) AS share FROM lineitem GROUP BY 1""")
def age_shares(t):
    fish = t.lineitem.select(F.col("l_linenumber").alias("age"), "l_extendedprice", "l_returnflag")
    return anglers.age_structure(fish, "age", "l_extendedprice", "l_returnflag", 64)["ages"]


@query("q15_length_at_age", """
WITH q AS (SELECT l_linenumber AS age, quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.5) AS median,
  quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem GROUP BY 1),
x AS (SELECT age, l_extendedprice AS v, q1, median, q3, v >= q1 - 1.5 * (q3 - q1) AND v <= q3 + 1.5 * (q3 - q1) AS inside FROM lineitem JOIN q ON age = l_linenumber)
SELECT age, count(*) AS n, round(max(q1), 6) AS q1, round(max(median), 6) AS median, round(max(q3), 6) AS q3,
  min(v) FILTER (inside) AS whisker_low, max(v) FILTER (inside) AS whisker_high, CAST(count(*) FILTER (NOT inside) AS BIGINT) AS outliers FROM x GROUP BY 1""")
def length_at_age(t):
    fish = t.lineitem.select(F.col("l_linenumber").alias("age"), "l_extendedprice", "l_returnflag")
    return _rounded(anglers.age_structure(fish, "age", "l_extendedprice", "l_returnflag", 64)["length_at_age"])


@query("q16_answer_shares", """
SELECT user_id, count(*) AS n, count(*) * 1.0::DOUBLE / (SELECT count(*) FROM events WHERE event_type = 'purchase') * 100 AS percent
FROM events WHERE event_type = 'purchase' GROUP BY 1""")
def answer_shares(t):
    return anglers.answer_shares(t.events, "event_type", "purchase", "user_id", None)


@query("q16_reason_shares", f"""
WITH a AS (SELECT CASE {' '.join(f"WHEN regexp_matches(text, '(?i){p}') THEN '{label}'" for p, label in text.SITE_REASONS)} ELSE 'Other' END AS reason
  FROM conversations WHERE role = 'user')
SELECT reason, count(*) AS n, count(*) * 1.0::DOUBLE / (SELECT count(*) FROM a) * 100 AS percent FROM a GROUP BY 1""")
def reason_shares(t):
    return anglers.reason_shares(t.conversations, "role", "user", "text", None)
