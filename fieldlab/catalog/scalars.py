"""Scalar functions over the given tables; odd texts are built from table columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldlab.catalog.aggregating import POINTS, points, utm_sql
from fieldlab.catalog.registry import BLANKS, query
from fieldlab.functions import geo, numbers, text, times
from fieldlab.operators.aggregates import counts
from fieldlab.plans.detections import WESTERN_BOUND, repair_coordinates

_S = lambda c: F.col(c).cast("string")


@query("xs1_trim_lower_upper", f"""
SELECT doc_id, trim(lower(text), {BLANKS}) AS tidy, upper(source) AS source FROM documents""")
def trim_lower_upper(t):
    return t.documents.select("doc_id", text.tidy("text").alias("tidy"), F.upper("source").alias("source"))


@query("xs2_replace_in_order", r"""
SELECT p_partkey, regexp_replace(regexp_replace(regexp_replace(p_name, '^small', 'smallmouth', 'g'), 'ring$', 'bass', 'g'),
  'smallmouth bass', 'SMB', 'g') AS name,
  CASE p_name WHEN 'blue bolt' THEN 'trout' WHEN 'red widget' THEN 'salmon' ELSE p_name END AS spelled FROM part""")
def replace_in_order(t):
    rules = [("^small", "smallmouth"), ("ring$", "bass"), ("smallmouth bass", "SMB")]
    return t.part.select(
        "p_partkey", text.replace_in_order("p_name", rules).alias("name"),
        text.spelled("p_name", {"blue bolt": "trout", "red widget": "salmon"}).alias("spelled"),
    )


@query("xs3_commas", r"""
SELECT p_partkey, regexp_replace(p_name || '; ' || p_type || ' and ' || p_brand || ' or none',
  '(?i);|\band\b|\bor\b', ',', 'g') AS list FROM part""")
def commas(t):
    mixed = F.concat("p_name", F.lit("; "), "p_type", F.lit(" and "), "p_brand", F.lit(" or none"))
    return t.part.select("p_partkey", text.commas(mixed).alias("list"))


@query("xs4_after_dash", r"""
SELECT page_id, CASE WHEN contains(url, '-') THEN regexp_extract(url, '-(.*)', 1) END AS tail,
  regexp_extract('VR2W-' || page_id || '-x', '-(.*)', 1) AS receiver FROM pages""")
def after_dash(t):
    label = F.concat(F.lit("VR2W-"), _S("page_id"), F.lit("-x"))
    return t.pages.select("page_id", text.after_dash("url").alias("tail"), text.after_dash(label).alias("receiver"))


@query("xs5_sum_numbers", r"""
SELECT event_id, CASE WHEN event_type <> 'view' THEN COALESCE(list_sum(list_transform(
  regexp_extract_all(props || ' 2 RB', '\d+'), lambda x: CAST(x AS DOUBLE))), 0) END AS total FROM events""")
def sum_numbers(t):
    cell = F.when(F.col("event_type") != "view", F.concat("props", F.lit(" 2 RB")))
    return t.events.select("event_id", text.sum_numbers(cell).alias("total"))


@query("xs6_digit_count", "SELECT page_id, length(regexp_replace(url, '[^0-9]', '', 'g')) AS digits FROM pages")
def digit_count(t):
    return t.pages.select("page_id", text.digit_count("url").cast("long").alias("digits"))


@query("xs7_categorise", f"""
SELECT conv_id, turn, CASE
{chr(10).join(f"WHEN regexp_matches(text, '(?i){p}') THEN '{label}'" for p, label in text.SITE_REASONS)}
ELSE 'Other' END AS reason FROM conversations""")
def categorise(t):
    return t.conversations.select("conv_id", "turn", text.categorise("text", text.SITE_REASONS).alias("reason"))


_NEST_CODES = """SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'A' THEN 'Y' WHEN 'N' THEN 'N (prev Y)' END AS destroyed,
  CASE WHEN l_linestatus = 'F' THEN 'Y (2)' WHEN l_linenumber > 3 THEN 'N (attempted)' ELSE 'n/a' END AS fry FROM lineitem"""


def nest_codes(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_returnflag") == "A", "Y").when(F.col("l_returnflag") == "N", "N (prev Y)").alias("destroyed"),
        F.when(F.col("l_linestatus") == "F", "Y (2)").when(F.col("l_linenumber") > 3, "N (attempted)").otherwise("n/a").alias("fry"),
    )


NEST_SQL = f"""SELECT l_orderkey, l_linenumber, trim(
  CASE destroyed WHEN 'Y' THEN 'Nest destroyed.' WHEN 'N (prev Y)' THEN 'Nest not destroyed.' ELSE '' END || ' ' ||
  CASE fry WHEN 'Y (2)' THEN 'Two fry captured.' WHEN 'N (attempted)' THEN 'Tried to catch fry, unsuccessful.' ELSE '' END) AS activity
FROM ({_NEST_CODES})"""


@query("xs8_nest_activity", NEST_SQL)
def nest_activity(t):
    return nest_codes(t).select("l_orderkey", "l_linenumber", text.nest_activity("destroyed", "fry").alias("activity"))


@query("xs9_labelled_text", """
SELECT o_orderkey, 'Air Temp: ' || o_custkey || ' Cloud: ' || o_orderpriority || ' Wind: ' || CASE WHEN o_orderstatus = 'F' THEN '' ELSE o_orderstatus END
  AS weather FROM orders""")
def labelled_text(t):
    wind = F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus"))
    return t.orders.select(
        "o_orderkey", text.labelled({"Air Temp": "o_custkey", "Cloud": "o_orderpriority", "Wind": wind}).alias("weather")
    )


@query("xs10_repair_value", """
SELECT event_id, CASE event_type WHEN 'signup' THEN 'alevin' ELSE event_type END AS life_stage FROM events""")
def repair_value(t):
    return t.events.select("event_id", text.repaired("event_type", "signup", "alevin").alias("life_stage"))


@query("xs11_fragments", f"""
SELECT doc_id, fragment FROM (SELECT doc_id, trim(unnest(string_split(text, '.')), {BLANKS}) AS fragment FROM documents)
WHERE fragment <> ''""")
def fragments(t):
    return t.documents.select("doc_id", F.explode(text.fragments("text")).alias("fragment"))


@query("xs12_tidy_activity", rf"""
SELECT doc_id, trim(regexp_replace(regexp_replace(replace(text, ' ', '.'), '\.( ?\.)+', '.', 'g'), '^[. ]+', '', 'g'), {BLANKS})
  AS activity FROM documents""")
def tidy_activity(t):
    return t.documents.select("doc_id", text.tidy_activity(F.replace("text", F.lit(" "), F.lit("."))).alias("activity"))


@query("xs13_label_missing", "SELECT o_orderkey, COALESCE(nullif(o_orderstatus, 'P'), 'NA') AS sex FROM orders")
def label_missing(t):
    return t.orders.select("o_orderkey", text.or_label(F.nullif("o_orderstatus", F.lit("P"))).alias("sex"))


def _serial(t):
    """Spreadsheet day numbers as text: date plus hundredths of a day; some are not numbers."""
    day = F.date_diff(F.to_date("o_orderdate"), F.lit("1899-12-30").cast("date")).cast("string")
    part = F.lpad((F.col("o_orderkey") % 100).cast("string"), 2, "0")
    return t.orders.select(
        "o_orderkey", "o_orderdate",
        F.when(F.col("o_orderstatus") == "P", "unknown").otherwise(F.concat(day, F.lit("."), part)).alias("serial"),
    )


@query("xd1_serial_date", """
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS date FROM orders""")
def serial_date(t):
    return _serial(t).select("o_orderkey", times.serial_date("serial").alias("date"))


@query("xd2_serial_seconds", """
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(round((o_orderkey % 100) * 864.0) AS INTEGER) END AS seconds,
  CASE WHEN o_orderstatus <> 'P' THEN strftime(TIMESTAMP '2000-01-01' + to_seconds((o_orderkey % 100) * 864), '%H:%M:%S') END AS clock
FROM orders""")
def serial_seconds(t):
    seconds = times.serial_seconds("serial")
    return _serial(t).select(
        "o_orderkey", seconds.alias("seconds"), F.when(seconds.isNotNull(), times.clock_text(seconds)).alias("clock")
    )


SHIFT_SQL = """CASE o_orderpriority WHEN '1-URGENT' THEN '1: 8:00-14:00' WHEN '2-HIGH' THEN '08:00:00-14:30:00'
  WHEN '3-MEDIUM' THEN '22:00-02:00' WHEN '4-NOT SPECIFIED' THEN 'nodash' END"""


def shift_text():
    p = F.col("o_orderpriority")
    return (
        F.when(p == "1-URGENT", "1: 8:00-14:00").when(p == "2-HIGH", "08:00:00-14:30:00")
        .when(p == "3-MEDIUM", "22:00-02:00").when(p == "4-NOT SPECIFIED", "nodash")
    )


@query("xd3_shift_parts", f"""
SELECT o_orderkey, CASE shift WHEN '1: 8:00-14:00' THEN 28800 WHEN '08:00:00-14:30:00' THEN 28800 WHEN '22:00-02:00' THEN 79200 END AS shift_start,
  CASE shift WHEN '1: 8:00-14:00' THEN 50400 WHEN '08:00:00-14:30:00' THEN 52200 WHEN '22:00-02:00' THEN 7200 END AS shift_end,
  CASE shift WHEN '1: 8:00-14:00' THEN 6.0 WHEN '08:00:00-14:30:00' THEN 6.5 WHEN '22:00-02:00' THEN -20.0 END::DOUBLE AS hours_worked
FROM (SELECT o_orderkey, {SHIFT_SQL} AS shift FROM orders)""")
def shift_parts(t):
    return t.orders.select("o_orderkey", *[c.alias(n) for n, c in times.shift_parts(shift_text()).items()])


@query("xd4_date_and_clock", """
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + to_seconds((o_orderkey % 86400)) END AS moment FROM orders""")
def date_and_clock(t):
    seconds = F.when(F.col("o_orderstatus") != "P", (F.col("o_orderkey") % 86400).cast("int"))
    return t.orders.select("o_orderkey", times.at_clock(F.to_date("o_orderdate"), seconds).alias("moment"))


@query("xd5_parse_dates", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS mdy, CAST(o_orderdate AS DATE) AS dmy,
  CASE WHEN o_orderstatus <> 'F' THEN CAST(o_orderdate AS DATE) END AS ymd, o_orderdate AS moment,
  CAST(hour(o_orderdate) * 3600 + 540 AS INTEGER) AS hm FROM orders""")
def parse_dates(t):
    d = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey",
        times.parse_date(F.concat(F.lit(" "), F.date_format(d, "M/d/yyyy"), F.lit(" ")), "mdy").alias("mdy"),
        times.parse_date(F.date_format(d, "dd-MM-yyyy"), "dmy").alias("dmy"),
        times.parse_date(F.when(F.col("o_orderstatus") == "F", "soon").otherwise(F.date_format(d, "yyyy-M-d")), "ymd").alias("ymd"),
        times.parse_moment(F.date_format(d, "yyyy-MM-dd HH:mm:ss")).alias("moment"),
        times.clock_seconds(F.concat(F.hour(d).cast("string"), F.lit(":09"))).alias("hm"),
    )


@query("xd6_date_parts", """
SELECT event_id, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day,
  CAST(hour(ts) AS INTEGER) AS hour, CAST(date_trunc('month', ts) AS DATE) AS month_floor FROM events""")
def date_parts(t):
    return t.events.select(
        "event_id", F.year("ts").alias("year"), F.month("ts").alias("month"), F.day("ts").alias("day"),
        F.hour("ts").alias("hour"), F.trunc(F.to_date("ts"), "month").alias("month_floor"),
    )


@query("xd7_hours_between", """
SELECT l_orderkey, l_linenumber, (l_partkey % 86400 - l_suppkey % 86400) / 3600.0::DOUBLE AS hours FROM lineitem""")
def hours_between(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber",
        times.hours_between(F.col("l_suppkey") % 86400, F.col("l_partkey") % 86400).alias("hours"),
    )


@query("xd8_undo_auto_date", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN month(o_orderdate) || '-' || day(o_orderdate) ELSE o_orderpriority END AS wind FROM orders""")
def undo_auto_date(t):
    day = F.date_diff(F.to_date("o_orderdate"), F.lit("1899-12-30").cast("date")).cast("string")
    wind = F.when(F.col("o_orderstatus") == "F", day).otherwise(F.col("o_orderpriority"))
    return t.orders.select("o_orderkey", times.undo_auto_date(wind).alias("wind"))


@query("xd9_missing_time", "SELECT o_orderkey, COALESCE(nullif(o_orderstatus, 'F'), '12:01') AS time FROM orders")
def missing_time(t):
    return t.orders.select("o_orderkey", times.or_missing_time(F.nullif("o_orderstatus", F.lit("F"))).alias("time"))


@query("xd10_hour_minute", "SELECT event_id, strftime(ts, '%H:%M') AS hm, strftime(ts, '%H:%M') AS from_seconds FROM events")
def hour_minute(t):
    seconds = F.hour("ts") * 3600 + F.minute("ts") * 60
    return t.events.select(
        "event_id", F.date_format("ts", "HH:mm").alias("hm"), times.clock_text(seconds, False).alias("from_seconds")
    )


@query("xm1_to_number", """
SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN p_size WHEN 'LARGE' THEN NULL WHEN 'MEDIUM' THEN p_size * 1000 WHEN 'PROMO' THEN NULL
  WHEN 'SMALL' THEN NULL ELSE -p_size + 0.5 END::DOUBLE AS number FROM part""")
def to_number(t):
    size, kind = _S("p_size"), F.col("p_type")
    odd = (
        F.when(kind == "ECONOMY", F.concat(F.lit("  "), size, F.lit(" ")))
        .when(kind == "LARGE", F.concat(size, F.lit("d")))
        .when(kind == "MEDIUM", F.concat(size, F.lit("e3")))
        .when(kind == "PROMO", F.concat(size, F.lit(" mm")))
        .when(kind == "SMALL", "")
        .otherwise(F.concat(F.lit("-"), (F.col("p_size") - 1).cast("string"), F.lit(".5")))
    )
    return t.part.select("p_partkey", numbers.to_number(odd).alias("number"))


@query("xm2_row_sum", """
SELECT event_id, COALESCE(CASE WHEN event_type = 'click' THEN user_id END, 0) + COALESCE(CASE WHEN user_id % 2 = 0 THEN value END, 0) AS total FROM events""")
def row_sum(t):
    a = F.when(F.col("event_type") == "click", F.col("user_id"))
    b = F.when(F.col("user_id") % 2 == 0, F.col("value"))
    return t.events.select("event_id", numbers.row_sum([a, b]).alias("total"))


@query("xm3_whole_hours", "SELECT event_id, CAST(trunc(value / 10) AS INTEGER) AS hours, CAST(trunc(-value / 10) AS INTEGER) AS back FROM events")
def whole_hours(t):
    return t.events.select(
        "event_id", numbers.whole_hours(F.col("value") / 10).alias("hours"), numbers.whole_hours(-F.col("value") / 10).alias("back")
    )


@query("xm4_round", "SELECT l_orderkey, l_linenumber, l_partkey, round(sqrt(l_extendedprice), 1) AS one, round(sqrt(l_extendedprice), 2) AS two FROM lineitem")
def rounding(t):
    x = F.sqrt("l_extendedprice")
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.round(x, 1).alias("one"), F.round(x, 2).alias("two"))


@query("xg1_degrees_minutes", """
SELECT c_custkey, round((CASE WHEN c_nationkey % 2 = 0 THEN 1 ELSE -1 END) * ((c_custkey % 90) + ((c_custkey % 60) + (c_custkey % 1000) / 1000.0::DOUBLE) / 60), 9) AS degrees
FROM customer""")
def degrees_minutes(t):
    side = F.when(F.col("c_nationkey") % 2 == 0, "N").otherwise("W")
    ddm = F.concat(
        (F.col("c_custkey") % 90).cast("string"), F.lit(" "),
        F.lpad((F.col("c_custkey") % 60).cast("string"), 2, "0"), F.lit("."),
        F.lpad((F.col("c_custkey") % 1000).cast("string"), 3, "0"), F.lit(" "), side,
    )
    return t.customer.select("c_custkey", F.round(geo.ddm_to_degrees(ddm), 9).alias("degrees"))


@query("xg2_west_negative", "SELECT c_custkey, -abs(c_acctbal) AS longitude FROM customer")
def west_negative(t):
    return t.customer.select("c_custkey", geo.west_negative("c_acctbal").alias("longitude"))


@query("xg3_haversine", f"""
SELECT id, round(2 * 6378.137::DOUBLE * asin(least(1, sqrt(pow(sin((radians(lat) - radians({geo.LAKE_LAT}::DOUBLE)) / 2), 2) +
  cos(radians(lat)) * cos(radians({geo.LAKE_LAT}::DOUBLE)) * pow(sin((radians(lon) - radians({geo.LAKE_LON}::DOUBLE)) / 2), 2)))), 6) AS km
FROM ({POINTS})""")
def haversine(t):
    return points(t).select("id", F.round(geo.haversine_km("lat", "lon"), 6).alias("km"))


NEST_PLACES = """SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN '49.0' || (1000 + p_size) WHEN 'LARGE' THEN '543' || (4000 + p_size)
  WHEN 'MEDIUM' THEN '57' || (4000 + p_size) WHEN 'PROMO' THEN NULL ELSE '543' || (1000 + p_size) END AS latitude,
  CASE p_type WHEN 'ECONOMY' THEN '-121.9' || (1000 + p_size) WHEN 'LARGE' THEN '57' || (4000 + p_size)
  WHEN 'MEDIUM' THEN '543' || (4000 + p_size) WHEN 'PROMO' THEN NULL ELSE '57' || (1000 + p_size) END AS longitude FROM part"""


def nest_places(t):
    kind = F.col("p_type")
    tail = (4000 + F.col("p_size")).cast("string")
    low = (1000 + F.col("p_size")).cast("string")
    text_of = lambda head, x: F.concat(F.lit(head), x)
    return t.part.select(
        "p_partkey",
        F.when(kind == "ECONOMY", text_of("49.0", low)).when(kind == "LARGE", text_of("543", tail))
        .when(kind == "MEDIUM", text_of("57", tail)).when(kind == "PROMO", F.lit(None)).otherwise(text_of("543", low)).alias("latitude"),
        F.when(kind == "ECONOMY", text_of("-121.9", low)).when(kind == "LARGE", text_of("57", tail))
        .when(kind == "MEDIUM", text_of("543", tail)).when(kind == "PROMO", F.lit(None)).otherwise(text_of("57", low)).alias("longitude"),
    )


@query("xg4_coordinate_kind", f"""
SELECT p_partkey, CASE WHEN latitude IS NULL THEN 'blank' WHEN latitude LIKE '49.%' THEN 'degrees' ELSE 'utm' END AS kind,
  CASE WHEN length(latitude) = 7 THEN latitude WHEN latitude NOT LIKE '49.%' THEN longitude END::DOUBLE AS northing,
  CASE WHEN length(latitude) = 7 THEN longitude WHEN latitude NOT LIKE '49.%' THEN latitude END::DOUBLE AS easting FROM ({NEST_PLACES})""")
def coordinate_kind(t):
    east, north = geo.ordered_utm("latitude", "longitude")
    kind = geo.coordinate_kind("latitude")
    metres = kind == "utm"
    return nest_places(t).select(
        "p_partkey", kind.alias("kind"), F.when(metres, north).alias("northing"), F.when(metres, east).alias("easting")
    )


@query("xg5_reproject", utm_sql(POINTS) + """
SELECT id, round(easting, 3) AS easting, round(northing, 3) AS northing, round(lon, 7) AS lon_back, round(lat, 7) AS lat_back
FROM utm JOIN pts USING (id)""")
def reproject(t):
    east, north = geo.lonlat_to_utm("lon", "lat")
    metres = points(t).select("id", east.alias("easting"), north.alias("northing"))
    lon, lat = geo.utm_to_lonlat("easting", "northing")
    return metres.select(
        "id", F.round("easting", 3).alias("easting"), F.round("northing", 3).alias("northing"),
        F.round(lon, 7).alias("lon_back"), F.round(lat, 7).alias("lat_back"),
    )


@query("xg6_split_pair", """
SELECT c_custkey, 49 + c_nationkey / 100.0::DOUBLE AS lat, 121 + c_nationkey / 100.0::DOUBLE AS lon FROM customer""")
def split_pair(t):
    two = F.lpad(_S("c_nationkey"), 2, "0")
    lat, lon = geo.split_pair(F.concat(F.lit("49."), two, F.lit("N 121."), two, F.lit("W")))
    return t.customer.select("c_custkey", lat.alias("lat"), lon.alias("lon"))


@query("xg7_range_repair", """
SELECT CASE WHEN longitude IS NULL OR longitude < -123 THEN CASE WHEN s_suppkey IS NULL THEN 'kept' ELSE 'repaired' END ELSE 'in range' END AS outcome,
  count(*) AS n FROM (SELECT user_id, CASE event_type WHEN 'error' THEN -130.5 WHEN 'view' THEN NULL ELSE -value END AS longitude FROM events)
LEFT JOIN supplier ON s_suppkey = user_id GROUP BY 1""")
def range_repair(t):
    kind = F.col("event_type")
    seen = t.events.select(
        F.concat(F.lit("VR2W-"), _S("user_id")).alias("receiver"), F.lit(None).cast("double").alias("latitude"),
        F.when(kind == "error", -130.5).when(kind != "view", -F.col("value")).alias("longitude"),
    ).withColumn("before", F.col("longitude"))
    stations = t.supplier.select(
        _S("s_suppkey").alias("station_label"), F.lit("49 03.5 N").alias("station_lat"), F.lit("121 58.8 W").alias("station_lon")
    )
    bad = F.col("before").isNull() | (F.col("before") < WESTERN_BOUND)
    outcome = F.when(~bad, "in range").when(F.col("latitude").isNotNull(), "repaired").otherwise("kept")
    return counts(repair_coordinates(seen, stations), outcome.alias("outcome"))
