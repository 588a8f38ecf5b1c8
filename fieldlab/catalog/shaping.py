"""Projection, schema shaping, reshaping and stacking over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldlab.catalog.registry import query
from fieldlab.operators import reshape, sets, shape
from fieldlab.plans.interviews import answer_table, answers_by_run, older_main_splits
from fieldlab.sources import workbooks


@query("p1_rename", """
SELECT o_orderkey AS surveyNumber, o_custkey AS anglerID, o_orderstatus AS status,
  o_totalprice AS total, o_orderdate AS date, o_orderpriority AS site FROM orders""")
def rename(t):
    return t.orders.withColumnsRenamed(
        {"o_orderkey": "surveyNumber", "o_custkey": "anglerID", "o_orderstatus": "status",
         "o_totalprice": "total", "o_orderdate": "date", "o_orderpriority": "site"}
    )


@query("p2_fix_headers", """
SELECT o_orderkey AS survey_no, o_custkey AS no_anglers, o_totalprice AS total_person_hr_fished,
  o_orderstatus AS no_smb_c, o_orderpriority AS no_smb_r FROM orders""")
def header_names(t):
    raw = ["Survey #", "# Anglers", "Total Person Hr. Fished", "# SMB c", "# SMB c"]
    picked = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
    return picked.toDF(*shape.fix_headers(raw, ("c", "r")))


# Cells as a workbook reader gives them: one sheet per supplier, header in row 2, a row per item.
_CELLS = """
WITH src AS (
  SELECT l_suppkey, row_number() OVER (PARTITION BY l_suppkey
    ORDER BY l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_discount, l_tax,
      l_returnflag, l_linestatus, l_shipdate) + 2 AS r,
    CAST(l_orderkey AS VARCHAR) AS a, CAST(l_partkey AS VARCHAR) AS b, l_returnflag AS c
  FROM lineitem)"""


def _sheet_cells(t):
    """Cells of a sheet per supplier: title in row 1, header in row 2, items below."""
    from fieldlab.operators.skew import numbered

    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_discount",
             "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
    rows = numbered(t.lineitem, ["l_suppkey"], order, "_r")
    name = F.col("l_suppkey").cast("string").alias("file")
    text = lambda c: F.col(c).cast("string")
    cell = lambda col, value: F.struct(F.lit(col).alias("col"), value.alias("text"))
    body = rows.select(
        name, F.lit("Tags").alias("sheet"), (F.col("_r") + 2).cast("int").alias("row"),
        F.inline(F.array(cell(1, text("l_orderkey")), cell(2, text("l_partkey")), cell(3, F.col("l_returnflag")))),
    )
    top = t.supplier.select(
        F.col("s_suppkey").cast("string").alias("file"), F.lit("Tags").alias("sheet"),
        F.inline(F.array(*[
            F.struct(F.lit(r).alias("row"), F.lit(c).alias("col"), v.alias("text"))
            for r, c, v in [
                (1, 1, F.col("s_name")),
                (1, 4, F.lit("Date:")),
                (1, 6, (F.lit(45000) + F.col("s_suppkey")).cast("string")),
                (2, 1, F.lit("VUE Tag ID")),
                (2, 2, F.lit("Serial No.")),
                (2, 3, F.lit("Tag Family")),
            ]
        ])),
    )
    return top.unionByName(body.select("file", "sheet", "row", "col", "text"))


_HEADERS = ["VUE Tag ID", "Serial No.", "Tag Family"]


@query("p5_promote_header", _CELLS + """
SELECT CAST(l_suppkey AS VARCHAR) AS file, r AS row_no, a AS vue_tag_id, b AS serial_no,
  c AS tag_family, s_name AS title
FROM src JOIN supplier ON s_suppkey = l_suppkey""")
def promoted_header(t):
    cells = _sheet_cells(t)
    table = workbooks.promote_header(cells, 2, _HEADERS)
    titled = workbooks.with_title(table, cells, 1, 1, "title")
    return titled.select(
        "file", F.col("row").cast("long").alias("row_no"), *shape.fix_headers(_HEADERS), "title"
    )


@query("p7_label_value", """
SELECT CAST(s_suppkey AS VARCHAR) AS file, CAST(45000 + s_suppkey AS VARCHAR) AS sold,
  CAST(n AS BIGINT) AS n_cells
FROM supplier LEFT JOIN (SELECT l_suppkey, 3 * count(*) + 6 AS n FROM lineitem GROUP BY 1) ON l_suppkey = s_suppkey""")
def value_beside_label(t):
    cells = _sheet_cells(t)
    sold = workbooks.labelled_value(cells, "Date:", 2, "sold")
    return cells.join(sold, ["file", "sheet"], "left").groupBy("file", "sold").agg(F.count("*").alias("n_cells"))


@query("p6_form_record", """
SELECT CAST(c_custkey AS VARCHAR) AS file, CAST(45000 + c_custkey AS VARCHAR) AS Date, c_name AS Surveyor,
  c_mktsegment AS StartTime, CAST(c_nationkey AS VARCHAR) AS water_temp,
  CAST(c_custkey + 1 AS VARCHAR) AS fish_seen, c_name || ' ' || c_mktsegment AS comments
FROM customer""")
def transposed_form(t):
    text = lambda c: F.col(c).cast("string")
    layout = [
        (1, 1, F.lit("Date:")), (1, 2, (F.lit(45000) + F.col("c_custkey")).cast("string")),
        (2, 1, F.lit("Surveyor:")), (2, 2, F.col("c_name")),
        (3, 1, F.lit("Start Time:")), (3, 2, F.col("c_mktsegment")),
        (5, 1, F.lit("water_temp")), (5, 2, F.lit("fish_seen")),
        (6, 1, text("c_nationkey")), (6, 2, (F.col("c_custkey") + 1).cast("string")),
        (8, 1, F.col("c_name")), (9, 1, F.col("c_mktsegment")),
    ]
    cells = t.customer.select(
        text("c_custkey").alias("file"), F.lit("Form").alias("sheet"),
        F.inline(F.array(*[
            F.struct(F.lit(r).alias("row"), F.lit(c).alias("col"), v.alias("text")) for r, c, v in layout
        ])),
    )
    record = workbooks.form_record(
        cells, (1, 3), ["Date", "Surveyor", "StartTime"], 5, ["water_temp", "fish_seen"], (8, 9)
    )
    return record.drop("sheet")


@query("p8_column_slice", "SELECT l_linenumber, l_quantity, l_extendedprice, l_discount FROM lineitem")
def column_slice(t):
    return t.lineitem.select(*shape.between_names(t.lineitem, "l_linenumber", "l_discount"))


@query("p9_reorder", "SELECT ts, value, event_id, user_id, event_type, props FROM events")
def reorder(t):
    return shape.move_before(shape.in_front(t.events, "ts"), ["value"], "event_id")


@query("p10_coalesce_synonyms", """
SELECT l_orderkey, l_linenumber, COALESCE(CASE WHEN l_returnflag = 'A' THEN l_quantity END,
  CASE WHEN l_returnflag = 'N' THEN l_tax END, CASE WHEN l_linestatus = 'O' THEN l_discount END) AS air_temp
FROM lineitem""")
def synonyms(t):
    drifted = t.lineitem.select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_returnflag") == "A", F.col("l_quantity")).alias("air_temp"),
        F.when(F.col("l_returnflag") == "N", F.col("l_tax")).alias("air_temperature"),
        F.when(F.col("l_linestatus") == "O", F.col("l_discount")).alias("mean_air_temperature"),
    )
    return shape.coalesce_synonyms(drifted, {"air_temp": ["air_temperature", "mean_air_temperature"]})


@query("p11_drop_empty_columns", "SELECT o_orderkey, o_orderstatus FROM orders")
def no_empty_columns(t):
    sparse = t.orders.select(
        "o_orderkey", "o_orderstatus", F.when(F.col("o_totalprice") < 0, "x").alias("unused")
    )
    return shape.drop_empty_columns(sparse)


@query("p12_all_text", """
SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name, CAST(n_regionkey AS VARCHAR) AS n_regionkey
FROM nation""")
def all_text(t):
    return shape.as_text(t.nation)


@query("p13_typed_projection", """
SELECT l_orderkey AS survey, CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_linenumber END AS fish_no,
  CASE l_returnflag WHEN 'A' THEN l_quantity WHEN 'N' THEN NULL ELSE l_quantity END AS length_mm,
  CAST(l_shipdate AS DATE) AS date
FROM lineitem""")
def typed_projection(t):
    text = t.lineitem.select(
        F.col("l_orderkey").cast("string").alias("survey"),
        F.when(F.col("l_returnflag") == "R", "n/a").otherwise(F.col("l_linenumber").cast("string")).alias("fish_no"),
        F.when(F.col("l_returnflag") == "A", F.concat(F.lit(" "), F.col("l_quantity").cast("string"), F.lit(" ")))
        .when(F.col("l_returnflag") == "N", F.concat(F.col("l_quantity").cast("string"), F.lit("d")))
        .otherwise(F.col("l_quantity").cast("string")).alias("length_mm"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"),
    )
    schema = T.StructType([
        T.StructField("survey", T.LongType()), T.StructField("fish_no", T.IntegerType()),
        T.StructField("length_mm", T.DoubleType()), T.StructField("date", T.DateType()),
    ])
    return shape.typed(text, schema)


@query("p16_allowed_columns", "SELECT c_custkey, c_mktsegment FROM customer")
def allowed_columns(t):
    return shape.only_allowed(t.customer, ["c_custkey", "c_mktsegment", "harvested"])


@query("p17_constant", "SELECT event_id, 'South basin' AS location, DATE '2024-05-25' AS date FROM events")
def constant(t):
    return t.events.select(
        "event_id", F.lit("South basin").alias("location"), F.lit("2024-05-25").cast("date").alias("date")
    )


@query("p18_older_splits", """
SELECT o_orderkey AS survey, unnest(['shifts', 'catch', 'weather', 'fishing_details']) AS split,
  unnest([o_orderpriority, o_orderstatus, CAST(o_custkey % 7 AS VARCHAR), CAST(o_custkey AS VARCHAR)]) AS attribute FROM orders""")
def older_splits(t):
    main = t.orders.select(
        F.col("o_orderkey").alias("survey"), F.col("o_orderpriority").alias("shift"), F.col("o_orderstatus").alias("number_smb_c"),
        (F.col("o_custkey") % 7).cast("string").alias("wind"), F.col("o_custkey").cast("string").alias("vessel"),
    )
    parts = older_main_splits(main, "survey")
    named = {name: df.withColumnRenamed(next(c for c in df.columns if c != "survey"), "attribute") for name, df in parts.items()}
    return sets.tagged(named, "split")


@query("p19_name_pattern", "SELECT l_orderkey, l_partkey, l_suppkey FROM lineitem")
def name_pattern(t):
    return t.lineitem.select(*shape.matching(t.lineitem, "key$"))


@query("r1_to_long", """
SELECT l_orderkey, l_linenumber, k AS variable, v AS value FROM (
  SELECT l_orderkey, l_linenumber, unnest(['l_quantity', 'l_discount', 'l_tax']) AS k,
    unnest([l_quantity, l_discount, l_tax]) AS v FROM lineitem)""")
def wide_to_long(t):
    return reshape.to_long(
        t.lineitem, ["l_orderkey", "l_linenumber"], ["l_quantity", "l_discount", "l_tax"], kind="double"
    )


@query("r2_to_long_split", """
SELECT l_orderkey, unnest(['No_Smb', 'No_Smb', 'No_Kok', 'No_Kok']) AS species,
  unnest(['c', 'r', 'c', 'r']) AS type, unnest([l_quantity, l_discount, l_tax, l_extendedprice]) AS value
FROM lineitem""")
def wide_to_long_split(t):
    wide = t.lineitem.select(
        "l_orderkey", F.col("l_quantity").alias("No_Smb_c"), F.col("l_discount").alias("No_Smb_r"),
        F.col("l_tax").alias("No_Kok_c"), F.col("l_extendedprice").alias("No_Kok_r"),
    )
    return reshape.to_long_split(
        wide, ["l_orderkey"], shape.matching(wide, "^No_.*_[cr]$"), "^(No.*)_(r|c)$", ["species", "type"]
    )


@query("r3_to_wide", """
SELECT CAST(ts AS DATE) AS day, user_id, arg_min(value, event_id) FILTER (event_type = 'click') AS click,
  arg_min(value, event_id) FILTER (event_type = 'error') AS error,
  arg_min(value, event_id) FILTER (event_type = 'purchase') AS purchase,
  arg_min(value, event_id) FILTER (event_type = 'signup') AS signup,
  arg_min(value, event_id) FILTER (event_type = 'view') AS view
FROM events GROUP BY 1, 2""")
def long_to_wide(t):
    daily = t.events.withColumn("day", F.to_date("ts"))
    return reshape.to_wide(daily, ["day", "user_id"], "event_type", "value", "event_id")


@query("r4_lookup_matrix", """
SELECT r_name AS TableName, unnest(CASE WHEN r_regionkey % 2 = 0 THEN ['orders', 'nation'] ELSE ['nation'] END) AS name
FROM region""")
def lookup_matrix(t):
    matrix = t.region.select(
        F.col("r_name").alias("TableName"),
        F.when(F.col("r_regionkey") % 2 == 0, "X").alias("orders"),
        F.lit("X").alias("nation"),
        F.lit("").alias("customer"),
    )
    return reshape.chosen_tables(matrix)


@query("r5_split_columns", """
SELECT page_id, split_part(url, '://', 1) AS scheme, split_part(url, '://', 2) AS rest FROM pages""")
def split_columns(t):
    return reshape.split_columns(t.pages, "url", "://", ["scheme", "rest"]).select("page_id", "scheme", "rest")


@query("r6_split_rows", """
SELECT p_partkey, word FROM (SELECT p_partkey, trim(unnest(string_split(p_name, ' '))) AS word FROM part)
WHERE word <> ''""")
def split_rows(t):
    return reshape.split_rows(t.part.select("p_partkey", F.col("p_name").alias("word")), "word", " ")


@query("r7_one_long_frame", """
SELECT variable, count(*) AS n, round(sum(value), 2) AS total FROM (
  SELECT unnest(['l_quantity', 'l_discount', 'l_tax']) AS variable,
    unnest([l_quantity, l_discount, l_tax]) AS value FROM lineitem) GROUP BY 1""")
def groups_stay_long(t):
    long = reshape.to_long(t.lineitem, [], ["l_quantity", "l_discount", "l_tax"], kind="double")
    return long.groupBy("variable").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("r9_recode", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Finished' WHEN 'O' THEN 'Open' ELSE o_orderstatus END AS status
FROM orders""")
def recode(t):
    return t.orders.select(
        "o_orderkey", reshape.recoded("o_orderstatus", {"F": "Finished", "O": "Open"}).alias("status")
    )


@query("u1_stack_fill_missing", """
SELECT event_id, user_id, NULL::DOUBLE AS value FROM events WHERE event_type = 'view'
UNION ALL SELECT event_id, NULL, value FROM events WHERE event_type <> 'view'""")
def stack_fill(t):
    view = F.col("event_type") == "view"
    return sets.stacked([
        t.events.filter(view).select("event_id", "user_id"), t.events.filter(~view).select("event_id", "value")
    ])


@query("u2_stack_strict", "SELECT l_orderkey, l_quantity FROM lineitem")
def stack_strict(t):
    part = t.lineitem.select("l_orderkey", "l_quantity", "l_returnflag")
    return sets.stacked_strict([part.filter("l_returnflag = 'A'"), part.filter("l_returnflag <> 'A'")]).drop("l_returnflag")


@query("u3_tagged_stack", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'Destroyed' ELSE 'Not Destroyed' END AS status FROM orders""")
def tagged_stack(t):
    done = F.col("o_orderstatus") == "F"
    keys = lambda df: df.select("o_orderkey")
    return sets.tagged(
        {"Destroyed": keys(t.orders.filter(done)), "Not Destroyed": keys(t.orders.filter(~done))}, "status"
    )


@query("q4_answers_with_runs", """
WITH d AS (SELECT *, dense_rank() OVER (ORDER BY CAST(l_shipdate AS DATE)) - 1 AS run FROM lineitem)
SELECT l_orderkey AS survey, l_linenumber AS fish, CAST(l_shipdate AS DATE) AS date, run, unnest([1, 2, 3])::BIGINT AS question_id,
  unnest(['l_returnflag', 'l_linestatus', 'l_partkey']) AS question, unnest([l_returnflag, l_linestatus, CAST(l_partkey AS VARCHAR)]) AS answer FROM d""")
def answers_with_runs(t):
    main = t.lineitem.withColumnsRenamed({"l_orderkey": "survey", "l_linenumber": "fish"}).withColumn("date", F.to_date("l_shipdate"))
    return answers_by_run(main, ["survey", "fish"], "date", ["l_returnflag", "l_linestatus", "l_partkey"])


@query("q4_question_answers", """
SELECT l_orderkey AS survey, l_linenumber AS fish, unnest([1, 2, 3])::BIGINT AS question_id,
  unnest([l_returnflag, l_linestatus, CAST(l_partkey AS VARCHAR)]) AS answer FROM lineitem""")
def question_answers(t):
    main = t.lineitem.withColumnsRenamed({"l_orderkey": "survey", "l_linenumber": "fish"})
    return answer_table(main, ["survey", "fish"], ["l_returnflag", "l_linestatus", "l_partkey"])
