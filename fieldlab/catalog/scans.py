"""Sources and sinks over the given tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldlab.catalog.registry import query
from fieldlab.functions.numbers import to_number
from fieldlab.session import fresh_path
from fieldlab.sources.delimited import SOURCE_COLUMNS, scan_delimited, scan_forms
from fieldlab.sources.sinks import append_table, csv_export, csv_report, snapshot
from fieldlab.sources.ledger import ingest
from fieldlab.sources.versions import StoredTable, stored
from fieldlab.sources.tables import key_sightings, profile_tables, tables_like

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@query("s1_scan_forms", """
SELECT CASE WHEN o_orderstatus = 'F' THEN 'year one' ELSE 'year two' END AS form,
  CAST(o_orderkey AS VARCHAR) AS survey_no, CAST(o_custkey AS VARCHAR) AS no_smb_c,
  CAST(o_custkey + 1 AS VARCHAR) AS no_smb_r,
  CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderpriority END AS wind
FROM orders""")
def scan_landed_forms(t):
    root = fresh_path(t.spark)
    one = t.orders.select(
        F.col("o_orderkey").alias("Survey #"),
        F.col("o_custkey").alias("# SMB c"),
        (F.col("o_custkey") + 1).alias("# SMB c "),
        F.col("o_orderpriority").alias("Wind"),
        "o_orderstatus",
    )
    first = one.filter("o_orderstatus = 'F'").drop("Wind", "o_orderstatus")
    csv_report(first, f"{root}/year one/Main Data")
    csv_report(one.filter("o_orderstatus <> 'F'").drop("o_orderstatus"), f"{root}/year two/Main Data")
    sheet = scan_forms(t.spark, root)["Main Data"]
    return sheet.withColumnRenamed("_form", "form").drop(*SOURCE_COLUMNS)


@query("s1_ledger", """
SELECT CAST(o_orderkey AS VARCHAR) AS survey, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS site,
  CASE WHEN o_orderstatus = 'O' THEN 'late' WHEN o_orderstatus = 'P' THEN 'changed' END AS note FROM orders""")
def ingest_what_is_new(t):
    """Three runs over a growing folder: first files, then new and changed ones, then nothing."""
    root, part = fresh_path(t.spark), lambda status: t.orders.filter(F.col("o_orderstatus") == status)
    key = F.col("o_orderkey").alias("Survey")
    target, noted = StoredTable(t.spark, f"{fresh_path(t.spark)}"), StoredTable(t.spark, f"{fresh_path(t.spark)}")
    csv_report(part("F").select(key, F.col("o_orderpriority").alias("Site")), f"{root}/a")
    csv_report(part("P").select(key, F.lit("first").alias("Note")), f"{root}/b")
    runs = [ingest(t.spark, root, target, noted)]
    csv_report(part("O").select(key, F.lit("late").alias("Note")), f"{root}/c")
    csv_report(part("P").select(key, F.lit("changed").alias("Note")), f"{root}/b2")
    gone = F.element_at(F.split("_file", "/"), -2) == "b"
    runs += [ingest(t.spark, root, target, noted), ingest(t.spark, root, target, noted)]
    if runs[-1]:
        raise RuntimeError("a file was read again")
    return target.delete_where(gone).read().select("survey", "site", "note")


@query("s3_scan_delimited", """
SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN user_id END AS transmitter,
  event_type AS station_name,
  CASE WHEN event_type IN ('click', 'view') THEN NULL ELSE value END AS sensor_value
FROM events""")
def scan_drifting_files(t):
    root = fresh_path(t.spark)
    early = F.col("event_type").isin("click", "view")
    csv_report(
        t.events.filter(early).select("event_id", F.col("user_id").alias("Transmitter"),
                                      F.col("event_type").alias("Station Name")),
        f"{root}/a",
    )
    csv_report(
        t.events.filter(~early).select("event_id", F.col("event_type").alias("Station Name"),
                                       F.col("value").alias("Sensor Value")),
        f"{root}/b",
    )
    text = scan_delimited(t.spark, root)
    return text.select(
        F.col("event_id").cast("long").alias("event_id"),
        F.col("transmitter").cast("long").alias("transmitter"),
        "station_name",
        to_number("sensor_value").alias("sensor_value"),
    )


@query("s5_full_scan", "SELECT * FROM orders")
def full_scan(t):
    return t.orders


@query("s6_tables_like", """
SELECT 'lineitem' AS table_name, count(*) AS n_rows FROM lineitem
UNION ALL SELECT 'orders', count(*) FROM orders
UNION ALL SELECT 'part', count(*) FROM part""")
def tables_by_name(t):
    t.register("orders", "lineitem", "part", "nation")
    tables = tables_like(t.spark, "^(orders|lineitem|part)$")
    sizes = [
        df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, sizes)


_COLUMNS = {
    "region": "r_regionkey r_name",
    "nation": "n_nationkey n_name n_regionkey",
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount "
    "l_tax l_returnflag l_linestatus l_shipdate",
    "events": "event_id ts user_id event_type value props",
    "documents": "doc_id text lang source n_chars",
    "embeddings": "vec_id embedding label",
    "pages": "page_id url html",
    "benchmark": "item_id text",
    "labels": "doc_id quality toxic",
    "conversations": "conv_id turn role text",
}


@query("s7_profile_tables", "\nUNION ALL ".join(
    f"SELECT '{name}' AS table_name, '{c}' AS column_name, count(*) AS n_rows, "
    f"count(*) - count({c}) AS nulls, count(DISTINCT {c}) AS distinct_values FROM {name}"
    for name, columns in _COLUMNS.items() for c in columns.split()
))
def profile_all_tables(t):
    return profile_tables({name: t.table(name) for name in TABLES}, "exact")


@query("s8_key_sightings", """
SELECT 'lineitem' AS table_name, CAST(l_orderkey AS VARCHAR) AS value, count(*) AS n
FROM lineitem GROUP BY l_orderkey
UNION ALL
SELECT 'orders', CAST(o_orderkey AS VARCHAR), count(*) FROM orders GROUP BY o_orderkey""")
def sightings_of_orders(t):
    return key_sightings(
        {
            "orders": t.orders.withColumnRenamed("o_orderkey", "survey"),
            "lineitem": t.lineitem.withColumnRenamed("l_orderkey", "survey"),
            "customer": t.customer,
        },
        "survey",
    )


@query("s3_text_comes_back", """
SELECT 'documents' AS kind, CAST(doc_id AS VARCHAR) AS id, text FROM documents
UNION ALL SELECT 'conversations', CAST(conv_id AS VARCHAR) || '/' || CAST(turn AS VARCHAR), text FROM conversations""")
def text_comes_back(t):
    """Texts with line breaks, quotes and commas through a CSV report and a scan."""
    root = fresh_path(t.spark)
    csv_report(t.documents.select(F.lit("documents").alias("kind"), F.col("doc_id").alias("id"), "text"), f"{root}/documents")
    turn = F.concat_ws("/", "conv_id", "turn").alias("id")
    csv_report(t.conversations.select(F.lit("conversations").alias("kind"), turn, "text"), f"{root}/conversations")
    return scan_delimited(t.spark, root).drop(*SOURCE_COLUMNS)


@query("s9_typed_append", """
SELECT CAST(year(o_orderdate) AS BIGINT) AS year, count(*) * 2 AS n,
  round(2 * sum(o_totalprice), 2) AS total
FROM orders GROUP BY 1""")
def append_twice(t):
    path = fresh_path(t.spark)
    schema = T.StructType([
        T.StructField("survey", T.LongType()),
        T.StructField("date", T.DateType()),
        T.StructField("total", T.DoubleType()),
        T.StructField("year", T.LongType()),
    ])
    text = t.orders.select(
        F.col("o_orderkey").cast("string").alias("survey"),
        F.to_date("o_orderdate").alias("date"),
        F.col("o_totalprice").cast("string").alias("total"),
        F.year("o_orderdate").alias("year"),
    )
    append_table(text, path, schema, ["year"])
    append_table(text, path, schema, ["year"])
    stored = t.spark.read.schema(schema).parquet(path)
    return stored.groupBy("year").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("total"), 2).alias("total")
    )


@query("s10_csv_report", """
SELECT o_orderpriority AS site, count(*) AS n FROM orders GROUP BY 1""")
def report_roundtrip(t):
    path = fresh_path(t.spark)
    report = t.orders.groupBy(F.col("o_orderpriority").alias("site")).agg(F.count("*").alias("n"))
    csv_report(report, path)
    return t.spark.read.schema("site string, n long").option("header", "true").csv(path)


@query("s11_snapshot", "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders")
def snapshot_roundtrip(t):
    path = fresh_path(t.spark)
    snapshot(t.orders.select("o_orderkey", "o_orderdate", "o_totalprice"), path)
    # Stored again from itself: nothing is lost, nothing doubled.
    snapshot(stored(t.spark, path), path)
    return stored(t.spark, path)


@query("s12_export_tables", """
SELECT 'lineitem' AS table_name, count(*) AS n FROM lineitem
UNION ALL SELECT 'orders', count(*) FROM orders""")
def export_tables(t):
    root = fresh_path(t.spark)
    names = csv_export(
        {
            "orders": t.orders.withColumnRenamed("o_orderkey", "survey"),
            "lineitem": t.lineitem.withColumnRenamed("l_orderkey", "survey"),
            "nation": t.nation,
        },
        "survey",
        root,
    )
    counts = [
        t.spark.read.option("header", "true").csv(f"{root}/{name}")
        .agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n"))
        for name in names
    ]
    return reduce(DataFrame.unionByName, counts)
