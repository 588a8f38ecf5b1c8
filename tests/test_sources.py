"""Files: drifting CSVs, landed forms, workbooks and sinks."""

import datetime as dt
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import values
from fieldlab.operators.windows import renumber_within
from fieldlab.session import scratch_dir
from fieldlab.sources import delimited, ledger, sinks, tables, workbooks
from fieldlab.sources.versions import StoredTable


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_scan_delimited_fills_drifted_columns(spark, tmp_path):
    write(tmp_path / "2023" / "a.csv", "Receiver,Station Name\nVR2W-1,dock\nVR2W-2,\n")
    write(tmp_path / "2024" / "b c.csv", "Receiver,Sensor Value\nVR2W-3,7\n")
    write(tmp_path / "2024" / "~$b.csv", "lock\nx\n")
    got = delimited.scan_delimited(spark, str(tmp_path))
    assert values(got.select("receiver", "station_name", "sensor_value")) == [
        ("VR2W-1", "dock", None), ("VR2W-2", None, None), ("VR2W-3", None, "7")]
    with pytest.raises(FileNotFoundError):
        delimited.scan_delimited(spark, str(tmp_path), "*.tsv")


def test_source_order_is_kept(spark, tmp_path):
    write(tmp_path / "x.csv", "date,n\n" + "".join(f"d,{i}\n" for i in range(50)))
    rows = delimited.scan_delimited(spark, str(tmp_path))
    numbered = renumber_within(rows, "date", delimited.SOURCE_COLUMNS, "k")
    assert numbered.filter(F.col("k") != F.col("n").cast("int") + 1).count() == 0


def test_line_breaks_long_headers_and_odd_names(spark, frame, tmp_path):
    names = [f"column number {i:06d}" for i in range(60_000)]
    write(tmp_path / "long" / "a.csv", ",".join(names) + "\n" + "," * 59_999 + "\n")
    header = delimited.file_headers(spark, str(tmp_path / "long"))
    assert len(header[0][1]) > 1 << 20 and header[0][1].endswith(names[-1])
    write(tmp_path / "odd" / "A+B 100" / "Main" / "x[1].csv", '"a\nb",c\n"one\ntwo ""x"", ",2\n')
    sheet = delimited.scan_forms(spark, str(tmp_path / "odd"))["Main"]
    assert values(sheet.select("_form", "a_b", "c")) == [("A+B 100", 'one\ntwo "x", ', "2")]
    texts = frame("id string, t string", ("1", " lead\r\nand \"quote\", comma\\ "), ("2", None), ("3", "\n"))
    sinks.csv_report(texts, str(tmp_path / "report"))
    assert values(delimited.scan_delimited(spark, str(tmp_path / "report")).select("id", "t")) == values(texts)


def test_many_header_versions_are_one_scan(spark, tmp_path):
    for i in range(40):
        write(tmp_path / f"{i}.csv", f"n,extra {i}\n{i},x\n")
    got = delimited.scan_delimited(spark, str(tmp_path))
    assert len(got.columns) == 44 and got._jdf.queryExecution().optimizedPlan().toString().count("csv") == 1
    assert values(got.where("n = 7").select("n", "extra_7", "extra_8")) == [("7", "x", None)]


def test_only_files_with_quoted_breaks_are_read_whole(spark, tmp_path):
    write(tmp_path / "plain.csv", "a,b\n" + "".join(f"{i},\"x, y\"\n" for i in range(20_000)))
    write(tmp_path / "broken.csv", 'b,a\n"one\ntwo",1\nthree,2\n')
    write(tmp_path / "empty.csv", "")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        got = delimited.scan_delimited(spark, str(tmp_path))
        assert got.where("b = 'x, y'").count() == 20_000 and got.where("_file LIKE '%plain%'").select("_block").distinct().count() > 2
        assert values(got.where("_file LIKE '%broken%'").select("a", "b")) == [("1", "one\ntwo"), ("2", "three")]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_ledger_reads_new_and_changed_files_only(spark, tmp_path):
    root, target, noted = tmp_path / "in", StoredTable(spark, f"{tmp_path}/t"), StoredTable(spark, f"{tmp_path}/l")
    write(root / "x" / "a b.csv", "k,v\n1,a\n2,b\n")
    write(root / "b.csv", "k\n3\n")
    assert ledger.ingest(spark, str(root), target, noted) == 2 and ledger.ingest(spark, str(root), target, noted) == 0
    opened = (root / "x" / "a b.csv").stat().st_atime_ns
    write(root / "b.csv", "k,w\n4,new\n5,new\n")
    write(root / "c.csv", "v,k\nc,6\n")
    assert ledger.ingest(spark, str(root), target, noted) == 2
    assert (root / "x" / "a b.csv").stat().st_atime_ns == opened
    want = [("1", "a", None), ("2", "b", None), ("4", None, "new"), ("5", None, "new"), ("6", "c", None)]
    assert values(target.read().select("k", "v", "w")) == want
    # A run that broke off before the files were noted is made good by the next one.
    noted.replace(noted.read().where("file NOT LIKE '%c.csv'"))
    assert ledger.ingest(spark, str(root), target, noted) == 1 and values(target.read().select("k", "v", "w")) == want


def test_scan_forms_stacks_all_sheet_names(spark, tmp_path):
    write(tmp_path / "June 1" / "Main Data" / "p.csv", "Survey #,# SMB c,# SMB c\n1,2,0\n")
    write(tmp_path / "June 2" / "Main Data" / "p.csv", "Survey #,Wind\n1,5-10\n")
    write(tmp_path / "June 2" / "ICE" / "p.csv", "Date,Comments\n45292,\"a, b\"\n")
    sheets = delimited.scan_forms(spark, str(tmp_path))
    assert sorted(sheets) == ["ICE", "Main Data"]
    main = sheets["Main Data"].select("_form", "survey_no", "no_smb_c", "no_smb_r", "wind")
    assert values(main) == [("June 1", "1", "2", "0", None), ("June 2", "1", None, None, "5-10")]
    assert values(sheets["ICE"].select("date", "comments")) == [("45292", "a, b")]


def cell(at, value):
    if value in ("s0", "s1"):
        return f'<c r="{at}" t="s"><v>{value[1]}</v></c>'
    if isinstance(value, str):
        return f'<c r="{at}" t="inlineStr"><is><t>{value}</t></is></c>'
    return f'<c r="{at}"><v>{value}</v></c>'


def make_workbook(path, sheets, shared=("Temp", "Date")):
    """A minimal workbook; ``sheets`` maps names to {cell: value}."""
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    office = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    with zipfile.ZipFile(path, "w") as book:
        links = "".join(f'<sheet name="{n}" sheetId="{i}" r:id="r{i}"/>' for i, n in enumerate(sheets, 1))
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{office}"><sheets>{links}</sheets></workbook>')
        rels = "".join(f'<Relationship Id="r{i}" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(sheets) + 1))
        book.writestr("xl/_rels/workbook.xml.rels", f"<Relationships>{rels}</Relationships>")
        strings = "".join(f"<si><t>{s}</t></si>" for s in shared)
        book.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}">{strings}</sst>')
        for i, cells in enumerate(sheets.values(), 1):
            body = "".join(cell(at, v) for at, v in cells.items())
            book.writestr(f"xl/worksheets/sheet{i}.xml", f'<worksheet xmlns="{main}"><sheetData><row>{body}</row></sheetData></worksheet>')


def test_workbook_cells_and_header(spark, tmp_path):
    make_workbook(tmp_path / "a.xlsx", {
        "Shore": {"A1": "North beach", "A2": "s1", "B2": "s0", "A3": 45292, "B3": 14.5, "A4": 45293},
        "Other": {"AB7": "x"},
    })
    (tmp_path / "~$a.xlsx").write_bytes(b"lock")
    cells = workbooks.workbook_cells(spark, str(tmp_path))
    assert values(cells.filter("sheet = 'Other'").select("row", "col", "text")) == [(7, 28, "x")]
    shore = cells.filter("sheet = 'Shore'")
    table = workbooks.with_title(workbooks.promote_header(shore, 2), cells, 1, 1, "location")
    assert values(table.select("row", "date", "temp", "location")) == [
        (3, "45292", "14.5", "North beach"), (4, "45293", None, "North beach")]


def test_label_lookup(frame):
    cells = frame(workbooks.CELLS, ("f", "s", 1, 3, "Date:"), ("f", "s", 1, 5, "45292"), ("g", "s", 2, 1, "Date:"))
    got = workbooks.labelled_value(cells, "Date:", 2, "sold").select("file", "sold")
    assert values(got) == sorted([("f", "45292"), ("g", None)], key=str)


def test_form_record(frame):
    rows = [(1, 1, "Start Time:"), (1, 2, "0.5"), (3, 1, "temp"), (3, 2, "fish"), (4, 1, "12"), (6, 1, "a"), (7, 1, "b")]
    cells = frame(workbooks.CELLS, *[("f", "s", *r) for r in rows])
    got = workbooks.form_record(cells, (1, 1), ["StartTime", "Weather"], 3, ["temp", "fish"], (6, 7))
    assert values(got.select("StartTime", "Weather", "temp", "fish", "comments")) == [("0.5", None, "12", None, "a b")]


def test_sinks(spark, frame, tmp_path):
    schema = T.StructType([T.StructField("d", T.DateType()), T.StructField("n", T.LongType())])
    batch = frame("n string, d string, extra string", ("1", "2024-05-01", "x"), ("bad", "2024-05-02", "y"))
    for _ in range(2):
        sinks.append_table(batch, f"{tmp_path}/t", schema)
    stored = spark.read.parquet(f"{tmp_path}/t")
    assert stored.schema.simpleString() == "struct<d:date,n:bigint>"
    assert values(stored.distinct()) == sorted([(dt.date(2024, 5, 1), 1), (dt.date(2024, 5, 2), None)], key=str)
    assert stored.count() == 4
    sinks.snapshot(batch, f"{tmp_path}/s")
    assert spark.read.parquet(f"{tmp_path}/s").count() == 2
    assert sinks.csv_export({"a": batch, "b": frame("q int", (1,))}, "extra", f"{tmp_path}/out") == ["a"]
    assert spark.read.option("header", "true").csv(f"{tmp_path}/out/a").count() == 2


def test_catalog_and_profile(spark, frame):
    frame("tag string, v int", ("a", 1), ("a", None)).createOrReplaceTempView("creel_one")
    frame("tag string", ("b",)).createOrReplaceTempView("creel_two")
    found = tables.tables_like(spark, "creel_(one|two)")
    assert sorted(found) == ["creel_one", "creel_two"]
    assert values(tables.profile_tables(found, "exact")) == [
        ("creel_one", "tag", 2, 0, 1), ("creel_one", "v", 2, 1, 1), ("creel_two", "tag", 1, 0, 1)]
    assert values(tables.key_sightings(found, "tag")) == [("creel_one", "a", 2), ("creel_two", "b", 1)]


def test_scratch_follows_the_session(spark):
    assert scratch_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_lines_are_gathered_once(frame):
    """Header, values and title of a sheet come from lines that were put together once."""
    cells = frame(
        workbooks.CELLS, ("f", "s", 1, 1, "North"), ("f", "s", 2, 1, "a"), ("f", "s", 2, 3, "b"), ("f", "s", 3, 1, "1"), ("f", "s", 3, 3, "2"),
        ("f", "s", 4, 3, "3"), ("g", "s", 1, 1, "a"), (None, "s", 2, 1, "a"), (None, "s", 3, 1, "4"),
    )
    table = workbooks.with_title(workbooks.promote_header(cells, 2, ["a", "b"]), cells, 1, 1, "title")
    assert values(table) == [("f", "s", 3, "1", "2", "North"), ("f", "s", 4, None, "3", "North")]
    table.collect()
    final = table._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("functions=[collect_list(") == 1
