"""Workbooks as cells, and tables cut out of cells.

A cell table has the columns file, sheet, row, col (both from 1) and text.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from itertools import batched
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlab.operators.shape import fix_headers

CELLS = "file string, sheet string, row int, col int, text string"


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def _texts(node) -> str:
    return "".join(t.text or "" for t in node.iter() if _local(t.tag) == "t")


def _column(reference: str) -> int:
    number = 0
    for letter in re.match("[A-Z]+", reference).group():
        number = number * 26 + ord(letter) - 64
    return number


def _read_workbook(path: str, content: bytes) -> Iterator[tuple]:
    """Cells of one workbook file as text; shared strings are resolved."""
    book = zipfile.ZipFile(io.BytesIO(content))
    names = set(book.namelist())
    shared = []
    if "xl/sharedStrings.xml" in names:
        shared = [_texts(si) for si in ElementTree.fromstring(book.read("xl/sharedStrings.xml"))]
    targets = {
        r.get("Id"): r.get("Target").lstrip("/").removeprefix("xl/")
        for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    }
    for sheet in ElementTree.fromstring(book.read("xl/workbook.xml")).iter():
        if _local(sheet.tag) != "sheet":
            continue
        link = next(v for k, v in sheet.attrib.items() if _local(k) == "id")
        tree = ElementTree.fromstring(book.read(f"xl/{targets[link]}"))
        for cell in (c for c in tree.iter() if _local(c.tag) == "c"):
            value = next((v.text for v in cell if _local(v.tag) == "v"), None)
            if cell.get("t") == "s" and value is not None:
                value = shared[int(value)]
            elif cell.get("t") == "inlineStr":
                value = _texts(cell)
            if value not in (None, ""):
                at = cell.get("r")
                yield path, sheet.get("name"), int(re.sub("[A-Z]", "", at)), _column(at), value


def workbook_cells(spark: SparkSession, root: str, glob: str = "*.xlsx") -> DataFrame:
    """Every non-empty cell of every workbook under ``root``, read in parallel by file."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(root)
        .filter(~F.col("path").rlike(r"/~\$[^/]*$"))
        .select("path", "content")
    )

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["file", "sheet", "row", "col", "text"]
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                for part in batched(_read_workbook(path, content), 50_000):
                    yield pd.DataFrame(part, columns=names)

    return files.mapInPandas(read, CELLS)


def sheet_lines(cells: DataFrame) -> DataFrame:
    """One row per (file, sheet, row) with its cells as a map from column to text.

    Everything below is made from these rows. Where a plan uses them more than once, Spark reuses their exchange. The one after the
    grouping is asked for, as the maps, which cost the most, would be gathered anew for every use otherwise; its keys are in another
    order than the grouping's, as Spark leaves out an exchange that repeats one.
    """
    line = F.map_from_entries(F.collect_list(F.struct("col", "text"))).alias("_line")
    return cells.groupBy("file", "sheet", "row").agg(line).repartition("row", "file", "sheet")


def _first_column(reads) -> Column:
    """The leftmost column of a line whose text fits."""
    return F.array_min(F.map_keys(F.map_filter("_line", lambda col, text: reads(text))))


def promote_header(cells: DataFrame, header_row: int = 1, names: list[str] | None = None) -> DataFrame:
    """Rows below a header row as a wide text table, one row per (file, sheet, row).

    ``names`` are the headers to keep as written in the sheet; without it the distinct headers are read once: they are the
    result's columns. The columns get fixed header names.
    """
    lines = sheet_lines(cells)
    if names is None:
        header = cells.filter(F.col("row") == header_row).select(F.trim("text").alias("_name"))
        names = [r[0] for r in header.dropna().distinct().orderBy("_name").collect()]
    is_header = F.when(F.col("row") == header_row, F.lit(1))
    def column_of(name: str) -> Column:
        return F.max(F.when(is_header == 1, _first_column(lambda text: F.trim(text) == name)))

    place = [column_of(n).alias(f"_c{i}") for i, n in enumerate(names)]
    places = lines.groupBy("file", "sheet").agg(F.max(F.when(is_header == 1, F.col("row"))).alias("_header"), *place).dropna(subset=["_header"])
    fixed = fix_headers(names)
    values = [F.try_element_at("_line", F.col(f"_c{i}")).alias(n) for i, n in enumerate(fixed)]
    # Compared with the header that was found, as a fixed row would be cut off before the lines are made, which then are made twice;
    # so would missing rows be, without the coalesce.
    below = F.coalesce(F.col("row") > F.col("_header"), F.lit(False))
    wide = lines.join(places, ["file", "sheet"]).where(below).select("file", "sheet", "row", *values)
    return wide.dropna("all", subset=fixed)


def with_title(table: DataFrame, cells: DataFrame, row: int, col: int, into: str) -> DataFrame:
    """Attach the text of one fixed cell of each sheet to all rows of that sheet."""
    text = F.max(F.when(F.col("row") == row, F.try_element_at("_line", F.lit(col)))).alias(into)
    title = sheet_lines(cells).groupBy("file", "sheet").agg(text)
    return table.join(title, ["file", "sheet"], "left")


def labelled_value(cells: DataFrame, label: str, across: int, into: str) -> DataFrame:
    """Per sheet with the label, the text ``across`` columns right of the first cell that reads ``label``."""
    at = _first_column(lambda text: text == label)
    marked = sheet_lines(cells).withColumn("_at", at)
    value = F.try_element_at("_line", F.col("_at") + across)
    first = F.min(F.when(F.col("_at").isNotNull(), F.struct("row", value.alias("value")))).alias("_first")
    found = marked.groupBy("file", "sheet").agg(first)
    return found.where(F.col("_first").isNotNull()).select("file", "sheet", F.col("_first.value").alias(into))


def _reads(name: str):
    return lambda col, text: text == name


def form_record(
    cells: DataFrame, label_rows: tuple[int, int], labels: list[str], response_row: int,
    responses: list[str], comment_rows: tuple[int, int],
) -> DataFrame:
    """One record per form: label/value pairs, a header-and-value block, and joined comments.

    Every part is an aggregate over (file, sheet), so the cells are shuffled once.
    """
    row, col, text = F.col("row"), F.col("col"), F.col("text")
    in_labels = row.between(*label_rows)
    line = (
        cells.groupBy("file", "sheet", "row")
        .agg(
            F.max(F.when(in_labels & (col == 1), F.regexp_replace(text, "[: ]", ""))).alias("_label"),
            F.max(F.when(in_labels & (col == 2), text)).alias("_value"),
            F.max(F.when(row.between(*comment_rows) & (col == 1), text)).alias("_comment"),
            F.map_from_entries(
                F.collect_list(
                    F.when(row.isin(response_row, response_row + 1), F.struct(col, text))
                )
            ).alias("_cells"),
        )
    )
    pairs = [F.max(F.when(F.col("_label") == n, F.col("_value"))).alias(n) for n in labels]
    heads = F.max_by("_cells", F.when(row == response_row, 1)).alias("_heads")
    values = F.max_by("_cells", F.when(row == response_row + 1, 1)).alias("_answers")
    notes = F.sort_array(
        F.collect_list(F.when(F.col("_comment").isNotNull(), F.struct("row", "_comment")))
    )
    record = line.groupBy("file", "sheet").agg(*pairs, heads, values, notes.alias("_notes"))
    answer = {}
    for name in responses:
        at = F.map_keys(F.map_filter("_heads", _reads(name)))
        answer[name] = F.try_element_at("_answers", F.try_element_at(at, F.lit(1)))
    comment = F.array_join(F.transform("_notes", lambda n: n["_comment"]), " ")
    return record.withColumns({**answer, "comments": comment}).drop("_heads", "_answers", "_notes")
