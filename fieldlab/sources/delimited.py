"""Delimited files whose columns drift from file to file.

All files of a scan are read as one scan of cells by place; each line is joined to its file's header version, which says at which
place a column's cell is. So the number of header versions does not matter to the plan, and files are split like any others. Only
files in which a quoted line break was found (a line with an odd number of quotes) are read by a task each.
"""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote, urlsplit

import pandas as pd
from pyarrow.fs import FileSystem
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldlab.operators.shape import fix_headers
from fieldlab.session import written
from fieldlab.sources.sinks import QUOTING

#: Every scan adds these: source file, byte offset of the split, and row order inside the split.
SOURCE_COLUMNS = ["_file", "_block", "_line"]


def _first_record(path: str) -> str:
    """First record of a CSV file, line breaks inside quotes included, read without fetching the rest."""
    where = path if "://" in path else "file://" + path.removeprefix("file:")
    system, name = FileSystem.from_uri(quote(where, safe="/:@%"))
    lines = []
    with system.open_input_stream(name) as stream, io.BufferedReader(stream) as reader:
        quotes = 0
        for line in reader:
            lines.append(line)
            quotes += line.count(b'"')
            if quotes % 2 == 0:
                break
    return b"".join(lines).decode("utf-8-sig").rstrip("\r\n")


def header_table(spark: SparkSession, root: str, glob: str = "*.csv", known: DataFrame | None = None) -> DataFrame:
    """``file`` (as ``_metadata.file_path``), ``size``, ``changed`` and ``header`` record of every matching file under ``root``.

    Editor lock files are left out, and files that ``known`` has with the same size and time of change. Files are listed without
    their content; tasks then open each file and read its head only.
    """
    files = _listed(spark, root, glob)
    if known is not None:
        files = files.join(known.select("file", "size", "changed"), ["file", "size", "changed"], "left_anti").select(*files.columns)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(header=[_first_record(path) for path in batch["path"]])

    schema = "path string, file string, size long, changed timestamp, header string"
    return files.mapInPandas(read, schema).drop("path")


def _listed(spark: SparkSession, root: str, glob: str) -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(root)
        .select("path", F.col("_metadata.file_path").alias("file"), F.col("length").alias("size"), F.col("modificationTime").alias("changed"))
        .filter(~F.col("path").rlike(r"/~\$[^/]*$"))
    )


def file_headers(spark: SparkSession, root: str, glob: str = "*.csv") -> list[tuple[str, str]]:
    """(file, header record) of every matching file, for a look at a folder; scans do not need this list."""
    return [(r["file"], r["header"]) for r in header_table(spark, root, glob).collect()]


def _folder(level: int) -> Column:
    """A folder above ``file``: a path has spaces and such as %xx; a plus is a plus."""
    return F.url_decode(F.replace(F.element_at(F.split("file", "/"), -1 - level), F.lit("+"), F.lit("%2B")))


def _plain_path(file: str) -> str:
    """A path for a reader: decoded, and no pattern."""
    parts = urlsplit(file)
    where = unquote(parts.path)
    path = where if parts.scheme in ("", "file") else f"{parts.scheme}://{parts.netloc}{where}"
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def scan_delimited(
    spark: SparkSession, root: str | list[str], glob: str = "*.csv", repeats: tuple[str, ...] = (), headers: DataFrame | None = None,
    among: Column | None = None,
) -> DataFrame:
    """All files as text columns, stacked by fixed header name; missing columns are null.

    ``root`` is a folder, or a list of files (as ``_metadata.file_path``).

    ``headers`` is a written table of ``file`` and ``header``, if there is one; files that it does not name are left out. ``among``
    is a condition on ``file`` that holds for all of its files and saves reading others.
    """
    root = root if isinstance(root, str) else [_plain_path(file) for file in root]
    headers = written(header_table(spark, root, glob)) if headers is None else headers
    versions = [r["header"] for r in headers.select("header").distinct().orderBy("header").collect() if r["header"] is not None]
    fixed = {h: fix_headers(cells, repeats) for h in versions if (cells := next(csv.reader(io.StringIO(h, newline="")), []))}
    if not fixed:
        raise FileNotFoundError(f"no {glob} under {root}")
    names = list(dict.fromkeys(n for own in fixed.values() for n in own))
    places = {n: i for i, n in enumerate(names)}
    told = []
    for header, own in fixed.items():
        at = [-1] * len(names)
        for i, n in enumerate(own):
            at[places[n]] = i
        told.append((header, at))
    maps = spark.createDataFrame(told, "header string, _at array<int>")
    width = max(map(len, fixed.values()))
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(width)])
    reader = spark.read.schema(schema).options(header="true", enforceSchema="true", **QUOTING)
    broken = _with_breaks(spark, root, glob, among).join(headers.select("file"), "file", "left_semi")
    whole = [_plain_path(r["file"]) for r in broken.collect()]

    def cells(df: DataFrame) -> DataFrame:
        # Places in the source are told by the scan itself, before anything is shuffled.
        return df.select(
            F.array(*[f"c{i}" for i in range(width)]).alias("_cells"), F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_line"),
        )

    split = cells(reader.options(recursiveFileLookup="true", pathGlobFilter=glob).csv(root))
    lines = split if among is None else split.where(among)
    if whole:
        lines = lines.join(broken, "file", "left_anti").unionByName(cells(reader.option("multiLine", "true").csv(whole)))
    joined = lines.join(headers.select("file", "header").join(maps, "header").select("file", "_at"), "file")
    cell = lambda i: F.when(F.get("_at", F.lit(i)) >= 0, F.get("_cells", F.get("_at", F.lit(i))))
    return joined.select(*[cell(i).alias(n) for n, i in places.items()], F.col("file").alias("_file"), "_block", "_line")


def _with_breaks(spark: SparkSession, root: str, glob: str, among: Column | None) -> DataFrame:
    """Files that have a line with an odd number of quotes."""
    lines = spark.read.options(recursiveFileLookup="true", pathGlobFilter=glob).text(root)
    lines = lines.select("value", F.col("_metadata.file_path").alias("file"))
    odd = (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2 == 1
    return (lines if among is None else lines.where(among)).where(odd).select("file").distinct()


def scan_forms(
    spark: SparkSession, root: str, glob: str = "*.csv", repeats: tuple[str, ...] = ("c", "r")
) -> dict[str, DataFrame]:
    """Landed workbooks, stacked by sheet: ``root/<workbook>/<sheet>/<text files>``.

    Returns one table per sheet name found in any workbook, with the workbook as ``_form``.
    """
    headers = written(header_table(spark, root, glob).withColumn("sheet", _folder(1)))
    sheets = [r["sheet"] for r in headers.select("sheet").distinct().orderBy("sheet").collect()]
    form = F.url_decode(F.replace(F.element_at(F.split("_file", "/"), -3), F.lit("+"), F.lit("%2B")))
    return {
        sheet: scan_delimited(spark, root, glob, repeats, headers.where(F.col("sheet") == sheet), _folder(1) == sheet).withColumn("_form", form)
        for sheet in sheets
    }
