"""A ledger of files that were read, so that a rerun over a growing folder reads what is new or has changed only.

The ledger is a stored table of (file, size, time of the last change). What a listing has beyond it is pending. ``ingest`` reads the
pending files, replaces the rows that the target has of them, and then notes them. A run that breaks off between the two is made good
by the next one, which reads the same files and replaces the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fieldlab.session import written
from fieldlab.sources.delimited import header_table, scan_delimited
from fieldlab.sources.versions import StoredTable

#: What tells that a file is still the same.
NOTED = ["file", "size", "changed"]


def ingest(
    spark: SparkSession, root: str, target: StoredTable, ledger: StoredTable, glob: str = "*.csv", repeats: tuple[str, ...] = ()
) -> int:
    """Read what is new or changed below ``root`` into the target; the number of files that were read.

    The target has all cells as text and ``_file``; new columns are added, missing ones are null. A changed file's rows take the
    place of its old ones. Files that are gone keep their rows. Only pending files are opened.
    """
    fresh = written(header_table(spark, root, glob, None if ledger.version is None else ledger.read()))
    names = [r["file"] for r in fresh.select("file").collect()]
    if not names:
        return 0
    rows = scan_delimited(spark, names, glob, repeats, fresh)
    if target.version is None:
        target.replace(rows)
    else:
        old = target.read()
        kept = old.join(fresh.select(fresh["file"].alias("_file")), "_file", "left_anti")
        target.replace(kept.unionByName(rows, allowMissingColumns=True).select(*dict.fromkeys([*old.columns, *rows.columns])))
    noted = fresh.select(*NOTED)
    if ledger.version is not None:
        earlier = ledger.read()
        noted = earlier.join(noted.select("file"), "file", "left_anti").select(*NOTED).unionByName(noted)
    ledger.replace(noted)
    return len(names)
