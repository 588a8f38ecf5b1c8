"""Writing typed tables, snapshots and CSV reports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from fieldlab.operators.shape import typed
from fieldlab.sources.tables import tables_holding
from fieldlab.sources.versions import StoredTable


#: CSV options by which any text comes back as it was: a quote is doubled, white space stays.
QUOTING = {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def append_table(
    df: DataFrame, path: str, schema: T.StructType, partition_by: list[str] = (), mode: str = "append"
) -> None:
    """Append rows with the declared types, or (``overwrite``) store them as the table's next version."""
    rows = typed(df, schema)
    if mode == "overwrite":
        StoredTable(df.sparkSession, path).replace(rows, partition_by)
    else:
        rows.write.mode(mode).partitionBy(*partition_by).parquet(path)


def snapshot(df: DataFrame, path: str) -> None:
    """Replace the stored copy of a cleaned sheet, which the frame may read.

    The first copy is plain files, later ones are versions beside them: ``versions.stored`` reads the current one.
    """
    table = StoredTable(df.sparkSession, path)
    if table.version is None:
        df.write.parquet(path)
    else:
        table.replace(df)


def csv_report(df: DataFrame, path: str) -> None:
    """A report folder of CSV parts with headers; rows stay distributed."""
    df.write.mode("overwrite").options(header="true", **QUOTING).csv(path)


def csv_export(tables: Mapping[str, DataFrame], column: str, root: str) -> list[str]:
    """One CSV report under ``root`` for every table that holds the column."""
    chosen = tables_holding(tables, column)
    for name, df in chosen.items():
        csv_report(df, f"{root}/{name}")
    return sorted(chosen)
