"""Helpers shared by the operators: batches of text as bytes, row keys, sorted runs over range partitions."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that one Arrow batch holds at most; long texts make a batch of many rows large.
BATCH_ROWS = 1000


def prepared(spark: SparkSession) -> SparkSession:
    """Settings for the Python stages: small Arrow batches, so that a task's memory does not follow its rows."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return prepared(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_key(text: Column | str) -> Column:
    """31 bits of a text's hash. Rows of one doc_id with different texts stay apart by it; equal rows are one document."""
    return F.xxhash64(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))).bitwiseAND(
        F.lit(0x7FFFFFFF)
    ).cast("int")


def keyed_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n`` (the text's key) and ``text`` (null: empty) of each row; rows that repeat all three are one."""
    return docs.select(
        F.col(doc_id).alias("doc_id"), text_key(text).alias("n"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )


def free(name: str, *frames: DataFrame) -> str:
    """The name, with an underscore in front as often as some frame has a column of it."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def texts_of(column: pa.Array) -> list[str]:
    """Texts of a batch; null is empty."""
    return ["" if t is None else t for t in column.to_pylist()]


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a batch's texts, one after the other, and the ``len + 1`` places where texts begin. No copy of the bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, wide)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(at: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Consecutive groups of texts of about ``most`` bytes; a longer text is a group of its own."""
    first, n = 0, len(at) - 1
    while first < n:
        last = int(np.searchsorted(at, at[first] + most, "right")) - 1
        last = min(n, max(last, first + 1))
        yield first, last
        first = last


def arrow_map(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch | Iterable[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` of a function of one batch; columns are cast to the schema's Arrow types."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                made = work(batch)
                yield from [made] if isinstance(made, pa.RecordBatch) else made

    return df.mapInArrow(run, schema)


def batch_of(**columns) -> pa.RecordBatch:
    """A record batch of named arrays, lists or numpy arrays."""
    return pa.RecordBatch.from_arrays(
        [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()],
        names=list(columns),
    )


def gathered(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
    """All rows of a partition; for partitions whose size the range splitters bound."""
    held = [b for b in batches if b.num_rows]
    return pa.Table.from_batches(held).combine_chunks() if held else None
