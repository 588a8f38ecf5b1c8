"""Tables stored over themselves: nothing is lost, nobody sees half a table."""

import pytest
from pyspark.sql import functions as F

from conftest import values
from fieldlab.operators.maintain import KeyConflict
from fieldlab.sources import sinks
from fieldlab.sources.versions import FailedCheck, StaleTable, StoredTable, stored


@pytest.fixture
def table(spark, frame, tmp_path):
    return StoredTable(spark, f"{tmp_path}/t").replace(frame("k int, v string", (1, "a"), (2, "b"), (3, None)))


def test_update_and_delete_over_themselves(table):
    before = table.read()
    table.update_where(F.col("v") == "a", {"v": F.lit("z")}).delete_where(F.col("k") == 2)
    assert values(table.read()) == [(1, "z"), (3, None)]
    assert values(before) == [(1, "a"), (2, "b"), (3, None)]
    assert len(table.history()) == 3 and values(table.read(table.history()[0])) == values(before)


def test_a_failing_write_leaves_the_old_version(spark, table):
    bad = table.read().withColumn("v", F.when(F.col("k") == 3, F.raise_error(F.lit("broken"))).otherwise(F.col("v")).cast("string"))
    name = table.version
    with pytest.raises(Exception, match="broken"):
        table.replace(bad)
    with pytest.raises(FailedCheck):
        table.replace(table.read().limit(1), check=lambda df: df.count() == 3)
    assert table.version == name and values(table.read()) == [(1, "a"), (2, "b"), (3, None)]
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{table.root}/_versions")
    assert len(folder.getFileSystem(table._conf).listStatus(folder)) == 1


def test_a_writer_that_comes_late_gives_up(table):
    since = table.version
    table.delete_where(F.col("k") == 1)
    with pytest.raises(StaleTable):
        table.replace(table.read().limit(0), since=since)
    assert table.read().count() == 2


def test_append_and_keys(frame, table):
    table.append(frame("k int, v string", (4, "d")), ["k"])
    with pytest.raises(KeyConflict):
        table.append(frame("k int, v string", (4, "e")), ["k"])
    assert table.append(frame("k int", (9,))).read().count() == 5


def test_vacuum_keeps_the_current_version(table):
    table.delete_where(F.col("k") == 1).delete_where(F.col("k") == 2)
    assert len(table.vacuum(keep=2)) == 1 and len(table.history()) == 2
    assert len(table.vacuum()) == 1 and table.vacuum() == [] and values(table.read()) == [(3, None)]


def test_plain_files_are_the_first_version(spark, frame, tmp_path):
    path = f"{tmp_path}/plain"
    with pytest.raises(FileNotFoundError):
        stored(spark, path)
    sinks.snapshot(frame("k int", (1,), (2,)), path)
    sinks.snapshot(spark.read.parquet(path).withColumn("k", F.col("k") * 10), path)
    assert values(stored(spark, path)) == [(10,), (20,)]
    sinks.snapshot(stored(spark, path).where("k = 10"), path)
    table = StoredTable(spark, path)
    assert values(table.read()) == [(10,)] and table.vacuum()[0] == "" and values(stored(spark, path)) == [(10,)]


def test_overwrite_with_types_and_partitions(spark, frame, tmp_path):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("year", T.LongType())])
    path = f"{tmp_path}/typed"
    for _ in range(2):
        sinks.append_table(frame("n string, year string", ("1", "2024"), ("2", "2025")), path, schema, ["year"], mode="overwrite")
    assert values(stored(spark, path).select("n", "year")) == [(1, 2024), (2, 2025)]


def test_empty_tables(spark, frame, tmp_path):
    table = StoredTable(spark, f"{tmp_path}/none").replace(frame("k int", (1,)).limit(0))
    assert table.read().count() == 0 and table.delete_where(F.col("k") == 1).read().columns == ["k"]
