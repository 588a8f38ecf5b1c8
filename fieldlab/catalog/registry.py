"""Register of named queries and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fieldlab.sources.tables import Store

# White space as a DuckDB character list.
BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of the table store under a name, with its SQL if there is one."""

    def add(build: Callable[[Store], DataFrame]):
        if name in QUERIES:
            raise KeyError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, root: build(Store(spark, root))
        if sql:
            ORACLES[name] = sql.strip()
        return build

    return add
