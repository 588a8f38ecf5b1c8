"""Compare registered queries with their SQL on DuckDB: names, row count and values."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time
import traceback

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, decimal.Decimal)):
        return float(value) if isinstance(value, decimal.Decimal) else value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _rows(columns, rows):
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in at], sorted(
        (tuple(_plain(r[i]) for i in at) for r in rows), key=lambda r: [(v is None, str(type(v)), v) for v in r]
    )


def differences(df, con, sql) -> str | None:
    """What differs between a Spark result and a SQL result, or None."""
    names, got = _rows(df.columns, df.collect())
    cur = con.execute(sql)
    want_names, want = _rows([d[0] for d in cur.description], cur.fetchall())
    if names != want_names:
        return f"columns {names} != {want_names}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    types = [(type(g), type(w)) for pair in zip(got[:1], want[:1]) for g, w in zip(*pair)]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ, first:\n   spark {bad[0][0]}\n   sql   {bad[0][1]}"
    if not got:
        return "no rows at all"
    loose = [(n, a.__name__, b.__name__) for n, (a, b) in zip(names, types) if a != b]
    return f"types {loose}" if loose else None


def main(sf: str, patterns: list[str]) -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from fieldlab.session import local_session

    spark = local_session()
    sf_dir = f"/root/testdata/{sf}"
    con = duck(sf_dir)
    oracles = entry.oracle_sql()
    failed = 0
    for name, build in entry.queries().items():
        if patterns and not any(name.startswith(p) for p in patterns):
            continue
        begin = time.time()
        try:
            df = build(spark, sf_dir)
            problem = differences(df, con, oracles[name]) if name in oracles else f"unchecked, {df.count()} rows"
        except Exception as error:  # noqa: BLE001
            problem = "".join(traceback.format_exception_only(error))[:700]
            tb = [f for f in traceback.extract_tb(error.__traceback__) if "fieldlab" in f.filename]
            problem += "".join(f"\n   {f.filename}:{f.lineno} {f.line}" for f in tb)
        if problem and not problem.startswith("unchecked"):
            failed += 1
        print(f"{'ok  ' if not problem else 'FAIL'} {name} {time.time() - begin:.2f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
