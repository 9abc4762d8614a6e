"""Compare registered queries with their SQL on DuckDB: ``python -m tests.oracle [sf_dir] [name …]``."""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(repr(value))
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(plain, key=repr)


def compare(df, con, sql: str) -> str | None:
    """None when columns and rows agree, else what differs."""
    left = _rows(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    right = _rows([d[0] for d in result.description], result.fetchall())
    if left[0] != right[0]:
        return f"columns {left[0]} != {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"rows {len(left[1])} != {len(right[1])}"
    wrong = [(a, b) for a, b in zip(left[1], right[1]) if a != b]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None


def main() -> None:
    from stratalake.session import local_session
    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = local_session(8, "oracle")
    con = connect(sf_dir)
    bad = 0
    for name, build in entry.queries().items():
        if wanted and name.split("_")[0] not in wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = build(spark, sf_dir)
            sql = entry.oracle_sql().get(name)
            found = compare(df, con, sql) if sql else None
            text = f"rows only ({df.count()})" if not sql else (found or "ok")
        except Exception as exc:
            text = found = f"{type(exc).__name__}: {str(exc)[:600]}"
        bad += found is not None
        print(f"{time.time() - start:6.2f}s {name:34s} {text}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()
