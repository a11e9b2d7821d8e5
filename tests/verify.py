"""Holds queries against their SQL: python tests/verify.py [folder] [prefix...]. Also used by the tests."""

from __future__ import annotations

import decimal
import os
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

ROOT = os.environ.get("TESTDATA", "/root/testdata")


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in Path(folder).glob("*.parquet"):
        files = f"{path}/*.parquet" if path.is_dir() else str(path)
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{files}'")
    return con


def plain(value):
    if value is None or value != value:
        return None
    if isinstance(value, (decimal.Decimal, float)):
        return round(float(value), 6)
    if hasattr(value, "isoformat"):
        return value.isoformat().replace("T00:00:00", "")
    return value


def counted(columns, rows) -> Counter:
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in at) for r in rows)


def compare(df, sql: str, con) -> tuple[list[str], list[str], Counter, Counter]:
    ours = counted(df.columns, df.collect())
    cur = con.execute(sql)
    names = [x[0] for x in cur.description]
    theirs = counted(names, cur.fetchall())
    return sorted(df.columns), sorted(names), ours - theirs, theirs - ours


def main() -> None:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry
    from tidemark.session import local_session

    folder, prefixes = sys.argv[1], sys.argv[2:]
    spark, con = local_session(), duck(folder)
    sql = entry.oracle_sql()
    for name, query in entry.queries().items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        t = time.time()
        try:
            if name not in sql:
                print(f"{name}: no SQL, {query(spark, folder).count()} rows, {time.time() - t:.1f} s", flush=True)
                continue
            df = query(spark, folder)
            a, b, more, less = compare(df, sql[name], con)
            n = df.count()
            same = a == b and not more and not less
            print(f"{name}: {'ok' if same else 'DIFFERS'} {n} rows {time.time() - t:.1f} s", "" if same else (a, b, sum(more.values()), sum(less.values()), list(more)[:3], list(less)[:3]), flush=True)
        except Exception as e:
            print(f"{name}: ERROR {str(e)[:1500]}", flush=True)


if __name__ == "__main__":
    main()
