"""Run registered queries against their SQL equivalents and report differences.

    python tools/compare.py [--sf DIR] [name-prefix ...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from laborlens.registry import QUERIES  # noqa: E402
from laborlens.session import build_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
         "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP"}


def duck(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def plain(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


def check(spark, con, sf: str, name: str) -> str | None:
    """None when equal, else what differs."""
    q = QUERIES[name]
    df = q.run(spark, sf)
    got = df.collect()
    if q.sql is None:
        return None if got else "no rows"
    cur = con.execute(q.sql)
    names = [d[0] for d in cur.description]
    kinds = {d[0]: str(d[1]) for d in cur.description}
    want = cur.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    for column, kind in df.dtypes:
        if TYPES.get(kind, kind) != kinds[column]:
            return f"type of {column}: {kind} vs {kinds[column]}"
    if len(got) != len(want):
        return f"rows {len(got)} vs {len(want)}"
    left, right = rows_of(df.columns, got), rows_of(names, want)
    different = [(a, b) for a, b in zip(left, right) if a != b]
    if different:
        return f"{len(different)} of {len(left)} rows differ, first {sorted(names)}\n   spark {different[0][0]}\n   sql   {different[0][1]}"
    return None if got else "no rows on either side"


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(args.sf)
    failed = 0
    chosen = [n for n in QUERIES if not args.names or any(n.startswith(p) for p in args.names)]
    for name in chosen:
        started = time.time()
        try:
            problem = check(spark, con, args.sf, name)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        took = time.time() - started
        kind = "sql" if QUERIES[name].sql else "rows"
        print(f"{'ok  ' if problem is None else 'FAIL'} {kind:4} {took:6.2f}s {name}" + (f": {problem}" if problem else ""), flush=True)
        failed += problem is not None
    print(f"{len(chosen) - failed} of {len(chosen)} passed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
