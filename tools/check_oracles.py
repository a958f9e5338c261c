"""Run every registered query against its SQL in DuckDB and compare all values.

usage: python tools/check_oracles.py [sf_dir] [name-prefix ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if Path(path).exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def normal(value):
    """A hashable form that keeps the type apart: 1, 1.0 and True are three values."""
    if value is None:
        return ("null",)
    if isinstance(value, bool):
        return ("bool", value)
    if isinstance(value, int):
        return ("int", value)
    if isinstance(value, float):
        return ("float", "nan" if math.isnan(value) else value + 0.0)
    if isinstance(value, decimal.Decimal):
        return ("decimal", value)
    if isinstance(value, (dt.datetime, dt.date)):
        return ("time", value.isoformat())
    if isinstance(value, (list, tuple)):
        return ("list", tuple(normal(v) for v in value))
    return ("text", str(value))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(normal(r[i]) for i in order) for r in rows), key=repr
    )


def compare(spark, con, name, build, sql, sf_dir) -> tuple[bool, str, float]:
    started = time.time()
    df = build(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    took = time.time() - started
    if sql is None:
        return True, f"{len(got)} rows, no oracle", took
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    gc, gr = rows_of(df.columns, got)
    wc, wr = rows_of(names, cursor.fetchall())
    if gc != wc:
        return False, f"columns differ: {gc} / {wc}", took
    if len(gr) != len(wr):
        return False, f"row counts differ: {len(gr)} / {len(wr)}", took
    bad = [(a, b) for a, b in zip(gr, wr) if a != b]
    if bad:
        a, b = bad[0]
        diff = [(c, x, y) for c, x, y in zip(gc, a, b) if x != y]
        return False, f"{len(bad)} of {len(gr)} rows differ, first: {diff[:4]}", took
    return True, f"{len(gr)} rows agree", took


def main() -> int:
    from tidegrid import session
    from tidegrid.catalog import ORACLES, QUERIES

    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    wanted = args[1:]
    spark = session(
        "check",
        "local[8]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("OFF")
    con = connect(sf_dir)
    failed = []
    for name, build in QUERIES.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        try:
            ok, note, took = compare(spark, con, name, build, ORACLES.get(name), sf_dir)
        except Exception as error:  # noqa: BLE001
            ok, note, took = False, f"{type(error).__name__}: {str(error)[:600]}", 0.0
        print(f"{'ok  ' if ok else 'FAIL'} {took:6.2f}s {name}: {note}", flush=True)
        if not ok:
            failed.append(name)
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
