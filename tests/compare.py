"""Runs a registered query and its SQL on the same tables and compares all rows."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, bool):
        return value
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    if isinstance(value, float):
        return "nan" if math.isnan(value) else (0.0 if value == 0 else value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(plain(row[i]) for i in order) for row in rows]
    return sorted(names), sorted(out, key=repr)


def type_of(value):
    return type(value).__name__


def check(spark, folder: str, name: str, function, sql: str | None):
    """(passed, message, seconds)"""
    start = time.time()
    frame = function(spark, folder)
    names, rows = sorted_rows(frame.columns, [tuple(r) for r in frame.collect()])
    took = time.time() - start
    if sql is None:
        return len(rows) > 0, f"{len(rows)} rows, no SQL", took
    con = connect(folder)
    cursor = con.execute(sql)
    want_names, want = sorted_rows([d[0] for d in cursor.description], cursor.fetchall())
    con.close()
    if names != want_names:
        return False, f"columns {names} != {want_names}", took
    if len(rows) != len(want):
        return False, f"rows {len(rows)} != {len(want)}; {rows[:2]} {want[:2]}", took
    wrong = [(a, b) for a, b in zip(rows, want) if a != b]
    if wrong:
        return False, f"{len(wrong)} of {len(rows)} rows differ, first {str(wrong[0])[:600]}", took
    types = [tuple(map(type_of, r)) for r in rows[:1]] != [tuple(map(type_of, r)) for r in want[:1]]
    if types:
        return False, f"types differ {rows[:1]} {want[:1]}", took
    return True, f"{len(rows)} rows equal", took


def main(argv):
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from __spark_entry__ import oracle_sql, queries
    from versemill.session import build_session

    folder, wanted = argv[0], argv[1:]
    spark = build_session("compare", "local[8]")
    sqls = oracle_sql()
    bad = 0
    for name, function in queries().items():
        if wanted and not any(name == w or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
            continue
        try:
            passed, message, took = check(spark, folder, name, function, sqls.get(name))
        except Exception as error:  # report every query, then fail
            passed, message, took = False, f"{type(error).__name__}: {str(error)[:700]}", 0.0
        bad += not passed
        print(f"{'ok  ' if passed else 'FAIL'} {took:6.2f}s {name}: {message}", flush=True)
    print("failed:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
