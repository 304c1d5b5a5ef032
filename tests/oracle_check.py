"""Compare registered queries with their SQL on one data folder: python tests/oracle_check.py."""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as spark_entry  # noqa: E402
from pricing_audit.sources.testdata import SCHEMAS  # noqa: E402


def canonical(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, bool) or value is None:
        return repr(value)
    if isinstance(value, int):
        return repr(float(value))
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(canonical(r[i]) for i in order) for r in rows)


def connect(sf_dir):
    con = duckdb.connect()
    for name in SCHEMAS:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def compare(spark, con, sf_dir, name):
    df = spark_entry.queries()[name](spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    sql = spark_entry.oracle_sql().get(name)
    if sql is None:
        return got, None
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    return got, rows_of(columns, result.fetchall())


def main():
    from conftest import make_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(spark_entry.queries())
    spark, con = make_session(), connect(sf_dir)
    bad = 0
    for name in names:
        started = time.time()
        try:
            got, want = compare(spark, con, sf_dir, name)
        except Exception as error:
            print(f"ERR  {name}: {type(error).__name__} {str(error)[:1500]}", flush=True)
            bad += 1
            continue
        ok = got == want
        bad += not ok
        print(f"{'ok  ' if ok else 'DIFF'} {name} rows={len(got[1])} {time.time() - started:.1f}s",
              flush=True)
        if not ok and want is not None:
            print("   columns", got[0], want[0], "rows", len(got[1]), len(want[1]))
            mine, theirs = set(got[1]), set(want[1])
            print("   only spark", sorted(mine - theirs)[:2])
            print("   only sql  ", sorted(theirs - mine)[:2])
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
