"""Compares a query with its SQL through the helpers of the other tests."""

from __future__ import annotations

from oracle_check import connect, rows_of


def compare_with_sql(spark, sf_dir, name, query, sql):
    df = query(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = connect(sf_dir).execute(sql)
    return got, rows_of([d[0] for d in result.description], result.fetchall())
