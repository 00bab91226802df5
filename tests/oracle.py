"""Runs a query on Spark and its SQL twin on DuckDB and compares them."""

from __future__ import annotations

import sys
import time

import duckdb

sys.path.insert(0, __file__.rsplit("/", 2)[0])

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def rows_of(columns, rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=lambda r: tuple((v is not None, str(v)) for v in r))


def compare(spark, con, name, query, sql, folder):
    """(equal, Spark row count, seconds); raises on differing column names."""
    began = time.time()
    df = query(spark, folder)
    arrow = df.toArrow()
    took = time.time() - began
    got = rows_of(arrow.column_names, zip(*[c.to_pylist() for c in arrow.columns]))
    if sql is None:
        return None, len(got), took
    twin = con.sql(sql).to_arrow_table()
    if sorted(arrow.column_names) != sorted(twin.column_names):
        raise AssertionError(f"{name}: columns {arrow.column_names} / {twin.column_names}")
    kinds = {c: str(twin.schema.field(c).type) for c in twin.column_names}
    mine = {c: str(arrow.schema.field(c).type) for c in arrow.column_names}
    if kinds != mine:
        print(f"{name}: types {mine} / {kinds}")
    want = rows_of(twin.column_names, zip(*[c.to_pylist() for c in twin.columns]))
    if got != want:
        extra, missing = list(set(got) - set(want))[:3], list(set(want) - set(got))[:3]
        print(f"{name}: {len(got)} / {len(want)} rows; only Spark {extra}; only SQL {missing}")
    return got == want, len(got), took


def main() -> None:
    import __spark_entry__ as contract
    from millrace.session import local_session

    folder = sys.argv[1]
    spark, con = local_session(), connect(folder)
    sqls = contract.oracle_sql()
    for name, query in contract.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        try:
            equal, n, took = compare(spark, con, name, query, sqls.get(name), folder)
            print(f"{'ok  ' if equal else 'rows' if equal is None else 'DIFF'} {name:24} {n:>9} rows {took:6.2f} s")
        except Exception as e:  # report all queries, not only the first bad one
            print(f"FAIL {name}: {str(e)[:1500]}")


if __name__ == "__main__":
    main()
