"""Side-by-side run of registered queries in Spark and DuckDB."""

from __future__ import annotations

import datetime
import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "~"
    if isinstance(value, bool):
        return str(int(value))
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return str(value)


def rows_of(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(canonical(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql: str) -> str | None:
    """None when equal, else a short description of the first difference."""
    got_cols, got = rows_of(spark_df.columns, spark_df.collect())
    cursor = con.execute(sql)
    want_cols, want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        g, w = bad[0]
        cells = [(c, a, b) for c, a, b in zip(got_cols, g, w) if a != b]
        return f"{len(bad)} of {len(got)} rows differ, first: {cells[:4]} in {g[:6]}"
    return None


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from tributary.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark = local_session("8")
    con = connect(sf_dir)
    sql = oracle_sql()
    for name, query in queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            if name in sql:
                problem = compare(query(spark, sf_dir), con, sql[name])
            else:
                problem = f"rows only: {query(spark, sf_dir).count()}"
        except Exception as error:  # noqa: BLE001
            problem = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        print(f"{name:24s} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)


if __name__ == "__main__":
    main()
