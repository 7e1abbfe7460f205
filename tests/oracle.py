"""Compare registered queries with their SQL in DuckDB.

``python -m tests.oracle [folder] [name-prefix ...]`` prints one line per query.
"""

from __future__ import annotations

import decimal
import pathlib
import sys
import time

import duckdb

import __spark_entry__ as registered


def connect(folder: str):
    con = duckdb.connect()
    for file in sorted(pathlib.Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return float(f"{value:.10g}")
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(plain, key=repr)


def compare(spark, con, folder: str, name: str) -> str | None:
    """None if the query equals its SQL, else what differs."""
    df = registered.queries()[name](spark, folder)
    got_names, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    sql = registered.oracle_sql().get(name)
    if sql is None:
        return None if got else "no rows"
    result = con.execute(sql)
    want_names, want = _rows([d[0] for d in result.description], result.fetchall())
    if got_names != want_names:
        return f"columns {got_names} instead of {want_names}"
    if len(got) != len(want):
        return f"{len(got)} rows instead of {len(want)}"
    for g, w in zip(got, want):
        if g != w or [type(x) for x in g] != [type(x) for x in w]:
            return f"{str(g)[:300]} instead of {str(w)[:300]}"
    return None


def main(folder: str, prefixes: list[str]) -> int:
    from tidemark.session import build_session

    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name in registered.queries():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        start = time.time()
        try:
            fault = compare(spark, con, folder, name)
        except Exception as error:
            fault = f"{type(error).__name__}: {str(error)[:400]}"
        empty = con.execute(f"SELECT count(*) FROM ({registered.oracle_sql()[name].rstrip().rstrip(';')})").fetchall()[0][0] \
            if name in registered.oracle_sql() and fault is None else -1
        bad += fault is not None
        print(f"{'ok ' if fault is None else 'BAD'} {time.time() - start:6.2f}s {name} {empty} {fault or ''}", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:]))
