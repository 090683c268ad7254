"""Runs queries and their SQL side by side: ``python -m tests.compare [sf] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
import traceback

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def rows_of_spark(df):
    columns = sorted(df.columns)
    return columns, sorted((tuple(plain(v) for v in r) for r in df.select(*[f"`{c}`" for c in columns]).collect()), key=key)


def rows_of_sql(con, sql):
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [tuple(plain(r[i]) for i in order) for r in result.fetchall()]
    return [names[i] for i in order], sorted(rows, key=key)


def difference(run, sql, spark, con, sf_dir) -> str | None:
    """None when both agree exactly, else what differs first."""
    columns, got = rows_of_spark(run(spark, sf_dir))
    if sql is None:
        return None if got else "no rows"
    names, want = rows_of_sql(con, sql)
    if columns != names:
        return f"columns {columns} against {names}"
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"{g} against {w}"
        if [type(x) for x in g] != [type(x) for x in w]:
            return f"types of {g} against {w}"
    return None if got else "no rows on both sides"


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from tests.conftest import session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark, con, sqls = session(), connect(sf_dir), oracle_sql()
    wanted = sys.argv[2:]
    failed = []
    for name, run in queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            problem = difference(run, sqls.get(name), spark, con, sf_dir)
        except Exception as err:  # the next queries still count
            problem = f"{type(err).__name__}: {str(err)[:1500]}"
            if wanted:
                traceback.print_exc()
        if problem:
            failed.append(name)
        print(f"{'FAIL' if problem else 'ok  '} {time.time() - start:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{len(failed)} failed: {failed}")


if __name__ == "__main__":
    main()
