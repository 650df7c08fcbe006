"""Run registered queries next to their SQL and compare the rows.

    python -m suite.check [--sf 0.01] [--time] [name ...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

from pitwall.session import local_session
from suite.registry import load

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


# Spark type names and what DuckDB calls the same type.
TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
         "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


def norm(v):
    if isinstance(v, bool) or v is None or isinstance(v, str):
        return v
    if isinstance(v, decimal.Decimal):
        return f"decimal:{v}"
    if isinstance(v, float):
        return repr(v + 0.0)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(norm(r[i]) for i in order) for r in rows)


def compare(spark, con, fn, sql, folder) -> str | None:
    """None when equal, else a description of the difference."""
    df = fn(spark, folder)
    got = rows_of(df.columns, df.collect())
    if not sum(got.values()):
        return "no rows"
    if sql is None:
        return None
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    want = rows_of(names, rel.fetchall())
    kinds = {row[0]: row[1] for row in con.execute(f"DESCRIBE {sql}").fetchall()}
    other = [(f.name, f.dataType.simpleString(), kinds[f.name]) for f in df.schema if TYPES.get(f.dataType.simpleString()) != kinds[f.name]]
    if other:
        return f"types {other}"
    if got == want:
        return None
    only, missing = list((got - want).items())[:3], list((want - got).items())[:3]
    return f"{sum(got.values())} rows against {sum(want.values())}; columns {sorted(names)}\n  spark: {only}\n  sql:   {missing}"


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("names", nargs="*")
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("--time", action="store_true")
    args = parser.parse_args()
    folder = f"/root/testdata/sf{args.sf}"
    queries, oracles = load()
    spark, con = local_session(cores="8"), duck(folder)
    failed = []
    names = args.names or list(queries)
    for name in names:
        start = time.perf_counter()
        try:
            problem = compare(spark, con, queries[name], oracles.get(name), folder)
        except Exception as e:  # noqa: BLE001 - report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        if args.time:
            print(f"{time.perf_counter() - start:7.2f}s {name}", flush=True)
        if problem:
            failed.append(name)
            print(f"FAIL {name}: {problem}", flush=True)
    print(f"{len(names) - len(failed)} of {len(names)} equal at sf{args.sf}; without SQL: "
          f"{[n for n in names if n not in oracles]}; failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    sys.exit(main())
