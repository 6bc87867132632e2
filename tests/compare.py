"""Runs registered queries next to their SQL twins and reports differences.

Usage: python -m tests.compare [sf dir] [name prefix ...]
"""

from __future__ import annotations

import decimal
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    """A value both engines agree on: sorted containers, numbers without engine types."""
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return value + 0.0 if value else 0.0
    if isinstance(value, dict):
        return tuple(sorted((k, plain(v)) for k, v in value.items()))
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


KINDS = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
         "date": "DATE", "boolean": "BOOLEAN"}


def compare(df, con, sql: str) -> str:
    """Empty when both sides agree, else what differs."""
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    relation = con.sql(sql)
    theirs = rows_of(relation.columns, relation.fetchall())
    if sorted(df.columns) != sorted(relation.columns):
        return f"columns {sorted(df.columns)} != {sorted(relation.columns)}"
    kinds = dict(zip(relation.columns, map(str, relation.types)))
    for name, kind in df.dtypes:
        if KINDS.get(kind, kinds[name]) != kinds[name]:
            return f"type of {name}: {kind} != {kinds[name]}"
    if len(mine) != len(theirs):
        return f"{len(mine)} rows != {len(theirs)} rows"
    bad = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if bad:
        return f"{len(bad)} of {len(mine)} rows differ, first {sorted(df.columns)}\n  spark {bad[0][0]}\n  duck  {bad[0][1]}"
    return ""


def main() -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from riskloom.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("compare", **{"spark.master": "local[8]", "spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    sqls = entry.oracle_sql()
    failed = 0
    for name, run in entry.queries().items():
        if sys.argv[2:] and not any(name.startswith(p) for p in sys.argv[2:]):
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            if name in sqls:
                problem = compare(df, con, sqls[name])
                note = "ok"
            else:
                problem, note = "", f"rows only: {df.count()}"
        except Exception as error:  # noqa: BLE001
            problem, note = f"{type(error).__name__}: {str(error)[:600]}", ""
        failed += bool(problem)
        print(f"{name:40s} {time.time() - start:6.1f}s {'FAIL ' + problem if problem else note}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main())
