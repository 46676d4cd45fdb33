"""Compare registered queries with their SQL on the given tables.

    python tests/oracle.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from datetime import date, datetime
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def canonical(value):
    if value is None:
        return "~"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return "~" if math.isnan(value) else repr(value)
    if isinstance(value, Decimal):
        return "D" + str(value)
    if isinstance(value, datetime | date):
        return value.isoformat()
    if isinstance(value, list | tuple):
        return "[" + ",".join(canonical(v) for v in value) + "]"
    return str(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted(tuple(canonical(row[i]) for i in order) for row in rows)


def compare(df, con, sql) -> str | None:
    """None when equal, else a short account of the difference."""
    spark_names, spark_rows = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    duck_names, duck_rows = rows_of([d[0] for d in result.description], result.fetchall())
    if spark_names != duck_names:
        return f"columns {spark_names} != {duck_names}"
    if spark_rows == duck_rows:
        return None if spark_rows else "both sides are empty"
    left, right = set(spark_rows) - set(duck_rows), set(duck_rows) - set(spark_rows)
    return (
        f"{len(spark_rows)} rows vs {len(duck_rows)}, only spark {len(left)} {sorted(left)[:2]}, "
        f"only sql {len(right)} {sorted(right)[:2]} columns {spark_names}"
    )


def main() -> int:
    from tradeloom.session import build_session

    args = sys.argv[1:]
    sf_dir = "/root/testdata/sf0.01"
    if args[:1] == ["--sf"]:
        sf_dir, args = args[1], args[2:]
    import __spark_entry__ as entry

    spark = build_session("oracle", "local[8]", 8, {"spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in args or queries:
        start = time.time()
        try:
            if name in oracle:
                problem = compare(queries[name](spark, sf_dir), con, oracle[name])
            else:
                problem = None if queries[name](spark, sf_dir).count() else "no rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:900]}"
        bad += problem is not None
        mark = "ok  " if problem is None else "FAIL"
        print(f"{mark} {name} {time.time() - start:.1f}s {'' if name in oracle else '(rows only)'} {problem or ''}", flush=True)
    print(f"{bad} problems", flush=True)
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
