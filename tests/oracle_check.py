"""Run registered queries and their SQL side by side and compare the rows."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name, query, sql, sf_dir) -> str | None:
    """None when both give the same columns, types and rows, else what differs."""
    df = query(spark, sf_dir)
    columns, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    expected_columns, expected = _rows(names, cursor.fetchall())
    if columns != expected_columns:
        return f"columns {columns} != {expected_columns}"
    pairs = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
    wrong = [f"{c}: {t} vs {types[c]}" for c, t in df.dtypes if pairs.get(t, t) != types[c]]
    if wrong:
        return f"types {wrong}"
    if got != expected:
        missing, extra = [r for r in expected if r not in set(got)][:3], [r for r in got if r not in set(expected)][:3]
        return f"{len(got)} rows vs {len(expected)}; missing {missing}; extra {extra}"
    return None


def main() -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__ as entry
    from tests.conftest import make_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark, con, sql = make_session(), connect(sf_dir), entry.oracle_sql()
    failed = 0
    for name, query in entry.queries().items():
        if only and name not in only:
            continue
        began = time.monotonic()
        try:
            problem = compare(spark, con, name, query, sql[name], sf_dir) if name in sql else "no oracle"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.monotonic() - began:.2f}s {problem or ''}", flush=True)
    return failed


if __name__ == "__main__":
    raise SystemExit(main())
