"""Runs registered queries and their SQL side by side: ``python tests/oracle.py [folder] [name ...]``."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]
# Spark type name -> the other engine's.
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9) + 0.0)
    if isinstance(value, decimal.Decimal):
        return str(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(normal(row[i]) for i in order) for row in rows)


def compare(df, con, sql: str) -> str | None:
    """None if both agree, else what differs."""
    found = con.execute(sql)
    theirs = {d[0]: str(d[1]) for d in found.description}
    mine = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    if sorted(theirs) != sorted(mine):
        return f"columns {sorted(mine)} vs {sorted(theirs)}"
    for name, kind in mine.items():
        expected = TYPES.get(kind, kind.upper())
        if expected != theirs[name]:
            return f"type of {name}: {kind} vs {theirs[name]}"
    expected_rows = rows_of([d[0] for d in found.description], found.fetchall())
    actual_rows = rows_of(df.columns, df.collect())
    if len(actual_rows) != len(expected_rows):
        return f"{len(actual_rows)} rows vs {len(expected_rows)}"
    for a, b in zip(actual_rows, expected_rows):
        if a != b:
            return f"row {a} vs {b}"
    return None


def main() -> int:
    from orderloom.catalog import QUERIES, SQL
    from orderloom.session import local_session

    arguments = sys.argv[1:]
    folder = arguments.pop(0) if arguments and "/" in arguments[0] else "/root/testdata/sf0.01"
    names = arguments or list(QUERIES)
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name in names:
        began = time.time()
        try:
            df = QUERIES[name](spark, folder)
            problem = compare(df, con, SQL[name]) if name in SQL else (None if df.count() >= 0 else "")
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'BAD '} {name} {time.time() - began:.2f}s {problem or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
