"""Run registered queries next to their SQL oracles and compare the values."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    """Rows with columns sorted by name, in a total order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


SAME_TYPE = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


def compare(spark, con, sf_dir: str, query, sql: str) -> str | None:
    """None if schema and values agree, else what differs."""
    got = query(spark, sf_dir)
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    want = cursor.fetchall()
    if sorted(names) != sorted(got.columns):
        return f"columns {sorted(got.columns)} != {sorted(names)}"
    for name, sql_type in got.dtypes:
        if SAME_TYPE[sql_type] != types[name]:
            return f"type of {name}: {sql_type} != {types[name]}"
    left = rows_of(got.columns, [tuple(row) for row in got.collect()])
    right = rows_of(names, want)
    if len(left) != len(right):
        return f"{len(left)} rows != {len(right)}"
    for a, b in zip(left, right, strict=True):
        if a != b:
            return f"{sorted(names)}\n  spark  {str(a)[:1500]}\n  oracle {str(b)[:1500]}"
    if not left:
        return "no rows"
    return None


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from snapfold.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark = local_session()
    con = connect(sf_dir)
    for name, query in queries().items():
        if chosen and name not in chosen:
            continue
        started = time.time()
        try:
            verdict = compare(spark, con, sf_dir, query, oracle_sql()[name]) or "ok"
        except Exception as error:
            verdict = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{name:28s} {time.time() - started:6.2f}s  {verdict}", flush=True)
