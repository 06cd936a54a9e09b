"""Run queries on Spark and their SQL on DuckDB and compare the rows.

    python -m conformance.compare [--sf DIR] [query ...]
"""

from __future__ import annotations

import argparse
import datetime
import math
import time
from collections import Counter
from decimal import Decimal

import duckdb

from conformance.oracle import all_sql
from conformance.queries import all_queries
from meterline.session import build_session

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def _plain(value):
    if isinstance(value, Decimal):
        return value.normalize() + 0
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


# Spark and DuckDB names of types that mean the same.
_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP"}


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty if both give the same columns and rows."""
    result = con.sql(sql)
    types = dict(zip(result.columns, map(str, result.types), strict=True))
    if sorted(df.columns) != sorted(types):
        return f"columns {sorted(df.columns)} <> {sorted(types)}"
    other = {c: (t, types[c]) for c, t in df.dtypes if _TYPES.get(t, t.upper()) != types[c]}
    ours, theirs = rows_of(df.columns, df.collect()), rows_of(result.columns, result.fetchall())
    if ours != theirs:
        only = list((ours - theirs).items())[:3], list((theirs - ours).items())[:3]
        return f"{ours.total()} rows <> {theirs.total()} rows, e.g. {only[0]} <> {only[1]}; types {other}"
    return f"types {other}" if other else ""


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sql = connect(args.sf), all_sql()
    failed = 0
    for name, query in all_queries().items():
        if args.names and name not in args.names:
            continue
        started = time.monotonic()
        try:
            df = query(spark, args.sf)
            outcome = difference(df, con, sql[name]) if name in sql else f"{df.count()} rows, no SQL"
        except Exception as error:  # noqa: BLE001
            outcome = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(outcome)
        print(f"{time.monotonic() - started:6.1f}s {name}: {outcome or 'ok'}", flush=True)
    print(f"{failed} not ok")


if __name__ == "__main__":
    main()
