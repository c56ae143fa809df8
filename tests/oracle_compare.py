"""Compare registered queries with their DuckDB twins: ``python tests/oracle_compare.py DIR [names]``."""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

import __spark_entry__ as E  # noqa: E402

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _plain(value):
    if value is None:
        return "\0"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, decimal.Decimal)):
        return str(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, datetime.date):
        return value.isoformat()
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, folder: str, name: str) -> str:
    """'' when both engines agree, else what differs."""
    df = E.queries()[name](spark, folder)
    got = rows_of(df.columns, df.collect())
    sql = E.oracle_sql().get(name)
    if sql is None:
        return "" if got[1] else "no rows"
    cur = con.execute(sql)
    kinds = {d[0]: str(d[1]) for d in cur.description}
    want = rows_of([d[0] for d in cur.description], cur.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    same = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
            "date": "DATE", "boolean": "BOOLEAN"}
    for column, kind in df.dtypes:
        if same.get(kind, kind) != kinds[column]:
            return f"type of {column}: {kind} != {kinds[column]}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} != {len(want[1])}"
    bad = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
    if bad:
        return f"{len(bad)} of {len(want[1])} rows differ, e.g. {bad[0]}"
    return "" if want[1] else "both empty"


if __name__ == "__main__":
    from salesmart.session import build_session

    where = sys.argv[1]
    session = build_session(
        "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                       "spark.driver.memory": "8g"}
    )
    session.sparkContext.setLogLevel("ERROR")
    duck = connect(where)
    failed = 0
    for key in sys.argv[2:] or E.queries():
        start = time.time()
        try:
            problem = compare(session, duck, where, key)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {key} {time.time() - start:.1f}s {problem}", flush=True)
    print("registered", len(E.queries()), "failed", failed)
