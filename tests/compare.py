"""Run named queries in Spark and in DuckDB and compare all rows."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tallywright.catalog.oracle import ORACLES  # noqa: E402
from tallywright.catalog.queries import QUERIES, run  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events".split()


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return con


def _plain(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def spark_result(name, spark, folder):
    df = run(name, spark, folder)
    return _rows(df.columns, [tuple(r) for r in df.collect()])


def oracle_result(name, con):
    cursor = con.execute(ORACLES[name])
    return _rows([d[0] for d in cursor.description], cursor.fetchall())


def difference(name, spark, con, folder) -> str | None:
    columns, got = spark_result(name, spark, folder)
    wanted_columns, wanted = oracle_result(name, con)
    if columns != wanted_columns:
        return f"columns {set(columns) ^ set(wanted_columns)}"
    if len(got) != len(wanted):
        return f"rows {len(got)} != {len(wanted)}"
    for a, b in zip(got, wanted):
        for column, x, y in zip(columns, a, b):
            if x != y or type(x) is not type(y):
                return f"{column}: {x!r} != {y!r}"
    return None


if __name__ == "__main__":
    from tallywright.session import local_session

    folder = f"/root/testdata/{sys.argv[1]}"
    names = sys.argv[2:] or list(QUERIES)
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name in names:
        started = time.time()
        try:
            if name not in ORACLES:
                columns, rows = spark_result(name, spark, folder)
                print(f"{name:36s} no oracle, {len(rows)} rows {time.time() - started:.2f}s", flush=True)
                continue
            problem = difference(name, spark, con, folder)
        except Exception as error:  # keep going, report at the end
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{name:36s} {problem or 'ok'} {time.time() - started:.2f}s", flush=True)
    print(f"{bad} of {len(names)} differ")
