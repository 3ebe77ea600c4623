"""Each text query that SQL can express equals its SQL twin, row for row."""

import compare
import duckdb
import pytest
from conftest import SMALL

from tallywright.llm.oracle import ORACLES
from tallywright.llm.queries import QUERIES


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "labels", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SMALL}/{table}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(name, spark, con):
    df = QUERIES[name](spark, SMALL)
    got = compare._rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(ORACLES[name])
    assert got == compare._rows([d[0] for d in cursor.description], cursor.fetchall())


def test_every_operator_has_a_query():
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, 14))
