"""Queries whose results SQL can state, against that SQL on the smallest tables."""

import duckdb
import pytest

from covisit.llm.queries import ORACLE_SQL, QUERIES

from .tools import SMALL

KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("documents", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query(name, spark, duck):
    ours, theirs = QUERIES[name](spark, SMALL), duck.sql(ORACLE_SQL[name])
    assert {c: KINDS[t] for c, t in ours.dtypes} == dict(zip(theirs.columns, map(str, theirs.types)))
    columns = sorted(ours.columns)
    place = {c: k for k, c in enumerate(theirs.columns)}
    got = sorted((tuple(r[c] for c in columns) for r in ours.collect()), key=repr)
    assert got == sorted((tuple(r[place[c]] for c in columns) for r in theirs.fetchall()), key=repr) and got
