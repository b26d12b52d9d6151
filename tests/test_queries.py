"""Every registered query against its SQL, row by row, types included."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as registry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
         "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}
ORDERED = {"actions_by_type", "actions_by_hour", "user_history", "user_item_history",
           "user_activity", "similar_items"}
MAY_BE_EMPTY: set[str] = set()


@pytest.fixture(scope="module")
def duck():
    from tests.conftest import SF

    con = duckdb.connect()
    for name in TABLES:
        path = Path(SF) / f"{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def test_every_query_has_sql():
    without = set(registry.queries()) - set(registry.oracle_sql())
    assert set(registry.oracle_sql()) <= set(registry.queries())
    assert all(name == "pipeline" or name.startswith("op") for name in without)


# those of the training-data operators are compared by the tests of that folder, on smaller tables
@pytest.mark.parametrize("name", sorted(set(registry.oracle_sql()) - set(registry.LLM_SQL)))
def test_query(name, spark, sf, duck):
    ours = registry.queries()[name](spark, sf)
    theirs = duck.sql(registry.oracle_sql()[name])
    assert {c: TYPES[t] for c, t in ours.dtypes} == dict(
        zip(theirs.columns, map(str, theirs.types))
    )
    columns = sorted(ours.columns)
    got = [tuple(row[c] for c in columns) for row in ours.collect()]
    place = {c: i for i, c in enumerate(theirs.columns)}
    want = [tuple(row[place[c]] for c in columns) for row in theirs.fetchall()]
    if name not in ORDERED:
        got, want = sorted(got, key=repr), sorted(want, key=repr)
    assert got == want
    assert got or name in MAY_BE_EMPTY


def test_entry(spark):
    rows = registry.entry(spark)
    assert rows.columns == ["item_i", "item_j", "score"]
    assert rows.count() == 117
