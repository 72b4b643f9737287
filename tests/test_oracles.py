"""Every named query against its SQL oracle on the smallest test directory."""

import duckdb
import pytest

import __spark_entry__ as contract
from conftest import SMALL
from wardlight.plans.catalog import BATCH, STREAMS

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages"
          " benchmark labels conversations").split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
         "boolean": "BOOLEAN", "date": "DATE"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return con


@pytest.mark.parametrize("key", sorted(contract.oracle_sql()))
def test_query_equals_oracle(spark, duck, key):
    frame = contract.queries()[key](spark, SMALL)
    columns = sorted(frame.columns)
    ours = sorted(repr(tuple(row[c] for c in columns)) for row in frame.collect())
    cursor = duck.execute(contract.oracle_sql()[key])
    types = {d[0]: str(d[1]) for d in cursor.description}
    places = [[d[0] for d in cursor.description].index(c) for c in columns]
    theirs = sorted(repr(tuple(row[i] for i in places)) for row in cursor.fetchall())
    assert columns == sorted(types)
    assert {c: TYPES[frame.schema[c].dataType.simpleString()] for c in columns} == types
    assert ours == theirs


def test_every_clinical_query_has_an_oracle():
    assert set(BATCH) | set(STREAMS) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() == 2
