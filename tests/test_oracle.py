"""Every registered query against its SQL oracle, value by value."""

import math
import re

import duckdb
import pytest

import __spark_entry__ as entry_module

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


# The queries over corpora have tests of their own.
NAMES = sorted(n for n in entry_module.queries() if n != "pipeline" and not re.match(r"op\d+_", n))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    yield con
    con.close()


def _canonical(rows, columns, order):
    places = [columns.index(c) for c in order]
    clean = [
        tuple(None if isinstance(r[i], float) and math.isnan(r[i]) else r[i] for i in places) for r in rows
    ]
    return sorted(clean, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", NAMES)
def test_query(name, spark, duck):
    df = entry_module.queries()[name](spark, SF_DIR)
    order = sorted(df.columns)
    actual = _canonical([tuple(r) for r in df.collect()], df.columns, order)
    assert actual
    sql = entry_module.oracle_sql().get(name)
    if sql is None:
        return
    cursor = duck.execute(sql)
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == order
    assert actual == _canonical(cursor.fetchall(), columns, order)


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(entry_module.oracle_sql())


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
