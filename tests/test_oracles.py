"""Every registered query against its SQL, run by DuckDB on the same files."""

from __future__ import annotations

import datetime
import math
import os

import duckdb
import pytest

from __spark_entry__ import entry
from framestore.plans import ORACLES, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{os.path.join(sf_dir, name)}.parquet'")
    yield con
    con.close()


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def as_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    rows = df.collect()
    sql = ORACLES.get(name)
    assert sql is not None
    result = duck.execute(sql)
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    expected = result.fetchall()
    assert expected, "a check on no rows checks nothing"
    assert len(rows) == len(expected)
    assert as_rows(df.columns, rows) == as_rows(columns, expected)


def test_entry(spark):
    assert entry(spark).count() > 0
