"""Every registered query against its SQL twin on the smallest given tables."""

from __future__ import annotations

import os

import pandas as pd
import pytest

import __spark_entry__ as entry
from harness.queries import QUERIES
from tools.trial import TABLES, canonical

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="given tables are not here")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def test_every_query_has_a_twin():
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    got = pd.DataFrame([tuple(r) for r in df.collect()], columns=df.columns, dtype=object)
    cursor = duck.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    want = pd.DataFrame(cursor.fetchall(), columns=columns, dtype=object)
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)


def test_entry(spark):
    assert entry.entry(spark).columns == ["bucket", "equipment_type", "total_power"]
