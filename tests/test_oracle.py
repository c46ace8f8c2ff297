"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import glob
import os
from collections import Counter

import pytest

import __spark_entry__ as entry_point
from catalog.base import ORACLES, QUERIES

duckdb = pytest.importorskip("duckdb")


@pytest.fixture(scope="module")
def checker(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, checker, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = Counter(repr([row[c] for c in columns]) for row in df.collect())
    cursor = checker.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    expected = Counter(repr([row[names.index(c)] for c in columns]) for row in cursor.fetchall())
    assert got == expected


def test_flagship(spark):
    assert entry_point.entry(spark).count() > 0
