"""Queries of the subpackage against their SQL, on the smallest tables."""

from __future__ import annotations

import glob
import os
from collections import Counter

import pytest

from contactmine.llm.queries import ORACLES, QUERIES

duckdb = pytest.importorskip("duckdb")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = Counter(repr([row[c] for c in columns]) for row in df.collect())
    with duckdb.connect() as connection:
        for path in glob.glob(f"{sf_dir}/*.parquet"):
            table = os.path.basename(path).removesuffix(".parquet")
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
        cursor = connection.execute(ORACLES[name])
        names = [d[0] for d in cursor.description]
        assert sorted(names) == columns
        want = Counter(repr([r[names.index(c)] for c in columns]) for r in cursor.fetchall())
    assert got == want
