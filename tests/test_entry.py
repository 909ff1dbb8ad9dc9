"""The driver contract: names, schemas, and every SQL against its query at the smallest scale."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    return float(f"{v:.9g}") if isinstance(v, float) else v


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_sql_agrees(spark, con, sf, name):
    assert os.path.isdir(sf)
    df = entry.queries()[name](spark, sf)
    r = con.execute(entry.oracle_sql()[name])
    names = [x[0] for x in r.description]
    assert sorted(names) == sorted(df.columns)
    cols = sorted(names)
    got = sorted((tuple(plain(row[c]) for c in cols) for row in df.collect()), key=repr)
    want = sorted((tuple(plain(row[names.index(c)]) for c in cols) for row in r.fetchall()), key=repr)
    assert got == want
