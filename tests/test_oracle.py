"""Every registered query against its SQL equivalent on the supplied tables."""

import math
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def _canonical(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_canonical(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, oracle, name):
    df = queries()[name](spark, SF)
    got = _rows(df.columns, df.collect())
    if name not in oracle_sql():
        assert got
        return
    answer = oracle.execute(oracle_sql()[name])
    names = [d[0] for d in answer.description]
    want = _rows(names, answer.fetchall())
    assert sorted(df.columns) == sorted(names)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a == b


def test_entry(spark):
    assert entry(spark).count() > 0
