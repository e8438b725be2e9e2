"""Key buckets: current rows, untouched files, writers side by side, erasure."""

import os
from concurrent.futures import ThreadPoolExecutor

import pytest

from lamina.sources.keyed import KeyedTable

SCHEMA = "id long, day int, v string"


def _files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(f"{path}/data") for f in names if f.endswith(".parquet")}


def _rows(table):
    return sorted((r["id"], r["day"], r["v"]) for r in table.read().collect())


def test_loads_rewrite_only_their_buckets(spark, folder):
    table = KeyedTable(spark, f"{folder}/t", ["id"], ["day"], buckets=8)
    table.upsert(spark.createDataFrame([(i, 1, "a") for i in range(200)], SCHEMA))
    first = _files(f"{folder}/t")
    state = table.upsert(spark.createDataFrame([(7, 2, "b"), (7, 3, "c"), (9, 0, "old"), (500, 1, "new")], SCHEMA))
    assert first <= _files(f"{folder}/t")  # nothing is changed in place
    want = {i: (1, "a") for i in range(200)} | {7: (3, "c"), 500: (1, "new")}
    assert _rows(table) == sorted((i, *x) for i, x in want.items())
    assert len(set(state.folders.values())) == 2 and state.version == 2
    plan = table.read()._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange" not in plan
    assert table.vacuum() > 0 and _rows(table) == sorted((i, *x) for i, x in want.items())


def test_equal_order_goes_to_the_later_load_and_columns_may_come_in(spark, folder):
    table = KeyedTable(spark, f"{folder}/t", ["id"], ["day"], buckets=2)
    table.upsert(spark.createDataFrame([(1, 1, "z"), (None, 1, "null key")], SCHEMA))
    table.upsert(spark.createDataFrame([(1, 1, "a", 5)], SCHEMA + ", extra int"))
    got = {r["id"]: (r["v"], r["extra"]) for r in table.read().collect()}
    assert got == {1: ("a", 5), None: ("null key", None)}
    table.upsert(spark.createDataFrame([], SCHEMA))
    assert table.read().count() == 2


def test_two_writers_lose_nothing(spark, folder):
    loads = [spark.createDataFrame([(i, n, str(n)) for i in range(n * 10, n * 10 + 20)], SCHEMA) for n in range(5)]
    make = lambda df: KeyedTable(spark, f"{folder}/t", ["id"], ["day"], buckets=4).upsert(df)
    with ThreadPoolExecutor(5) as pool:
        versions = sorted(s.version for s in pool.map(make, loads))
    assert versions == [1, 2, 3, 4, 5]
    want = {i: n for n in range(5) for i in range(n * 10, n * 10 + 20)}
    assert _rows(KeyedTable(spark, f"{folder}/t", ["id"], ["day"], buckets=4)) == [(i, n, str(n)) for i, n in sorted(want.items())]


def test_an_entry_half_written_does_not_count(spark, folder):
    table = KeyedTable(spark, f"{folder}/t", ["id"], ["day"])
    table.upsert(spark.createDataFrame([(1, 1, "a")], SCHEMA))
    with open(f"{folder}/t/_log/000000000009.json", "w") as out:
        out.write('{"version": 9, "fold')
    assert table.state().version == 1 and table.read().count() == 1


def test_erasure_leaves_no_file_with_the_rows(spark, folder):
    table = KeyedTable(spark, f"{folder}/t", ["id"], ["day"], buckets=8)
    table.upsert(spark.createDataFrame([(i, 1, "a") for i in range(100)], SCHEMA))
    before = _files(f"{folder}/t")
    state = table.erase(spark.createDataFrame([(3,), (3,), (4000,), (None,)], "id long"))
    assert sum(state.erased.values()) == 1 and len(state.erased) == 1
    assert _rows(table) == [(i, 1, "a") for i in range(100) if i != 3]
    assert len(before - _files(f"{folder}/t")) >= 1 and len(before & _files(f"{folder}/t")) >= 7
    left = spark.read.parquet(*_files(f"{folder}/t"))
    assert left.filter("id = 3").count() == 0
    assert table.erase(spark.createDataFrame([(4000,)], "id long")).version == state.version


def test_empty_table(spark, folder):
    table = KeyedTable(spark, f"{folder}/t", ["id"])
    assert table.read().count() == 0 and table.vacuum() == 0
    with pytest.raises(Exception):
        table.read().select("id")
