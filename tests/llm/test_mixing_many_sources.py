"""Default targets of many sources."""

import math

import duckdb
import pytest

from lamina.llm import mixing


@pytest.mark.parametrize("hot, others", [(500, 1000), (100, 200)])
def test_hot_source_keeps_its_share(hot, others):
    counts = {"hot": hot} | {f"s{i}": 1 for i in range(others)}
    weights = mixing.tempered(counts)
    target = math.sqrt(hot) / (math.sqrt(hot) + others)
    assert abs(weights["hot"] / sum(weights.values()) - target) < 0.01 * target


def test_every_target_is_met():
    counts = {None: 3} | {f"s{i}": 1 + i * i for i in range(150)} | {"huge": 10**9}
    weights = mixing.tempered(counts)
    whole, total = sum(math.sqrt(n) for n in counts.values()), sum(weights.values())
    assert abs(total - 100 * len(counts)) <= len(counts) and min(weights.values()) >= 1
    assert sum(abs(w / total - math.sqrt(counts[s]) / whole) for s, w in weights.items()) < 0.03
    assert mixing.tempered({"a": 4, "b": 1}) == {"a": 133, "b": 67}


def test_mix_of_many_sources(spark):
    rows = [(i, f"s{i % 200}") for i in range(400)] + [(1000 + i, "hot") for i in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, source string")
    got = mixing.mix(docs, block_docs=1).collect()
    on = [r for r in got if r["on_target"]]
    assert len(got) == len(rows) and len({r["slot"] for r in got}) == len(rows)
    target = math.sqrt(800) / (math.sqrt(800) + 200 * math.sqrt(2))
    hot = sum(r["source"] == "hot" for r in on)
    assert len(on) > 50 and abs(hot - target * len(on)) <= 2


def test_sql_gives_the_schedule_of_many_sources(spark):
    """One rule for the targets at any number of sources, here with some due far under one part in a hundred."""
    rows = [(i, f"s{i % 60}") for i in range(1200)] + [(5000 + i, "hot") for i in range(1500)] + [(9000, "tiny"), (9001, None)]
    docs = spark.createDataFrame(rows, "doc_id long, source string")
    got = {tuple(r) for r in mixing.mix(docs, block_docs=4).collect()}
    con = duckdb.connect()
    con.register("docs", docs.toPandas())
    want = set(con.execute(mixing.mix_sql("docs", block_docs=4)).fetchall())
    assert got == want and len(got) == len(rows)
