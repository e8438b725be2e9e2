import hashlib
import itertools
import random
from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

from lamina.functions import exprs
from lamina.functions.hashing import pseudonym
from lamina.operators import agreement, breakdown, dedup, linkage, masking, retention, skew
from lamina.operators.components import connected_components
from lamina.operators.masking import MaskingRule, apply_masking
from lamina.sources.catalogue import PARTNER_DROP, masking_rule


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---------------------------------------------------------------- masking


def test_hashes(spark):
    df = spark.createDataFrame([("x",), ("",), (None,)], "v string")
    for name in ("sha256", "sha512", "md5"):
        got = [r[0] for r in df.select(pseudonym(F.col("v"), name)).collect()]
        assert got == [hashlib.new(name, b"x").hexdigest(), hashlib.new(name, b"").hexdigest(), None]
    empty = [r[0] for r in df.select(pseudonym(F.col("v"), empty_as_null=True)).collect()]
    assert empty == [hashlib.sha256(b"x").hexdigest(), None, None]
    with pytest.raises(ValueError, match="Unsupported hashing algorithm"):
        pseudonym(F.col("v"), "crc32")
    number = spark.createDataFrame([(7,)], "v int").select(pseudonym(F.col("v"))).first()[0]
    assert number == hashlib.sha256(b"7").hexdigest()


def test_masking_precedence_and_order(spark):
    df = spark.createDataFrame([(1, "b", "c", "d")], "a int, b string, c string, d string")
    rule = MaskingRule.of(drop=["b"], hash=["b", "c"], keep=["a", "b", "c"])
    assert apply_masking(df, rule).columns == ["a", "c_Hash"]
    assert apply_masking(df, MaskingRule.of(hash=["c"])).columns == ["a", "b", "c_Hash", "d"]
    assert apply_masking(df, MaskingRule.of(keep_all=True, drop=["a"])).columns == df.columns
    assert apply_masking(df, None).columns == df.columns
    with pytest.raises(ValueError, match="No columns"):
        apply_masking(df, MaskingRule.of(keep=["zz"]))
    config = {"exclude_columns": ["a"], "pseudonymize": ["b"], "retain": ["d"], "hash_algorithm": "md5"}
    assert apply_masking(df, MaskingRule.from_config(config)).columns == ["b_Hash", "d"]


def test_masked_partners_hold_no_personal_columns(spark):
    names = [*PARTNER_DROP, "CardName", "CardCode", "Balance"]
    df = spark.createDataFrame([tuple("x" for _ in names)], ", ".join(f"{n} string" for n in names))
    masked = apply_masking(df, masking_rule("ocrd"))
    assert masked.columns == ["CardName_Hash", "CardCode", "Balance"]
    assert masking.present_columns(masked, [*PARTNER_DROP, "CardName"]) == []
    assert masking.present_columns(df, ["Fax", "CardName"]) == ["Fax", "CardName"]
    catalogue = masking.column_catalogue(masked)
    assert [r["column_name"] for r in catalogue.orderBy("position").collect()] == masked.columns


# ---------------------------------------------------------------- expressions


def test_expressions(spark):
    df = spark.createDataFrame(
        [(None, 5, None, None), (-5, 0, date(2024, 1, 1), date(2024, 1, 3)), (120, 10, None, date(2024, 1, 1))],
        "c int, d int, a date, b date",
    )
    got = df.select(
        exprs.clamp_percent(F.col("c")).cast("double"),
        exprs.share_percent(F.col("c"), F.col("d")),
        exprs.days_between(F.col("a"), F.col("b")),
        exprs.in_order(F.col("a"), F.col("b")),
        exprs.none_of(F.col("c"), [120]),
        exprs.between_open(F.col("c"), 0, 200),
        exprs.label(F.col("c") == 120, "yes", "no"),
    ).collect()
    assert [tuple(r) for r in got] == [
        (0.0, None, None, True, False, None, "no"),
        (0.0, 0.0, 2, True, True, False, "no"),
        (100.0, 1200.0, None, True, False, True, "yes"),
    ]


# ---------------------------------------------------------------- dedup


def test_keep_latest_nulls_ties_and_null_keys(spark):
    rows = [("a", None, 1), ("a", date(2024, 1, 1), 2), ("a", date(2024, 1, 1), 3), (None, None, 4), (None, None, 5), ("A", None, 6)]
    df = spark.createDataFrame(rows, "k string, d date, v int")
    want = [("A", 6), ("a", 2), (None, 4)]
    for n in (1, 7):
        got = dedup.keep_latest(df.repartition(n), ["k"], ["d"]).select("k", "v")
        assert rows_of(got) == sorted(want, key=str)


def test_keep_latest_limits_before_the_shuffle(spark, folder):
    spark.range(100).withColumn("k", F.col("id") % 3).write.parquet(f"{folder}/t")
    plan = plan_of(dedup.keep_latest(spark.read.parquet(f"{folder}/t"), ["k"], ["id"]))
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_keep_latest_with_nested_columns(spark):
    df = spark.sql("SELECT 1 AS k, map('a', 2) AS m, array(1) AS l UNION ALL SELECT 1, map('a', 1), array(2)")
    assert dedup.keep_latest(df, ["k"]).first()["m"] == {"a": 1}


def test_upsert_is_idempotent(spark):
    current = spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], "k int, t int, v string")
    delta = spark.createDataFrame([(2, 2, "B"), (3, 1, "c"), (1, 0, "late")], "k int, t int, v string")
    once = dedup.upsert(current, delta, ["k"], ["t"])
    twice = dedup.upsert(once, delta, ["k"], ["t"])
    assert rows_of(once) == rows_of(twice) == [(1, 1, "a"), (2, 2, "B"), (3, 1, "c")]


# ---------------------------------------------------------------- joins under skew


def skewed(spark):
    """A third of the rows under one key, a tenth without a key, copies of whole rows."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 10 == 1, None).otherwise(
        (F.col("id") % 50).cast("string")
    )
    return spark.range(6000).select(key.alias("k"), (F.col("id") % 7).alias("v"))


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_equals_plain_join(spark, how):
    left = skewed(spark)
    right = spark.createDataFrame(
        [("hot", 1), ("hot", 2), *[(str(i), i) for i in range(30)], (None, 9)], "k string, w int"
    )
    want = Counter(tuple(r) for r in left.join(right, "k", how).collect())
    for rows in (100, 1_000_000):
        got = skew.salted_join(left, right, ["k"], how, rows_per_task=rows)
        assert Counter(tuple(r) for r in got.collect()) == want
    wider = skew.safe_join(left, right, ["k"], how, limit=0)
    assert Counter(tuple(r) for r in wider.collect()) == want
    assert "__salt" in plan_of(wider)
    small = spark.range(30).select(F.col("id").cast("string").alias("k"), "id")
    assert "__salt" not in plan_of(skew.safe_join(left, small, ["k"], how))
    with pytest.raises(ValueError):
        skew.salted_join(left, right, ["k"], "full")


def test_hot_keys_get_salts_by_their_size(spark):
    found = {r[0]: r[1] for r in skew.hot_keys(skewed(spark), ["k"], 500).collect()}
    assert found == {spark.sql("SELECT xxhash64('hot')").first()[0]: 4}  # 2000 rows
    many = spark.range(4000).select((F.col("id") % 40).alias("k"))
    assert skew.hot_keys(many, ["k"], 99).count() == 40  # every key over the limit, however many
    assert skew.hot_keys(skewed(spark), ["k"]).count() == 0


def test_a_hot_key_is_spread_over_tasks(spark):
    left, right = skewed(spark), spark.createDataFrame([("hot", 1)], "k string, w int")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = skew.salted_join(left, right, ["k"], "left", rows_per_task=100)
        shares = joined.groupBy(F.spark_partition_id().alias("p"), "k").count().filter("k = 'hot' or k is null")
        rows = shares.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(r["count"] for r in rows) < 1000 and len({r["p"] for r in rows}) == 8


# ---------------------------------------------------------------- breakdown, retention


def test_json_breakdown_has_one_row_per_item(spark):
    rows = [("g", f"i{n % 40}", 1.25) for n in range(400)] + [("h", None, 2.0), (None, "x", 1.0)]
    df = spark.createDataFrame(rows, "k string, item string, v double").withColumn("v", F.col("v").cast("decimal(10,4)"))
    got = {(r["k"], r["item"]): r["breakdown"] for r in breakdown.json_breakdown(df, ["k"], "item", "v").collect()}
    assert len(got) == 42 and got["g", "i7"] == '{"i7":12.5000}' and got["h", ""] == '{"":2.0000}'


def test_money_keeps_its_scale(spark):
    df = spark.sql("SELECT CAST(0.004 AS DECIMAL(18,6)) AS a, 0.1D AS b, 7 AS c, CAST(1e17 AS DECIMAL(28,6)) AS d FROM range(1000)")
    got = df.agg(*[F.sum(exprs.money(df, c)).cast("string").alias(c) for c in "abcd"]).first()
    assert got["a"] == "4.000000" and got["b"] == "100.00000000" and got["c"] == "7000" and got["d"].startswith("1" + "0" * 20)
    clamped = df.select(exprs.clamp_percent(F.col("a"))).first()[0]
    assert str(clamped) == "0.004000"


def test_retention_partitions_rows(spark):
    rows = [(1, "to_delete", date(2024, 1, 1)), (2, "to_delete", None), (3, None, date(2020, 1, 1)), (4, "active", date(2020, 1, 1))]
    df = spark.createDataFrame(rows, "id int, retention_category string, gdpr_delete_after date")
    due = retention.erasure_due(df, as_of=date(2024, 6, 1))
    kept = retention.without_erased(df, as_of=date(2024, 6, 1))
    assert [r["id"] for r in due.collect()] == [1]
    assert sorted(r["id"] for r in kept.collect()) == [2, 3, 4]
    aged = spark.createDataFrame([(date(2017, 1, 1),), (date(2024, 1, 1),)], "d date")
    assert retention.within_days(aged, "d", 2555, date(2024, 6, 1)).count() == 1
    assert retention.retained(aged, "d", as_of=date(2024, 6, 1)).count() == 1


# ---------------------------------------------------------------- components and linkage


def components_by_hand(nodes, edges):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        ra, rb = root(a), root(b)
        parent[max(ra, rb)] = min(ra, rb)
    return {n: root(n) for n in nodes}


@pytest.mark.parametrize("limit", ["10MB", "-1"])
def test_components(spark, limit):
    rnd = random.Random(3)
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 1299)]
    rest = [(rnd.randrange(6000, 6200), rnd.randrange(6000, 6200)) for _ in range(120)]
    edges = [(a, b) for a, b in chain + star + rest if a != b]
    nodes = sorted({n for e in edges for n in e})
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        df = spark.createDataFrame(edges, "a long, b long")
        got = {r["node"]: r["component"] for r in connected_components(df, "a", "b").collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == components_by_hand(nodes, edges)


def people(n=220, seed=5):
    """Records with copies, typing errors, unknown values and one block holding most of them."""
    rnd = random.Random(seed)
    names = ["anna", "bernd", "carla", "dieter", "emil", "x", ""]
    rows = []
    for i in range(n):
        name = rnd.choice(names)
        if name and rnd.random() < 0.3:
            at = rnd.randrange(len(name))
            name = name[:at] + rnd.choice(["", "q", name[at] + "z"]) + name[at + 1 :]
        block = "big" if rnd.random() < 0.7 else rnd.choice(["s1", "s2", None])
        rows.append(
            (i, block, None if rnd.random() < 0.1 else name, rnd.choice(["p", "q", None]),
             None if rnd.random() < 0.1 else round(rnd.uniform(0, 40) * 2) / 2,
             None if rnd.random() < 0.1 else round(rnd.uniform(-6, 6) * 4) / 4)
        )
    return rows


SETTINGS = {
    "edit": [
        linkage.Comparison("name", "edit", 1), linkage.Comparison("city"), linkage.Comparison("age", "near", 1.0),
    ],
    "edit2": [linkage.Comparison("name", "edit", 2), linkage.Comparison("city")],
    "near only": [linkage.Comparison("age", "near", 1.5), linkage.Comparison("city")],
    "two close": [linkage.Comparison("name", "edit", 1, {2: 0.5, 1: 0.48, 0: 0.02}, {2: 0.02, 1: 0.03, 0: 0.95}),
                  linkage.Comparison("age", "near", 1.0, {2: 0.5, 1: 0.48, 0: 0.02}, {2: 0.02, 1: 0.05, 0: 0.93})],
    "two near": [linkage.Comparison("age", "near", 2.0, {2: 0.5, 1: 0.48, 0: 0.02}, {2: 0.02, 1: 0.05, 0: 0.93}),
                 linkage.Comparison("height", "near", 1.5, {2: 0.5, 1: 0.48, 0: 0.02}, {2: 0.02, 1: 0.05, 0: 0.93})],
}


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        previous, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            previous, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, previous + (x != y))
    return row[-1]


def pair_weight(settings, columns, a, b):
    total = settings.prior_weight
    for c in settings.comparisons:
        x, y = a[columns.index(c.column)], b[columns.index(c.column)]
        if x is None or y is None:
            level = -1
        elif x == y:
            level = 2
        elif c.kind == "edit" and levenshtein(x, y) <= c.limit:
            level = 1
        elif c.kind == "near" and abs(x - y) <= c.limit:
            level = 1
        else:
            level = 0
        total += c.weight(level)
    return total


@pytest.mark.parametrize("kind", sorted(SETTINGS))
@pytest.mark.parametrize("low", [0.05, 0.5, 0.95])
def test_links_connect_what_all_pairs_would(spark, kind, low):
    columns = ["id", "block", "name", "city", "age", "height"]
    rows = people()
    try:
        settings = linkage.LinkageSettings("id", [["block"]], SETTINGS[kind], 0.02, low)
        linkage.minimal_patterns(settings)
    except ValueError:
        pytest.skip("threshold accepts everything")
    matched = [
        (a[0], b[0]) for a, b in itertools.combinations(rows, 2)
        if a[1] is not None and a[1] == b[1] and pair_weight(settings, columns, a, b) >= settings.min_weight
    ]
    df = spark.createDataFrame(rows, "id long, block string, name string, city string, age double, height double")
    links = linkage.candidate_links(df, settings).collect()
    pairs = [tuple(r) for r in links]
    assert len(pairs) == len(set(pairs)) and all(a < b for a, b in pairs)
    assert set(pairs) <= set(matched)  # every link is a match
    want = components_by_hand(range(len(rows)), matched)
    assert components_by_hand(range(len(rows)), pairs) == want
    if kind == "edit" and low == 0.5:
        clustered = linkage.cluster(df, linkage.candidate_links(df, settings), "id").collect()
        assert {r["id"]: r["cluster_id"] for r in clustered} == want


def test_links_stay_linear_in_a_hot_group(spark):
    settings = linkage.LinkageSettings("id", [["block"]], SETTINGS["edit"], 0.02, 0.5)
    rows = [(i, "b", "same", "p", 3.0) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, block string, name string, city string, age double")
    assert linkage.candidate_links(df, settings).count() == 499


@pytest.mark.parametrize("kind", ["two near", "two close"])
def test_links_stay_linear_with_two_close_columns(spark, kind):
    settings = linkage.LinkageSettings("id", [["block"]], SETTINGS[kind], 0.02, 0.5)
    n = 600
    rows = [(i, "b", "same", "p", (i % 40) / 40, (i % 31) / 31) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, block string, name string, city string, age double, height double")
    links = [tuple(r) for r in linkage.candidate_links(df, settings).collect()]
    assert len(links) < 8 * n
    assert set(components_by_hand(range(n), links).values()) == {0}


def test_several_rules_and_survivors(spark):
    settings = linkage.LinkageSettings(
        "id", [["block"], ["city"]], [linkage.Comparison("name")], 0.2, 0.9
    )
    rows = [(1, "a", "n", "x", 1.0), (2, "a", "n", "y", 2.0), (3, "b", "n", "y", 3.0), (4, "c", "m", "y", 4.0)]
    df = spark.createDataFrame(rows, "id long, block string, name string, city string, age double")
    got = linkage.deduplicate(df, settings, ["age"]).select("id", "cluster_id", "age")
    assert rows_of(got) == [(3, 1, 3.0), (4, 4, 4.0)]


def test_settings_are_checked():
    with pytest.raises(ValueError, match="blocking rule"):
        linkage.LinkageSettings("id", [], [linkage.Comparison("a")])
    with pytest.raises(ValueError, match="kind"):
        linkage.Comparison("a", "sound")
    with pytest.raises(ValueError, match="positive limit"):
        linkage.Comparison("a", "edit")
    with pytest.raises(ValueError, match="grow"):
        linkage.Comparison("a", "exact", 0, {2: 0.1, 0: 0.9}, {2: 0.5, 0: 0.5})
    loose = linkage.LinkageSettings("id", [["b"]], [linkage.Comparison("a")], 0.9, 0.01)
    with pytest.raises(ValueError, match="nothing but the block"):
        linkage.minimal_patterns(loose)


def test_pattern_counts_with_unknown_values(spark):
    rows = [r[:5] for r in people(150, 9)]
    df = spark.createDataFrame(rows, "id long, block string, name string, city string, age double")
    want = Counter()
    for a, b in itertools.combinations(rows, 2):
        if a[1] is not None and a[1] == b[1]:
            want[tuple(-1 if x is None or y is None else 2 if x == y else 0 for x, y in zip(a[2:], b[2:]))] += 1
    got = agreement.pattern_counts(df, ["block"], ["name", "city", "age"])
    assert got == dict(want)


def test_pattern_counts_with_close_values(spark):
    rows = [r[:5] for r in people(150, 9)]
    df = spark.createDataFrame(rows, "id long, block string, name string, city string, age double")

    def edits(a, b):
        before = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            now = [i]
            for j, y in enumerate(b, 1):
                now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (x != y)))
            before = now
        return before[-1]

    def level(x, y, close):
        return -1 if x is None or y is None else 2 if x == y else 1 if close(x, y) else 0

    near = [lambda x, y: edits(x, y) <= 2, lambda x, y: False, lambda x, y: abs(x - y) <= 3]
    inside, every = Counter(), Counter()
    for a, b in itertools.combinations(rows, 2):
        pattern = tuple(level(x, y, c) for x, y, c in zip(a[2:], b[2:], near))
        every.update((j, lv) for j, lv in enumerate(pattern) if lv >= 0)
        if a[1] is not None and a[1] == b[1]:
            inside[pattern] += 1
    columns = [linkage.Comparison("name", "edit", 2), "city", linkage.Comparison("age", "near", 3)]
    assert agreement.pattern_counts(df, ["block"], columns) == dict(inside)
    for j, c in ((0, columns[0]), (1, linkage.Comparison("city")), (2, columns[2])):
        assert {lv: n for lv, n in agreement.level_counts(df, c).items() if n} == {lv: n for (i, lv), n in every.items() if i == j}


def _model_counts(m, u, prior, n=10_000_000):
    counts = {}
    for pattern in itertools.product((2, 0), repeat=3):
        pm, pu = prior, 1 - prior
        for i, lv in enumerate(pattern):
            pm *= m[i] if lv == 2 else 1 - m[i]
            pu *= u[i] if lv == 2 else 1 - u[i]
        counts[pattern] = round(n * (pm + pu))
    return counts


def test_em_recovers_known_probabilities():
    m, u, prior = (0.9, 0.8, 0.95), (0.1, 0.2, 0.05), 0.1
    given = [{2: x, 0: 1 - x} for x in u]
    for tolerance in (1e-6, 1e-9):
        found = agreement.estimate_em(_model_counts(m, u, prior), given, tolerance=tolerance)
        assert found.settled and found.rounds < 200
        assert found.prior == pytest.approx(prior, abs=1e-5)
        assert [x[2] for x in found.m] == pytest.approx(m, abs=1e-4)


def test_em_without_matches_says_so():
    u = (0.1, 0.2, 0.05)
    found = agreement.estimate_em(_model_counts(u, u, 0.5, 100_000), [{2: x, 0: 1 - x} for x in u])
    assert not found.settled and found.prior < 1e-3


def test_estimated_settings_link_what_belongs_together(spark):
    from lamina.plans.star_inputs import shaped

    df = shaped(spark, "/root/testdata/sf0.001", "party")
    comparisons = [linkage.Comparison("name", "edit", 1), linkage.Comparison("segment"), linkage.Comparison("seller")]
    settings = agreement.estimated_settings(df, linkage.LinkageSettings("id", [["nation"]], comparisons, min_probability=0.5))
    links = linkage.candidate_links(df, settings)
    clusters = linkage.cluster(df, links, "id").select("id", "cluster_id").collect()
    whole = Counter(r["cluster_id"] for r in clusters)
    right = Counter((r["cluster_id"], r["id"] // 3) for r in clusters)
    assert 0 < settings.prior < 0.2 and len(whole) < 300
    assert sum(n for (c, _), n in right.items() if n == whole[c]) > 0.6 * len(clusters)


# ---------------------------------------------------------------- ordered rows


@pytest.mark.parametrize("descending", [False, True])
def test_ordered_rows_equal_plain_windows(spark, descending):
    from pyspark.sql import Window

    from lamina.operators.ordered import ordered_rows

    # One group holds most rows, and within it most rows share one order value.
    df = spark.range(3000).select(
        F.when(F.col("id") % 10 < 7, "hot").when(F.col("id") % 10 == 7, None).otherwise((F.col("id") % 40).cast("string")).alias("k"),
        F.when(F.col("id") % 3 == 0, 50).when(F.col("id") % 31 == 0, None).otherwise(F.col("id") % 97).alias("o"),
        "id", (F.col("id") * 2).alias("v"),
    )
    first = F.desc_nulls_last("o") if descending else F.asc_nulls_last("o")
    w, r = Window.partitionBy("k").orderBy(first, "id"), Window.partitionBy("k").orderBy(first)
    want = df.select(
        "*", F.row_number().over(w).cast("long"), F.rank().over(r).cast("long"),
        F.lag("v").over(w), F.lead("v").over(w),
    )
    got = ordered_rows(df, ["k"], ["o"], ["id"], ["v"], chunks=20, descending=descending)
    assert got.columns == ["k", "o", "id", "v", "row_number", "rank", "previous_v", "next_v"]
    assert rows_of(got) == rows_of(want)


def test_close_values_cut_tasks_by_number(spark, monkeypatch):
    monkeypatch.setattr(agreement, "VALUES_PER_TASK", 50)
    names = [f"name {i:03d}" for i in range(0, 300, 2)] + [None, "name 002", "nme 002"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    found = agreement.close_values(df, linkage.Comparison("name", "edit", 1))
    plan = found._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" not in plan  # the keys of short values are many times their bytes
    assert "REPARTITION_BY_NUM" in plan

    def close(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    known = {n for n in names if n}
    assert {tuple(r) for r in found.collect()} == {(a, b) for a in known for b in known if close(a, b)}
