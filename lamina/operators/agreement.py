"""How often pairs agree: pattern counts without pairs, and the linkage model estimated from them.

Of the model's parameters u comes from pairs that cannot be matches by much: those outside the
blocks, counted exactly by value frequencies. With u fixed, expectation maximisation (Dempster et al.
1977) finds the prior and m from the pattern counts of the blocks, with extrapolated steps (SQUAREM, Varadhan
and Roland 2008).
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lamina.operators.linkage import CLOSE, DIFFERENT, EXACT, UNKNOWN, Comparison, LinkageSettings, share_keys
from lamina.session import cut_lineage

KNOWN, ANY = "known", "any"  # what pairs a state counts beside EXACT and CLOSE
FLOOR = 1e-12                # no probability is closer to 0 or 1
MAX_ROUNDS = 20_000
VALUES_PER_TASK = 8_192      # distinct values of a column that one task compares


def _comparisons(columns: Sequence[str | Comparison]) -> list[Comparison]:
    return [c if isinstance(c, Comparison) else Comparison(c) for c in columns]


def close_values(df: DataFrame, c: Comparison) -> DataFrame:
    """(a, b): the different values of a column that are close, both ways round.

    Only distinct values meet, and only those that share a key of the comparison: a text with up to
    ``limit`` characters left out, or a cell of the number line. The work grows with the close values there are.
    Values are short but have many keys, so tasks are cut by their number, not by their bytes, and keys are shuffled.
    """
    values = cut_lineage(df.select(F.col(c.column).alias("a")).filter(F.col("a").isNotNull()).distinct())
    tasks = max(1, math.ceil(values.count() / VALUES_PER_TASK))
    values = values.repartition(tasks, "a")
    if c.kind == "edit":
        keys = share_keys(c, F.col("a"))
        left, right = values.withColumn("key", F.explode(keys)), values.withColumn("key", F.explode(keys))
    else:
        cell = F.floor(F.col("a") / F.lit(float(c.limit)))
        left = values.withColumn("key", F.explode(F.array(cell - 1, cell, cell + 1)))
        right = values.withColumn("key", cell)
    left, right = (side.repartition(tasks, "key") for side in (left, right))
    pairs = left.join(right.withColumnRenamed("a", "b").hint("merge"), "key").filter(F.col("a") != F.col("b"))
    return pairs.filter(c.close(F.col("a"), F.col("b"))).select("a", "b").distinct()


def pattern_counts(
    df: DataFrame, rule: Sequence[str], columns: Sequence[str | Comparison], close: Mapping[str, DataFrame] | None = None
) -> dict[tuple[int, ...], int]:
    """How many pairs of each block show each pattern of agreement, without forming the pairs.

    Returns ``{pattern: pairs}``; a pattern has one level per column (2 agree, 1 close, 0 differ,
    -1 unknown on either side). A column given by name is compared exactly.

    ``n * (n - 1) / 2`` over the groups equal in a set of columns counts the pairs that agree at
    least there; for close levels each group meets the groups whose values are in the list of close ones.
    One grouped aggregate yields the groups of all sets, and inclusion and exclusion turns
    "at least" into "exactly". Only 4 ** len(columns) numbers reach the driver.
    """
    compared, rule = _comparisons(columns), list(rule)
    names = [c.column for c in compared]
    blocks = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in rule])
    # Rule columns may be compared too, so both get names of their own.
    profiles = df.filter(blocks).groupBy(
        *[F.col(c).alias(f"r{i}") for i, c in enumerate(rule)], *[F.col(c).alias(f"c{j}") for j, c in enumerate(names)]
    ).agg(F.count(F.lit(1)).alias("n"))
    profiles = cut_lineage(profiles)
    wanted = [(EXACT, KNOWN, ANY) if c.kind == "exact" else (EXACT, CLOSE, KNOWN, ANY) for c in compared]
    states = list(itertools.product(*wanted))
    views = []
    for i, state in enumerate(states):
        there = [F.col(f"c{j}").isNotNull() for j, s in enumerate(state) if s != ANY]
        masked = [
            (F.col(f"c{j}") if s in (EXACT, CLOSE) else F.lit(None).cast(df.schema[names[j]].dataType)).alias(f"v{j}")
            for j, s in enumerate(state)
        ]
        views.append(F.when(reduce(lambda a, b: a & b, there, F.lit(True)), F.struct(F.lit(i).alias("state"), *masked)))
    blocked = [f"r{i}" for i in range(len(rule))]
    spread = profiles.select(*blocked, "n", F.explode(F.array(*views)).alias("w")).filter("w is not null")
    sizes = cut_lineage(spread.groupBy(*blocked, "w").agg(F.sum("n").cast("decimal(19,0)").alias("size")))
    size = F.col("size")

    def states_with(subset: tuple[int, ...]) -> Column:
        own = [i for i, s in enumerate(states) if tuple(j for j, x in enumerate(s) if x == CLOSE) == subset]
        return F.col("w.state").isin(own)

    twice = [sizes.filter(states_with(())).groupBy(F.col("w.state").alias("state")).agg(F.sum(size * (size - 1)).alias("twice"))]
    fuzzy = [j for j, c in enumerate(compared) if c.kind != "exact"]

    def within_blocks(j: int) -> DataFrame:
        """(block, a, b): the close values that stand in one block."""
        pairs = close[names[j]] if close else close_values(df, compared[j])
        there = profiles.select(*blocked, F.col(f"c{j}").alias("a")).filter(F.col("a").isNotNull()).distinct()
        return cut_lineage(there.join(pairs, "a").join(there.withColumnRenamed("a", "b"), [*blocked, "b"]))

    lists = {j: within_blocks(j) for j in fuzzy}
    for subset in (s for k in range(1, len(fuzzy) + 1) for s in itertools.combinations(fuzzy, k)):
        held = sizes.filter(states_with(subset))
        moved = held.select(*blocked, "size", "w.*")
        for j in subset:
            own = lists[j].select(*blocked, F.col("a").alias(f"v{j}"), F.col("b").alias(f"b{j}"))
            moved = moved.join(own, [*blocked, f"v{j}"])
        other = F.struct("state", *[F.col(f"b{j}" if j in subset else f"v{j}").alias(f"v{j}") for j in range(len(names))])
        met = moved.select(*blocked, F.col("size").alias("own"), other.alias("w")).join(held, [*blocked, "w"])
        twice.append(met.groupBy(F.col("w.state").alias("state")).agg(F.sum(F.col("own") * size).alias("twice")))
    at_least = {states[r["state"]]: int(r["twice"]) // 2 for r in reduce(DataFrame.unionByName, twice).collect()}

    def exactly(pattern: tuple[int, ...]) -> int:
        # DIFFERENT = known minus agreeing; UNKNOWN = everything minus known.
        options = [
            {EXACT: [(EXACT, 1)], CLOSE: [(CLOSE, 1)], UNKNOWN: [(ANY, 1), (KNOWN, -1)],
             DIFFERENT: [(KNOWN, 1), (EXACT, -1)] + ([(CLOSE, -1)] if j in fuzzy else [])}[lv]
            for j, lv in enumerate(pattern)
        ]
        total = 0
        for choice in itertools.product(*options):
            sign = math.prod(s for _, s in choice)
            total += sign * at_least.get(tuple(st for st, _ in choice), 0)
        return total

    patterns = itertools.product(*[[*reversed(c.levels), UNKNOWN] for c in compared])
    counts = {p: exactly(p) for p in patterns}
    return {p: n for p, n in counts.items() if n}


def level_counts(df: DataFrame, c: Comparison, close: DataFrame | None = None) -> dict[int, int]:
    """Of all pairs of rows with known values, how many agree at each level; by value frequencies."""
    sized = df.filter(F.col(c.column).isNotNull()).groupBy(F.col(c.column).alias("a")).agg(F.count(F.lit(1)).cast("decimal(19,0)").alias("n"))
    n = F.col("n")
    whole = sized.agg(F.sum("n").alias("rows"), F.sum(n * (n - 1)).alias("twice")).first()
    rows, equal = int(whole["rows"] or 0), int(whole["twice"] or 0) // 2
    near = 0
    if c.kind != "exact":
        close = close_values(df, c) if close is None else close
        met = sized.join(close, "a").join(sized.select(F.col("a").alias("b"), F.col("n").alias("m")), "b")
        near = int(met.agg(F.sum(n * F.col("m")).alias("twice")).first()["twice"] or 0) // 2
    out = {EXACT: equal, DIFFERENT: rows * (rows - 1) // 2 - equal - near}
    return out if c.kind == "exact" else out | {CLOSE: near}


def outside_agreement(all_pairs: Sequence[Mapping[int, int]], counts: Mapping[tuple[int, ...], int]) -> tuple[dict[int, float], ...]:
    """u of each column: the share of each level among pairs outside the blocks (among all, if every pair
    with known values is inside)."""
    out = []
    for j, whole in enumerate(all_pairs):
        inside = {lv: sum(n for p, n in counts.items() if p[j] == lv) for lv in whole}
        left = {lv: whole[lv] - inside[lv] for lv in whole}
        out.append(_shares(left if sum(left.values()) else whole))
    return tuple(out)


def _shares(parts: Mapping[int, float]) -> dict[int, float]:
    whole = sum(parts.values())
    kept = {lv: max(x / whole, FLOOR) if whole else 1 / len(parts) for lv, x in parts.items()}
    total = sum(kept.values())
    return {lv: x / total for lv, x in kept.items()}


@dataclass(frozen=True)
class Estimate:
    """Level probabilities per column. ``settled`` is False where rounds ran out, where fewer than one
    match is expected, or where m is u: then the data do not tell matches from other pairs."""

    prior: float
    m: tuple[dict[int, float], ...]
    u: tuple[dict[int, float], ...]
    rounds: int
    settled: bool


def _step(counts, u, prior, m) -> tuple[float, list[dict[int, float]], float]:
    """One round: new prior and m, and the log likelihood of the old ones."""
    matched, whole, likelihood = 0.0, 0, 0.0
    seen = [dict.fromkeys(own, 0.0) for own in m]
    for pattern, n in counts.items():
        like_m, like_u = prior, 1 - prior
        for i, lv in enumerate(pattern):
            if lv != UNKNOWN:
                like_m *= m[i][lv]
                like_u *= u[i][lv]
        p = n * like_m / (like_m + like_u)
        likelihood += n * math.log(like_m + like_u)
        matched += p
        whole += n
        for i, lv in enumerate(pattern):
            if lv != UNKNOWN:
                seen[i][lv] += p
    return min(max(matched / whole, FLOOR), 1 - FLOOR), [_shares(s) for s in seen], likelihood


def _pack(prior: float, m) -> list[float]:
    """Log odds, in which a step cannot leave the range of probabilities."""
    return [math.log(prior / (1 - prior))] + [math.log(own[lv] / own[DIFFERENT]) for own in m for lv in own if lv != DIFFERENT]


def _unpack(x: Sequence[float], like) -> tuple[float, list[dict[int, float]]]:
    cut = [min(max(v, -27.0), 27.0) for v in x]
    rest, m = iter(cut[1:]), []
    for own in like:
        m.append(_shares({lv: 1.0 if lv == DIFFERENT else math.exp(next(rest)) for lv in own}))
    return 1 / (1 + math.exp(-cut[0])), m


def estimate_em(
    counts: Mapping[tuple[int, ...], int], u: Sequence[Mapping[int, float]], prior: float = 0.01,
    tolerance: float = 1e-9,
) -> Estimate:
    """Prior and m from pattern counts, with u given; unknown levels carry no evidence.

    Rounds go on until the way still to go, judged by the rate of the last steps, is below
    ``tolerance`` in every probability.
    """
    start = {EXACT: 0.9, CLOSE: 0.07, DIFFERENT: 0.03}
    m = [_shares({lv: start[lv] for lv in own}) for own in u]
    total = sum(counts.values())
    rounds, settled = 0, False

    def probabilities(lam, ms):
        return [lam, *(own[lv] for own in ms for lv in own)]

    def step(lam, ms):
        nonlocal rounds
        rounds += 1
        return _step(counts, u, lam, ms)

    while rounds < MAX_ROUNDS and not settled:
        lam1, m1, _ = step(prior, m)
        lam2, m2, like1 = step(lam1, m1)
        first = max(abs(a - b) for a, b in zip(probabilities(lam1, m1), probabilities(prior, m)))
        second = max(abs(a - b) for a, b in zip(probabilities(lam2, m2), probabilities(lam1, m1)))
        rate = min(second / first, 1 - 1e-6) if first else 0.0
        if second / (1 - rate) < tolerance or lam2 * total < 1:
            apart = max(abs(own[lv] - other[lv]) for own, other in zip(m2, u) for lv in own)
            prior, m, settled = lam2, m2, lam2 * total >= 1 and apart > 1e-3
            break
        x0, x1, x2 = _pack(prior, m), _pack(lam1, m1), _pack(lam2, m2)
        r = [b - a for a, b in zip(x0, x1)]
        v = [c - 2 * b + a for a, b, c in zip(x0, x1, x2)]
        bend = math.sqrt(sum(y * y for y in v))
        length = max(1.0, math.sqrt(sum(y * y for y in r)) / bend) if bend else 1.0
        lam3, m3 = _unpack([a + 2 * length * d + length * length * w for a, d, w in zip(x0, r, v)], m)
        lam4, m4, like3 = step(lam3, m3)
        prior, m = (lam4, m4) if like3 >= like1 else (lam2, m2)  # a step too far is taken back
    return Estimate(prior, tuple(m), tuple(dict(x) for x in u), rounds, settled)


def estimate(
    df: DataFrame, rule: Sequence[str], columns: Sequence[str | Comparison], tolerance: float = 1e-9
) -> Estimate:
    """The linkage model of the pairs that ``rule`` blocks; no pair is formed."""
    compared = _comparisons(columns)
    close = {c.column: cut_lineage(close_values(df, c)) for c in compared if c.kind != "exact"}
    counts = pattern_counts(df, rule, compared, close)
    every = [level_counts(df, c, close.get(c.column)) for c in compared]
    if not counts:
        raise ValueError(f"no two rows agree in {list(rule)}")
    return estimate_em(counts, outside_agreement(every, counts), tolerance=tolerance)


def estimated_settings(df: DataFrame, settings: LinkageSettings, rule: Sequence[str] | None = None) -> LinkageSettings:
    """``settings`` with prior, m and u estimated within a blocking rule (the first one, if none is given).

    A column that the rule itself blocks agrees in every pair, so it keeps its probabilities.
    """
    rule = list(rule or settings.blocking[0])
    free = [c for c in settings.comparisons if c.column not in rule]
    found = estimate(df, rule, free)
    if not found.settled:
        raise ValueError("the data do not determine the model: matches cannot be told from other pairs")
    own = {c.column: (found.m[j], found.u[j]) for j, c in enumerate(free)}
    comparisons = [replace(c, m=own[c.column][0], u=own[c.column][1]) if c.column in own else c for c in settings.comparisons]
    return replace(settings, comparisons=comparisons, prior=found.prior)
