"""Probabilistic record linkage (Fellegi and Sunter 1969); ``agreement`` estimates its probabilities.

Records that agree on a blocking rule are compared column by column. Every comparison yields a
level (2 exact, 1 close, 0 different, -1 unknown); a level carries the weight log2(m / u), where
m and u are its probabilities among matching and non-matching pairs. A pair matches when its
weights and the prior reach a threshold.

Comparing all pairs of a block is quadratic, and one block may hold a third of all rows. So
pairs are never enumerated. Weights grow with the level, hence a pair matches exactly when it
reaches one of a few *minimal patterns* of levels (:func:`minimal_patterns`). Each pattern is an
equi-join on the values that must agree:

* records equal in all columns of a pattern all match each other; each is linked to the
  smallest id among them, one link per record;
* close values are looked for among the distinct values only, by keys close values share.

The links connect the same records as the full set of matching pairs would, so clusters are
the ones a comparison of all pairs gives. An unknown value never counts as agreement.
"""

from __future__ import annotations

import itertools
import math
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from lamina.operators.components import connected_components
from lamina.operators.dedup import keep_latest
from lamina.operators.skew import safe_join
from lamina.session import cut_lineage

EXACT, CLOSE, DIFFERENT, UNKNOWN = 2, 1, 0, -1


@dataclass(frozen=True)
class Comparison:
    """How one column is compared.

    ``kind`` is ``exact``, ``edit`` (close: at most ``limit`` character edits; made for names
    and codes, its work grows with length ** limit) or ``near`` (close: absolute difference of
    at most ``limit``). ``m`` and ``u`` map the level to its probability.
    """

    column: str
    kind: str = "exact"
    limit: float = 0
    m: Mapping[int, float] = field(default_factory=lambda: {EXACT: 0.9, CLOSE: 0.07, DIFFERENT: 0.03})
    u: Mapping[int, float] = field(default_factory=lambda: {EXACT: 0.01, CLOSE: 0.04, DIFFERENT: 0.95})

    def __post_init__(self):
        if self.kind not in ("exact", "edit", "near"):
            raise ValueError(f"Unknown comparison kind {self.kind}")
        if self.kind != "exact" and self.limit <= 0:
            raise ValueError(f"{self.kind} comparison of {self.column} needs a positive limit")
        weights = [self.weight(lv) for lv in self.levels]
        if weights != sorted(weights):
            raise ValueError(f"weights of {self.column} must grow with the level")

    @property
    def levels(self) -> list[int]:
        return [DIFFERENT, EXACT] if self.kind == "exact" else [DIFFERENT, CLOSE, EXACT]

    def weight(self, level: int) -> float:
        level = DIFFERENT if level == UNKNOWN else level
        return math.log2(self.m[level] / self.u[level])

    def close(self, left: Column, right: Column) -> Column:
        if self.kind == "edit":
            distance = F.levenshtein(left, right, int(self.limit))
            return (distance >= 0) & (distance <= int(self.limit))
        return F.abs(left - right) <= F.lit(self.limit)


_EQUAL = re.compile(r"""^\s*l\.["`]?(\w+)["`]?\s*=\s*r\.["`]?(\w+)["`]?\s*$""", re.IGNORECASE)


def _blocking_columns(rule: str | Sequence[str]) -> list[str]:
    if not isinstance(rule, str):
        return list(rule)
    columns = []
    for part in re.split(r"\s+and\s+", rule, flags=re.IGNORECASE):
        found = _EQUAL.match(part)
        if found is None or found.group(1) != found.group(2):
            raise ValueError(f"blocking rule must compare a column with itself: {rule}")
        columns.append(found.group(1))
    return columns


@dataclass(frozen=True)
class LinkageSettings:
    id: str
    blocking: Sequence[Sequence[str]]
    comparisons: Sequence[Comparison]
    prior: float = 0.001
    min_probability: float = 0.9

    def __post_init__(self):
        if not self.blocking or any(not rule for rule in self.blocking):
            raise ValueError("at least one blocking rule with at least one column is required")
        if not self.comparisons:
            raise ValueError("at least one comparison is required")
        if not (0 < self.prior < 1 and 0 < self.min_probability < 1):
            raise ValueError("prior and min_probability must lie between 0 and 1")

    @classmethod
    def from_config(cls, config: Mapping) -> "LinkageSettings":
        """Settings from a plain mapping.

        A blocking rule is a list of columns or text such as ``l.a = r.a AND l.b = r.b``; a
        comparison is a column name (exact) or a mapping with the fields of :class:`Comparison`.
        """
        if config.get("link_type", "dedupe_only") != "dedupe_only":
            raise ValueError("only one dataset can be linked with itself (dedupe_only)")
        rules = config.get("blocking_rules_to_generate_predictions") or []
        single = config.get("blocking_rule")
        parsed = [_blocking_columns(r) for r in ([*rules, single] if single else rules)]
        comparisons = [
            Comparison(c) if isinstance(c, str) else Comparison(**c) for c in config["comparisons"]
        ]
        options = {k: config[k] for k in ("prior", "min_probability") if k in config}
        return cls(config["unique_id_column_name"], parsed, comparisons, **options)

    @property
    def prior_weight(self) -> float:
        return math.log2(self.prior / (1 - self.prior))

    @property
    def min_weight(self) -> float:
        return math.log2(self.min_probability / (1 - self.min_probability))

    def columns(self) -> list[str]:
        """Columns linkage reads, id first."""
        wanted = [self.id, *itertools.chain(*self.blocking), *(c.column for c in self.comparisons)]
        return list(dict.fromkeys(wanted))


def minimal_patterns(settings: LinkageSettings) -> list[tuple[int, ...]]:
    """Smallest level combinations (one level per comparison) that reach the threshold."""

    def reached(levels: Sequence[int]) -> bool:
        total = settings.prior_weight + sum(
            c.weight(lv) for c, lv in zip(settings.comparisons, levels)
        )
        return total >= settings.min_weight

    def lowered(levels: tuple[int, ...]):
        for i, (c, lv) in enumerate(zip(settings.comparisons, levels)):
            for lower in c.levels:
                if lower < lv:
                    yield levels[:i] + (lower,) + levels[i + 1 :]

    if reached([DIFFERENT] * len(settings.comparisons)):
        raise ValueError("the threshold accepts pairs that agree on nothing but the block")
    every = itertools.product(*(c.levels for c in settings.comparisons))
    return [p for p in every if reached(p) and not any(reached(q) for q in lowered(p))]


# ---------------------------------------------------------------- comparing and scoring pairs


def compare(pairs: DataFrame, comparisons: Sequence[Comparison]) -> DataFrame:
    """``pairs`` (columns ``<c>_l`` and ``<c>_r``) with one ``level_<c>`` per comparison."""
    out = pairs
    for c in comparisons:
        left, right = F.col(f"{c.column}_l"), F.col(f"{c.column}_r")
        level = F.when(left.isNull() | right.isNull(), UNKNOWN).when(left == right, EXACT)
        if c.kind != "exact":
            level = level.when(c.close(left, right), CLOSE)
        out = out.withColumn(f"level_{c.column}", level.otherwise(DIFFERENT))
    return out


def score(compared: DataFrame, settings: LinkageSettings) -> DataFrame:
    """Adds ``match_weight`` and ``match_probability`` to compared pairs."""
    total = F.lit(settings.prior_weight)
    for c in settings.comparisons:
        level = F.col(f"level_{c.column}")
        weight = F.lit(c.weight(DIFFERENT))
        for lv in c.levels[1:]:
            weight = F.when(level == lv, F.lit(c.weight(lv))).otherwise(weight)
        total = total + weight
    odds = F.pow(F.lit(2.0), F.col("match_weight"))
    return compared.withColumn("match_weight", total).withColumn(
        "match_probability", odds / (F.lit(1.0) + odds)
    )


def matches(scored: DataFrame, settings: LinkageSettings) -> DataFrame:
    return scored.filter(F.col("match_weight") >= settings.min_weight)


# ---------------------------------------------------------------- finding links


def _deletions(text: Column, times: int) -> Column:
    """``text`` and every string left after deleting up to ``times`` characters.

    Two strings within ``times`` edits always share at least one of these.
    """

    def once(s: Column) -> Column:
        shorter = F.transform(
            F.sequence(F.lit(1), F.greatest(F.length(s), F.lit(1))),
            lambda i: F.concat(F.substr(s, F.lit(1), i - 1), F.substr(s, i + 1)),
        )
        return F.when(F.length(s) > 0, F.concat(F.array(s), shorter)).otherwise(F.array(s))

    found = once(text)
    for _ in range(times - 1):
        found = F.array_distinct(F.flatten(F.transform(found, once)))
    return F.array_distinct(found)


def share_keys(c: Comparison, value: Column) -> Column:
    """Keys of a text value; close values have at least one in common."""
    return F.transform(_deletions(value, int(c.limit)), lambda s: F.xxhash64(s))


def _star_links(rows: DataFrame, keys: list[str], id_col: str) -> DataFrame:
    """Each record linked to the smallest id among the records equal in ``keys``."""
    reps = rows.groupBy(*keys).agg(F.min(id_col).alias("id_l"))
    linked = safe_join(rows.select(*keys, F.col(id_col).alias("id_r")), reps, keys, "inner")
    return linked.filter("id_l <> id_r").select("id_l", "id_r")


def _near_chain_links(
    rows: DataFrame, same: list[str], c: Comparison, id_col: str
) -> DataFrame:
    """Links for one ``near`` column: cells of width ``limit``, chained to their neighbour.

    Values inside a cell are all close to each other, so one link per record suffices there;
    two neighbouring cells touch exactly when the largest value of the lower and the smallest
    value of the upper are close.
    """
    celled = rows.withColumn("__cell", F.floor(F.col(c.column) / F.lit(float(c.limit))))
    inner = _star_links(celled, [*same, "__cell"], id_col)
    edge = F.struct(F.col(c.column).alias("v"), F.col(id_col).alias("id"))
    cells = celled.groupBy(*same, "__cell").agg(F.min(edge).alias("lo"), F.max(edge).alias("hi"))
    below = cells.select(*same, (F.col("__cell") + 1).alias("__cell"), "hi")
    touching = cells.drop("hi").join(below, [*same, "__cell"]).filter(
        c.close(F.col("lo.v"), F.col("hi.v"))
    )
    crossing = touching.select(
        F.least("lo.id", "hi.id").alias("id_l"), F.greatest("lo.id", "hi.id").alias("id_r")
    )
    return inner.unionByName(crossing)


def _near_grid_links(rows: DataFrame, same: list[str], x: Comparison, y: Comparison, id_col: str) -> DataFrame:
    """Links for two ``near`` columns, by a grid of cells as wide and high as the limits.

    Records of one cell are all close: one link each. Cells side by side share a row or column of
    the grid, so they touch exactly when their edges along the other column are close. Cells that
    touch at a corner do so if some record of one has a record of the other within both limits: a
    sweep along x with the running extreme of y finds one without pairing any.
    """
    a, b = F.col(x.column), F.col(y.column)
    grid = rows.select(
        *same, a.alias("x"), b.alias("y"), F.col(id_col).alias("id"),
        F.floor(a / F.lit(float(x.limit))).alias("cx"), F.floor(b / F.lit(float(y.limit))).alias("cy"),
    )
    found = [_star_links(grid, [*same, "cx", "cy"], "id")]
    for along, cell, c in (("x", "cx", x), ("y", "cy", y)):
        edge = F.struct(F.col(along).alias("v"), "id")
        cells = grid.groupBy(*same, "cx", "cy").agg(F.min(edge).alias("lo"), F.max(edge).alias("hi"))
        below = cells.withColumn(cell, F.col(cell) + 1).drop("lo")
        touching = cells.drop("hi").join(below, [*same, "cx", "cy"]).filter(c.close(F.col("lo.v"), F.col("hi.v")))
        found.append(_link(touching, "lo.id", "hi.id"))
    for sign in (1, -1):  # the corner above to the right, then below to the right
        turned = grid.withColumn("y", F.col("y") * sign).withColumn("cy", F.col("cy") * sign)
        # Per value of x only the record nearest to the corner counts.
        point = F.struct("y", "id")
        lower = turned.groupBy(*same, "cx", "cy", "x").agg(F.max(point).alias("p")).withColumn("upper", F.lit(False))
        upper = turned.groupBy(*same, "cx", "cy", "x").agg(F.min(point).alias("p")).withColumn("upper", F.lit(True))
        upper = upper.withColumn("cx", F.col("cx") - 1).withColumn("cy", F.col("cy") - 1)
        reach = F.when(F.col("upper"), F.col("x")).otherwise(F.col("x") + F.lit(x.limit))
        sweep = Window.partitionBy(*same, "cx", "cy").orderBy(F.desc("reach"), "upper")
        best = F.max(F.when(~F.col("upper"), F.struct("p.y", "p.id", "x"))).over(sweep)
        met = (
            lower.unionByName(upper).withColumn("reach", reach).withColumn("best", best)
            .filter(F.col("upper") & F.col("best").isNotNull())
            .filter(x.close(F.col("x"), F.col("best.x")) & y.close(F.col("p.y"), F.col("best.y")))
        )
        found.append(_link(met, "p.id", "best.id"))
    return reduce(DataFrame.unionByName, found)


def _link(df: DataFrame, one: str, other: str) -> DataFrame:
    linked = df.select(F.least(one, other).alias("id_l"), F.greatest(one, other).alias("id_r"))
    return linked.filter("id_l <> id_r")


def _edit_near_links(rows: DataFrame, same: list[str], text: Comparison, number: Comparison, id_col: str) -> DataFrame:
    """Links for an ``edit`` and a ``near`` column: per pair of close texts, one link for each pair of
    touching cells of the numbers."""
    chained = _near_chain_links(rows, [*same, text.column], number, id_col)
    celled = rows.withColumn("__cell", F.floor(F.col(number.column) / F.lit(float(number.limit))))
    edge = F.struct(F.col(number.column).alias("v"), F.col(id_col).alias("id"))
    cells = celled.groupBy(*same, F.col(text.column).alias("v"), "__cell").agg(
        F.min(edge).alias("lo"), F.max(edge).alias("hi")
    )
    near = cut_lineage(_close_values(rows.select(F.col(text.column).alias("v")).distinct(), text))
    seen = rows.select(F.col(text.column).alias("v"))
    mine = safe_join(cells, near, ["v"], "inner", counted_from=seen).drop("v").withColumnRenamed("w", "v")
    mine = mine.withColumnsRenamed({"lo": "lo_l", "hi": "hi_l", "__cell": "__mine"}).withColumn(
        "__cell", F.explode(F.array(F.col("__mine"), F.col("__mine") + 1))
    )
    met = mine.join(cells, [*same, "v", "__cell"]).filter(
        (F.col("__cell") == F.col("__mine")) | number.close(F.col("hi_l.v"), F.col("lo.v"))
    )
    # Both orders of a pair of texts are there, so the cell below is met from the other side.
    return chained.unionByName(_link(met, "hi_l.id", "lo.id"))


def _close_values(values: DataFrame, c: Comparison) -> DataFrame:
    """(v, w): pairs of distinct values of an ``edit`` column that are close, in both orders."""
    keyed = values.withColumn("k", F.explode(share_keys(c, F.col("v"))))
    other = keyed.select(F.col("v").alias("w"), "k")
    pairs = keyed.join(other, "k").filter(F.col("v") != F.col("w"))
    return pairs.filter(c.close(F.col("v"), F.col("w"))).select("v", "w").distinct()


def _key_links(
    rows: DataFrame, same: list[str], close: list[Comparison], id_col: str
) -> DataFrame:
    """Links between groups of records whose values are close in every ``close`` column.

    Text is compared between the distinct values of a column, once per pair of values; groups
    are then joined on equality with the values found. Numbers meet in neighbouring cells.
    """
    values = [c.column for c in close]
    reps = rows.groupBy(*same, *values).agg(F.min(id_col).alias("id"))
    left = reps.select(*same, F.col("id").alias("id_l"), *[F.col(v).alias(f"{v}_l") for v in values])
    right = reps.select(*same, F.col("id").alias("id_r"), *[F.col(v).alias(f"{v}_r") for v in values])
    meet = list(same)
    for c in close:
        mine, theirs = f"{c.column}_l", f"{c.column}_r"
        if c.kind == "edit":
            distinct = rows.select(F.col(c.column).alias("v")).distinct()
            near = cut_lineage(_close_values(distinct, c))  # now of known size
            if len(close) > 1:  # equal here, close elsewhere
                near = near.union(distinct.select("v", F.col("v").alias("w")))
            near = near.select(F.col("v").alias(mine), F.col("w").alias(theirs))
            seen = rows.select(F.col(c.column).alias(mine))
            left = safe_join(left, near, [mine], "inner", counted_from=seen)
            meet.append(theirs)
        else:
            cell = F.floor(F.col(mine) / F.lit(float(c.limit)))
            around = F.explode(F.array(cell - 1, cell, cell + 1))
            left = left.withColumn(f"__cell_{c.column}", around)
            right = right.withColumn(
                f"__cell_{c.column}", F.floor(F.col(theirs) / F.lit(float(c.limit)))
            )
            meet.append(f"__cell_{c.column}")
    # Per key one group on the right, and on the left only the groups close to it.
    joined = left.join(right, meet).filter("id_l < id_r")
    for c in close:
        if c.kind == "near":
            joined = joined.filter(c.close(F.col(f"{c.column}_l"), F.col(f"{c.column}_r")))
    return joined.select("id_l", "id_r").distinct()


def candidate_links(df: DataFrame, settings: LinkageSettings) -> DataFrame:
    """(id_l, id_r) with id_l < id_r: matching pairs that connect all matching records.

    With up to two close columns that are numbers, or a text and a number, the links grow with
    the records and the pairs of close distinct texts. Two close texts, or three close columns,
    meet group by group: there the links grow with the pairs of different records that are close.
    """
    records = df.select(*settings.columns())
    found: list[DataFrame] = []
    for rule in settings.blocking:
        for pattern in minimal_patterns(settings):
            parts = list(zip(settings.comparisons, pattern))
            exact = [c.column for c, lv in parts if lv == EXACT]
            close = [c for c, lv in parts if lv == CLOSE]
            same = list(dict.fromkeys([*rule, *exact]))
            close = [c for c in close if c.column not in same]
            needed = [*same, *(c.column for c in close)]
            known = reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in needed])
            rows = records.filter(known).select(settings.id, *needed)
            if len(close) == 1 and close[0].kind == "near":
                found.append(_near_chain_links(rows, same, close[0], settings.id))
                continue
            kinds = sorted(c.kind for c in close)
            if kinds == ["near", "near"]:
                found.append(_near_grid_links(rows, same, *close, settings.id))
                continue
            found.append(_star_links(rows, needed, settings.id))
            if kinds == ["edit", "near"]:
                text, number = sorted(close, key=lambda c: c.kind)
                found.append(_edit_near_links(rows, same, text, number, settings.id))
            elif close:
                found.append(_key_links(rows, same, close, settings.id))
    if not found:  # not even full agreement reaches the threshold
        nobody = records.select(F.col(settings.id).alias("id_l"), F.col(settings.id).alias("id_r"))
        return nobody.filter(F.lit(False))
    # Written out: scoring and clustering both read the links several times.
    return cut_lineage(reduce(DataFrame.unionByName, found).distinct())


def scored_links(df: DataFrame, links: DataFrame, settings: LinkageSettings) -> DataFrame:
    """Links with the compared values of both sides, their levels, weight and probability."""
    values = [c.column for c in settings.comparisons]
    records = df.select(settings.id, *dict.fromkeys(values))

    def side(tag: str) -> DataFrame:
        return records.select(
            F.col(settings.id).alias(f"id_{tag}"),
            *[F.col(v).alias(f"{v}_{tag}") for v in dict.fromkeys(values)],
        )

    # Many links share their smaller id, so both lookups may meet hot keys.
    pairs = safe_join(links, side("l"), ["id_l"], "inner")
    pairs = safe_join(pairs, side("r"), ["id_r"], "inner", counted_from=links.select("id_r"))
    return score(compare(pairs, settings.comparisons), settings)


def cluster(df: DataFrame, links: DataFrame, id_col: str) -> DataFrame:
    """``df`` with ``cluster_id``, the smallest id of its linked records (its own if alone)."""
    parts = connected_components(links, "id_l", "id_r").withColumnRenamed("node", id_col)
    return (
        df.join(parts, id_col, "left")
        .withColumn("cluster_id", F.coalesce(F.col("component"), F.col(id_col)))
        .drop("component")
    )


def deduplicate(
    df: DataFrame, settings: LinkageSettings, newest_by: Sequence[str] = ()
) -> DataFrame:
    """One record per cluster with all its columns, plus ``cluster_id``.

    The survivor is the newest by ``newest_by``, then the one with the smallest id.
    """
    clustered = cluster(df, candidate_links(df, settings), settings.id)
    return keep_latest(clustered, ["cluster_id"], newest_by, [settings.id])
