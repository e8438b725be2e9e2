"""Near duplicates by SimHash: fingerprints that differ in at most three bits, found by balls.

Two fingerprints within radius 2 meet in a point that is within 1 of both (meet in the middle), so
when each emits all its variants within 1, those that share a variant are within 2: every such
bucket is a clique, and one link per member is enough. For radius 3 the fingerprint is cut into four
groups of 16 bits, one of which is masked: if the masked group holds exactly one of the three
differing bits, the two others lie in the remaining 48 bits and the balls meet there; buckets
whose masked values differ in one bit are linked. If all three bits lie in one group, the other 48
agree exactly, and within that group the balls of radius 1 and 2 meet. Each fingerprint thus emits
196 variants instead of the 2,146 that whole balls of radius 1 and 2 would need.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from lamina.llm.common import map_batches, text_chunks
from lamina.operators.components import connected_components
from lamina.session import cut_lineage

SHINGLE_WORDS = 3
SEED = 42
GROUP_BITS, GROUPS = 16, 4
_ALL = (1 << 64) - 1
_SHINGLES_AT_ONCE = 1 << 14


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint(text: bytes) -> int:
    """64-bit fingerprint of a text as a signed number; 0 for a text without words."""
    words = text.lower().split()  # on bytes: only A-Z, only ASCII white space
    if not words:
        return 0
    n = max(1, len(words) - SHINGLE_WORDS + 1)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:n].tolist()
    stops = ends[-n:].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, n, _SHINGLES_AT_ONCE):
        part = [
            digest(joined[a:b], SEED)
            for a, b in zip(starts[at : at + _SHINGLES_AT_ONCE], stops[at : at + _SHINGLES_AT_ONCE])
        ]
        bits = np.unpackbits(np.array(part, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return _signed(sum(1 << i for i in range(64) if 2 * counts[i] > n))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp) of every row, over the whole text."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def scan(batch):
        for first, texts in text_chunks(batch, batch.schema.names[1]):
            yield batch.column(0).slice(first, len(texts)), [fingerprint(t) for t in texts]

    return map_batches(docs.select(id_col, text_col), scan, f"id {id_type}, fp long").withColumnRenamed("id", id_col)


def _variants() -> list[tuple[int, int, int]]:
    """(group, bits kept, bit flipped) of every variant a fingerprint emits."""
    out = []
    for g in range(GROUPS):
        keep = _ALL ^ (((1 << GROUP_BITS) - 1) << (GROUP_BITS * g))
        flips = [0] + [1 << b for b in range(64) if keep >> b & 1]
        out += [(g, _signed(keep), _signed(f)) for f in flips]
    return out


def _literal_array(values: list[int], kind: str = "bigint"):
    return F.array(*[F.lit(v).cast(kind) for v in values])


def _buckets(fps: DataFrame) -> DataFrame:
    """(g, key, masked, fp, head, exact): members of buckets that hold several fingerprints.

    ``head`` is the smallest member with the same masked value; ``exact`` marks the members whose
    48 bits are the key itself.
    """
    variants = F.array(*[
        F.struct(F.lit(g).cast("byte").alias("g"), F.lit(k).cast("bigint").alias("keep"), F.lit(f).cast("bigint").alias("flip"))
        for g, k, f in _variants()
    ])
    emitted = (
        fps.select("fp", F.explode(variants).alias("v"))
        .select("fp", "v.g", F.col("fp").bitwiseAND(F.col("v.keep")).bitwiseXOR(F.col("v.flip")).alias("key"),
                (F.col("v.flip") == 0).alias("exact"))
    )
    whole = Window.partitionBy("g", "key").orderBy("masked", "fp")
    equal = Window.partitionBy("g", "key", "masked").orderBy("fp")
    return (
        emitted.repartition("g", "key")
        .withColumn("masked", F.expr(f"cast(shiftrightunsigned(fp, {GROUP_BITS} * g) & 65535 as int)"))
        .withColumn("before", F.lag("fp").over(whole))
        .withColumn("after", F.lead("fp").over(whole))
        .filter("before is not null or after is not null")
        .withColumn("head", F.first("fp").over(equal))
        .select("g", "key", "masked", "fp", "head", "exact")
    )


def links(fps: DataFrame) -> DataFrame:
    """(a, b): enough links between distinct fingerprints ``fp`` to join all that are within 3 bits.

    Every link holds, none that matters to a component is missing, and their number grows with
    the members of buckets, not with the pairs in them.
    """
    buckets = cut_lineage(_buckets(fps))
    same = buckets.filter("fp <> head").select(F.col("fp").alias("a"), F.col("head").alias("b"))

    heads = buckets.filter("fp = head").select("g", "key", "masked", "head")
    several = heads.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("g", "key"))).filter("n > 1").drop("n")
    bits = _literal_array([1 << b for b in range(GROUP_BITS)], "int")
    lower = (
        several.select("g", "key", F.col("head").alias("a"), "masked", F.explode(bits).alias("bit"))
        .filter(F.col("masked").bitwiseAND(F.col("bit")) != 0)
        .select("g", "key", "a", F.col("masked").bitwiseXOR(F.col("bit")).alias("masked"))
    )
    near = lower.join(several.withColumnRenamed("head", "b"), ["g", "key", "masked"]).select("a", "b")

    exact = buckets.filter("exact").select("g", "key", "masked", "fp")
    exact = exact.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("g", "key"))).filter("n > 1")
    one = [0] + [1 << b for b in range(GROUP_BITS)]
    two = [1 << b | 1 << c for b in range(GROUP_BITS) for c in range(b)]
    ball = F.array(*[
        F.struct(F.lit(f).cast("int").alias("flip"), F.lit(r).alias("outer"))
        for r, flips in ((False, one), (True, two)) for f in flips
    ])
    points = exact.select("g", "key", "masked", "fp", F.explode(ball).alias("v")).select(
        "g", "key", F.col("masked").bitwiseXOR(F.col("v.flip")).alias("point"), "fp", "v.outer"
    )
    at = Window.partitionBy("g", "key", "point").orderBy("outer", "fp")
    inner = (
        points.withColumn("a", F.first("fp").over(at))
        .withColumn("far", F.first("outer").over(at))
        .filter("not far and fp <> a").select(F.col("fp").alias("a"), F.col("a").alias("b"))
    )
    return same.union(near).union(inner).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``fingerprint`` (16 hex digits) and ``component_id``, the smallest
    id that can be reached over links of at most three differing bits.

    Null and empty texts have fingerprint zero and are linked like any other. Copies of a text
    share one fingerprint and are linked through it, never pair by pair. Rows that repeat an id
    stay rows; a row without an id gets the component of the ids that share its fingerprint's links,
    or null if there is none. Other columns are not read.
    """
    own = cut_lineage(fingerprints(docs, id_col, text_col))
    distinct = cut_lineage(own.groupBy("fp").agg(F.min(id_col).alias("smallest")))
    grouped = connected_components(links(distinct.select("fp")), "a", "b")
    members = distinct.join(grouped.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp")
    )
    names = members.groupBy("component").agg(F.min("smallest").alias("component_id"))
    classes = members.join(names, "component").select("fp", "component_id")
    return own.join(classes, "fp").select(
        id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
