"""Benchmark passages in documents: MinHash containment search, then exact containment.

Only DataFrame functions. Five consecutive words form a shingle. An item's MinHash under a random
order is one of its shingles, each as likely as any other; if a document holds the share t of an
item's shingles, it holds a given minimum with probability t. Items are partitioned by size, and
each partition takes as many smallest shingles as it needs for a miss to be impossible or below
(1 - t) ** 9. Documents are far longer than items, so their own minima would say nothing; instead
every shingle of a document is looked up among the items' minima, where it lies. Only documents that
hit are read again, to count how much of the item they really hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lamina.llm.common import free_name
from lamina.session import cut_lineage

WORDS = 5
CONTAINMENT = 0.8
MOST_MINIMA = 9
BROADCAST_ROWS = 1_000_000  # ids of documents that hit; beyond that many they are shuffled

_NO_WORD = "[^0-9a-z\\x{80}-\\x{10FFFF}]+"


def _row_hash(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col), F.col(text_col))


def shingles(df: DataFrame, keys: list[str], text_col: str) -> DataFrame:
    """``keys`` and ``shingle``, a hash of five consecutive words, for every place in the texts."""
    words = F.split(F.trim(F.regexp_replace(F.lower(text_col), _NO_WORD, " ")), " ")
    split = df.select(*keys, words.alias("w"))
    shifted = [F.slice("w", F.lit(i + 1), F.size("w")).alias(f"w{i}") for i in range(1, WORDS)]
    rows = split.filter(F.size("w") >= WORDS).select(*keys, F.explode(F.arrays_zip(F.col("w").alias("w0"), *shifted)).alias("s"))
    return rows.filter(F.col(f"s.w{WORDS - 1}").isNotNull()).select(
        *keys, F.xxhash64(*[F.col(f"s.w{i}") for i in range(WORDS)]).alias("shingle")
    )


def _item_shingles(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """(item, shingle, n): distinct shingles of each item, and how many it has."""
    keyed = benchmark.select(F.col(item_col).alias("item"), F.col(text_col).alias("text")).filter("item is not null")
    distinct = shingles(keyed, ["item"], "text").distinct()
    return distinct.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("item")))


def _minima(items: DataFrame, containment: float) -> DataFrame:
    """(item, shingle): the smallest shingles of each item in a random order.

    Partition p holds items of 2^p to 2^(p+1) - 1 shingles. One minimum more than a document may
    lack, at the partition's upper size, makes a miss impossible; nine make it improbable.
    """
    upper = F.pow(F.lit(2.0), F.floor(F.log2("n")) + 1) - 1
    lacking = F.floor(upper * (1 - containment) + 1e-9)
    order = Window.partitionBy("item").orderBy(F.xxhash64(F.lit("order"), "shingle"), "shingle")
    return (
        items.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= F.least(F.lit(MOST_MINIMA), lacking + 1))
        .select("item", "shingle")
    )


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", containment: float = CONTAINMENT,
) -> DataFrame:
    """(row_hash, id, item, n_shared, n_item): documents that hold at least ``containment`` of an item.

    Words are runs of digits, a-z and all characters beyond ASCII, in lower case. A null or empty
    text, or one of fewer than five words, holds nothing; such an item is held by nothing, and rows
    without an item id are left out. Rows equal in id and text are one document, rows that repeat
    an item id are one item. Other columns are not read.
    """
    items = cut_lineage(_item_shingles(benchmark, item_col, item_text_col))
    minima = cut_lineage(_minima(items, containment))  # written, so that its size is known
    keyed = docs.select(
        _row_hash(id_col, text_col).alias("row_hash"), F.col(id_col).alias("id"), F.col(text_col).alias("text")
    )
    hits = cut_lineage(
        shingles(keyed, ["row_hash"], "text").join(minima, "shingle").select("row_hash", "item").distinct()
    )
    ids = hits.select("row_hash").distinct()
    few = ids.count() <= BROADCAST_ROWS
    again = keyed.join(F.broadcast(ids) if few else ids, "row_hash", "left_semi")
    shared = (
        shingles(again, ["row_hash", "id"], "text").join(items, "shingle").distinct()
        .groupBy("row_hash", "id", "item").agg(F.count(F.lit(1)).alias("n_shared"), F.first("n").alias("n_item"))
    )
    return shared.join(hits, ["row_hash", "item"], "left_semi").filter(
        F.col("n_shared") >= containment * F.col("n_item") - 1e-9
    ).select("row_hash", "id", "item", "n_shared", "n_item")


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs``, all columns, without the documents that ``contaminated`` names."""
    found = cut_lineage(contaminated(docs, benchmark, id_col, text_col, **options).select("row_hash").distinct())
    own, name = _row_hash(id_col, text_col), free_name(docs, "row_hash")
    return docs.join(found.withColumnRenamed("row_hash", name), own == F.col(name), "left_anti")
