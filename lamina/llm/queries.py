"""The operators as queries over the supplied tables, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lamina.llm import ann, decontaminate, fptree, hardneg, langid, licenses, linededup, mixing, packing, pii, pitmanyor, quality, simhash
from lamina.llm.common import crc_mod, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


@query("op2_license_scan")
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_spans(table(spark, sf_dir, "documents"))


@query("op5_pii")
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(table(spark, sf_dir, "documents"))
    name = lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])
    base = F.filter("found", lambda x: x["kind"].isin(*pii.BASE_KINDS))
    count = lambda kind: F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in pii.BASE_KINDS],
        F.sha2(F.concat_ws(",", F.transform(base, name)), 256).alias("base_sha256"),
        F.concat_ws(",", F.transform("found", name)).alias("spans"),
        F.coalesce(F.array_max(F.transform("found", lambda x: x["score"])), F.lit(0.0)).alias("max_score"),
    )


@query("op7_language_id")
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_mod("doc_id", 5) == 0
    model = langid.train(docs.filter(~held_out))
    return langid.identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query("op9_quality")
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = crc_mod("doc_id", 5) == 0
    model = quality.train(docs, labels.filter(~held_out))
    return quality.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query("op10_simhash")
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op4_line_dedup")
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = linededup.dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.md5(F.col("text").cast("binary")).alias("text_md5"))


_WORDS_SQL = r"""regexp_extract_all(lower(text), '[0-9a-z\x{80}-\x{10FFFF}]+')"""
CONTAMINATED_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS_SQL} AS w FROM documents),
b AS (SELECT item_id, {_WORDS_SQL} AS w FROM benchmark WHERE item_id IS NOT NULL),
ds AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) AS s FROM d),
bs AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) AS s FROM b),
sizes AS (SELECT item_id, count(*) AS n_item FROM bs GROUP BY item_id)
SELECT doc_id, item_id, count(*) AS n_shared, any_value(n_item) AS n_item, count(*) / any_value(n_item) AS containment
FROM ds JOIN bs USING (s) JOIN sizes USING (item_id)
GROUP BY doc_id, item_id HAVING count(*) >= 0.8 * any_value(n_item) - 1e-9
"""


@query("op8_decontamination", CONTAMINATED_SQL)
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "n_shared", "n_item",
        (F.col("n_shared") / F.col("n_item")).alias("containment"),
    )


@query("op6_mixing", mixing.mix_sql("documents"))
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


@query("op1_nearest")
def op1_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op3_pitman_yor")
def op3_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitmanyor.score_texts(table(spark, sf_dir, "documents"), crc_mod("doc_id", 7) == 2)


@query("op12_packing")
def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query("op13_hard_negatives", hardneg.hard_negatives_sql("embeddings"))
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=moved)


@query("op11_ranked_search", fptree.search_sql("documents", "benchmark"))
def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fptree.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
