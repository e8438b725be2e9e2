"""A corpus cleaned in five stages: language, repeated lines, near duplicates, benchmark passages, mix.

Every stage takes (spark, docs, sf_dir) and works on all that the one before kept; all but the
last return the columns of ``docs``. ``run`` writes each stage's result to the session's shared
folder and reads it again for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lamina.llm import decontaminate, langid, linededup, mixing, simhash
from lamina.llm.common import crc_mod, free_name, table
from lamina.session import drop_steps, fresh_dir, remove_dir, step_copies

LEAST_SCORE = 0.5  # posterior below which a document's language counts as undetermined


def keep_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found; those without letters, or undecided, go.

    The model learns from the language column of the documents whose id's crc32 modulo 5 is not 0.
    A document goes by its id: rows that share one are judged together and stay if any of them
    does. Rows without an id stay.
    """
    model = langid.train(docs.filter(crc_mod("doc_id", 5) != 0))
    found = langid.identify(docs, model)
    good = F.max((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= LEAST_SCORE))
    rejected = found.groupBy("doc_id").agg(good.alias("good")).filter(~F.col("good"))
    return _without(docs, rejected.select("doc_id"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with one line left of each component of near-duplicate lines; ``n_chars`` follows.

    A document all of whose lines went is a copy and goes; one that had no line to lose stays.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")  # other columns meet no new names
    kept = linededup.dedup_lines(docs.select("doc_id", "text", whole))
    empty = (F.col("n_dropped") > 0) & (F.length(F.trim(F.regexp_replace("text", "\n", " "))) == 0)
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return kept.filter(~F.coalesce(empty, F.lit(False))).select(
        *[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns]
    )


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each SimHash component; rows without an id stay."""
    found = simhash.near_duplicates(docs)
    copies = found.groupBy("doc_id").agg(F.min("component_id").alias("first")).filter("first < doc_id")
    return _without(docs, copies.select("doc_id"))


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not hold 0.8 or more of a benchmark item."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The order of the documents that brings every source to its target weight."""
    return mixing.mix(docs)


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` without these ids. A null id matches nothing, so such rows stay."""
    gone = free_name(docs, "gone")
    return docs.join(ids.withColumnRenamed("doc_id", gone), F.col("doc_id") == F.col(gone), "left_anti")


STAGES = [
    ("language", keep_language),
    ("lines", drop_repeated_lines),
    ("near_duplicates", drop_near_duplicates),
    ("benchmark", drop_benchmark),
    ("mix", mix_sources),
]

# The first stage sums over segmentations and the third hashes in 64 bits: no DuckDB text says that.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents after all stages. Copies made on the way are deleted as soon as nothing reads them."""
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path, before = fresh_dir(spark, f"pipeline-{name}"), step_copies()
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        drop_steps(spark, before)
        if last is not None:
            remove_dir(spark, last)
        last = path
    return docs
