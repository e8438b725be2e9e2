"""File scans and sinks."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lamina.session import shuffles_dropped


def read_parquet(
    spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None,
    partitioned: bool = True, merge_schema: bool = False,
) -> DataFrame:
    """Parquet scan of a file, a glob or a directory tree.

    A directory with ``column=value`` folders is read with partition discovery, so filters on
    those columns skip whole folders. ``partitioned=False`` takes every Parquet file at any depth.
    """
    reader = spark.read.option("mergeSchema", str(merge_schema).lower())
    if schema is not None:
        reader = reader.schema(schema)
    if not partitioned:
        reader = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    return reader.parquet(*([path] if isinstance(path, str) else path))


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """Raw extract: a glob or a ``.parquet`` path as given, any other path as a table root.

    ``**`` (any depth) is not a Spark glob, so it becomes a recursive read of the part before it.
    A glob below ``column=value`` folders keeps those columns through ``basePath``.
    """
    if "**" in path:
        return read_parquet(spark, path.split("**", 1)[0].rstrip("/"), partitioned=False)
    if "*" in path:
        base = path.split("*", 1)[0].rsplit("/", 1)[0]
        return spark.read.option("basePath", base).parquet(path)
    return read_parquet(spark, path)


def read_delimited(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """CSV or TSV with a header line; types are inferred unless a schema is given."""
    sep = "\t" if path.lower().rstrip("/").endswith(".tsv") else ","
    reader = spark.read.option("header", "true").option("sep", sep)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", "true").csv(path)


def read_any(
    spark: SparkSession, source: str | None = None, query: str | None = None
) -> DataFrame:
    """A file by its suffix, or the result of a query."""
    if query:
        return spark.sql(query)
    if not source:
        raise ValueError("Either source or query must be provided")
    suffix = source.lower().rsplit(".", 1)[-1]
    if suffix == "parquet":
        return read_parquet(spark, source)
    if suffix in ("csv", "tsv"):
        return read_delimited(spark, source)
    raise ValueError(f"Unsupported file format: .{suffix}")


def read_layer(spark: SparkSession, path: str, alias: str | None = None) -> DataFrame:
    """Parquet dataset, registered as a view when an alias is given."""
    df = read_parquet(spark, path)
    if alias:
        df.createOrReplaceTempView(alias)
    return df


def write_parquet(
    df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None,
    **options: Any,
) -> str:
    """Parquet sink. Rows keep the partitioning the plan gave them; zstd, unless the options name another codec.
    Shuffle files go with the end of the write."""
    writer = df.write.mode(mode).options(**{"compression": "zstd"} | options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with shuffles_dropped(df.sparkSession):
        writer.parquet(path)
    return path
