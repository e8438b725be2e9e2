"""Landing of source tables in the bronze layer, in full or by watermark."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, Observation, Row, SparkSession, functions as F, types as T

from lamina.operators.dedup import keep_latest
from lamina.operators.masking import MaskingRule, apply_masking
from lamina.sources import catalogue, files, jdbc
from lamina.sources.commitlog import Commit, CommitLog, decode_watermark, encode_watermark
from lamina.sources.layout import layer_path, load_path, raw_table_path

LOAD = "__load"  # the load a row came with


@dataclass(frozen=True)
class Source:
    """One configured source. ``tables`` hold ``name`` and, where they apply, ``query``,
    ``incremental_column``, ``source_file_pattern``, ``split_column``, ``partitions``,
    ``inclusive`` and ``keys``: what tells rows apart, so that of several versions of a row the
    newest counts."""

    name: str
    type: str
    connection: Mapping[str, Any]
    tables: Sequence[Mapping[str, Any]] = field(default_factory=list)

    @classmethod
    def from_config(cls, config: Mapping[str, Any]) -> "Source":
        return cls(config["name"], config["type"], config["connection"], config.get("tables", []))


# ---------------------------------------------------------------- readers by source type


def _read_jdbc(target: jdbc.JdbcTarget, spark: SparkSession, table: Mapping) -> DataFrame:
    return jdbc.read_query(
        spark, target, table["query"], table.get("split_column"), table.get("partitions")
    )


def _read_sql_server(spark, source: Source, table) -> DataFrame:
    return _read_jdbc(jdbc.sql_server_target(source.connection["dsn"]), spark, table)


def _read_postgres(spark, source: Source, table) -> DataFrame:
    return _read_jdbc(jdbc.postgres_target(source.connection["conn_str"]), spark, table)


def _read_raw_lake(spark, source: Source, table) -> DataFrame:
    base = source.connection["source_storage_path"]
    path = raw_table_path(base, table["name"], table.get("source_file_pattern"))
    return files.read_raw(spark, path)


READERS: dict[str, Callable[[SparkSession, Source, Mapping], DataFrame]] = {
    "azure_sql": _read_sql_server,
    "postgres": _read_postgres,
    "sap_b1": _read_raw_lake,
}


def read_source(spark: SparkSession, source: Source, table: Mapping[str, Any]) -> DataFrame:
    try:
        reader = READERS[source.type]
    except KeyError:
        raise ValueError(f"Unsupported source type {source.type}") from None
    return reader(spark, source, table)


def source_masking(source: Source, table: Mapping[str, Any]) -> MaskingRule | None:
    """Masking applies to raw-lake tables, unless the source switches it off."""
    if source.type == "sap_b1" and source.connection.get("apply_gdpr", True):
        return catalogue.masking_rule(table["name"])
    return None


# ---------------------------------------------------------------- delta and watermark


def delta_since(
    df: DataFrame, column: str, last: tuple[str, str] | None, inclusive: bool = False
) -> DataFrame:
    """Rows newer than the watermark ``last`` (text, type); all rows when there is none.

    The comparison is with a literal of the column's own type, so it reaches the Parquet or JDBC
    scan. ``inclusive`` takes rows equal to the watermark again: right for day-grain columns, with
    a keep-latest by key downstream.
    """
    if last is None:
        return df
    bound = decode_watermark(*last)
    return df.filter(F.col(column) >= bound if inclusive else F.col(column) > bound)


def watermark_of(df: DataFrame, column: str) -> DataFrame:
    """One row with the largest value of ``column``, NULL for no rows."""
    return df.agg(F.max(column).alias("watermark"))


def land_table(
    spark: SparkSession,
    source: Source,
    table: Mapping[str, Any],
    root: str,
    log: CommitLog,
    df: DataFrame | None = None,
) -> Commit:
    """Land one table: filter, mask and write in one pass, then commit.

    The new watermark is the maximum of the rows this load wrote, observed while writing, so rows
    arriving meanwhile belong to the next load. An empty or all-NULL delta leaves it unchanged.
    """
    name, column = table["name"], table.get("incremental_column")
    state = log.latest("bronze", source.name, name)
    load_id = 1 if state is None else state["load_id"] + 1
    last = None
    if column and state is not None and state["watermark_value"] is not None:
        last = (state["watermark_value"], state["watermark_type"])

    rows = read_source(spark, source, table) if df is None else df
    seen = Observation(f"landing_{source.name}_{name}_{load_id}")
    metrics = [F.count(F.lit(1)).alias("rows")]
    if column:
        rows = delta_since(rows, column, last, table.get("inclusive", False))
        metrics.append(F.max(column).alias("watermark"))
    masked = apply_masking(rows.observe(seen, *metrics), source_masking(source, table))
    target = load_path(layer_path(root, "bronze", source.name, name), load_id)
    files.write_parquet(masked, target)

    found = seen.get
    newest = found.get("watermark") if column else None
    value, type_name = last if last else (None, None)
    if newest is not None:
        value, type_name = encode_watermark(newest, rows.schema[column].dataType)
    commit = Commit(
        "bronze", source.name, name, load_id, "incremental" if last else "full",
        column, value, type_name, found["rows"], found["rows"], masked.schema.json(),
    )
    log.append(commit)
    return commit


def land_all(
    spark: SparkSession, sources: Sequence[Source], root: str, log: CommitLog, parallel: int = 4
) -> list[Commit]:
    """Land every table of every source, some at a time so that small tables do not idle the
    cluster. The first failure is raised after the loads already running have ended."""
    wanted = [(s, t) for s in sources for t in s.tables]
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        return list(pool.map(lambda pair: land_table(spark, *pair, root, log), wanted))


def read_loads(spark: SparkSession, root: str, loads: Sequence[Row], numbered: bool = False) -> DataFrame:
    """Rows of the given loads (rows of the log) of one dataset; columns of all of them.

    Loads are read with the schemas in the log, all loads of one schema together, so no file is
    opened to find out its columns. ``numbered`` adds the load of each row as ``LOAD``.
    """
    if not loads:
        raise FileNotFoundError("nothing committed")
    first = loads[0]
    base = layer_path(root, first["stage"], first["source"], first["dataset"])
    by_schema: dict[str, list[str]] = {}
    for row in loads:
        by_schema.setdefault(row["schema_json"], []).append(load_path(base, row["load_id"]))
    frames = []
    for schema, paths in by_schema.items():
        kind = T.StructType.fromJson(json.loads(schema)) if schema else None
        frame = files.read_parquet(spark, list(dict.fromkeys(paths)), kind, merge_schema=kind is None)
        if numbered:
            place = F.regexp_extract(F.col("_metadata.file_path"), r"/load_id=(\d+)/[^/]*$", 1)
            frame = frame.select("*", place.cast("long").alias(LOAD))
        frames.append(frame)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def current_rows(
    spark: SparkSession, root: str, loads: Sequence[Row], keys: Sequence[str], newest_by: Sequence[str] = ()
) -> DataFrame:
    """Newest version of every key over the given loads: by ``newest_by``, then by the later load."""
    rows = read_loads(spark, root, loads, numbered=True)
    known = [c for c in newest_by if c in rows.columns]
    return keep_latest(rows, keys, [*known, LOAD]).drop(LOAD)


def read_dataset(
    spark: SparkSession, root: str, log: CommitLog, stage: str, source: str, dataset: str
) -> DataFrame:
    """Committed rows of a dataset: its last full load and every increment after it."""
    return read_loads(spark, root, log.live(stage, source, dataset))


def current_view(
    spark: SparkSession, root: str, log: CommitLog, source: str, table: str, keys: Sequence[str],
    newest_by: Sequence[str], stage: str = "bronze",
) -> DataFrame:
    """Newest version of every key over all committed loads of a dataset."""
    return current_rows(spark, root, log.live(stage, source, table), keys, newest_by)


def compact(
    spark: SparkSession,
    root: str,
    log: CommitLog,
    source: str,
    table: str,
    keys: Sequence[str],
    newest_by: Sequence[str],
    stage: str = "bronze",
) -> Commit:
    """Replace the loads of a table by one full load of its current view; the watermark stays.

    Keeps the number of files and of superseded rows in check when increments are frequent.
    """
    last = log.latest(stage, source, table)
    rows = current_view(spark, root, log, source, table, keys, newest_by, stage)
    load_id = last["load_id"] + 1
    target = load_path(layer_path(root, stage, source, table), load_id)
    files.write_parquet(rows, target)
    n = files.read_parquet(spark, target).count()
    commit = Commit(
        stage, source, table, load_id, "full", last["watermark_column"],
        last["watermark_value"], last["watermark_type"], n, n, rows.schema.json(),
    )
    log.append(commit)
    return commit
