"""Incremental landing of files as a stream that ends when it has caught up.

The stream's checkpoint remembers which files were read, so it replaces the watermark state for
file sources. There is no event-time logic and no state beyond that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from lamina.operators.masking import MaskingRule, apply_masking
from lamina.sources.commitlog import Commit, CommitLog
from lamina.sources.layout import layer_path, load_path


def land_new_files(
    spark: SparkSession,
    source_dir: str,
    schema: T.StructType,
    root: str,
    source: str,
    table: str,
    checkpoint: str,
    log: CommitLog,
    rule: MaskingRule | None = None,
    file_glob: str = "*.parquet",
    files_per_batch: int = 10_000,
) -> int:
    """Land all files that appeared since the last call; returns the number of batches run.

    Each micro-batch owns one load directory and replaces it, and becomes visible by one row in the
    commit log. A batch that is repeated after a failure does not land or commit its rows twice.
    """
    stream = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", file_glob)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(source_dir)
    )
    target = layer_path(root, "bronze", source, table)
    batches = []

    def write(batch: DataFrame, batch_id: int) -> None:
        load_id = batch_id + 1
        masked = apply_masking(batch, rule)
        masked.write.mode("overwrite").parquet(load_path(target, load_id))
        if load_id not in log.load_ids("bronze", source, table):
            n = spark.read.schema(masked.schema).parquet(load_path(target, load_id)).count()
            log.append(
                Commit(
                    "bronze", source, table, load_id, "incremental", rows_in=n, rows_out=n,
                    schema_json=masked.schema.json(),
                )
            )
        batches.append(batch_id)

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return len(batches)
