"""Copies leave no shuffle files behind, and the session's settings as they were."""

import time
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from lamina.session import _CLEANUP, cut_lineage
from lamina.sources import files


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_copies_leave_no_shuffle_files(spark):
    before, setting = _shuffle_files(spark), spark.conf.get(_CLEANUP, None)
    copy = cut_lineage(spark.range(10_000).repartition(5).groupBy((F.col("id") % 100).alias("k")).count())
    for _ in range(50):
        if not _shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not _shuffle_files(spark) - before and spark.conf.get(_CLEANUP, None) == setting
    assert copy.count() == 100


def test_written_layers_leave_no_shuffle_files(spark, folder):
    """Also where several threads write at a time; the session's setting is as before."""
    before, setting = _shuffle_files(spark), spark.conf.get(_CLEANUP, None)

    def write(i):
        files.write_parquet(spark.range(1000).repartition(4 + i).groupBy((F.col("id") % 10).alias("k")).count(), f"{folder}/{i}")

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(write, range(6)))
    for _ in range(50):
        if not _shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not _shuffle_files(spark) - before and spark.conf.get(_CLEANUP, None) == setting
