"""Session settings and the few facts about a session that operators need."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from threading import Lock

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "lamina", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on and UTC time; ``conf`` adds or overrides settings."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.aggregatePushdown": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def broadcast_limit(spark: SparkSession) -> int:
    """The session's automatic broadcast threshold in bytes (-1 when it is switched off)."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if text.strip().startswith("-"):
        return -1
    return int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text))


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's own size estimate of ``df``; None where the session cannot tell."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except AttributeError:
        return None


def fits_broadcast(df: DataFrame, limit: int | None = None) -> bool:
    """True when the estimated size of ``df`` is within the session's broadcast threshold."""
    if limit is None:
        limit = broadcast_limit(df.sparkSession)
    size = estimated_bytes(df)
    return size is not None and size <= limit


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local master may fall back to a temporary folder; on a cluster a missing
    setting is an error, because a machine-local folder would not survive a lost executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lamina-checkpoint-"))
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


def fresh_dir(spark: SparkSession, prefix: str) -> str:
    """A new, not yet existing path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{prefix}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def remove_dir(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the shared storage, whatever file system it is on."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


_steps: list[str] = []  # copies that may still be read


# Shuffle files go when the query that wrote them ends, not when the driver happens to collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


_lock = Lock()
_writes: dict[int, tuple[int, str | None]] = {}  # by session: writes under way, the setting before the first


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """What is written inside leaves no shuffle files. Threads may write side by side: the setting goes back
    with the last of them."""
    key, conf = spark._jsparkSession.hashCode(), spark.conf
    with _lock:
        n, before = _writes.get(key) or (0, conf.get(_CLEANUP, None))
        _writes[key] = (n + 1, before)
        conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        with _lock:
            n, before = _writes.pop(key)
            if n > 1:
                _writes[key] = (n - 1, before)
            else:
                conf.unset(_CLEANUP) if before is None else conf.set(_CLEANUP, before)


def _written(df: DataFrame, **options) -> tuple[str, DataFrame]:
    path = fresh_dir(df.sparkSession, "step")
    with shuffles_dropped(df.sparkSession):
        df.write.options(**options).parquet(path)
    _steps.append(path)
    return path, df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame, **options) -> DataFrame:
    """``df`` written to the shared folder, with these writer options, and read back.

    Later steps start from files every executor can read, and Catalyst knows their real size. The
    copy stays until ``drop_steps``, because whoever got the frame may read it at any time.
    """
    return _written(df, **options)[1]


def step_copies() -> set[str]:
    """The copies there are now."""
    return set(_steps)


def drop_steps(spark: SparkSession, but: set[str] = frozenset()) -> int:
    """Deletes copies made by ``cut_lineage``, except ``but``; for the end of a job that made them.
    Returns their number."""
    paths = [p for p in _steps if p not in but]
    for path in paths:
        remove_dir(spark, path)
        _steps.remove(path)
    return len(paths)


class StepFolder:
    """Copies of an iteration's rounds, of which only the newest is kept."""

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._paths: list[str] = []

    def cut(self, df: DataFrame) -> DataFrame:
        path, copy = _written(df)
        self._paths.append(path)
        return copy

    def drop_older(self) -> None:
        for path in self._paths[:-1]:
            remove_dir(self._spark, path)
            _steps.remove(path)
        self._paths = self._paths[-1:]
