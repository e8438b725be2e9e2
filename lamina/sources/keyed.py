"""A stored table of current rows, hashed by key into buckets.

Each load rewrites only the buckets that hold one of its keys; a reader takes every bucket's newest
folder from the log and needs no window. A log entry is a small file that names the folder of each bucket.
It is created only if its number is free, so of two writers at a time one wins and the other merges
again into what the winner left. Data files are never changed in place.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from lamina.operators.dedup import keep_latest
from lamina.session import cut_lineage, path_exists, remove_dir

BUCKETS = 64
_BUCKET, _LOAD = "__bucket", "__load"


@dataclass(frozen=True)
class TableState:
    """One log entry: the folder of every bucket that has rows, and rows erased by it, per bucket."""

    version: int = 0
    folders: dict[int, str] = field(default_factory=dict)
    schema: str | None = None
    erased: dict[int, int] = field(default_factory=dict)


class KeyedTable:
    """The table below ``path``. ``buckets`` must not change once it has rows; choose it so that a bucket
    (rows / buckets) fits a task."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], newest_by: Sequence[str] = (), buckets: int = BUCKETS):
        self.spark, self.path = spark, path.rstrip("/")
        self.keys, self.newest_by, self.buckets = list(keys), list(newest_by), buckets

    # ------------------------------------------------------------ log

    def _entry(self, version: int) -> str:
        return f"{self.path}/_log/{version:012d}.json"

    def _fs(self, path: str):
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()), target

    def state(self) -> TableState:
        """The newest complete entry; one that is still being written does not count."""
        folder = f"{self.path}/_log"
        if not path_exists(self.spark, folder):
            return TableState()
        fs, target = self._fs(folder)
        names = sorted((f.getPath().getName() for f in fs.listStatus(target)), reverse=True)
        for name in (n for n in names if n.endswith(".json")):
            _, entry = self._fs(f"{folder}/{name}")
            stream = fs.open(entry)
            try:
                text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            try:
                found = json.loads(text)
            except ValueError:
                continue
            numbered = lambda key: {int(b): v for b, v in found[key].items()}
            return TableState(found["version"], numbered("folders"), found["schema"], numbered("erased"))
        return TableState()

    def _commit(self, state: TableState) -> bool:
        """True if the entry's number was free and the entry is written."""
        fs, target = self._fs(self._entry(state.version))
        text = json.dumps({"version": state.version, "folders": state.folders, "schema": state.schema, "erased": state.erased})
        try:
            stream = fs.create(target, False)
        except Exception as wrong:  # py4j's error, or Spark's, for a file that is there
            if path_exists(self.spark, self._entry(state.version)):
                return False
            raise wrong
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        return True

    # ------------------------------------------------------------ rows

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in self.keys]), F.lit(self.buckets)).cast("int")

    def _folders(self, state: TableState, wanted: Sequence[int] | None = None) -> list[str]:
        held = state.folders if wanted is None else {b: state.folders[b] for b in wanted if b in state.folders}
        return [f"{self.path}/{folder}/{_BUCKET}={b}" for b, folder in sorted(held.items())]

    def _rows(self, state: TableState, wanted: Sequence[int] | None = None) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(state.schema)) if state.schema else T.StructType()
        paths = self._folders(state, wanted)
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def read(self) -> DataFrame:
        """The current rows: one per key."""
        return self._rows(self.state())

    def _write(self, rows: DataFrame) -> tuple[str, set[int]]:
        """Writes rows, already dealt by bucket, to a folder of their own; the buckets that got rows."""
        folder = f"data/{uuid.uuid4().hex}"
        rows.write.partitionBy(_BUCKET).parquet(f"{self.path}/{folder}")
        fs, target = self._fs(f"{self.path}/{folder}")
        names = [f.getPath().getName() for f in fs.listStatus(target)]
        return folder, {int(n.split("=")[1]) for n in names if n.startswith(f"{_BUCKET}=")}

    def upsert(self, delta: DataFrame) -> TableState:
        """Merge rows in: of the versions of a key the newest stays, of equally new ones that of the
        later load. Rows that came late and are older change nothing."""
        keyed = keep_latest(delta.withColumn(_BUCKET, self._bucket()), [_BUCKET, *self.keys], self.newest_by)
        fresh = cut_lineage(keyed)
        touched = [r[_BUCKET] for r in fresh.select(_BUCKET).distinct().collect()]  # at most one per bucket
        while True:
            before = self.state()
            schema, merged = fresh.drop(_BUCKET).schema, fresh.withColumn(_LOAD, F.lit(1))
            if self._folders(before, touched):
                old = self._rows(before, touched).withColumn(_BUCKET, self._bucket()).withColumn(_LOAD, F.lit(0))
                merged = old.unionByName(merged, allowMissingColumns=True)
                schema = merged.drop(_BUCKET, _LOAD).schema
            elif before.schema:
                known = self.spark.createDataFrame([], T.StructType.fromJson(json.loads(before.schema)))
                schema = known.unionByName(fresh.drop(_BUCKET), allowMissingColumns=True).schema
            dealt = merged.repartition(_BUCKET)  # the window below needs no other shuffle
            newest = keep_latest(dealt, [_BUCKET, *self.keys], [*self.newest_by, _LOAD]).drop(_LOAD)
            folder, filled = self._write(newest)
            after = TableState(before.version + 1, before.folders | dict.fromkeys(filled, folder), schema.json())
            if self._commit(after):
                return after
            remove_dir(self.spark, f"{self.path}/{folder}")  # another writer was first; merge into its rows

    def erase(self, due: DataFrame) -> TableState:
        """Remove the keys of ``due`` for good: buckets that hold one are rewritten, their old folders deleted.

        The log entry keeps the number of rows removed from each bucket as proof. Readers of
        earlier states fail from then on, as they must.
        """
        gone = cut_lineage(due.select(*self.keys).distinct().withColumn(_BUCKET, self._bucket()))
        asked = [r[_BUCKET] for r in gone.select(_BUCKET).distinct().collect()]
        same = lambda a, b: reduce(Column.__and__, [a[k].eqNullSafe(b[k]) for k in self.keys])
        while True:
            before = self.state()
            if not self._folders(before, asked):
                return before
            held = self._rows(before, asked).withColumn(_BUCKET, self._bucket())
            found = held.join(gone.drop(_BUCKET), same(held, gone), "left_semi").groupBy(_BUCKET).agg(F.count(F.lit(1)).alias("n"))
            erased = {r[_BUCKET]: r["n"] for r in found.collect()}
            if not erased:
                return before
            old = self._rows(before, list(erased)).withColumn(_BUCKET, self._bucket())
            kept = old.join(gone.drop(_BUCKET), same(old, gone), "left_anti").repartition(_BUCKET)
            folder, filled = self._write(kept)
            folders = {b: f for b, f in before.folders.items() if b not in erased} | dict.fromkeys(filled, folder)
            after = TableState(before.version + 1, folders, before.schema, erased)
            if self._commit(after):
                for path in self._folders(before, list(erased)):
                    remove_dir(self.spark, path)
                return after
            remove_dir(self.spark, f"{self.path}/{folder}")

    def vacuum(self) -> int:
        """Delete bucket folders the newest state does not name; for times without readers of older ones
        and without writers. Returns their number."""
        kept, n = set(self._folders(self.state())), 0
        data = f"{self.path}/data"
        if not path_exists(self.spark, data):
            return 0
        fs, target = self._fs(data)
        for folder in fs.listStatus(target):
            for bucket in fs.listStatus(folder.getPath()):
                path = f"{data}/{folder.getPath().getName()}/{bucket.getPath().getName()}"
                if bucket.getPath().getName().startswith(f"{_BUCKET}=") and path not in kept:
                    remove_dir(self.spark, path)
                    n += 1
        return n
