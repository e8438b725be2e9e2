"""Append-only log of finished loads: watermark state, publish pointer and run metrics in one.

Every load writes its own ``load_id=<n>`` directory first and appends its log row last. Readers
take only directories named in the log, so a load that died half-way is invisible, and running it
again overwrites its own directory. The newest row of a table is its state; nothing is updated in
place, hence nothing can be torn.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T

from lamina.operators.dedup import keep_latest
from lamina.session import path_exists

SCHEMA = (
    "stage string, source string, dataset string, load_id long, mode string, "
    "watermark_column string, watermark_value string, watermark_type string, "
    "rows_in long, rows_out long, schema_json string, committed_at timestamp"
)


@dataclass(frozen=True)
class Commit:
    stage: str
    source: str
    dataset: str
    load_id: int
    mode: str
    watermark_column: str | None = None
    watermark_value: str | None = None
    watermark_type: str | None = None
    rows_in: int | None = None
    rows_out: int | None = None
    schema_json: str | None = None


PARTITIONS = ("stage", "source", "dataset")


class CommitLog:
    """The log below ``path``, one folder per dataset."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _read(self, *paths: str) -> DataFrame:
        there = [p for p in paths if path_exists(self.spark, p)]
        if not there:
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).option("basePath", self.path).parquet(*there)

    def append(self, commit: Commit) -> None:
        # One row in one file: the file appears under its final name only when it is complete.
        values = {**asdict(commit), "committed_at": datetime.now(timezone.utc)}
        fields = T.StructType.fromDDL(SCHEMA).fields
        one = self.spark.range(0, 1, 1, 1).select(
            *[
                F.lit(values[f.name]).cast(f.dataType).alias(f.name)
                for f in fields if f.name not in PARTITIONS
            ]
        )
        # Straight into the dataset's own folder, so commits of several tables at a time
        # do not share a folder for unfinished files.
        one.write.mode("append").parquet(self._folder(commit.stage, commit.source, commit.dataset))

    def _folder(self, stage: str, source: str, dataset: str) -> str:
        return f"{self.path}/stage={stage}/source={source}/dataset={dataset}"

    def history(self) -> DataFrame:
        """All commits; the run metrics of every stage."""
        return self._read(self.path)

    def commits(self, stage: str, source: str, dataset: str) -> list[Row]:
        """Commits of one dataset, oldest first: one small row per load."""
        rows = self._read(self._folder(stage, source, dataset)).collect()
        return sorted(rows, key=lambda r: (r["load_id"], r["committed_at"]))

    def live(self, stage: str, source: str, dataset: str) -> list[Row]:
        """Loads that make up the dataset now: the last full load and all increments after it."""
        rows: list[Row] = []
        for row in self.commits(stage, source, dataset):
            if row["mode"] == "full":
                rows = []
            if row["mode"] != "reset":
                rows.append(row)
        return rows

    def latest(self, stage: str, source: str, dataset: str) -> Row | None:
        rows = self.commits(stage, source, dataset)
        return rows[-1] if rows else None

    def next_load_id(self, stage: str, source: str, dataset: str) -> int:
        last = self.latest(stage, source, dataset)
        return 1 if last is None else last["load_id"] + 1

    def load_ids(self, stage: str, source: str, dataset: str) -> list[int]:
        return list(dict.fromkeys(r["load_id"] for r in self.live(stage, source, dataset)))

    def reset(self, stage: str, source: str, dataset: str) -> None:
        """Forget the watermark; the next load takes everything and replaces what was there."""
        self.append(
            Commit(stage, source, dataset, self.next_load_id(stage, source, dataset), "reset")
        )

    def watermarks(self) -> DataFrame:
        """Newest watermark of every table."""
        newest = keep_latest(
            self.history(), ["stage", "source", "dataset"], ["load_id", "committed_at"]
        )
        return newest.select(
            "stage", "source", "dataset", "load_id",
            "watermark_column", "watermark_value", "watermark_type",
        )


def encode_watermark(value, data_type: T.DataType) -> tuple[str, str]:
    """Text and type of a watermark; instants as UTC microseconds, independent of time zones."""
    if isinstance(data_type, T.TimestampType):
        micros = round(value.timestamp() * 1_000_000)
        return str(micros), "timestamp_micros"
    return str(value), data_type.simpleString()


def decode_watermark(value: str, type_name: str):
    """The watermark as a literal Column of its original type."""
    if type_name == "timestamp_micros":
        return F.timestamp_micros(F.lit(int(value)))
    return F.lit(value).cast(type_name)
