"""What several of the operators share: reading a table, running over texts in bounded batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lamina.session import cut_lineage, drop_steps, step_copies

CHUNK_BYTES = 1 << 20  # texts handled together by one numpy step; a longer text is a chunk of its own
BATCH_ROWS = 1000      # rows that travel to a Python worker together


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(column: str, n: int) -> Column:
    """crc32 of the value as text, modulo ``n``; a null value counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % n


def free_name(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def settled(df: DataFrame, before: set[str]) -> DataFrame:
    """A written copy of ``df``; other copies made since there were ``before`` are deleted."""
    made = step_copies() - before
    copy = cut_lineage(df)
    drop_steps(df.sparkSession, step_copies() - made)
    return copy


def text_chunks(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts as UTF-8) for runs of rows of about CHUNK_BYTES; null is the empty text."""
    texts = batch.column(column).cast(pa.large_binary())
    first, size, held = 0, 0, []
    for i in range(len(texts)):
        text = texts[i].as_py() or b""
        if held and size + len(text) > CHUNK_BYTES:
            yield first, held
            first, size, held = i, 0, []
        held.append(text)
        size += len(text)
    if held:
        yield first, held


def map_batches(df: DataFrame, function: Callable, schema: str, rows: int = BATCH_ROWS) -> DataFrame:
    """``function(batch) -> dict of columns`` over Arrow batches small enough for long texts.

    The session's batch size is set because one batch of its default 10,000 rows of long texts
    would not fit a worker.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    target = pa_schema(schema)

    def run(batches):
        for batch in batches:
            for columns in function(batch):
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, target)],
                    schema=target,
                )

    return df.mapInArrow(run, schema)


def map_slices(df: DataFrame, function: Callable, schema: str, rows: int = BATCH_ROWS) -> DataFrame:
    """Like ``map_batches``, with batches cut here and the session's settings left alone. Spark bounds
    the bytes of a batch by spark.sql.execution.arrow.maxBytesPerBatch."""
    target = pa_schema(schema)

    def run(batches):
        for batch in batches:
            for first in range(0, len(batch), rows):
                for columns in function(batch.slice(first, rows)):
                    yield pa.RecordBatch.from_arrays(
                        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, target)],
                        schema=target,
                    )

    return df.mapInArrow(run, schema)


def pa_schema(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def class_table(members: bytes | set[int]) -> np.ndarray:
    """A 256-entry lookup that is true for the given bytes."""
    out = np.zeros(256, dtype=bool)
    out[list(members)] = True
    return out


WORD_BYTES = class_table(set(range(0x30, 0x3A)) | set(range(0x61, 0x7B)) | set(range(0x80, 0x100)))
TOKEN_BYTES = class_table(set(range(256)) - {0x20, *range(0x09, 0x0E)})


def runs(data: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the maximal runs of bytes that ``inside`` marks."""
    mask = np.zeros(len(data) + 2, dtype=np.int8)
    mask[1:-1] = inside[data]
    step = np.diff(mask)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(n, base, dtype=np.uint64)
        steps[0] = 1
        have = _powers[base] = np.cumprod(steps)
    return have[:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of bytes: a polynomial in the bytes, by prefix sums, finalised."""
    n = len(data)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    size = max(n, CHUNK_BYTES + BATCH_ROWS + 2)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power_table(_BASE, size)[:n], out=sums[1:])
    value = (sums[ends] - sums[starts]) * _power_table(_BASE_INVERSE, size)[starts]
    return mix64(value + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
