"""Packing documents into sequences of fixed length by exact complements, then by best fit.

What decides how pieces combine is only how many there are of each length, so the plan is made on
that histogram, which has at most ``capacity`` entries whatever the corpus. The longest length left
is completed by a single length, a pair or a triple whose sum fills its gap exactly, each
combination being used as often as the counts of its lengths allow. Lengths for which no such combination is
left go through best fit, whole groups of equal sequences at a time.

The plan gives each combination a run of sequences, and each of its places a run of ranks of one
length. Pieces are ranked within their length in blocks, so that no length needs one task, and look
their rank up in the plan.
"""

from __future__ import annotations

import gc
import os
import re
import string
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from lamina.llm.common import map_slices
from lamina.session import cut_lineage

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
CAPACITY = 1024
END_ID = 2
RANK_ROWS = 100_000     # pieces of one length that one task ranks
CACHED_CHUNKS = 1_200_000  # chunks of text a worker remembers the ids of
CACHED_CHARS = 64       # longest chunk that is remembered
LONG_CHUNK = 100_000    # characters from which a chunk without spaces is cut further

# A token of the byte-level vocabulary begins with a space or lies within a run of one kind of character, so
# the ids of a text are those of its chunks, cut before each space that follows something else than white space.
_UNSAFE = re.compile(r"[\s\u180e] ")
_SAFE_CUT = re.compile(r"(?<=[^\s\u180e])(?= )")
_LONG_CUT = re.compile("(?<=[A-Za-z0-9ぁ-ゖァ-ヺ一-龥])(?=[.,;:!?、。])")
_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
# Within a chunk a mark ends a run of letters, and a single line feed stands alone.
_LINE_CUT = re.compile(f"(?<=[{_LETTERS}.,;:!?])(?=\n)|(?<=[{_LETTERS}.,;:!?]\n)(?=[{_LETTERS}])")
_WORD = re.compile(f" ?[{_LETTERS}]+")  # one run, whatever stands beside it


def _byte_characters() -> dict[int, str]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves,
    the others for those from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(0x100 + n) for n, b in enumerate(hidden)}


_BYTE_CHARACTERS = _byte_characters()


class _Known(dict):
    """Ids of chunks, found when first asked for. With ``before`` a space, a chunk is asked for without it."""

    def __init__(self, tokenizer, before: str, plain: _Known | None):
        self._tokenizer, self._tokenize, self._before = tokenizer, tokenizer.model.tokenize, before
        self._plain = self if plain is None else plain

    def __missing__(self, chunk: str) -> bytes:
        ids = self._find(chunk)
        if len(chunk) <= CACHED_CHARS:
            self[chunk] = ids
        return ids

    def _find(self, chunk: str) -> bytes:
        whole = self._before + chunk
        if _WORD.fullmatch(whole):
            tokens = self._tokenize(whole.encode().decode("latin-1").translate(_BYTE_CHARACTERS))
            return struct.pack(f"<{len(tokens)}I", *[t.id for t in tokens])
        word = chunk.rstrip(string.punctuation)
        if 0 < len(word) < len(chunk) and _WORD.fullmatch(self._before + word):
            return self[word] + self._plain[chunk[len(word) :]]
        parts = _LINE_CUT.split(chunk) if "\n" in chunk else _LONG_CUT.split(chunk) if len(chunk) > LONG_CHUNK else ()
        if len(parts) > 1:
            return b"".join([self[parts[0]]] + [self._plain[p] for p in parts[1:]])
        ids = self._tokenizer.encode(whole, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)


class TokenIds:
    """Ids of texts by a tokenizer file, as bytes of little-endian unsigned 32-bit numbers."""

    def __init__(self, tokenizer_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker for each core
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(tokenizer_path)
        tokenizer.encode_special_tokens = True  # names of special tokens in a text are ordinary text
        self._plain = _Known(tokenizer, "", None)
        self._spaced = _Known(tokenizer, " ", self._plain)

    def of(self, text: str) -> bytes:
        if len(self._plain) + len(self._spaced) > CACHED_CHUNKS:
            self._plain.clear()
            self._spaced.clear()
        if not text:
            return b""
        plain, spaced = self._plain, self._spaced
        if _UNSAFE.search(text):
            return b"".join([spaced[c[1:]] if c[0] == " " else plain[c] for c in _SAFE_CUT.split(text)])
        words = text.split(" ")
        first = words[0]
        words[0] = ""
        out = [spaced[w] for w in words]
        out[0] = plain[first] if first else b""
        return b"".join(out)


_tokenizers: dict[str, TokenIds] = {}  # of this worker, which serves many tasks


def piece_bounds(length: int, capacity: int) -> Iterator[tuple[int, int]]:
    """(start, length) of the pieces of a document: only the first may be shorter than ``capacity``."""
    first = length if length <= capacity else (length - 1) % capacity + 1
    yield 0, first
    for start in range(first, length, capacity):
        yield start, capacity


def token_pieces(
    docs: DataFrame, tokenizer_path: str = TOKENIZER, capacity: int = CAPACITY, end_id: int = END_ID,
    id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False,
) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]): the tokens of every document in pieces of at most
    ``capacity``, each document ending with ``end_id``. Null counts as the empty text."""
    id_type = docs.schema[id_col].dataType.simpleString()
    end = struct.pack("<I", end_id)

    def cut(batch: pa.RecordBatch):
        if tokenizer_path not in _tokenizers:
            _tokenizers[tokenizer_path] = TokenIds(tokenizer_path)
        gc.disable()  # nothing here is cyclic, and the remembered chunks make each collection slow
        at, out = [], []
        for row, text in enumerate(batch.column(1)):
            ids = _tokenizers[tokenizer_path].of(text.as_py() or "") + end
            for n, (start, length) in enumerate(piece_bounds(len(ids) // 4, capacity)):
                own = ids[4 * start : 4 * (start + length)]
                at.append(row)
                out.append((n, start, length, zlib.crc32(own), own if keep_ids else None))
        gc.enable()
        n, start, length, crc, own = zip(*out) if out else ((),) * 5
        columns = [batch.column(0).take(pa.array(at, pa.int64())), n, start, length, crc]
        yield tuple(columns + ([[np.frombuffer(x, "<u4").astype(np.int32) for x in own]] if keep_ids else []))

    schema = f"id {id_type}, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if keep_ids else "")
    return map_slices(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), cut, schema)


@dataclass
class Plan:
    """Runs of ranks: from rank ``low`` on, ``times`` pieces of ``length`` go to the sequences from
    ``sequence`` on, one each, at ``offset``. Ordered by length and rank."""

    length: np.ndarray
    low: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int


@dataclass
class _Open:
    """Sequences begun by best fit, in groups of equal content by the room they have left."""

    groups: dict[int, list[tuple[tuple[int, ...], int]]] = field(default_factory=dict)

    def add(self, room: int, content: tuple[int, ...], times: int) -> None:
        if times:
            self.groups.setdefault(room, []).append((content, times))

    def tightest(self, length: int) -> int | None:
        return min((r for r in self.groups if r >= length), default=None)

    def take(self, room: int, most: int) -> tuple[tuple[int, ...], int]:
        content, times = self.groups[room].pop()
        used = min(times, most)
        if times > used:
            self.groups[room].append((content, times - used))
        elif not self.groups[room]:
            del self.groups[room]
        return content, used


class SumIndex:
    """Which singles, pairs and triples of the lengths still there have a given sum."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts

    def _times(self, lengths: tuple[int, ...]) -> int:
        return min(int(self.counts[x]) // lengths.count(x) for x in set(lengths))

    def _two(self, total: int, opened: tuple[int, ...]) -> tuple[int, ...] | None:
        """The pair of this sum with the longest member that is there besides ``opened``."""
        half = np.arange(total - 1, (total - 1) // 2, -1)
        for a in half[(self.counts[half] > 0) & (self.counts[total - half] > 0)]:
            pair = (int(a), total - int(a))
            if self._times(opened + pair):
                return pair
        return None

    def filling(self, opened: int) -> tuple[int, ...] | None:
        """A single, else a pair, else a triple that fills what ``opened`` leaves; longest member first."""
        gap = len(self.counts) - 1 - opened
        if gap == 0:
            return ()
        if self._times((opened, gap)):
            return (gap,)
        pair = self._two(gap, (opened,)) if gap > 1 else None
        if pair or gap < 3:
            return pair
        there = (self.counts[: gap + 1] > 0).astype(np.float64)
        size = 2 * len(there)
        pair_sums = np.rint(np.fft.irfft(np.fft.rfft(there, size) ** 2, size))[: gap + 1] > 0
        for a in range(gap - 2, (gap + 2) // 3 - 1, -1):
            if there[a] and pair_sums[gap - a] and self._times((opened, a)):
                pair = self._two(gap - a, (opened, a))
                if pair:
                    return (a, *pair)
        return None


def combinations(counts: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, times): sequences that hold the given number of pieces of each length. ``counts`` has an
    entry for each length from 0 to the capacity. The number of combinations depends on the capacity, not
    on the counts."""
    left = counts.astype(np.int64).copy()
    capacity = len(left) - 1
    index, out = SumIndex(left), []
    for opened in range(capacity, 0, -1):
        while left[opened]:
            others = index.filling(opened)
            if others is None:
                break
            whole = (opened, *others)
            times = index._times(whole)
            for x in whole:
                left[x] -= times
            out.append((whole, times))
    started = _Open()
    for length in range(capacity, 0, -1):
        n = int(left[length])
        while n:
            room = started.tightest(length)
            if room is not None:
                content, times = started.take(room, n)
                started.add(room - length, content + (length,), times)
                n -= times
                continue
            each = capacity // length
            started.add(capacity - each * length, (length,) * each, n // each)
            if n % each:
                started.add(capacity - n % each * length, (length,) * (n % each), 1)
            n = 0
    return out + [group for groups in started.groups.values() for group in groups]


def make_plan(counts: np.ndarray) -> Plan:
    used = np.zeros(len(counts), dtype=np.int64)
    rows, sequence = [], 0
    for lengths, times in combinations(counts):
        offset = 0
        for length in lengths:
            rows.append((length, used[length], sequence, offset))
            used[length] += times
            offset += length
        sequence += times
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)
    return Plan(*table.T.copy(), sequences=sequence)


def _ranked(pieces: DataFrame, counts: np.ndarray) -> DataFrame:
    """``pieces`` with ``rank``, from 0 within each length.

    A length with many pieces is dealt over blocks by their hash; the number of blocks comes from the
    exact count. Blocks of one length follow each other by their counts.
    """
    blocks = [max(1, -(-int(c) // RANK_ROWS)) for c in counts]
    of_length = F.array(*[F.lit(b) for b in blocks])[F.col("length").cast("int")]
    dealt = pieces.withColumn("block", F.pmod(F.xxhash64("id", "piece", "ids_crc32"), of_length))
    sizes = dealt.groupBy("length", "block").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    # One row for each length and RANK_ROWS pieces; left to Spark to broadcast or shuffle.
    own = Window.partitionBy("length", "block").orderBy("id", "piece", "start", "ids_crc32")
    return (
        dealt.withColumn("place", F.row_number().over(own) - 1)
        .join(starts, ["length", "block"])
        .withColumn("rank", F.col("first") + F.col("place"))
        .drop("block", "place", "first")
    )


def pack(
    docs: DataFrame, tokenizer_path: str = TOKENIZER, capacity: int = CAPACITY, end_id: int = END_ID,
    id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False,
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset (and ids).

    A document is the ids of its whole text, then ``end_id``; null counts as the empty text. Documents
    longer than ``capacity`` are cut into pieces of that length, the first of which may be shorter.
    Pieces lie in their sequence without gaps from offset 0. Repeated rows and ids, and null ids, are
    packed one by one. An empty table has no pieces. Columns other than the two are not read, so their
    names do not matter.
    """
    pieces = cut_lineage(token_pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col, keep_ids))
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for row in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect():  # a row per length
        counts[row["length"]] = row["n"]
    plan = make_plan(counts)
    wide = int(counts.max()) + 1
    key = plan.length * wide + plan.low
    ranked = _ranked(pieces, counts)

    def place(batch: pa.RecordBatch):
        length, rank = (batch.column(batch.schema.names.index(c)).to_numpy() for c in ("length", "rank"))
        at = np.searchsorted(key, length * wide + rank, side="right") - 1
        others = [c for n, c in zip(batch.schema.names, batch.columns) if n != "rank"]
        yield (*others, plan.sequence[at] + rank - plan.low[at], plan.offset[at])

    kept = ranked.select(*pieces.columns, "rank")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long, offset long"
    return map_slices(kept, place, schema).withColumnRenamed("id", id_col)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the token ids of every sequence, from ``pack`` with ``keep_ids``."""
    pieces = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(pieces, lambda p: p["ids"])).alias("ids"))
