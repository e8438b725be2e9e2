"""Hierarchical Pitman-Yor language model over words, its seating sampled by Gibbs.

Words follow the word before them. Every context, the preceding word, is a restaurant whose dishes
are words; its tables are customers of the parent restaurant, which all contexts share, and whose
own tables draw from a uniform base. Given the seating,

    P(w)     = (c(w) - d0 s(w) + (t0 + d0 s) / (V + 1)) / (t0 + c)
    P(w | u) = (c(u,w) - d1 t(u,w) + (t1 + d1 t(u)) P(w)) / (t1 + c(u))

with customers c, tables t of a context, tables s of the parent. Words are dealt over parts by
their hash, so a word's customers in all contexts lie in one part; the commonest words are dealt
by word and context instead. Parts sample their seatings side by side against the totals of the
last sweep. Totals of the common words are of fixed size and pass through the driver; those of the contexts
grow with the corpus: parts send what they know of their contexts to shards of contexts, which send
the sums back to the parts that hold a context. A pair seen once has one table in any seating, so sweeps
only move pairs seen again, and their contexts.
Probabilities are averaged over several seatings before their logarithm is taken.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, functions as F

from lamina.llm.common import TOKEN_BYTES, map_batches, mix64, pa_schema, run_hashes, runs, settled, text_chunks
from lamina.session import cut_lineage, drop_steps, shuffles_dropped, step_copies

COMMON_WORDS = 4096          # words dealt by context too, to spread their load; found on a sample
COMMON_SAMPLE_ROWS = 2000    # documents of that sample; the choice does not change any probability
PART_BYTES = 6 << 20         # text that one part's share of words comes from
SHARD_PARTS = 4              # parts' worth of contexts that are summed together
BLOCK_TOKENS, BLOCK_DOCS = 800_000, 30_000
SWEEPS, SAMPLES = 4, 3       # sweeps over all parts, of which the last SAMPLES are averaged
CHAIN = 2                    # seatings of one part within a sweep
STRENGTH_CONTEXT, STRENGTH_PARENT = 1.0, 10.0
ONE_BY_ONE = 64              # customers seated singly; later ones in groups of a sixteenth of those seated
END = np.uint64(0x5EED5EED5EED5EED)

_MIX = np.uint64(0x9E3779B97F4A7C15)


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes with an end after each text, the context of each, which is the word before it (an end before
    the first of a text), and the text it is in."""
    data = np.frombuffer(b"\n".join(texts).lower() + b"\n", dtype=np.uint8)
    highs = np.cumsum([len(t) + 1 for t in texts]) - 1
    s, e = runs(data, TOKEN_BYTES)
    text_of = np.searchsorted(highs, s)
    n = np.bincount(text_of, minlength=len(texts)) + 1
    words = np.full(len(s) + len(texts), END, dtype=np.uint64)
    words[np.arange(len(s)) + text_of] = run_hashes(data, s, e)
    before = np.concatenate([[END], words[:-1]])  # a text begins after an end
    return words, before, np.repeat(np.arange(len(texts)), n)


def part_of(words: np.ndarray, contexts: np.ndarray, common: np.ndarray, parts: int) -> np.ndarray:
    key = words.copy()
    if len(common):
        at = np.minimum(np.searchsorted(common, words), len(common) - 1)
        spread = common[at] == words
        key[spread] = mix64(words[spread] ^ (contexts[spread].astype(np.uint64) * _MIX))
    return _share(key, parts)


def _share(hashes: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` equal ranges a hash lies in."""
    return ((hashes >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def _starts(changed: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], changed])) if len(changed) + 1 else np.zeros(0, int)


def _block_rows(block: int, words, docs, train: np.ndarray, common: np.ndarray, parts: int):
    """One row that has the documents of the block's pairs of word and context, and one per part with its words
    and contexts, each level with its run lengths. The documents are in the order of the parts' pairs."""
    kinds, word_id = np.unique(words, return_inverse=True)
    end = np.searchsorted(kinds, END)  # every text has one
    bits = np.uint64(max(1, int(len(kinds) - 1).bit_length()))
    key = word_id.astype(np.uint64) << bits
    key[1:] |= word_id[:-1].astype(np.uint64)  # contexts are the words before
    key[0] |= np.uint64(end)
    del words, word_id
    known = None
    if 2 * bits + 16 > 64:  # an enormous text
        known, key = np.unique(key, return_inverse=True)
    key = key.astype(np.uint64, copy=False) << np.uint64(16)
    key |= docs.astype(np.uint64)
    key.sort()
    first = _starts(key[1:] != key[:-1])
    times = np.diff(np.append(first, len(key))).astype(np.int32)
    key = key[first]
    doc = (key & np.uint64(0xFFFF)).astype(np.int64)
    pair = key >> np.uint64(16)
    pair_first = _starts(pair[1:] != pair[:-1])
    seats = np.diff(np.append(pair_first, len(pair)))
    pair = pair[pair_first] if known is None else known[pair[pair_first].astype(np.int64)]
    learned = np.add.reduceat(times * train[doc], pair_first)
    pair_word = kinds[(pair >> bits).astype(np.int64)]
    pair_context = (pair & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    part = part_of(pair_word, kinds[pair_context], common, parts)
    order = np.argsort(part, kind="stable")
    by_doc = np.argsort(np.repeat(part, seats), kind="stable")
    pair_word, pair_context, learned, seats, part = (x[order] for x in (pair_word, pair_context, learned, seats, part))
    doc, times = doc[by_doc], times[by_doc]
    yield {"pair_docs": seats.astype(np.int32), "docs": doc.astype(np.uint16).view(np.int16), "times": times}
    for p, lo, hi in zip(*_bounds(part)):
        own = pair_word[lo:hi]
        word_first = _starts(own[1:] != own[:-1])
        names, at = np.unique(pair_context[lo:hi], return_inverse=True)
        low, high = _halves(at)
        yield {
            "part": int(part[lo]), "block": block, "words": own[word_first].view(np.int64),
            "word_pairs": np.diff(np.append(word_first, hi - lo)).astype(np.int32), "own": kinds[names].view(np.int64),
            "contexts": low, "contexts_high": high, "learned": learned[lo:hi].astype(np.int32),
        }


def _halves(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Low and high 16 bits of numbers below 2^32; the high ones are mostly zero, so they take little room."""
    return (values & 0xFFFF).astype(np.uint16).view(np.int16), (values >> 16).astype(np.uint16).view(np.int16)


def _joined(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return low.view(np.uint16).astype(np.int64) | (high.view(np.uint16).astype(np.int64) << 16)


def _bounds(values: np.ndarray):
    first = _starts(values[1:] != values[:-1]) if len(values) else np.zeros(0, int)
    return values[first], first, np.append(first[1:], len(values))


_BLOCK_SCHEMA = (
    "part long, block long, words array<bigint>, word_pairs array<int>, own array<bigint>, contexts array<smallint>, contexts_high array<smallint>, "
    "learned array<int>, pair_docs array<int>, docs array<smallint>, times array<int>, "
    "ids array<{id}>, held_out array<boolean>, n_tokens array<int>"
)
_PART_SCHEMA = (
    "part long, block long, words array<bigint>, word_pairs array<int>, own array<bigint>, contexts array<smallint>, "
    "contexts_high array<smallint>, counts array<int>, "
    "blocks array<bigint>, block_pairs array<int>, pair_gaps array<smallint>, pair_gaps_high array<smallint>, "
    "pair_docs array<int>, docs array<smallint>, times array<int>, "
    "ids array<{id}>, held_out array<boolean>, n_tokens array<int>"
)


def _table(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in rows], f.type) for f in schema], schema=schema)


def _blocks(docs: DataFrame, common: np.ndarray, parts: int, id_type: str) -> DataFrame:
    """Rows of _BLOCK_SCHEMA: those of words, and one without words for each block, which names its documents
    and has those of its pairs."""
    ddl = _BLOCK_SCHEMA.format(id=id_type)
    target = pa_schema(ddl)

    def run(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 24
        held: list = []
        ids: list = []
        flags: list = []
        size = 0

        def flush():
            nonlocal held, ids, flags, size, number
            words, text_of = (np.concatenate(x) for x in zip(*held))
            train = ~np.concatenate(flags)
            rows = _block_rows(number, words, text_of, train, common, parts)
            yield _table([next(rows) | {
                "part": -1 - number, "block": number, "ids": pa.concat_arrays(ids), "held_out": ~train,
                "n_tokens": np.bincount(text_of, minlength=len(train)),
            }], target)
            held, ids, flags, size = [], [], [], 0
            for row in rows:
                yield _table([row], target)
            number += 1
            pa.default_memory_pool().release_unused()

        docs_held = 0
        for batch in batches:
            for first, texts in text_chunks(batch, batch.schema.names[1]):
                words, _, text_of = tokens(texts)
                if held and (size + len(words) > BLOCK_TOKENS or docs_held + len(texts) > BLOCK_DOCS):
                    yield from flush()
                    docs_held = 0
                held.append((words, text_of + docs_held))
                ids.append(batch.column(0).slice(first, len(texts)))
                flags.append(batch.column(2).slice(first, len(texts)).to_numpy(zero_copy_only=False))
                size += len(words)
                docs_held += len(texts)
        if held:
            yield from flush()

    return docs.mapInArrow(run, ddl)


def _flat(column: pa.ChunkedArray) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False)


def _merge(group: pa.Table, schema: pa.Schema) -> pa.Table:
    """The rows of one part as a single row: pairs of word and context once, and for every block the places of
    its own pairs among them, as gaps from one place to the next. Pairs are in the same order here and there."""
    if group["words"].null_count:  # has the documents of a block
        columns = [group[f.name].cast(f.type) if f.name in group.column_names else pa.nulls(len(group), f.type) for f in schema]
        return pa.Table.from_arrays(columns, schema=schema)
    block_pairs = pa.compute.list_value_length(group["contexts"].combine_chunks())
    sizes = pa.compute.list_value_length(group["own"].combine_chunks()).to_numpy()
    own, place = np.unique(_flat(group["own"]).view(np.uint64), return_inverse=True)
    context = place[_joined(_flat(group["contexts"]), _flat(group["contexts_high"])) + np.repeat(np.cumsum(sizes) - sizes, block_pairs.to_numpy())]
    kinds, word_id = np.unique(_flat(group["words"]).view(np.uint64), return_inverse=True)
    pair = np.repeat(word_id.astype(np.uint64) << np.uint64(32), _flat(group["word_pairs"])) | context.astype(np.uint64)
    del word_id, context, place
    pair, at = np.unique(pair, return_inverse=True)
    counts = np.bincount(at, _flat(group["learned"]), len(pair)).astype(np.int64)
    word_of = (pair >> np.uint64(32)).astype(np.int64)
    gaps = np.diff(at, prepend=0)
    first = np.cumsum(block_pairs.to_numpy()[:-1])
    gaps[first] = at[first]
    low, high = _halves((pair & np.uint64(0xFFFFFFFF)).astype(np.int64))
    # A gap is never negative: a block's pairs are in the order of the part's.
    gaps_low, gaps_high = _halves(gaps)
    return pa.Table.from_batches([_table([{
        "part": group["part"][0].as_py(), "block": None, "words": kinds.view(np.int64),
        "word_pairs": np.bincount(word_of, minlength=len(kinds)), "own": own.view(np.int64),
        "contexts": low, "contexts_high": high,
        "counts": counts, "blocks": group["block"].combine_chunks(), "block_pairs": block_pairs,
        "pair_gaps": gaps_low, "pair_gaps_high": gaps_high,
    }], schema)])


def seat(customers: np.ndarray, new_weight: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables after customers of one dish have come one by one: with k seated at t tables, the next
    opens a table in proportion to ``new_weight`` against k - discount * t."""
    tables = (customers > 0).astype(np.int64)
    live = np.flatnonzero(customers > 1)
    k = 1
    while len(live):
        group = 1 if k < ONE_BY_ONE else k // 16
        more = np.minimum(group, customers[live] - k)
        p = new_weight[live] / (new_weight[live] + k - discount * tables[live])
        tables[live] += rng.random(len(live)) < p if group == 1 else rng.binomial(more, p)
        k += group
        live = live[customers[live] > k]
    return tables


class Part:
    """One part's words and pairs of word and context, and a seating of their customers. Contexts are places in
    the part's own list of them, as are the totals of contexts. Where the row has ``singles``, numbers of
    pairs seen once by word, those pairs are not among its pairs."""

    def __init__(self, row: dict, common: np.ndarray):
        self.words = row["words"].view(np.uint64)
        self.word_of = np.repeat(np.arange(len(self.words)), row["word_pairs"])
        self.contexts = row["contexts"].astype(np.int64)
        self.counts = row["counts"].astype(np.int64)
        self.singles = row.get("singles", 0)
        self.common_at = np.minimum(np.searchsorted(common, self.words), max(0, len(common) - 1))
        self.is_common = common[self.common_at] == self.words if len(common) else np.zeros(len(self.words), bool)
        self.shared = self.common_at[self.is_common]

    def word_sum(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.word_of, values, len(self.words))

    def customers(self) -> np.ndarray:
        """Customers of each word in the parent: its tables in all contexts."""
        return self.word_sum(self.tables) + self.singles

    def repeated(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which pairs were seen again, pairs seen once by word, and the words whose seating is not settled by those."""
        again, singles = self.counts > 1, self.word_sum(self.counts == 1).astype(np.int64)
        return again, singles, self.is_common | (self.word_sum(again) > 0) | (singles > 1)

    def whole(self, own: np.ndarray, shared: np.ndarray) -> np.ndarray:
        """Per-word numbers; those of common words, which other parts hold too, come from totals."""
        own[self.is_common] = shared[self.shared]
        return own

    def _seat_parent(self, totals: dict, rng: np.random.Generator) -> None:
        customers = self.customers().astype(np.int64)
        self.parent_tables = seat(customers, np.full(len(customers), parent_weight(totals)), totals["d0"], rng)

    def _parent(self, totals: dict) -> np.ndarray:
        """P(w) of every word under the present seating."""
        customers = self.whole(self.customers(), totals["common_tables"])
        tables = self.whole(self.parent_tables.copy(), totals["common_parent_tables"])
        return (customers - totals["d0"] * tables + parent_weight(totals)) / (STRENGTH_PARENT + totals["parent_customers"])

    def _fresh_weight(self, totals: dict) -> np.ndarray:
        return (STRENGTH_CONTEXT + totals["d1"] * totals["context_tables"][self.contexts]) * self._parent(totals)[self.word_of]

    def sample(self, totals: dict, seed: list[int]) -> None:
        """Seats everybody by a short chain under the totals of the sweep before. The same arguments
        give the same seating again, so none needs to be stored."""
        rng = np.random.default_rng(seed)
        self.tables = (self.counts > 0).astype(np.int64)
        self._seat_parent(totals, rng)
        for _ in range(CHAIN):
            self.tables = seat(self.counts, self._fresh_weight(totals), totals["d1"], rng)
            self._seat_parent(totals, rng)

    def predictive(self, totals: dict) -> np.ndarray:
        """P(w | u) of all pairs; with the totals of this very seating it sums to one over words."""
        return (self.counts - totals["d1"] * self.tables + self._fresh_weight(totals)) / (
            STRENGTH_CONTEXT + totals["context_counts"][self.contexts]
        )


def parent_weight(totals: dict) -> float:
    """What a new table of the parent weighs: the base is uniform over known words and one unknown."""
    return (STRENGTH_PARENT + totals["d0"] * totals["parent_tables"]) / (totals["kinds"] + 1)


def _rows(batch: pa.RecordBatch):
    """The rows of a batch with their arrays as numpy arrays, halves of numbers joined."""
    for i in range(len(batch)):
        row = {
            name: column[i].values.to_numpy(zero_copy_only=False) if pa.types.is_list(column.type) else column[i].as_py()
            for name, column in zip(batch.schema.names, batch.columns)
        }
        for name in [n for n in row if n.endswith("_high")]:
            whole = name.removesuffix("_high")
            row[whole] = _joined(row[whole], row.pop(name))
        yield row


_MODEL_COLUMNS = ["part", "words", "word_pairs", "contexts", "contexts_high", "counts"]
_KINDS = ("context_counts", "context_tables", "common_counts", "common_tables", "other")
# To a shard: what a part knows of its contexts there, and which of them have pairs seen again.
_SENT_SCHEMA = "part long, shard int, contexts array<bigint>, customers array<int>, tables array<int>, again array<boolean>"
# Back to a part: tables of its contexts with pairs seen again, now and with one table a pair.
_PRIOR_SCHEMA = "part long, shard int, tables array<int>, base array<int>"
_REPEATED_SCHEMA = (
    "part long, words array<bigint>, word_pairs array<int>, own array<bigint>, contexts array<int>, counts array<int>, "
    "singles array<int>, settled long"
)
# After a sweep: rows for the shards, and one of shard -1 for each part with its seating and sums.
_SWEPT_SCHEMA = (
    "part long, shard int, contexts array<bigint>, extra array<int>, base array<int>, "
    "tables array<int>, parent_tables array<int>, common_tables array<double>, other array<double>"
)


def _initial(part: Part, totals: dict) -> dict:
    c, seen = part.counts, (part.counts > 0).astype(np.int64)
    words, places = part.word_sum(c), part.word_sum(seen)
    lone, n = ~part.is_common, len(totals["common"])
    return {
        "context_counts": np.bincount(part.contexts, c),
        "context_tables": np.bincount(part.contexts, seen),
        "common_counts": np.bincount(part.shared, words[part.is_common], n),
        "common_tables": np.bincount(part.shared, places[part.is_common], n),
        # words, pairs seen once and twice, words in one and in two contexts, tokens and pairs
        "other": [
            (words[lone] > 0).sum(), (c == 1).sum(), (c == 2).sum(), (places[lone] == 1).sum(), (places[lone] == 2).sum(),
            c.sum(), seen.sum(),
        ],
    }


def _swept(part: Part, totals: dict, settled_words: int = 0) -> dict:
    customers = part.customers()
    return {
        "context_tables": np.bincount(part.contexts, part.tables),
        "common_tables": np.bincount(part.shared, customers[part.is_common], len(totals["common"])),
        # tables of the parent, and its customers; settled words have one of each
        "other": [part.parent_tables[~part.is_common].sum() + settled_words, customers.sum() + settled_words],
    }


def _driver_sums(rows: DataFrame, sizes: dict[str, int]) -> dict:
    """Sums of array columns of fixed size over all rows."""
    each = [
        rows.select(F.lit(name).alias("kind"), F.posexplode(name).alias("at", "value")).filter("value <> 0") for name in sizes
    ]
    with shuffles_dropped(rows.sparkSession):
        summed = reduce(DataFrame.union, each).groupBy("kind", "at").agg(F.sum("value").alias("value")).toPandas()
    out = {name: np.zeros(size) for name, size in sizes.items()}
    for name in sizes:
        own = summed[summed["kind"] == name]
        out[name][own["at"].to_numpy(np.int64)] = own["value"].to_numpy()
    return out


def _start(model: DataFrame, common: np.ndarray) -> dict:
    """Sums over all parts before any sweep."""
    def run(batch):
        for row in _rows(batch):
            own = _initial(Part(row, common), {"common": common})
            yield [[np.asarray(own[k], float)] for k in _KINDS[2:]]

    sums = map_batches(model.select(*_MODEL_COLUMNS), run, ", ".join(f"{k} array<double>" for k in _KINDS[2:]), rows=1)
    return _driver_sums(sums, {"common_counts": len(common), "common_tables": len(common), "other": 7})


def _lists(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Runs of ``values`` as lists."""
    return pa.array(np.split(values, bounds[1:-1]), kind) if len(bounds) > 1 else pa.array([], kind)


def _sharded(own: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Shards of sorted contexts, and where each one's run begins, and the end."""
    shard, first, _ = _bounds(_share(own, shards))
    return shard, np.append(first, len(own)) if len(own) else np.zeros(1, int)


def _sent(model: DataFrame, shards: int) -> DataFrame:
    types = pa_schema(_SENT_SCHEMA)

    def run(batch):
        for row in _rows(batch):
            own, contexts, counts = row["own"].view(np.uint64), row["contexts"], row["counts"]
            shard, bounds = _sharded(own, shards)
            values = {
                "contexts": own.view(np.int64), "customers": np.bincount(contexts, counts, len(own)).astype(np.int32),
                "tables": np.bincount(contexts, counts > 0, len(own)).astype(np.int32),
                "again": np.bincount(contexts, counts > 1, len(own)) > 0,
            }
            yield [np.full(len(shard), row["part"]), shard, *(_lists(v, bounds, types.field(k).type) for k, v in values.items())]

    return map_batches(model.select("part", "own", "contexts", "contexts_high", "counts"), run, _SENT_SCHEMA, rows=1)


def _repeated(model: DataFrame, common: np.ndarray) -> DataFrame:
    """The parts with their pairs seen again only, their contexts, and the words whose seating these sway."""
    def run(batch):
        for row in _rows(batch):
            part = Part(row, common)
            again, singles, kept = part.repeated()
            places, contexts = np.unique(part.contexts[again], return_inverse=True)
            pairs = np.bincount(part.word_of[again], minlength=len(kept))
            yield [
                [row["part"]], [row["words"][kept]], [pairs[kept]], [row["own"][places]], [contexts], [row["counts"][again]],
                [singles[kept]], [int(singles[~kept].sum())],
            ]

    return map_batches(model.select(*_MODEL_COLUMNS, "own"), run, _REPEATED_SCHEMA, rows=1)


def _sizes(column: pa.ChunkedArray) -> np.ndarray:
    return pa.compute.list_value_length(column.combine_chunks()).to_numpy(zero_copy_only=False)


def _first_prior(sent: DataFrame) -> DataFrame:
    types = pa_schema(_PRIOR_SCHEMA)

    def run(rows: pa.Table) -> pa.Table:
        _, at = np.unique(_flat(rows["contexts"]).view(np.uint64), return_inverse=True)
        again = _flat(rows["again"])
        tables = np.bincount(at, _flat(rows["tables"]))[at[again]].astype(np.int32)
        ends = np.cumsum(_sizes(rows["contexts"]))
        bounds = np.append(0, np.cumsum(again)[ends - 1])
        lists = _lists(tables, bounds, types.field("tables").type)
        return pa.Table.from_arrays([rows["part"], rows["shard"], lists, lists], schema=types)

    return sent.groupBy("shard").applyInArrow(run, _PRIOR_SCHEMA)


def _next_prior(swept: DataFrame) -> DataFrame:
    types = pa_schema(_PRIOR_SCHEMA)

    def run(rows: pa.Table) -> pa.Table:
        _, at = np.unique(_flat(rows["contexts"]).view(np.uint64), return_inverse=True)
        tables = _flat(rows["base"]) + np.bincount(at, _flat(rows["extra"]))[at].astype(np.int32)
        bounds = np.append(0, np.cumsum(_sizes(rows["contexts"])))
        return pa.Table.from_arrays(
            [rows["part"], rows["shard"], _lists(tables, bounds, types.field("tables").type), rows["base"].cast(types.field("base").type)],
            schema=types,
        )

    return swept.filter("shard >= 0").select("part", "shard", "contexts", "extra", "base").groupBy("shard").applyInArrow(run, _PRIOR_SCHEMA)


def _sweep(repeated: DataFrame, prior: DataFrame, totals: dict, sweep: int, shards: int) -> DataFrame:
    """Every part seated anew against ``totals`` and the tables of its contexts after the sweep before."""
    types = pa_schema(_SWEPT_SCHEMA)

    def run(own: pa.Table, before: pa.Table) -> pa.Table:
        row = next(_rows(own.combine_chunks().to_batches()[0]))
        before = before.sort_by("shard")
        tables, base = (_flat(before[c]) if len(before) else np.zeros(0, np.int32) for c in ("tables", "base"))
        part = Part(row, totals["common"])
        part.sample(totals | {"context_tables": tables}, [sweep, row["part"]])
        sums = _swept(part, totals, row["settled"])
        extra = np.bincount(part.contexts, part.tables - 1, len(row["own"])).astype(np.int32)
        shard, bounds = _sharded(row["own"].view(np.uint64), shards)
        rows = [
            {"part": row["part"], "shard": int(k), "contexts": row["own"][lo:hi], "extra": extra[lo:hi], "base": base[lo:hi]}
            for k, lo, hi in zip(shard, bounds, bounds[1:])
        ]
        rows.append({
            "part": row["part"], "shard": -1, "tables": part.tables, "parent_tables": part.parent_tables,
            "common_tables": sums["common_tables"], "other": np.asarray(sums["other"], float),
        })
        return pa.Table.from_batches([_table(rows, types)])

    swept = repeated.groupBy("part").cogroup(prior.groupBy("part")).applyInArrow(run, _SWEPT_SCHEMA)
    return cut_lineage(swept, compression="zstd")


def _context_totals(sent: DataFrame, swept: dict[int, DataFrame]) -> DataFrame:
    """Of every part's contexts the customers, and the tables after each of the given sweeps: one row a part."""
    sweeps = list(swept)
    names = [f"tables{sweep}" for sweep in sweeps]
    ddl = "part long, shard int, customers array<int>, " + ", ".join(f"{name} array<int>" for name in names)
    types = pa_schema(ddl)

    def run(rows: pa.Table) -> pa.Table:
        own = rows.filter(pa.compute.equal(rows["sweep"], 0))
        contexts, at = np.unique(_flat(own["contexts"]).view(np.uint64), return_inverse=True)
        bounds = np.append(0, np.cumsum(_sizes(own["contexts"])))
        columns = [np.bincount(at, _flat(own["customers"]), len(contexts))]
        base = np.bincount(at, _flat(own["tables"]), len(contexts))
        for sweep in sweeps:
            more = rows.filter(pa.compute.equal(rows["sweep"], sweep))
            places = np.searchsorted(contexts, _flat(more["contexts"]).view(np.uint64))
            columns.append(base + np.bincount(places, _flat(more["tables"]), len(contexts)))
        lists = [_lists(c[at].astype(np.int32), bounds, types.field("customers").type) for c in columns]
        return pa.Table.from_arrays([own["part"], own["shard"], *lists], schema=types)

    none = F.lit(None).cast("array<int>")
    sides = [sent.select("part", "shard", F.lit(0).alias("sweep"), "contexts", "customers", "tables")] + [
        rows.filter("shard >= 0").select("part", "shard", F.lit(sweep).alias("sweep"), "contexts", none.alias("customers"), F.col("extra").alias("tables"))
        for sweep, rows in swept.items()
    ]
    summed = reduce(DataFrame.union, sides).groupBy("shard").applyInArrow(run, ddl)
    shards = summed.groupBy("part").agg(F.sort_array(F.collect_list(F.struct("shard", "customers", *names))).alias("s"))
    return shards.select("part", *[F.flatten(F.col(f"s.{name}")).alias(name) for name in ("customers", *names)])


def _next_totals(totals: dict, swept: dict, sweep: int) -> dict:
    """Totals after a sweep; the common words' own tables in the parent are seated here. Totals of contexts
    are there for a single part only."""
    weight = np.full(len(totals["common"]), parent_weight(totals))
    seated = seat(swept["common_tables"].astype(np.int64), weight, totals["d0"], np.random.default_rng([sweep]))
    return totals | {
        **{k: swept[k] for k in ("context_tables", "common_tables") if k in swept}, "common_parent_tables": seated,
        "parent_tables": float(swept["other"][0] + seated.sum()), "parent_customers": float(swept["other"][1]),
    }


def _common_words(docs: DataFrame) -> np.ndarray:
    """Hashes of the commonest words of a bounded sample, sorted."""
    def count(batch):
        for _, texts in text_chunks(batch, "text"):
            yield tuple(x.view(np.int64) if k == 0 else x for k, x in enumerate(np.unique(tokens(texts)[0], return_counts=True)))

    with shuffles_dropped(docs.sparkSession):
        sample = docs.orderBy(F.xxhash64("id"), "id").limit(COMMON_SAMPLE_ROWS)
        counted = map_batches(sample.select("id", "text"), count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
        top = counted.orderBy(F.desc("n"), "word").limit(COMMON_WORDS).select("word").toPandas()
    return np.sort(top["word"].to_numpy(np.int64).view(np.uint64))


def score_texts(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, held_out, n_tokens, n_known, train_tokens, base_score and score.

    The model learns from the rows where ``held_out`` is not true and scores all. Tokens are runs of
    anything but ASCII white space, with A-Z in lower case, and one end for each text; a null or empty
    text is an end alone. ``base_score`` is that of an add-one unigram model, ``score`` the base-10
    logarithm of the model's probability. Without training rows every token has probability 1. Rows
    are scored one by one, so repeated rows and ids, and null ids, stay as they are. Other columns
    are not read.
    """
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = docs.sparkSession.conf.get(setting)
    try:  # all Python steps run before this returns, so the setting can go back
        return _scored(docs, held_out, id_col, text_col)
    finally:
        docs.sparkSession.conf.set(setting, before)


def _scored(docs: DataFrame, held_out: Column, id_col: str, text_col: str) -> DataFrame:
    before = step_copies()
    keyed = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out")
    )
    id_type = docs.schema[id_col].dataType.simpleString()
    size = keyed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // PART_BYTES))
    common = _common_words(keyed.filter(~F.col("held_out")))

    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    ddl = _PART_SCHEMA.format(id=id_type)
    schema = pa_schema(ddl)
    # The Parquet reader makes room for all rows of a batch, so each of these large rows gets a file of its own.
    merged = cut_lineage(
        _blocks(keyed, common, parts, id_type).groupBy("part").applyInArrow(lambda group: _merge(group, schema), ddl),
        maxRecordsPerFile=1, compression="zstd",
    )
    model = merged.filter("part >= 0")

    start = _start(model, common)
    kinds, once, twice, lone, double, n, pairs = start["other"]
    seen_common = (start["common_counts"] > 0).astype(np.int64)
    kinds += int(seen_common.sum())
    totals = {
        "common": common, "common_counts": start["common_counts"], "common_tables": start["common_tables"],
        "kinds": kinds, "parent_tables": kinds, "common_parent_tables": seen_common, "parent_customers": pairs,
        "d1": min(0.95, max(0.05, once / max(1.0, once + 2 * twice))),
        "d0": min(0.95, max(0.05, lone / max(1.0, lone + 2 * double))),
    }
    shards = -(-parts // SHARD_PARTS)
    sent = _sent(model, shards)
    passing = step_copies()
    repeated = cut_lineage(_repeated(model, common), maxRecordsPerFile=1, compression="zstd")
    prior, states, swept = _first_prior(sent), [totals], {}
    for sweep in range(1, SWEEPS + 1):
        swept[sweep] = _sweep(repeated, prior, states[-1], sweep, shards)
        sums = _driver_sums(swept[sweep].filter("shard < 0"), {"common_tables": len(common), "other": 2})
        states.append(_next_totals(states[-1], sums, sweep))
        prior = _next_prior(swept[sweep])
        if sweep <= SWEEPS - SAMPLES:
            unread = step_copies() - passing
    averaged = range(SWEEPS - SAMPLES + 1, SWEEPS + 1)
    sums = cut_lineage(
        _context_totals(sent, {sweep: swept[sweep] for sweep in averaged}), maxRecordsPerFile=1, compression="zstd"
    )
    drop_steps(docs.sparkSession, step_copies() - unread)  # parts with repeated pairs, sweeps that are not averaged

    def rate(batch):
        for row in _rows(batch):
            part = Part(row, common)
            again, singles, kept = part.repeated()
            mean = np.zeros(len(part.counts))
            for sweep in averaged:
                part.tables, part.parent_tables = (part.counts > 0).astype(np.int64), (singles > 0).astype(np.int64)
                part.tables[again], part.parent_tables[kept] = row[f"seated{sweep}"], row[f"parents{sweep}"]
                mean += part.predictive(states[sweep] | {"context_counts": row["customers"], "context_tables": row[f"tables{sweep}"]})
            model_log = np.log10(mean / SAMPLES)
            counts = part.whole(part.word_sum(part.counts), totals["common_counts"]).astype(np.int64)
            gaps, ends = row["pair_gaps"], np.cumsum(row["block_pairs"])
            for block, lo, hi in zip(row["blocks"], ends - row["block_pairs"], ends):
                own = np.cumsum(gaps[lo:hi])
                word, first, last = _bounds(part.word_of[own])
                yield [[block], [row["part"]], [counts[word]], [last - first], [model_log[own]]]

    ready = model.select(*_MODEL_COLUMNS, "blocks", "block_pairs", "pair_gaps", "pair_gaps_high").join(sums, "part")
    for sweep in averaged:
        seats = swept[sweep].filter("shard < 0")
        ready = ready.join(seats.select("part", F.col("tables").alias(f"seated{sweep}"), F.col("parent_tables").alias(f"parents{sweep}")), "part")
    rated = map_batches(
        ready, rate, "block long, part long, counts array<bigint>, word_pairs array<int>, model_log array<double>", rows=1,
    )
    ddl = f"id {id_type}, held_out boolean, n_tokens int, n_known long, base_score double, score double"
    scored = pa_schema(ddl)

    def total(rates: pa.Table, documents: pa.Table) -> pa.Table:
        """The documents of a block, each with the sums over its pairs, whose rates come from all parts."""
        rates = rates.sort_by("part")
        seats = _flat(documents["pair_docs"])
        counts, doc, times = np.repeat(_flat(rates["counts"]), _flat(rates["word_pairs"])), _flat(documents["docs"]).view(np.uint16), _flat(documents["times"])
        docs = len(documents["ids"][0])

        def summed(by_pair: np.ndarray) -> np.ndarray:
            return np.bincount(doc, np.repeat(by_pair, seats) * times, docs)

        columns = [
            *(documents[c].combine_chunks().flatten() for c in ("ids", "held_out", "n_tokens")), summed(counts > 0).astype(np.int64),
            summed(np.log10((counts + 1) / (n + kinds + 1))), summed(_flat(rates["model_log"])),
        ]
        return pa.Table.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, scored)], schema=scored)

    named = merged.filter("part < 0").select("block", "pair_docs", "docs", "times", "ids", "held_out", "n_tokens")
    out = settled(rated.groupBy("block").cogroup(named.groupBy("block")).applyInArrow(total, ddl), before)
    return out.select(
        F.col("id").alias(id_col), "held_out", F.col("n_tokens").cast("long").alias("n_tokens"),
        "n_known", F.lit(int(n)).cast("long").alias("train_tokens"), "base_score", "score",
    )
