"""Near-duplicate lines: MinHash over character shingles, banding, exact Jaccard, components.

Only DataFrame functions. A line's shingles are its runs of CHARS characters at every position, hashed to 64 bits and
put in order, all within the line's row. The hashes lie on a ring with evenly spread points. A band key is
the run of hashes that follows a point, so two lines share it if they agree in the smallest
shingles from there on; one order of one hash gives all bands. Only lines that share a band are sketched: a bitmap of their shingles,
by which pairs are told; those left are verified on their texts, whose shingle sets exist within a row only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from lamina.llm.common import free_name, settled
from lamina.operators.components import connected_components
from lamina.session import cut_lineage, drop_steps, step_copies

SIMILARITY = 0.8
MIN_CHARS = 1    # shorter lines, which is blank ones, are never taken for duplicates
CHARS = 5        # characters of a shingle; a shorter line is one shingle
BANDS, BAND_ROWS = 16, 5  # at similarity 0.8 a pair misses all bands with probability 0.67 ** 16 = 0.002
SHORT, SHORT_ROWS = 60, 4  # shingles up to which every run of 4 is a key: sets at 0.8, parted at no more than a quarter of places, share one
COPIES = 16  # copies of a line from which only one is signed
BROADCAST_LINES = 4_000_000  # line hashes (8 bytes each) a broadcast may hold; beyond, they are shuffled

PAIRED = 4096  # members up to which a bucket's lines meet in pairs; those of larger ones meet by rare shingles
BITMAP_LONGS = 32  # a line's bitmap has 64 times as many bits
MARKED = 576  # shingles from which each long holds the first FULL of its part of the ring only, as it would fill up:
FULL, LOOSE = 20, 280  # at similarity 0.8 more bits differ with a probability of about 1e-8, bands are missed with 2e-3
FOLDED_LONGS = 8  # the same where lines meet by rare shingles, in many rows a line
SORTED_SHINGLES = 1_000_000  # shingles that one task puts in order

BROADCAST_SHINGLES = 1_000_000  # most of the common shingles (16 bytes each) that are broadcast
ROUNDS = 8  # most heads a bucket's lines are compared with before those still apart meet

def _normal(line: Column) -> Column:
    return F.lower(F.trim(line))


def _row_hash(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col), F.col(text_col))


def _lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(doc, id, line_no, line) of lines long enough, normalised."""
    return (
        docs.select(
            _row_hash(id_col, text_col).alias("doc"), F.col(id_col).alias("id"),
            F.posexplode(F.split(F.col(text_col), "\n")).alias("line_no", "raw"),
        )
        .select("doc", "id", "line_no", _normal(F.col("raw")).alias("line"))
        .filter(F.char_length("line") >= min_chars)
    )


def _hashes(line: Column) -> Column:
    """The hash of the shingle at every position. The lambda variable holds what would else be encoded again at every
    position, as the optimizer puts expressions in the place of columns; at four bytes a character a position is found at once."""

    def at_each(wide: Column) -> Column:
        places = F.sequence(F.lit(1), F.greatest(F.length(wide) - 4 * CHARS + 1, F.lit(1)), F.lit(4))
        return F.transform(places, lambda at: F.xxhash64(F.substring(wide, at, F.lit(4 * CHARS))))

    return F.get(F.transform(F.array(F.encode(line, "UTF-32")), at_each), F.lit(0))


def _shingle_set(line: Column) -> Column:
    """The distinct shingle hashes of a line."""
    return F.array_distinct(_hashes(line))


def _points(count: int) -> list[Column]:
    """Evenly spread places on the ring of signed 64-bit numbers, from its lower end."""
    return [F.lit((k << 64) // count - (1 << 63)).cast("long") for k in range(count)]


def _with_starts(ordered: DataFrame, count: int, name: str) -> DataFrame:
    """``ordered`` with the places in ``s``, from 1, of the first hash not before each point; behind the last one there is the ring's start."""
    points, marked = _points(count), free_name(ordered, "marked")
    found = ordered.withColumn(marked, F.sort_array(F.concat(F.array(*points), "s")))
    starts = [F.array_position(marked, p).cast("int") - k for k, p in enumerate(points)]
    return found.withColumn(name, F.array(*starts)).drop(marked)


def _ordered(hashed: DataFrame) -> DataFrame:
    """(h, s, ring, n): the shingle hashes of each line in order, the same with the first few again, and their number."""
    ordered = hashed.select("h", F.sort_array(_shingle_set(F.col("line"))).alias("s"))
    return ordered.select("h", "s", F.concat("s", F.slice("s", 1, BAND_ROWS)).alias("ring"), F.size("s").alias("n"))


def _signed(hashed: DataFrame) -> DataFrame:
    """(h, key): the band keys of every line."""
    placed = _with_starts(_ordered(hashed), BANDS, "at")
    some = F.array(*[F.xxhash64(F.slice("ring", F.get("at", F.lit(b)), BAND_ROWS)) for b in range(BANDS)])
    runs = F.transform(
        F.array("ring"), lambda ring: F.transform(F.sequence(F.lit(1), F.col("n")), lambda i: F.xxhash64(F.slice(ring, i, SHORT_ROWS), F.lit(SHORT_ROWS)))
    )
    every = F.when(F.col("n") <= SHORT, F.get(runs, F.lit(0))).otherwise(F.array().cast("array<bigint>"))
    # Of two similar lines either both have at most SHORT shingles or both have more than SIMILARITY times that.
    bands = F.when(F.col("n") > int(SHORT * SIMILARITY) - 1, some).otherwise(F.array().cast("array<bigint>"))
    return placed.select("h", F.explode(F.array_distinct(F.concat(bands, every))).alias("key"))


def _sketched(hashed: DataFrame) -> DataFrame:
    """(h, n, bits): of every line the number of different shingles, and a bitmap in which each of them, or of
    many those that follow a point, sets a bit."""
    placed = _with_starts(_ordered(hashed), BITMAP_LONGS, "at")

    def word(k: int) -> Column:
        first = F.get("at", F.lit(k))
        size = (F.get("at", F.lit(k + 1)) if k + 1 < BITMAP_LONGS else F.col("n") + 1) - first
        bit = lambda x: F.call_function("shiftleft", F.lit(1).cast("long"), x.bitwiseAND(63).cast("int"))
        some = F.slice("s", first, F.when(F.col("n") >= MARKED, F.least(size, F.lit(FULL))).otherwise(size))
        return F.aggregate(some, F.lit(0).cast("long"), lambda bits, x: bits.bitwiseOR(bit(x)))

    return placed.select("h", "n", F.array(*[word(k) for k in range(BITMAP_LONGS)]).alias("bits"))


def _banded(signed: DataFrame) -> DataFrame:
    """(key, h, size, head): lines that share a band with another, with the most central line of the bucket,
    the one whose buckets hold most lines in all."""
    bucket = Window.partitionBy("key")
    shared = cut_lineage(
        signed.withColumn("before", F.lag("h").over(bucket.orderBy("h")))
        .withColumn("low", F.min("h").over(bucket)).withColumn("high", F.max("h").over(bucket))
        .filter("low <> high and (before is null or before <> h)").select("key", "h")
    )
    # Most of a family's lines share their minima with the line they all come from.
    sized = shared.withColumn("size", F.count(F.lit(1)).over(bucket))
    weighed = sized.withColumn("weight", F.sum("size").over(Window.partitionBy("h")))
    central = Window.partitionBy("key").orderBy(F.desc("weight"), "h")
    return weighed.withColumn("head", F.first("h").over(central)).select("key", "h", "size", "head")


def _only(df: DataFrame, wanted: DataFrame, how: str = "left_semi") -> DataFrame:
    """The rows of ``df`` whose h is wanted, or with left_anti the others."""
    few = wanted.count() <= BROADCAST_LINES
    return df.join(F.broadcast(wanted) if few else wanted, "h", how)


def _hashed(lines: DataFrame, places: DataFrame) -> DataFrame:
    """(h, line) of all lines, but of lines with many copies one only."""
    place = F.struct("doc", "line_no")
    often = cut_lineage(
        places.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("one")).filter(F.col("n") > COPIES).select("h", "one")
    )
    few = often.count() <= BROADCAST_LINES // 4
    hashed = lines.select(place.alias("place"), F.xxhash64("line").alias("h"), "line")
    return hashed.join(F.broadcast(often) if few else often, "h", "left").filter("one is null or one = place").select("h", "line")


def _texts(lines: DataFrame, wanted: DataFrame) -> DataFrame:
    """(h, line): the wanted lines, once each."""
    hashed = lines.select(F.xxhash64("line").alias("h"), "line")
    return _only(hashed, wanted).groupBy("h").agg(F.first("line").alias("line"))


def _may_fit(similarity: float) -> Column:
    """False for pairs that cannot be similar. Bitmaps differ in at most as many bits as the sets differ in
    shingles, and similar sets in at most a share of both sizes; those of many shingles hardly ever in more than LOOSE."""
    unequal = F.zip_with("bitsa", "bitsb", lambda x, y: F.bit_count(x.bitwiseXOR(y)))  # terms for each long would not be compiled by the JVM
    differ = F.aggregate(unequal, F.lit(0), lambda count, x: count + x)
    exact = (F.col("na") + F.col("nb")) * ((1 - similarity) / (1 + similarity)) + 1e-9
    return (
        (F.col("na") >= similarity * F.col("nb") - 1e-9) & (F.col("nb") >= similarity * F.col("na") - 1e-9)
        & (differ <= F.when(F.greatest("na", "nb") >= MARKED, F.lit(float(LOOSE))).otherwise(exact))
    )


def _both(df: DataFrame, shared: str) -> tuple[DataFrame, DataFrame]:
    """``df`` twice, all columns but ``shared`` named for the line a and the line b."""
    return tuple(
        df.select(shared, *[F.col(c).alias(x if c == "h" else f"{c}{x}") for c in df.columns if c != shared]) for x in ("a", "b")
    )


def _verified(pairs: DataFrame, lines: DataFrame, similarity: float) -> DataFrame:
    """The rows of ``pairs``, a written copy, whose lines a and b have shingle sets of at least this Jaccard similarity."""
    wanted = pairs.select(F.col("a").alias("h")).union(pairs.select(F.col("b").alias("h"))).distinct()
    texts = cut_lineage(_texts(lines, wanted))
    both = pairs.join(texts.select(F.col("h").alias("a"), F.col("line").alias("la")), "a").join(
        texts.select(F.col("h").alias("b"), F.col("line").alias("lb")), "b"
    )
    sets = F.struct(_shingle_set(F.col("la")).alias("a"), _shingle_set(F.col("lb")).alias("b"))

    def similar(s: Column) -> Column:
        common, whole = F.size(F.array_intersect(s["a"], s["b"])), F.size(s["a"]) + F.size(s["b"])
        return common * (1 + similarity) >= similarity * whole - 1e-9

    return both.filter(F.exists(F.array(sets), similar)).select(*pairs.columns)


def _common_shingles(lines: DataFrame) -> DataFrame:
    """(x, times): shingles that come several times in one sixteenth of the lines, the commonest first."""
    some = lines.filter(F.pmod(F.xxhash64(F.lit("sample"), "h"), F.lit(16)) == 0)
    counted = some.select(F.explode(_shingle_set(F.col("line"))).alias("x")).groupBy("x").agg(F.count(F.lit(1)).alias("times"))
    return cut_lineage(counted.filter("times > 1").orderBy(F.desc("times"), "x").limit(BROADCAST_SHINGLES))


def _rare_shingles(lines: DataFrame, similarity: float) -> DataFrame:
    """(h, component, n, bits, x): the shingles by which a line can meet a similar one, with its folded bitmap.

    Under any common order of shingles, two lines of at least this similarity share one among the
    first n - ceil(similarity * n) + 1 of each. The order puts rare shingles first, so lines that have
    a passage in common, but little else, do not meet. Which shingles count as common is found on
    a sample; that changes how many lines meet, not which similar ones do.

    Lines are dealt out by their hash before they fall into shingles, so only the first ones are shuffled.
    """
    total = lines.agg(F.sum("n")).first()[0] or 0
    folded = [
        F.expr(" | ".join(f"bits[{j}]" for j in range(k, BITMAP_LONGS, FOLDED_LONGS))) for k in range(FOLDED_LONGS)
    ]
    kept = ["h", "component", "n", "bits"]
    dealt = lines.withColumn("bits", F.array(*folded)).select(*kept, "line").repartition(1 + total // SORTED_SHINGLES, "h")
    exploded = dealt.select(*kept, F.explode(_shingle_set(F.col("line"))).alias("x"))
    ranked = exploded.join(F.broadcast(_common_shingles(lines)), "x", "left")
    order = Window.partitionBy("h").orderBy(F.coalesce("times", F.lit(0)), "x")
    last = F.col("n") - F.ceil(F.lit(similarity) * F.col("n") - 1e-9) + 1
    return ranked.withColumn("at", F.row_number().over(order)).filter(F.col("at") <= last).select(*kept, "x")


def _alike(pairs: DataFrame, sketches: DataFrame, fits: Column) -> DataFrame:
    """The rows of ``pairs`` whose lines a and b may be similar by their sketches."""
    named = pairs
    for x in ("a", "b"):
        named = named.join(sketches.select(F.col("h").alias(x), *[F.col(c).alias(c + x) for c in ("n", "bits")]), x)
    return named.filter(fits).select(*pairs.columns)


def _joined(members: DataFrame, joins: DataFrame) -> DataFrame:
    """``members`` with the components that result from joining components a and b."""
    merged = connected_components(joins, "componenta", "componentb").select(F.col("node").alias("component"), F.col("component").alias("whole"))
    return members.join(merged, "component", "left").withColumn("component", F.coalesce("whole", "component")).drop("whole")


def _still_open(members: DataFrame) -> DataFrame:
    """Rows of buckets that hold several components."""
    bucket = Window.partitionBy("key")
    return (
        members.withColumn("low", F.min("component").over(bucket)).withColumn("high", F.max("component").over(bucket))
        .filter("low <> high").drop("low", "high")
    )


def _apart(members: DataFrame) -> tuple[int, int]:
    """Rows of ``members``, and pairs of them that share a bucket but not a component."""
    sizes = members.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    all_, within = F.sum("n"), F.sum(F.col("n") * F.col("n"))
    found = sizes.groupBy("key").agg(all_.alias("n"), ((all_ * all_ - within) / 2).alias("pairs")).agg(F.sum("n"), F.sum("pairs")).first()
    return int(found[0] or 0), int(found[1] or 0)


def line_components(lines: DataFrame, places: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(h, component) of hashes of different lines that hang together by verified links.

    Each member of a bucket is first compared with the bucket's most central line only. While that
    leaves many pairs of members in different components, and fewer each time, they are compared with another member, drawn by hash.
    Those left meet, across components: in pairs told by
    their bitmaps if they are few, else by their rare shingles. Both find every similar pair. So neither a family of near copies nor a
    crowd of lines around one passage is compared pair by pair.
    """
    hashed = _hashed(lines, places)
    banded = settled(_banded(_signed(hashed)), step_copies())
    shared = _only(hashed, banded.select("h").distinct())
    sketches = cut_lineage(_sketched(shared).dropDuplicates(["h"]), compression="zstd")
    kept = step_copies()
    fits = _may_fit(similarity)
    star = banded.filter("h <> head").select(F.least("h", "head").alias("a"), F.greatest("h", "head").alias("b")).distinct()
    first = settled(connected_components(_verified(cut_lineage(_alike(star, sketches, fits)), lines, similarity), "a", "b"), kept)
    grouped = first.select(F.col("node").alias("h"), "component")

    known = banded.filter("h <> head").join(grouped, "h", "left")  # a bucket's head has met all its members
    members = cut_lineage(_still_open(known.select("key", "h", "size", F.coalesce("component", "h").alias("component"))))
    rows, pairs_apart = _apart(members)
    all_joins = []
    for turn in range(ROUNDS):
        if pairs_apart <= 16 * rows:
            break
        drawn = F.struct(F.xxhash64(F.lit(turn), "h").alias("x"), F.col("h"), F.col("component"))
        met = members.withColumn("head", F.min(drawn).over(Window.partitionBy("key")))
        tried = met.filter("component <> head.component").select(
            F.least("h", "head.h").alias("a"), F.greatest("h", "head.h").alias("b"),
            F.least("component", "head.component").alias("componenta"), F.greatest("component", "head.component").alias("componentb"),
        ).distinct()
        joins = cut_lineage(
            _verified(cut_lineage(_alike(tried, sketches, fits)), lines, similarity).select("componenta", "componentb").distinct()
        )
        all_joins.append(joins)
        members = cut_lineage(_still_open(_joined(met.filter("h <> head.h").drop("head"), joins)))
        last, (rows, pairs_apart) = pairs_apart, _apart(members)
        if pairs_apart > 0.7 * last:
            break

    small = members.filter(F.col("size") <= PAIRED).select("key", "h", "component")
    one, other = _both(small.join(sketches, "h"), "key")
    apart = F.col("componenta") < F.col("componentb")
    close = cut_lineage(
        one.join(other, "key").filter(apart & fits).select("a", "b", "componenta", "componentb").distinct()
    )
    large = cut_lineage(members.filter(F.col("size") > PAIRED).select("h", "component").distinct())
    pairs = close
    if not large.isEmpty():
        texts = cut_lineage(_texts(lines, large.select("h")))
        rare = _rare_shingles(texts.join(large, "h").join(sketches, "h"), similarity)
        meeting = Window.partitionBy("x")
        met = rare.withColumn("low", F.min("component").over(meeting)).withColumn("high", F.max("component").over(meeting))
        one, other = _both(cut_lineage(met.filter("low <> high").drop("low", "high")), "x")
        close_by = one.join(other, "x").filter(apart & _may_fit(similarity)).select("a", "b", "componenta", "componentb")
        pairs = cut_lineage(close_by.union(close).distinct())
    joins = reduce(DataFrame.union, all_joins, _verified(pairs, lines, similarity).select("componenta", "componentb")).distinct()
    merged = connected_components(joins, "componenta", "componentb").withColumnRenamed("component", "whole")
    # A line that was alone, but joins a component now, is a component of itself so far.
    known = grouped.union(merged.select("node", "node")).distinct()
    return known.join(merged, F.col("component") == F.col("node"), "left").select(
        "h", F.coalesce("whole", "component").alias("component")
    ).groupBy("h").agg(F.min("component").alias("component"))


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    similarity: float = SIMILARITY, min_chars: int = MIN_CHARS,
) -> DataFrame:
    """``docs`` with near-duplicate lines removed, plus ``n_lines`` and ``n_dropped``.

    Lines end at a line feed; they are compared trimmed and in lower case. Equal lines and lines
    linked by a Jaccard similarity of at least ``similarity`` form components; the line of the
    smallest id (null before all), then the smallest line number, stays, all others go. Lines
    shorter than ``min_chars``, blank ones by default, always stay. A null text stays null with no lines; an empty one has one
    empty line. Rows equal in id and text are one document, and each of them keeps the same lines.
    All columns are kept, but for those called ``n_lines`` or ``n_dropped``, which the new ones replace.
    """
    doc, gone = free_name(docs, "row_hash"), free_name(docs, "dropped_lines")
    lines = _lines(docs, id_col, text_col, min_chars)
    places = cut_lineage(lines.select("doc", "id", "line_no", F.xxhash64("line").alias("h")))
    before = step_copies()
    grouped = settled(line_components(lines, places, similarity), before)
    classed = places.join(grouped, "h", "left").select(
        "doc", F.struct("id", "doc", "line_no").alias("place"), F.coalesce("component", "h").alias("class")
    )
    first = (
        classed.groupBy("class").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("kept")).filter("n > 1")
    )
    dropped = (
        classed.join(first, "class").filter("place <> kept")
        .groupBy("doc").agg(F.collect_set("place.line_no").alias(gone)).withColumnRenamed("doc", doc)
    )
    split = F.split(F.col(text_col), "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col(gone))
    text = F.when(F.col(gone).isNull(), F.col(text_col)).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get(split, i)), "\n")
    )
    own = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")]
    columns = [text.alias(c) if c == text_col else F.col(f"`{c}`") for c in own]
    return (
        docs.withColumn(doc, _row_hash(id_col, text_col)).join(dropped, doc, "left")
        .select(
            *columns,
            F.when(F.col(text_col).isNull(), 0).otherwise(F.size(split)).alias("n_lines"),
            F.coalesce(F.size(F.col(gone)), F.lit(0)).alias("n_dropped"),
        )
    )
