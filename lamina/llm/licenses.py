"""License notices found despite small edits.

Each short notice may differ by a few characters. Cut into one piece more than edits are allowed,
at least one piece stands unchanged in any match (pigeonhole). An automaton over all pieces finds
those places in one pass over the text; only around them the bounded-error matcher runs.
"""

from __future__ import annotations

import re

import ahocorasick
import numpy as np
import regex
from pyspark.sql import DataFrame

from lamina.llm.common import WORD_BYTES, map_batches, runs, text_chunks

# Phrases counted word by word, with their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Notices in the normal form of a text: words only, lower case, one space between.
NOTICES = {
    "licensed under the apache license": "apache",
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "neither the name of the copyright holder nor the names of its contributors": "bsd",
    "licensed under the gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license version 2 0": "mpl",
    "eclipse public license": "epl",
    "licensed under cc by": "cc-by",
    "creative commons attribution": "cc-by",
    "dedicated to the public domain": "public-domain",
    "permission to use copy modify and or distribute this software": "isc",
    "this is free and unencumbered software": "unlicense",
    "all rights reserved": "reserved",
}
EDIT_SHARE = 0.1  # edits allowed as a share of a notice's length, one at least


def allowed_edits(notice: str) -> int:
    return max(1, int(len(notice) * EDIT_SHARE))


def pieces(notice: str, edits: int) -> list[tuple[int, str]]:
    """(offset, piece) of ``edits + 1`` pieces of nearly equal length."""
    cuts = [round(i * len(notice) / (edits + 1)) for i in range(edits + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:])]


class Matcher:
    """The automaton over all pieces and one bounded-error expression for each notice."""

    def __init__(self, notices: dict[str, str]):
        self.notices = [(n, label, allowed_edits(n)) for n, label in notices.items()]
        self.fuzzy = [regex.compile(f"(?b)(?:{regex.escape(n)}){{e<={k}}}") for n, _, k in self.notices]
        seeds: dict[str, list[tuple[int, int]]] = {}
        for i, (n, _, k) in enumerate(self.notices):
            for offset, piece in pieces(n, k):
                seeds.setdefault(piece, []).append((i, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, places in seeds.items():
            self.automaton.add_word(piece, (len(piece), places))
        self.automaton.make_automaton()

    def find(self, text: str, lo: int = 0, hi: int | None = None) -> list[tuple[int, int, int, int]]:
        """(notice, start, end, edits), leftmost non-overlapping within each notice."""
        windows: dict[int, list[tuple[int, int]]] = {}
        for last, (length, places) in self.automaton.iter(text, lo, len(text) if hi is None else hi):
            for i, offset in places:
                n, _, k = self.notices[i]
                seed = last + 1 - length
                a, b = max(lo, seed - offset - k), seed - offset + len(n) + k
                a = max(a, text.rfind("\n", a, seed) + 1)  # a match stays within its text
                stop = text.find("\n", seed, b)
                windows.setdefault(i, []).append((a, b if stop < 0 else stop))
        found = []
        for i, spans in windows.items():
            spans.sort()
            done = -1
            for a, b in spans:
                m = self.fuzzy[i].search(text, max(a, done), min(b, len(text)))
                if m:
                    found.append((i, m.start(), m.end(), sum(m.fuzzy_counts)))
                    done = m.end()
        found.sort(key=lambda x: (x[1], x[0]))
        return found


_SPACE, _BREAK = 0x20, 0x0A
_BASE_RE = re.compile("|".join(f"(?<![^ \n])(?:{p})(?![^ \n])" for p in BASE).encode())


def _normal(texts: list[bytes]):
    """The texts in normal form, one after another with a line break after each, and for each byte
    of it the offset among all bytes of the texts (a break counts as one byte)."""
    raw = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    low = np.where((raw >= 0x41) & (raw <= 0x5A), raw + 32, raw).astype(np.uint8)
    word = WORD_BYTES[low]
    out = np.where(word, low, _SPACE).astype(np.uint8)
    out[ends] = _BREAK
    keep = word.copy()
    keep[1:] |= word[:-1]  # a single space after each word
    keep[ends] = True
    places = np.flatnonzero(keep)
    return raw, out[places], places, ends


def license_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts of words and base phrases, labels, score and spans.

    ``spans`` holds (label, start, end, edits) of each fuzzy match, offsets in code points of the
    original text. ``score`` is the best 1 - edits / length of a match, 1 for a base phrase, 0 for
    none. A null or empty text has no words and no labels. Non-ASCII letters count as one edit
    for each UTF-8 byte. Rows are independent: repeated rows give repeated results, other columns
    are not read.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = (
        f"id {id_type}, n_words long, n_base long, first_word long, last_word long, base_labels string, "
        "labels string, score double, spans array<struct<label:string,start:long,end:long,edits:int>>"
    )

    built: list[Matcher] = []  # once in each task

    def scan(batch):
        if not built:
            built.append(Matcher(NOTICES))
        matcher = built[0]
        for first, texts in text_chunks(batch, batch.schema.names[1]):
            rows = _scan_chunk(matcher, texts)
            yield batch.column(0).slice(first, len(texts)), *zip(*rows)

    return map_batches(docs.select(id_col, text_col), scan, schema).withColumnRenamed("id", id_col)


def _scan_chunk(matcher: Matcher, texts: list[bytes]) -> list[tuple]:
    raw, normal, places, ends = _normal(texts)
    starts, _ = runs(normal, WORD_BYTES)
    breaks = np.flatnonzero(normal == _BREAK)
    lows = np.concatenate([[0], breaks[:-1] + 1])
    first_word = np.searchsorted(starts, lows)
    n_words = np.searchsorted(starts, breaks) - first_word
    doc_start = np.concatenate([[0], ends[:-1] + 1])
    text = normal.tobytes()
    base: dict[int, list[tuple[int, str]]] = {}
    for m in _BASE_RE.finditer(text):
        d = int(np.searchsorted(breaks, m.start()))
        base.setdefault(d, []).append(
            (int(np.searchsorted(starts, m.start()) - first_word[d]), BASE[m[0].decode()])
        )
    fuzzy: dict[int, list[tuple]] = {}
    matches = matcher.find(text.decode("latin-1"))
    points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)]) if matches else None
    for i, s, e, edits in matches:
        d = int(np.searchsorted(breaks, s))
        a, b = int(places[s]), int(places[e - 1]) + 1
        n, label, _ = matcher.notices[i]
        zero = points[doc_start[d]]
        fuzzy.setdefault(d, []).append(
            (label, int(points[a] - zero), int(points[b] - zero), edits, 1 - edits / len(n))
        )
    rows = []
    for d in range(len(texts)):
        places_d, near = base.get(d, ()), fuzzy.get(d, ())
        base_labels = {x for _, x in places_d}
        labels = base_labels | {x[0] for x in near}
        score = 1.0 if places_d else max((x[4] for x in near), default=0.0)
        at = [w for w, _ in places_d]
        spans = [{"label": x[0], "start": x[1], "end": x[2], "edits": x[3]} for x in near]
        rows.append(
            (
                int(n_words[d]), len(at), min(at, default=None), max(at, default=None),
                ",".join(sorted(base_labels)), ",".join(sorted(labels)), score, spans,
            )
        )
    return rows
