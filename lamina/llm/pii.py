"""Personal data: expressions propose spans, checksums confirm them, context moves the score."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame

from lamina.llm.common import map_slices

KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
BASE_KINDS = KINDS[:4]

# Each pattern starts only where a run of its characters starts and gives nothing back, so a scan
# is linear in the text.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
IBAN_LEAST = 12  # characters that a proposal has at least, and so any shorter reading of it
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_PROPOSES = re.compile(r"[0-9@]")

CONTEXT_BEFORE, CONTEXT_AFTER = 48, 24
CONTEXT_GAIN = 0.25
PRIOR = {"email": 0.7, "ip": 0.5, "card": 0.6, "phone": 0.5, "iban": 0.7, "ssn": 0.3}
CONTEXT = {
    "email": re.compile(r"mail|contact|write|address", re.I),
    "ip": re.compile(r"\bip\b|host|server|address|login", re.I),
    "card": re.compile(r"card|visa|credit|debit|payment", re.I),
    "phone": re.compile(r"phone|call|tel\b|mobile|fax", re.I),
    "iban": re.compile(r"iban|bank|account|transfer", re.I),
    "ssn": re.compile(r"\bssn\b|social security", re.I),
}
NEEDS_CONTEXT = {"ssn"}  # has no checksum: only its context confirms it


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def mod97(text: str) -> bool:
    """The ISO 7064 test of an account number: letters as 10 to 35, remainder 1."""
    turned = text[4:] + text[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _ibans(text: str):
    """Spans of account numbers: of each proposal the longest run of whole groups that passes the test, as a
    short word in capitals may follow. The search goes on after that run, else one character on; a
    proposal has at most 43 characters, so this stays linear."""
    at = 0
    while m := _IBAN.search(text, at):
        end = m.end()
        while end > m.start() and not mod97(text[m.start() : end].replace(" ", "")):
            end = max(m.start(), text.rfind(" ", m.start(), end))
            if len(text[m.start() : end].replace(" ", "")) < IBAN_LEAST:
                end = m.start()
        if end > m.start():
            yield m.start(), end
        at = max(end, m.start() + 1)


def _emails(text: str):
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _proposed(text: str):
    """(kind, start, end) of all matches whose form and checksum hold."""
    if "@" in text:
        for s, e in _emails(text):
            yield "email", s, e
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            yield "ip", *m.span()
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            yield "card", *m.span()
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m[0])) <= 15:
                yield "phone", *m.span()
    for s, e in _ibans(text):
        yield "iban", s, e
    for m in _SSN.finditer(text):
        yield "ssn", *m.span()


def find_spans(text: str) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) of one text, by start, then by kind in the order of KINDS."""
    if not _PROPOSES.search(text):
        return []
    found = []
    for kind, s, e in _proposed(text):
        around = text[max(0, s - CONTEXT_BEFORE) : s] + "\n" + text[e : e + CONTEXT_AFTER]
        near = bool(CONTEXT[kind].search(around))
        if near or kind not in NEEDS_CONTEXT:
            found.append((kind, s, e, round(PRIOR[kind] + CONTEXT_GAIN * near, 4)))
    found.sort(key=lambda x: (x[1], KINDS.index(x[0])))
    return found


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id and ``found``, an array of (kind, start, end, score).

    Offsets are code points, ends exclusive. A null or empty text has no span; repeated rows give
    repeated results; other columns are not read.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"id {id_type}, found array<struct<kind:string,start:int,end:int,score:double>>"

    def scan(batch):
        texts = batch.column(1).to_pylist()
        found = [
            [{"kind": k, "start": s, "end": e, "score": p} for k, s, e, p in find_spans(t or "")] for t in texts
        ]
        yield batch.column(0), found

    return map_slices(docs.select(id_col, text_col), scan, schema).withColumnRenamed("id", id_col)


def joined(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e, *_ in spans)


def digest_row(spans) -> tuple:
    """Counts per base kind, digest of the base spans, all spans as text; for tests."""
    base = [x for x in spans if x[0] in BASE_KINDS]
    counts = tuple(sum(x[0] == k for x in base) for k in BASE_KINDS)
    return (*counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans))
