"""Personal data against a direct reading of the definitions."""

import hashlib
import random
import re

from lamina.llm import pii
from lamina.llm.queries import op5_pii

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _plain(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),
                "card": lambda: 12 <= len(digits) <= 19 and pii.luhn(digits), "phone": lambda: 9 <= len(digits) <= 15,
            }[kind]()
            if good:
                out.append((kind, *m.span()))
    return sorted(out, key=lambda x: (x[1], list(BASE).index(x[0])))


def test_checksums():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.mod97("DE89370400440532013000") and not pii.mod97("DE89370400440532013001")


def test_base_spans_on_random_texts():
    rng = random.Random(1)
    for _ in range(4000):
        text = "".join(rng.choices("0123456789.@+-() aZ%ü", weights=[4] * 10 + [8, 4, 2, 2, 1, 1, 4, 4, 4, 1, 1], k=rng.randint(0, 40)))
        got = [x[:3] for x in pii.find_spans(text) if x[0] in pii.BASE_KINDS]
        assert got == _plain(text), text


def test_context_and_iban():
    text = "Please pay to IBAN DE89 3704 0044 0532 0130 00 by card 4111 1111 1111 1111. 123-45-6789"
    found = {k: p for k, _, _, p in pii.find_spans(text)}
    assert found["iban"] > pii.PRIOR["iban"] and found["card"] > pii.PRIOR["card"] and "ssn" not in found
    assert [x[0] for x in pii.find_spans("SSN 123-45-6789")] == ["ssn"]


def test_account_numbers_beside_words_in_capitals():
    spanish, german = "ES91 2100 0418 4502 0005 1332", "DE89 3704 0044 0532 0130 00"
    ibans = lambda text: [text[s:e] for k, s, e, _ in pii.find_spans(text) if k == "iban"]
    assert ibans(f"{spanish} BIC") == ibans(f"{spanish} BIC XXXX") == ibans(spanish) == [spanish]
    assert ibans(f"{spanish} {german}") == [spanish, german]
    assert ibans(f"AB12 3456 7890 {german} EUR") == [german]
    assert ibans("ES91 2100 0418 4502 0005 1333 BIC") == [] and ibans("ES9121000418450200051332BIC") == []


def test_session_settings_stay(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    docs = spark.createDataFrame([(i, "mail a@b.co") for i in range(2500)], "doc_id long, text string")
    assert pii.personal_data(docs).filter("size(found) = 1").count() == 2500
    assert spark.conf.get(name) == before


def test_long_runs_are_linear():
    for text in ("AB12 " * 60_000, "a" * 300_000, "1" * 300_000, "1." * 150_000, "a@" * 100_000, "+" * 300_000, "A1" * 150_000):
        pii.find_spans(text)


def test_query(spark, tmp_path):
    rows = [(1, None), (2, ""), (3, "mail a@b.co, 1.2.3.4 and +1 (386) 555-3733"), (3, "ü x@y.z"), (None, "10.0.0.1")]
    docs = spark.createDataFrame([(d, t, "k", 0) for d, t in rows], "doc_id long, text string, kind string, start int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r["doc_id"], r["spans"]): r for r in op5_pii(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    for d, t in rows:
        spans = _plain(t or "")
        row = got[d, pii.joined(spans)]
        assert row["base_sha256"] == hashlib.sha256(pii.joined(spans).encode()).hexdigest()
        assert [row[f"n_{k}"] for k in pii.BASE_KINDS] == [sum(x[0] == k for x in spans) for k in pii.BASE_KINDS]
