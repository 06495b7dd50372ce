import hashlib
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from starloom.llm import queries
from starloom.llm.personal import BASE_KINDS, KINDS, find, luhn, redacted, spans

# The base definitions.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
SCHEMA = "doc_id long, text string, spans string, kind long, n_email string"


def _valid(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(part) <= 255 for part in found.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def _brute(text):
    found = [
        (kind, m.start(), m.end()) for kind, pattern in PATTERNS.items() for m in re.finditer(pattern, text)
        if _valid(kind, m.group())
    ]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


@pytest.mark.parametrize("letters", ["a@.b1-", "12.+ -()", "0123456789 -.+", "a1@.+ (-)x:/", "5. @+é", "@.a%_:/x"])
def test_base_spans_as_by_regular_expressions(letters):
    draw = random.Random(letters)
    for _ in range(5_000):
        text = "".join(draw.choices(letters, k=draw.randrange(60)))
        assert [tuple(s[:3]) for s in spans(text) if s.base] == _brute(text), text


def test_base_spans_among_cues():
    draw = random.Random(3)
    pieces = ["iban ", "GB82 WEST 1234 5698 7654 32", "account no. ", "tel:", "555-123-4567", "a@b.c", "://", "http", "x:y@",
              "4111 1111 1111 1111", "+1 (509) 555-6973", "10.0.0.1", "(at)", " dot ", "com", "SSN ", "123-45-6789", "é", "\n"]
    for _ in range(5_000):
        text = "".join(draw.choices(pieces, k=draw.randrange(12)))
        found = spans(text)
        assert [tuple(s[:3]) for s in found if s.base] == _brute(text), text
        assert found == sorted(found, key=lambda s: (s.start, KINDS.index(s.kind), s.end))


@pytest.mark.parametrize("text, kind, value", [
    ("see https://bob:pw@host.example/x?y. ok", "url", "https://bob:pw@host.example/x?y"),
    ("mail jane.doe (at) mail dot example dot com", "email", "jane.doe (at) mail dot example dot com"),
    ("mail jane[at]example[dot]org!", "email", "jane[at]example[dot]org"),
    ("IBAN: GB82 WEST 1234 5698 7654 32 thanks", "iban", "GB82 WEST 1234 5698 7654 32"),
    ("Social security number 123-45-6789.", "ssn", "123-45-6789"),
    ("account no. 12345-678 x", "account", "12345-678"),
    ("Twitter: @some_body!", "account", "@some_body"),
    ("tel:555-123-4567", "phone", "555-123-4567"),
])
def test_what_cues_add(text, kind, value):
    assert [(s.kind, text[s.start:s.end]) for s in spans(text) if not s.base] == [(kind, value)]


@pytest.mark.parametrize("text", [
    "IBAN: GB82 WEST 1234 5698 7654 33", "ssn 000-45-6789", "the account was closed", "@media print", "https://host/x@y",
    "meet at noon (at) the bar", "theuser 1234567", "member of parliament", "tel: call me", "token 12345678",
])
def test_what_cues_do_not_add(text):
    assert spans(text) == []


def test_marks_for_overlapping_spans():
    text = "x https://bob:pw@host.example/x y +1 509 555 6973."
    assert redacted(text, spans(text)) == "x [URL] y [PHONE]."


@pytest.mark.parametrize("piece", ["1  ", "1..", "a@b", "a@", "://a@b/c", "1.2.3.4.", "1 ", "+1 ", "a.", "+1-", "iban GB82 "])
def test_long_texts_take_linear_time(piece):
    started = time.process_time()
    spans(piece * 200_000)
    assert time.process_time() - started < 10


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "a@b.cc"), (3, "a@b.cc"), (3, "a@b.cc"), (4, "é 😀 10.0.0.1"), (5, "256.1.1.1 " * 9)]
    found = find(spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], SCHEMA), redact=True).collect()
    assert sorted((r.doc_id or 0, r.n_email, r.n_ip, r.text) for r in found) == sorted([
        (1, 0, 0, None), (2, 0, 0, ""), (0, 1, 0, "[EMAIL]"), (3, 1, 0, "[EMAIL]"), (3, 1, 0, "[EMAIL]"),
        (4, 0, 1, "é 😀 [IP]"), (5, 0, 0, "256.1.1.1 " * 9),
    ], key=lambda r: r[:3] + (r[3] or "",))
    assert [(s.kind, s.start, s.end, s.base) for r in found if r.doc_id == 4 for s in r.spans] == [("ip", 4, 12, True)]


def test_empty_table(spark):
    assert find(spark.createDataFrame([], SCHEMA)).collect() == []


def test_whole_query_as_by_regular_expressions(spark):
    folder = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = queries.op11_personal(spark, folder).collect()
    assert len(found) == len(texts)
    for row in found:
        base = _brute(texts[row.doc_id])
        told = ",".join(f"{kind}:{start}:{end}" for kind, start, end in base)
        assert row.base_sha256 == hashlib.sha256(told.encode()).hexdigest()
        assert [row[f"n_{kind}"] for kind in BASE_KINDS] == [sum(k == kind for k, _, _ in base) for kind in BASE_KINDS]
        assert set(filter(None, told.split(","))) <= set(row.spans.split(","))
    assert sum(r.n_email + r.n_phone + r.n_card for r in found) > 20


def test_query_columns(spark):
    assert queries.op11_personal(spark, "/root/testdata/sf0.001").filter(F.col("base_sha256").isNull()).count() == 0
