"""Spans of personal data against the plain patterns in Python."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from visitlens.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(text):
    numbers = [int(c) for c in text if c in "0123456789"][::-1]
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(numbers)) % 10 == 0


def n_digits(text):
    return sum(c in "0123456789" for c in text)


def expected(text):
    text = text or ""
    kinds = {
        "email": [m.span() for m in EMAIL.finditer(text)],
        "ip": [m.span() for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))],
        "card": [m.span() for m in CARD.finditer(text) if 16 <= n_digits(m[0]) <= 19 and luhn(m[0])],
        "phone": [m.span() for m in PHONE.finditer(text) if 8 <= n_digits(m[0]) <= 15],
    }
    written = ",".join(f"{k}:{a}:{b}" for k, spans in kinds.items() for a, b in spans)
    return tuple(len(v) for v in kinds.values()) + (hashlib.sha256(written.encode()).hexdigest(),), written


def found(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return sorted(pii.span_digest(pii.find_personal_data(df)).collect())


def test_base_kinds_equal_the_plain_patterns(spark):
    random.seed(5)
    parts = ["a", "b.c", "@", ".", "-", "+", " ", "1", "23", "456", "é", "x@y.de", "%", "1.2.3.4", "(", ")",
             "4111 1111 1111 1111", "+49 (30) 1234567", "256.1.1.1", "\n", "𝒳", "0", "4012888888881881", "_"]
    texts = ["".join(random.choice(parts) for _ in range(random.randint(0, 40))) for _ in range(600)]
    texts += [None, "", "1.2.3.4.5.6.7.8", "a@b.c%d@e.f", "1  2345 6", "0000000001.2.3.4"]
    for row, text in zip(found(spark, texts), texts):
        digest, written = expected(text)
        assert tuple(row)[1:6] == digest, text
        added = [s for s in row["spans"].split(",") if s.split(":")[0] in ("iban", "ssn")]
        assert ",".join([s for s in [written] if s] + added) == row["spans"]


@pytest.mark.parametrize("filler", ["1", "a", "1 ", "1.", "+1", "a.", "@a", "AB12"])
def test_long_runs_are_linear(spark, filler):
    assert found(spark, [filler * 60_000])[0]["n_email"] == 0  # the plain patterns would take minutes


def test_checksums_and_context(spark):
    rows = found(spark, ["Konto DE89 3704 0044 0532 0130 00 bitte", "DE88370400440532013000",
                         "my ssn is 123-45-6789", "order 123-45-6789", "card 4111 1111 1111 1111"])
    assert [r["spans"] for r in rows] == ["iban:6:33", "", "ssn:10:21", "", "card:5:24"]
    assert rows[0]["top_score"] == pytest.approx(1.0) and rows[1]["top_score"] is None


@pytest.mark.parametrize("text, spans", [
    ("DE89370400440532013000 Thanks", ["0:22"]),
    ("DE89 3704 0044 0532 0130 00 Please pay", ["0:27"]),
    ("IBAN: DE89370400440532013000 BIC COBADEFF", ["6:28"]),
    ("GB82 WEST 1234 5698 7654 32 AND 12 MORE CAPITALS", ["0:27"]),
    ("DE89370400440532013000 GB82WEST12345698765432", ["0:22", "23:45"]),
    ("AB12 DE89370400440532013000 2 times", ["5:27"]),
    ("DE89370400440532013000Thanks xGB82WEST12345698765432", []),
    ("DE89370400440532013001 Thanks", []),
    ("MT84MALT011000012345MTLCAST001S, NO9386011117947.", ["0:31", "33:48"]),
    ("é𝒳 LC55HEMM000100010012001200023015 X", ["3:35"]),
    ("D E 8 9 DE89 3 7 0 4 0 0 4 4 0 5 3 2 0 1 3 0 0 0 X", ["8:48"]),
])
def test_account_numbers_end_where_the_checksum_says(spark, text, spans):
    got = [s.removeprefix("iban:") for s in found(spark, [text])[0]["spans"].split(",") if s.startswith("iban")]
    assert got == spans


def test_odd_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, email string")
    assert pii.span_digest(pii.find_personal_data(empty)).count() == 0
    rows = spark.createDataFrame([(None, "x@y.de", "e"), (1, "x@y.de", None), (1, "x@y.de", None)],
                                 "doc_id long, text string, email string")
    assert [r["n_email"] for r in pii.span_digest(pii.find_personal_data(rows)).collect()] == [1, 1, 1]


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = pii.span_digest(pii.find_personal_data(df))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_mod97(spark):
    df = spark.createDataFrame([("GB82WEST12345698765432",), ("GB82WEST12345698765433",)], "v string")
    assert [r[0] for r in df.select(pii.mod97(F.col("v"))).collect()] == [True, False]
