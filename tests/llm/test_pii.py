"""Personal data against the rule in Python's expressions, and against SQL."""

import hashlib
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from tests.oracle import assert_agrees, connection
from tideline.llm.pii import OP13_SQL, find_personal_data, op13_pii, running_sums

RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def checked(digits):
    return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def base_by_definition(text):
    for kind, pattern in RULES.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip":
                ok = all(int(x) <= 255 for x in m[0].split("."))
            elif kind == "card":
                ok = 16 <= len(digits) <= 19 and checked(digits)
            else:
                ok = kind == "email" or 8 <= len(digits) <= 15
            if ok:
                yield kind, m.start(), m.end()


def spans_of(spark, texts, extra=""):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    return {r.doc_id: [(s.kind, s.start, s.end, s.score) for s in r.personal] for r in find_personal_data(rows).collect()}


CASES = [
    "a@b.c-d@e.f a@b.co_x@y.zz .@x.y a..b@c..d.e a@b@c.d @x.y a@b. a@b.c. a@-.- é@a.b a@b.é x@1.2.3.4",
    "1.2.3.4.5.6.7.8 256.1.1.1 1.1.1.256 0001.02.3.255 1..2.3.4 .1.2.3.4. 1.2.3 99999999999.1.1.1 00000000000000.0.0.0",
    "4111 1111 1111 1111 4111-1111-1111-1111 4111111111111111 4111  1111 1111 1111 4111 -1111 1111 1111 1 4111111111111111",
    "5500005555555559 - 1 5500005555555559-x -5500005555555559 6304000000000000000 0000000000000000000 00000000000000000000",
    "+1 (017) 555-5036 +1((((((9 +12 +1-+1 555 55555 +123456789012345 +1234567890123456 ++49 30 1234567. +1 ).- 2345678",
    "\U0001f600 mail a@b.cc \U0001f600 1.2.3.4 é +1 234 567 89",
]


def test_base_spans_equal_the_definition(spark):
    rng = random.Random(3)
    alphabet = ["a", "B", "@", ".", "-", "_", " ", "1", "2", "0", "9", "+", "(", ")", "é", "\U0001f600", "\n", "%", "255", "4111111111111111", "a@b.c", "1.2.3.4", "+1 23456789"]
    texts = CASES + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(600)]
    texts += ["".join(rng.choice("12 -.") for _ in range(60)) for _ in range(200)] + ["".join(rng.choice("a@.-_") for _ in range(50)) for _ in range(300)]
    got = spans_of(spark, texts)
    for i, text in enumerate(texts):
        assert [s[:3] for s in got[i] if s[0] in RULES] == list(base_by_definition(text)), text


def test_added_kinds_and_scores(spark):
    texts = [
        "IBAN: DE89 3704 0044 0532 0130 00 THE BANK",
        "GB82WEST12345698765432",
        "DE89 3704 0044 0532 0130 01",
        "xDE89370400440532013000 and DE893704004405320130001",
        "DE89 37040044 0532 0130 00",
        "ZZ89370400440532013000",
        "ssn 123-45-6789 and 123-45-6789",
        "123-45-6789",
        "social security number: 666-12-1234, 000-12-1234, 912-12-1234, 123-00-1234, 123-12-0000, 1123-12-1234",
        "my visa card 4111111111111111 was charged",
        "order 4111111111111111",
        "discard 4111111111111111",
        "release 1.2.3.4 of",
        "call +1 (017) 555-5036",
        "NO9386011117947",
    ]
    got = spans_of(spark, texts)
    assert got[0] == [("iban", 6, 33, 95)] and got[1] == [("iban", 0, 22, 80)] and got[14] == [("iban", 0, 15, 80)]
    assert all(got[i] == [] for i in (2, 3, 4, 5, 7, 8))
    assert got[6] == [("ssn", 4, 15, 70)]  # words count up to the next proposal
    assert [got[i][0][3] for i in (9, 10, 11, 12, 13)] == [90, 50, 70, 30, 80]


def test_long_texts_need_no_stack_and_no_square(spark):
    n = 200_000
    texts = ["1" * n, "1 " * n, "1-" * n, "a." * n + "@b.c", "x@" + "a." * n + "a", "1." * n, "+" + "1 " * n, "a" * n, "+1" + " " * n + "+1", "DE89 " * n, "-" * n + "12", "a@b.cc " * n, "AB12CD34" * n]
    began = time.time()
    got = spans_of(spark, texts)
    assert [len(got[i]) for i in range(len(texts))] == [0, 0, 0, 1, 1, n // 4, 0, 0, 0, 0, 0, n, 0]
    assert got[4] == [("email", 0, 2 * n + 3, 90)] and got[11][-1][:3] == ("email", 7 * n - 7, 7 * n - 1)
    assert time.time() - began < 120


def test_odd_rows(spark):
    rows = [(1, None, "p"), (2, "", "p"), (2, "a@b.cc", None), (2, "a@b.cc", None), (None, "a@b.cc", "q")]
    got = find_personal_data(spark.createDataFrame(rows, "doc_id int, text string, personal string").withColumn("doc", F.lit(1)).withColumn("email", F.lit(2)))
    assert got.columns == ["doc_id", "text", "doc", "email", "personal"]
    assert sorted((r.doc_id or 0, len(r.personal)) for r in got.collect()) == [(0, 1), (1, 0), (2, 0), (2, 1), (2, 1)]
    assert find_personal_data(spark.createDataFrame([], "text string")).count() == 0


@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 2000])
def test_running_sums(spark, n):
    df = spark.createDataFrame([(list(range(n)),)], "a array<int>")
    assert df.select(running_sums(F.col("a")).alias("s")).first().s == [i * (i + 1) // 2 for i in range(n)]


def test_op13_contract(spark):
    assert_agrees(spark, op13_pii, OP13_SQL, "/root/testdata/sf0.01")
    got = {r.doc_id: r for r in op13_pii(spark, "/root/testdata/sf0.01").collect()}
    for doc_id, text in connection("/root/testdata/sf0.01").execute("SELECT doc_id, text FROM documents").fetchall():
        base = list(base_by_definition(text or ""))
        r = got[doc_id]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for k, *_ in base) for kind in RULES]
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()


def test_no_python_in_the_plan(spark):
    plan = op13_pii(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
