"""Literal cases of text functions, segments, groups and windows."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tideline.functions import text as t
from tideline.operators import segments as g


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("label", "period"), [("007", 7), ("299期", 299), ("0", None), ("-1", None), ("12.3", None), ("1000", None), ("1期2期", None), (" 12 期", 12)])
def test_periods(spark, label, period):
    assert one(spark, t.try_period(F.lit(label))) == period


def test_period_keys_and_numbers(spark):
    assert one(spark, t.period_key(F.lit("第０12期"))) == "12"
    assert one(spark, t.period_key(F.lit("期"))) == ""
    assert one(spark, t.normalize_numbers(F.lit(" 01 ， 02 . 03 "))) == "01,02.03"


def test_html_is_unescaped_before_tags_are_cut(spark):
    assert one(spark, t.html_to_text(F.lit("a&lt;b&gt;c&amp;amp;<br>d<script>x</script><p>ｅ１</p>"))) == "ac&\nd\ne1"


@pytest.mark.parametrize(
    ("text", "strict", "relaxed"),
    [
        ("28.4002.14", None, "28,40,02,14"),
        ("28.5002.14", None, None),
        ("48.46.1", None, "48,46,01"),
        ("01.02.03", "01,02,03", "01,02,03"),
        ("开:0000 12 13 14", "12,13,14", "12,13,14"),
        ("开:05 12 13 14", None, None),
        ("2026-10-27\n01 02 03", "01,02,03", "01,02,03"),
        ("19:41:06 01 02 03", "01,02,03", "01,02,03"),
    ],
)
def test_number_groups(spark, text, strict, relaxed):
    for want, loose in ((strict, False), (relaxed, True)):
        got = one(spark, F.try_element_at(g.number_groups(F.lit(text), loose), F.lit(1)))
        assert (",".join(got) if got else None) == want


def test_segments_equal_a_scan(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice(["12", "期", "棋", "3", " ", "\n", "x", ":", "1000期", "0", "45期"]) for _ in range(30)) for _ in range(300)]
    pattern = re.compile(r"(?<!\d)0?(\d{1,3})\s*[期棋](?:.*?)(?=(?<!\d)\d+\s*[期棋]|\n[ \t]*\d+[ \t]*[:：]|\Z)", re.S)
    want = {(i, m.start(), m[0]) for i, x in enumerate(texts) for m in pattern.finditer(x) if int(m[1])}
    got = g.segments(spark.createDataFrame(list(enumerate(texts)), "doc int, content string")).collect()
    assert {(r.doc, r.start, r.segment) for r in got} == want


def rows(spark, items, region, window):
    return spark.createDataFrame([(1, i, p, v, None, region, window) for i, (p, v) in enumerate(items)], "doc int, start int, period int, value string, seam int, region string, window int")


def test_windows_do_not_count_repeated_rows(spark):
    top = g.direction_window(rows(spark, [(3, "a"), (3, "a"), (2, "b"), (1, "c")], "top", 2)).filter("in_window").collect()
    assert sorted(r.start for r in top) == [0, 2]
    bottom = g.direction_window(rows(spark, [(230, "a"), (231, "b"), (230, "a")], "bottom", 1)).filter("in_window").collect()
    assert [r.start for r in bottom] == [2]


def test_last_years_rows_lie_behind_the_seam(spark):
    docs = spark.createDataFrame([(1, i, p) for i, p in enumerate([2, 1, 365, 364])], "doc int, start int, period int")
    assert {r.seam for r in g.cycle_seam(docs).collect()} == {2}


def test_a_missing_anchor_is_never_the_whole_page(spark):
    docs = spark.createDataFrame([(1, "x\n271期:A 01 02 03\nend", "A", "end"), (2, "x", "A", None), (3, "A x", "A", "end")], "doc int, content string, anchor string, stop_anchor string")
    got = {r.doc: (r.content, r.problem) for r in g.scope_by_anchor(docs).collect()}
    assert got[1] == ("271期:A 01 02 03\n", None)
    assert got[2] == (None, "anchor not found") and got[3] == (None, "stop anchor not found")


def test_ambiguity_is_a_problem_unless_pending_rows_are_preferred(spark):
    docs = [(1, "9期 01 02 03 \n9期 04 05 06 "), (2, "9期 01 02 03 \n9期 04 05 06 开:??"), (3, "9期 07 07 08 \n9期 07 07 08 ")]
    frame = spark.createDataFrame(docs, "doc int, content string").selectExpr("*", "cast(array() as array<string>) AS keywords", "3 AS count", "'top' AS region", "5 AS window")
    found = lambda **how: {r.doc: (r.value, r.problem) for r in g.extract(frame, **how).collect()}
    assert found() == {1: (None, "ambiguous"), 2: (None, "ambiguous")}
    assert found(prefer_pending=True) == {1: (None, "ambiguous"), 2: ("04,05,06", None)}
    assert found(strict=False) == {1: ("01,02,03", None), 2: ("04,05,06", None)}
    assert found(allow_repeats=True)[3] == ("07,07,08", None)
