"""Evidence of literal pages: offsets, and every violation in its turn."""

from pyspark.sql import functions as F

from tideline.functions import text as t
from tideline.operators import evidence as e

PAGE = "head 9期 十码 09.08.07\n栏目\n003期 十码 03.04.05\n002期 十码 02.03.04\n001期 十码 01.02.03\n终点 tail"


def docs(spark, *cases, window=2):
    """A page for each case (its name), with a content and a pattern of its own where the case has them."""
    rows = [(name, "page", "http://H/Topic/1", content or PAGE, "栏目", "终点", 3, "top", window, pattern) for name, content, pattern in cases or [("d", None, None)]]
    frame = spark.createDataFrame(rows, "doc string, kind string, url string, content string, anchor string, stop_anchor string, count int, region string, window int, source_url_pattern string")
    return frame.withColumns({"fingerprint": F.sha2("content", 256), "keywords": F.array(t.normalize_keyword(F.lit("十码"), folded=False))})


def violations(found, page):
    return [(r.period, r.violation) for r in e.evidence_violations(found, page).orderBy("period").collect()]


def test_offsets_are_those_of_the_whole_page(spark):
    rows = {r.period: r for r in e.extract_located(docs(spark)).collect()}
    assert set(rows) == {3, 2}
    for period, row in rows.items():
        at = row.evidence
        assert PAGE[at.section_start : at.section_end].startswith("栏目\n") and PAGE[at.section_end :].startswith("终点")
        assert PAGE[at.candidate_start :].startswith(f"00{period}期") and at.source_kind == "page" and at.anchor == "栏目"
    assert violations(e.extract_located(docs(spark)), docs(spark)) == []
    lost = e.extract_located(docs(spark, ("d", "no section", None))).collect()
    assert [(r.period, r.problem, r.evidence) for r in lost] == [(None, "anchor not found", None)]


def test_what_the_window_leaves_out_is_not_reproduced(spark):
    wide, narrow = e.extract_located(docs(spark, window=3)), docs(spark, window=2)
    assert violations(wide, narrow) == [(1, "not reproduced")]


def test_each_violation(spark):
    at, end, start, doc = F.col("evidence.candidate_start"), F.col("evidence.section_end"), F.col("evidence.section_start"), F.col("doc")
    changed = [
        ("incomplete", "source_url", F.lit("")),
        ("incomplete too", "section_start", F.lit(None).cast("int")),
        ("altered", "fingerprint", F.lit("x")),
        ("out of range", "candidate_start", start - 1),
        ("out of range too", "section_end", end + 1000),
        ("another section", "section_start", start - 1),
        ("another period", "candidate_start", at + 3),
        ("not reproduced", "candidate_start", at + 1),
    ]
    cases = [(name, None, None) for name, *_ in changed] + [("another value", None, None), ("another URL", None, "/post/"), ("good", None, "/topic/"), ("good too", None, " ".strip())]
    pages = docs(spark, *cases)
    found = e.extract_located(pages).withColumn("value", F.when(doc == "another value", "01,02,03").otherwise(F.col("value")))
    for name, field, value in changed:
        found = found.withColumn("evidence", F.when(doc == name, F.col("evidence").withField(field, value)).otherwise(F.col("evidence")))
    got = {}
    for r in e.evidence_violations(found, pages).collect():
        got.setdefault(r.doc, set()).add(r.violation)
    assert got == {name: {name.removesuffix(" too")} for name, *_ in cases if not name.startswith("good")}
