"""Candidate rows are worked out within each document: no window, sort or shuffle over segments, and the same rows."""

import random
import re

from pyspark.sql import functions as F

from tideline.functions import text as t
from tideline.operators import evidence as e
from tideline.operators import identity as i
from tideline.operators import segments as g
from tideline.plans import segment_queries as q
from tests.oracle import DATA


def pages(spark):
    rng = random.Random(5)
    row = lambda: f"{rng.choice([1, 2, 3, 4, 5, 364, 365]):03d}期 {rng.choice(['十码', '十码', '五码'])} {rng.choice(['01.02.03', '01.02.03', '04.05.06', '1.2.3', '07.07.08', '01.02', 'x', '01.02.03 / 04.05.06'])} 开:??"
    rows = [(d, "\n".join(row() for _ in range(rng.randint(0, 12))), 3, rng.choice(["top", "bottom", "top", "bottom", "left", None]), rng.choice([None, 0, 1, 2, 5])) for d in range(120)]
    docs = spark.createDataFrame([*rows, (120, None, 3, "top", 2)], "doc int, content string, count int, region string, window int")
    return docs.withColumn("keywords", F.array(t.normalize_keyword(F.lit("十码"), folded=False)))


def test_windows_of_documents_are_those_of_their_rows(spark):
    docs = pages(spark).localCheckpoint()
    rows = g.candidate_rows(docs)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"\bWindow\b|\bSort \[|Exchange", plan)
    found = {(r.doc, r.start): r for r in rows.collect()}
    seams = {(r.doc, r.start): r.seam for r in g.cycle_seam(g.segments(docs)).collect()}
    assert {k: r.seam for k, r in found.items()} == {k: seams[k] for k in found} and len({*seams.values()}) > 2
    marks = {(r.doc, r.start): r.in_window for r in g.direction_window(rows.drop("in_window")).collect()}
    assert {k: r.in_window for k, r in found.items()} == marks and {*marks.values()} == {True, False, None}


def test_usable_rows(spark):
    rows = g.candidate_rows(pages(spark)).collect()
    want = {}
    for r in rows:
        live = [x for x in rows if x.doc == r.doc and (x.seam is None or x.start < x.seam)]
        newest = max((x.period for x in live if x.in_window), default=None)
        held = any(x.period == r.period and x.in_window is not False and x.groups for x in live)
        want[r.doc, r.start] = r in live and (r.in_window is not False or (not held and newest is not None and newest < r.period))
    assert {(r.doc, r.start): r.usable for r in rows} == want
    assert any(r.usable and r.in_window is False for r in rows) and any(not r.usable for r in rows)


def test_identity_and_evidence_sort_no_segments(spark):
    pages_ = spark.createDataFrame([("d", "x", "a", "b", "top", 2, [1], False)], "doc string, content string, author string, row_anchor string, region string, window int, requested array<int>, skip_repeats boolean").localCheckpoint()
    for rows in i.identity_candidates(pages_):
        assert not re.search(r"\bWindow\b|\bSort \[|Exchange|Join", rows._jdf.queryExecution().executedPlan().toString())
    docs = pages(spark).withColumns({"kind": F.lit("page"), "url": F.lit("u"), "anchor": F.lit(""), "stop_anchor": F.lit(""), "source_url_pattern": F.lit(""), "fingerprint": F.sha2("content", 256)}).localCheckpoint()
    checked = e.evidence_violations(e.extract_located(docs).localCheckpoint(), docs)
    plan = checked._jdf.queryExecution().executedPlan().toString()
    # Pages are never deduplicated by an aggregate that holds them, and never stand in a window.
    assert not re.search(r"\bWindow\b|first\((content|section)", plan)


def test_other_contracts_are_joined_alike_at_every_size(spark):
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for threshold in ("-1", held):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            for name in ("what_if_extraction", "what_if_coverage"):
                plan = q.QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
                assert "SortMergeJoin" not in plan and "Broadcast" not in plan and plan.count("ShuffledHashJoin") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
