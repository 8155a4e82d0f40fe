"""State replacement, retention, refusal, the stream, and readers of odd inputs."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from tideline.operators import history as h
from tideline.sources import landed as s
from tideline.streaming import rounds

STATES = "site_name string, site_url string, period int, state string, value string, reason string"


def states(spark, rows):
    return spark.createDataFrame([(n, "u", p, "success" if v else "failed", v, None if v else "lost") for n, p, v in rows], STATES)


def results(spark, rows):
    return spark.createDataFrame([(n, "u", p, v) for n, p, v in rows], "site_name string, site_url string, period int, value string")


def failures(spark, rows):
    return spark.createDataFrame([(n, "u", p, r) for n, p, r in rows], "site_name string, site_url string, period int, reason string")


def test_a_round_replaces_states_and_rolls_its_own_sites_only(spark):
    old = states(spark, [("a", 1, "x"), ("a", 2, "x"), ("b", 1, "x"), ("b", 215, "y")])
    new = h.update(old, results(spark, [("a", 12, "z")]), failures(spark, [("a", 2, "gone")]), [2, 12])
    assert sorted((r.site_name, r.period, r.state) for r in new.collect()) == [("a", 12, "success"), ("b", 1, "success"), ("b", 215, "success")]
    again = h.update(old, results(spark, []), failures(spark, [("a", 2, "gone")]), [2])
    assert ("a", 2, "failed", None) in [(r.site_name, r.period, r.state, r.value) for r in again.collect()]


def test_both_states_at_once_are_refused(spark):
    with pytest.raises(ValueError, match="refused"):
        h.update(states(spark, []), results(spark, [("a", 1, "x")]), failures(spark, [("a", None, "r")]), [1])


def test_replayed_batches_change_nothing(spark, tmp_path):
    path = f"file://{tmp_path}/history"
    rounds.apply_round(states(spark, [("a", 1, "x")]), 0, path)
    rounds.apply_round(states(spark, [("a", 2, "y")]), 1, path)
    rounds.apply_round(states(spark, [("a", 2, "other")]), 1, path)
    assert sorted((r.period, r.value) for r in rounds.latest_history(spark, path).collect()) == [(1, "x"), (2, "y")]


def test_pages_are_decoded(spark):
    data = [("a", "杀码".encode("gb18030")), ("b", gzip.compress("杀码".encode())), ("c", b'<meta charset="big5">' + "開".encode("big5")), ("d", None)]
    got = {r.path: r.text for r in s.decode_pages(spark.createDataFrame(data, "path string, content binary")).collect()}
    assert got["a"] == "杀码" and got["b"] == "杀码" and got["c"].endswith("開") and got["d"] is None


def test_registry_rules(spark, tmp_path):
    entries = [{"name": "a", "url": "u", "region": "top"}, {"name": "a", "url": "u", "region": "top", "disabled": "false"}, {"name": "b", "url": "v", "region": "top", "disabled": True}]
    (tmp_path / "r.json").write_text(json.dumps(entries))
    registry = s.read_registry(spark, f"file://{tmp_path}/r.json", active=False)
    assert registry.count() == 3 and s.read_registry(spark, f"file://{tmp_path}/r.json").count() == 2
    assert {(r.ord, r.violation) for r in s.registry_violations(registry).collect()} == {(1, "disabled is no boolean"), (0, "name is not unique"), (1, "name is not unique")}


def test_articles(spark):
    rows = [("s", "7", "me", json.dumps({"id": "7", "author": "me", "name": "n", "title": "t", "body": "aGVsbG8gd29ybGQ="})), ("q", "9", None, json.dumps({"sectionData": {"x": [{"id": "9", "author": "you", "name": "n", "title": "t", "body": "b"}]}})), ("z", "1", None, "{}")]
    got = {r.site: (r.content, r.problem) for r in s.article_documents(spark.createDataFrame(rows, "site string, article_id string, author string, json string")).collect()}
    assert got == {"s": ("n\nt\nhello world", None), "q": ("n\nt\nb", None), "z": (None, "no such article")}


def test_success_gate_is_strict(spark):
    from tideline.operators.reconcile import success_rate_gate

    rows = spark.range(100)
    assert not success_rate_gate(rows.select((F.col("id") < 80).alias("ok"))).first().open
    assert success_rate_gate(rows.select((F.col("id") < 81).alias("ok"))).first().open


def test_a_streamed_round_is_expanded_or_refused(spark, tmp_path):
    row = lambda site, period, state, value=None, reason=None: (site, "u", period, state, value, reason)
    fields = "site_name string, site_url string, period int, state string, value string, reason string"
    batch = lambda *rows: spark.createDataFrame(rows, fields)
    at = f"file://{tmp_path}/history"
    rounds.apply_round(batch(row("a", 1, "success", "01"), row("b", None, "failed", reason=" ")), 0, at, requested=[1, 2])
    found = {(r.site_name, r.period, r.state, r.value) for r in rounds.latest_history(spark, at).collect()}
    assert found == {("a", 1, "success", "01"), ("b", 1, "failed", None), ("b", 2, "failed", None)}
    for wrong in ((row("a", 2, "success", "01"), row("a", 2, "failed", reason="x")), (row("a", 9, "success", "01"),), (row("a", 2, "success", " "),)):
        with pytest.raises(ValueError, match="refused"):
            rounds.apply_round(batch(*wrong), 1, at, requested=[1, 2])
    assert {(r.site_name, r.period, r.state, r.value) for r in rounds.latest_history(spark, at).collect()} == found
