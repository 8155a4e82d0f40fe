"""One commit for each run: retried tasks, repeated runs, runs that break off, conflicts and replacement."""

import json

import pyarrow as pa

from tideline.sources import landed, sinks


def lines(spark, path):
    return sorted(r.value for r in sinks.read_lines(spark, path).collect())


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string").repartition(3)


def test_runs_are_committed_once(spark, tmp_path):
    at = f"file://{tmp_path}/out"
    assert lines(spark, at) == []
    sinks.write_lines(frame(spark, ["a", "b\nc", None, ""]), at, "r.1", header="h")
    assert lines(spark, at) == ["", "a", "b c"]
    before = sinks.read_lines(spark, at)
    sinks.write_lines(frame(spark, ["other"]), at, "r.1")
    sinks.write_lines(frame(spark, ["d"]), at, "r2")
    assert lines(spark, at) == ["", "a", "b c", "d"] and before.count() == 3
    sinks.write_lines(frame(spark, ["e"]), at, "r3", replace=True)
    sinks.write_lines(frame(spark, []), at, "r4")
    assert lines(spark, at) == ["e"] and [c["run"] for c in sinks.commits(spark, at)] == ["r3", "r4"]


def test_a_task_that_ran_twice_counts_once(spark, tmp_path):
    at = f"file://{tmp_path}/out"
    writer = sinks.LinesWriter(at, "r1", "", False)
    batch = pa.RecordBatch.from_arrays([pa.array(["x", "y"])], names=["value"])
    first, second = writer.write(iter([batch])), writer.write(iter([batch]))
    assert lines(spark, at) == []
    writer.commit([second, None])
    assert lines(spark, at) == ["x", "y"]
    # The driver commits again after a lost answer: nothing changes.
    writer.commit([second])
    writer.commit([writer.write(iter([batch]))])
    writer.abort([writer.write(iter([batch])), None])
    assert lines(spark, at) == ["x", "y"]
    assert first.file != second.file


def test_rounds_append_conflict_and_replace(spark, tmp_path):
    at = f"file://{tmp_path}"
    registry = spark.createDataFrame([("a", "u", "top"), ("b", "u2", "bottom")], "site_name string, site_url string, region string")
    results = lambda *rows: spark.createDataFrame([(n, "u", v, i) for i, (n, v) in enumerate(rows)], "name string, url string, value string, seq int")
    failures = lambda *rows: spark.createDataFrame([(n, "u", r) for n, r in rows], "name string, url string, reason string")
    stored = lambda: sorted((r.name, r.value) for r in sinks.stored_results(spark, f"{at}/results").collect())
    assert sinks.store_round(results(("a", "02"), ("a", "01"), ("b c", "03"), ("b c", "03")), failures(("z", "lost")), registry, at, "r1").collect()[0][:3] == ("a", "01", "02")
    assert stored() == [("a", "02"), ("b c", "03")]
    assert len(lines(spark, f"{at}/failures")) == 2
    for run in ("r2", "r2", "r3"):
        found = sinks.store_round(results(("a", "09"), ("b c", "03"), ("d", "04")), failures(), registry, at, run)
        assert [(r.name, r.value, r.stored) for r in found.collect()] == [("a", "09", "02")]
        assert stored() == [("a", "02"), ("b c", "03"), ("d", "04")]
        assert [x.split(" ")[:3] for x in lines(spark, f"{at}/failures")] == [["a", "top", "u"]]
    sinks.store_round(results(("a", "02")), failures(), registry, at, "r4")
    assert lines(spark, f"{at}/failures") == []


def test_history_export(spark, tmp_path):
    at = f"file://{tmp_path}/h"
    rows = [("a", "http://h/x.html", 9, "success", 'q"\\', None), ("a", "http://h/x.html", 10, "success", "v", None), ("b", "http://h/x.html", 11, "failed", None, "lost"), ("c", "http://h/y", 2, "success", "w", None)]
    history = spark.createDataFrame(rows, "site_name string, site_url string, period int, state string, value string, reason string")
    registry = spark.createDataFrame([("a", "http://h/x.html", 1, '{"region":"上","id":"same","browser":true}'), ("b", "http://h/x.html", 0, '{"id": "same", "position": "first"}')], "site_name string, site_url string, ord int, raw string")
    sinks.write_history(history, registry, at, "r1", updated_at="now")
    header = json.loads(sinks.commits(spark, at)[0]["header"])
    assert header == {"base_period": 11, "periods": 10, "updated_at": "now", "version": 1}
    assert sorted(map(tuple, sinks.stored_history(spark, at).collect())) == sorted(rows)
    docs = {r.site_name: r for r in landed.history_documents(history, registry).collect()}
    assert docs["a"].fingerprint == '{"10":"v","9":"q\\"\\\\"}' and list(json.loads(docs["a"].fingerprint)) == ["10", "9"]
    assert (docs["b"].id, docs["a"].id, docs["c"].id) == ("same", "same_002", "s003_y")
    assert (docs["a"].pick, docs["a"].browser, docs["b"].click_first, docs["c"].contract, docs["b"].pick) == ("top", True, True, "", "")
