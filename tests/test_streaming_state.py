"""The history as keyed state: replays, restarts, late periods and refusals."""

import pytest

from tests.oracle import connection
from tideline.operators import history as h
from tideline.plans import history_queries as q
from tideline.streaming import keyed, rounds


def land(spark, at, name, rows):
    spark.createDataFrame([(s, "u", p, "success" if v else "failed", v, r) for s, p, v, r in rows], rounds.SCHEMA).coalesce(1).write.parquet(f"{at}/rounds/{name}")


def run(spark, at, history=None, **rules):
    stream = spark.readStream.schema(rounds.SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{at}/rounds")
    keyed.start_site_updates(keyed.site_changes(stream, history, **rules), f"{at}/changes", f"{at}/checkpoint").awaitTermination()
    return sorted((r.site_name, r.period, r.value or r.reason) for r in keyed.site_history(spark, f"{at}/checkpoint").collect())


def test_state_follows_rounds_restarts_and_late_periods(spark, tmp_path):
    at = f"file://{tmp_path}"
    old = spark.createDataFrame([("a", "u", 1, "success", "x", None), ("b", "u", 3, "success", "y", None)], keyed.CHANGES)
    land(spark, at, "r1", [("a", 2, "z", None), ("c", 40, "v", None), ("a", None, None, " ")])
    got = run(spark, at, old, n=3)
    assert got == [("a", 1, "x"), ("a", 2, "z"), ("b", 3, "y"), ("c", 40, "v")]
    # A restart goes on from the checkpoint; the old history isn't read in again.
    land(spark, at, "r2", [("a", 4, "w", None), ("a", 2, None, "gone"), ("c", 37, "late", None)])
    got = run(spark, at, old, n=3)
    assert got == [("a", 2, "gone"), ("a", 4, "w"), ("b", 3, "y"), ("c", 40, "v")]
    assert run(spark, at, old, n=3) == got
    told = {(r.site_name, r.period) for r in spark.read.schema(keyed.CHANGES).parquet(f"{at}/changes/batch=1").collect()}
    assert told == {("a", 2), ("a", 4), ("c", 40)}


def test_a_refused_batch_leaves_the_state(spark, tmp_path):
    at = f"file://{tmp_path}"
    land(spark, at, "r1", [("a", 1, "x", None), ("b", None, None, "lost")])
    got = run(spark, at, requested=[1, 2])
    assert got == [("a", 1, "x"), ("b", 1, "lost"), ("b", 2, "lost")]
    land(spark, at, "r2", [("b", 1, "x", None), ("a", 2, "y", None), ("a", 2, "z", None)])
    with pytest.raises(Exception, match="two values"):
        run(spark, at, requested=[1, 2])
    assert sorted((r.site_name, r.period, r.value or r.reason) for r in keyed.site_history(spark, f"{at}/checkpoint").collect()) == got


def test_sites_that_are_not_enabled_are_refused(spark, tmp_path):
    at = f"file://{tmp_path}"
    registry = spark.createDataFrame([("a", "u", None), ("b", "u", True)], "site_name string, site_url string, disabled boolean")
    land(spark, at, "r1", [("a", 1, "x", None)])
    assert run(spark, at, registry=registry) == [("a", 1, "x")]
    land(spark, at, "r2", [("b", 1, "x", None)])
    with pytest.raises(Exception, match="site not enabled"):
        run(spark, at, registry=registry)
    with pytest.raises(ValueError, match="site not enabled"):
        rounds.apply_round(spark.createDataFrame([("b", "u", 1, "success", "x", None)], rounds.SCHEMA), 0, f"{at}/versions", registry=registry)


@pytest.mark.parametrize(
    "rows",
    [
        [(1, "success", "x", None), (1, "success", "y", None)],
        [(1, "success", " ", None)],
        [(1, "success", None, None)],
        [(1, "failed", None, "a"), (1, "failed", None, "b")],
        [(1, "failed", None, "a"), (1, "success", "x", None)],
        [(9, "success", "x", None)],
        [(1, "success", "x", None), (1, "success", "x", None), (2, "failed", None, "a")],
    ],
)
@pytest.mark.parametrize("enabled", [True, False])
def test_refusals_are_those_of_the_batch_rules(spark, rows, enabled):
    new = {}
    for p, s, v, r in rows:
        new.setdefault(p, set()).add((s, v, r))
    df = spark.createDataFrame([("a", "u", *r) for r in rows], keyed.CHANGES)
    registry = spark.createDataFrame([("a", "u", not enabled)], "site_name string, site_url string, disabled boolean")
    found = h.round_violations(df.filter("state = 'success'").select(*h.KEY, "value"), df.filter("state = 'failed'").select(*h.KEY, "reason"), [1, 2], registry)
    assert keyed.refusal(new, [1, 2], enabled) == min((r.violation for r in found.collect()), default=None)


def test_the_registered_query_equals_the_batch_update(spark):
    got = q.QUERIES["site_changes_stream"](spark, "/root/testdata/sf0.001").collect()
    want = connection().execute(q.ORACLES["site_changes_stream"]).fetchall()
    assert len(want) > 30 and sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
