"""Runs of equal periods against a plain statement of the rule, and the cases that must be refused."""

import random

import pytest

from tideline.operators import duplicates as d

SCHEMA = "site_name string, site_url string, period int, value string, seq long"


def frame(spark, rows):
    return spark.createDataFrame([(n, f"u{n}", p, v, i) for i, (n, p, v) in enumerate(rows)], SCHEMA)


def runs_by_rule(rows):
    sites = {}
    for n, p, v in rows:
        sites.setdefault(n, {})[p] = v
    out = {}
    for a in sites:
        for b in sites:
            if a < b:
                best = run = None
                for p in range(0, 60):
                    same = p in sites[a] and sites[a].get(p) == sites[b].get(p)
                    run = (run or 0) + 1 if same else 0
                    if run >= 3:
                        best = max(best or (0, 0), (run, p))
                if best:
                    out[a, b] = best
    return out


def test_runs_equal_the_rule(spark):
    rng = random.Random(3)
    rows = [(f"s{n:02d}", p, rng.choice("ab")) for n in range(14) for p in range(1, 40) if rng.random() < 0.8]
    got = {(r.name_a, r.name_b): (r.run_length, r.last_period) for r in d.site_pair_runs(frame(spark, rows)).collect()}
    assert got == runs_by_rule(rows) and got


def test_two_values_for_a_period_are_refused(spark):
    rows = frame(spark, [("a", 1, "x"), ("a", 1, "y"), ("b", 1, "x")])
    assert [(r.first_value, r.value) for r in d.same_site_conflicts(rows).collect()] == [("x", "y")]
    with pytest.raises(ValueError):
        d.checked_pair_runs(rows)


def test_completeness_names_what_is_missing(spark):
    got = d.completeness_gaps(frame(spark, [("a", 211, "x"), ("b", 210, "x"), ("b", 211, "x")]), [210, 211]).collect()
    assert [(r.site_name, list(r.missing)) for r in got] == [("a", [210])]
    assert d.completeness_gaps(frame(spark, [("a", 211, "x")]), [210]).count() == 0


def test_groups_count_rows(spark):
    rows = frame(spark, [("a", 1, "x"), ("a", 1, "x"), ("b", 2, "x")])
    assert [r.members for r in d.same_period_groups(rows).collect()] == [2]
    assert d.same_period_groups(rows, distinct_sites=True).count() == 0
    assert [(r.periods, r.members) for r in d.cross_period_groups(rows).collect()] == [(2, 3)]


def test_incomplete_never_claims_clean(spark):
    none = d.site_pair_runs(frame(spark, []))
    problem = spark.createDataFrame([("k", "n", "u", "", "r")], "kind string, name string, url string, region string, reason string")
    assert d.conclusion(none, problem).first().conclusion == "incomplete"
    assert d.conclusion(none, problem.limit(0)).first().conclusion == "clean"


def test_urls_are_found_by_names_that_contain_each_other(spark):
    rng = random.Random(8)
    text = lambda most: "".join(rng.choices("ab甲", k=rng.randint(0, most)))
    registry = [(text(12), f"u{i}") for i in range(60)] + [("longer name of a site", "x"), ("", "y")]
    names = sorted({text(6) for _ in range(80)} | {"name of a", "the longer name of a site", "nothing like it"})
    want = {}
    for n in names:
        same = [u for t, u in registry if t == n]
        near = [u for t, u in registry if n and t and (t in n or n in t)]
        want[n] = same[0] if len(same) == 1 else near[0] if len(near) == 1 else ""
    frame = spark.createDataFrame(registry, "site_name string, site_url string")
    got = d.resolve_urls(spark.createDataFrame([(n,) for n in names], "name string"), frame)
    assert {r.name: r.url for r in got.collect()} == want
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()
