"""Sites of equal records meet others as one row, which becomes pairs at the last step."""

import random

import pytest

from tests.oracle import DATA
from tests.test_classes import records
from tests.test_duplicates import runs_by_rule
from tideline.operators import duplicates as d
from tideline.plans import duplicate_queries


def equal_sites(seed, chains=30):
    """Up to 40 sites of each chain, their names dealt among all."""
    rng = random.Random(seed)
    names = rng.sample(range(10_000), chains * 40)
    rows = []
    for n in range(chains):
        chain = [(p, rng.choice("aab")) for p in range(1, 30) if rng.random() < 0.8]
        sites = [f"s{names.pop()}" for _ in range(rng.choice([1, 1, 2, 9, 40]))]
        rows += [(s, p, v) for s in sites for p, v in chain]
    return rows


def passed_on(df):
    """Rows that the step which compares chains passes on."""
    df.collect()

    def walk(node):
        yield node
        inner = [node.executedPlan()] if node.nodeName() == "AdaptiveSparkPlan" else [node.plan()] if "QueryStage" in node.nodeName() else []
        children = node.children()
        for child in [*inner, *(children.apply(k) for k in range(children.size()))]:
            yield from walk(child)

    return sum(n.metrics().apply("pythonNumRowsReceived").value() for n in walk(df._jdf.queryExecution().executedPlan()) if n.nodeName().startswith("MapInArrow"))


@pytest.mark.parametrize("sizes", [(3, 5, 7), (5, 1, 50), (64, 2**11, 4096)])
def test_equal_sites_give_all_pairs(spark, monkeypatch, sizes):
    for name, size in zip(("CLASS", "EXPANDED", "BLOCK"), sizes, strict=True):
        monkeypatch.setattr(d, name, size)
    rows = equal_sites(4)
    want, values = runs_by_rule(rows), {(s, p): v for s, p, v in rows}
    frame = records(spark, rows)
    got = d.site_pair_runs(frame).collect()
    assert len(got) == len(want) > 1000 and {(r.name_a, r.name_b): (r.run_length, r.last_period) for r in got} == want
    each = d.pair_run_values(frame).collect()
    assert sorted((r.name_a, r.name_b, r.period, r.value) for r in each) == sorted((a, b, p, values[a, p]) for (a, b), (n, last) in want.items() for p in range(last - n + 1, last + 1))


def test_values_of_equal_sites_are_passed_on_once(spark):
    frame = records(spark, [(f"s{n}", p, "abc"[p % 3]) for n in range(300) for p in range(1, 8)])
    values = d.pair_run_values(frame)
    assert values.count() == 300 * 299 // 2 * 7 and passed_on(values) < 300 * 299 // 2 / 50


def test_pairs_of_twins_are_not_shuffled(spark):
    plan = duplicate_queries.QUERIES["site_run_class_pairs"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    after = plan[: plan.index("MapInArrow")]
    assert "Exchange" not in after.split("Initial Plan")[0] and "Join" not in after
