"""Classes of sites and periods, names by their rarest gram: equal to all pairs, without making them."""

import itertools
import random

from pyspark.sql import functions as F

from tests.oracle import DATA
from tideline.operators import duplicates as d
from tideline.plans import duplicate_queries as q

FIELDS = "site_name string, site_url string, period int, value string, seq int"


def records(spark, rows):
    return spark.createDataFrame([(s, "u", p, v, i) for i, (s, p, v) in enumerate(rows)], FIELDS)


def test_names_meet_few_texts(spark):
    folder = "/root/testdata/sf0.01"
    names, shops = q._names(spark, folder).select("name").distinct(), q._shops(spark, folder)
    below = d.containment_candidates(shops.select(F.col("site_name").alias("inner")), names.select(F.col("name").alias("outer"))).count()
    above = d.containment_candidates(names.select(F.col("name").alias("inner")), shops.select(F.col("site_name").alias("outer"))).count()
    assert 1000 <= below + above < 20_000, (below, above)


def test_containment_equals_all_pairs(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcé\U0001f600") for _ in range(rng.randrange(13)))
    inner, outer = [word() for _ in range(120)] + ["", None], [word() + word() for _ in range(120)] + ["", None]
    got = d.containing_pairs(spark.createDataFrame([(x,) for x in inner], "inner string"), spark.createDataFrame([(x,) for x in outer], "outer string")).collect()
    want = {(a, b) for a in inner for b in outer if a and b and a in b}
    assert len(got) == len(want) and {(r.inner, r.outer) for r in got} == want


def test_disjoint_classes_equal_all_pairs(spark):
    rng = random.Random(3)
    sites = {f"s{i}": set(rng.sample(range(1, 9), rng.randint(1, 4))) for i in range(40)}
    rows = records(spark, [(s, p, "v") for s, ps in sites.items() for p in ps])
    got = {(r.name_a, r.name_b) for r in d.no_common_period_pairs(rows).collect()}
    assert got == {(a, b) for a, b in itertools.combinations(sorted(sites), 2) if not sites[a] & sites[b]}
    assert d.disjoint_classes(rows.limit(0)).count() == 0


def test_thousands_of_equal_sites_are_one_class(spark):
    many = spark.range(10_000).select(F.concat(F.lit("s"), F.col("id").cast("string")).alias("site_name"), F.lit("u").alias("site_url"), F.explode(F.sequence(F.lit(1), F.lit(7))).alias("period"), F.lit("v").alias("value"), F.lit(1).alias("seq"))
    other = records(spark, [("z", p, "v" if p < 5 else "w") for p in range(1, 8)])
    got = [(r.name_a, r.sites_a, r.name_b, r.sites_b, r.status, r.run_length, r.last_period) for r in d.run_classes(many.unionByName(other)).collect()]
    assert sorted(got) == [("s0", 10_000, "s0", 10_000, "reject", 7, 7), ("s0", 10_000, "z", 1, "suspect", 4, 4)]


def test_pairs_of_classes_are_the_pairs_of_sites(spark):
    rows = q._twins(spark, DATA)
    got = d.class_pairs(d.run_classes(rows), d.class_members(rows))
    want = d.site_pair_runs(rows)
    assert got.count() == want.count() > 10 and got.exceptAll(want.select(got.columns)).count() == 0


def test_readiness_of_values_and_of_one_site(spark):
    rows = records(spark, [("a", 1, "01,02"), ("a", 2, "01.01"), ("a", 3, "7,50"), ("a", 4, "01,02,03")])
    got = {(r.period, r.reason) for r in d.readiness_problems(rows, None, 4).collect()}
    assert got == {(2, "repeats"), (3, "not a number"), (None, "fewer than two sites")}
    registry = spark.createDataFrame([("a", "u", 2, True, None), ("b", "u", 2, None, True)], "site_name string, site_url string, count int, allow_repeats boolean, disabled boolean").withColumn("recent_history_count", F.lit(4))
    got = {(r.site_name, r.period, r.reason) for r in d.readiness_problems(rows, registry, 4).collect()}
    assert got == {("a", 3, "not a number"), ("a", 4, "wrong size"), ("b", None, "incomplete"), ("b", None, "not enabled"), ("", None, "fewer than two sites")}


def test_joins_of_names_are_no_broadcasts(spark):
    # Files of names are small and their rows are not: only the few lengths of grams go to every task.
    plan = q.QUERIES["resolve_url"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "BroadcastHashJoin" in line]
    assert joins and all("[n#" in line for line in joins)
