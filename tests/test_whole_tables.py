"""Queries over all line items look at every row."""

from pyspark.sql import functions as F

from tests.oracle import DATA, assert_agrees
from tideline.operators import duplicates as d
from tideline.plans import duplicate_queries, views
from tideline.plans import reconcile_queries as q


def test_violations_of_all_line_items_are_found(spark):
    every = spark.read.parquet(f"{DATA}/lineitem.parquet").selectExpr("l_suppkey as site", "dayofmonth(l_shipdate) as period").distinct()
    odd = every.filter("period not in (2, 3, 4)")
    found = q.QUERIES["result_violations_all"](spark, DATA).filter("violation = 'period not requested'")
    assert found.select("site", "period").exceptAll(odd).count() == 0 and found.count() == odd.count() > 0
    assert q.QUERIES["valid_results_all"](spark, DATA).count() > 0


def test_conclusion_counts_the_problems_of_all_events(spark):
    every = d.same_site_conflicts(views.raw_day_records(spark, DATA))
    got = duplicate_queries.QUERIES["duplicate_conclusion"](spark, DATA).first()
    assert got.problems == every.count() > every.filter("period <= 2 and value in ('signup', 'purchase')").count() and got.conclusion == "incomplete"


def test_conclusion_counts_late_and_null_values_as_its_sql_does(spark, tmp_path):
    rows = [(0, 25, 1, "view"), (1, 25, 1, None), (2, 25, 1, "view"), (3, 9, 2, None), (4, 9, 2, "error")]
    events = spark.createDataFrame(rows, "event_id long, day int, user_id long, event_type string").withColumn("ts", F.expr("make_timestamp(2024, 1, day, 0, event_id, 0)"))
    events.drop("day").write.parquet(f"{tmp_path}/events.parquet")
    assert duplicate_queries.QUERIES["duplicate_conclusion"](spark, str(tmp_path)).first().problems == 2
    assert_agrees(spark, duplicate_queries.QUERIES["duplicate_conclusion"], duplicate_queries.ORACLES["duplicate_conclusion"], str(tmp_path))
