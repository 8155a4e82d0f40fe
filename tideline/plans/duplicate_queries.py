"""Queries of the duplicate analytics, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import duplicates as d
from .views import day_list_records, day_records, raw_day_records, registry, sql, table

REQUESTED = [3, 4, 5, 6]


def _pairs(spark: SparkSession, sf: str) -> DataFrame:
    return d.site_pair_runs(day_records(spark, sf))


def _joined(periods: str) -> F.Column:
    return F.array_join(F.transform(periods, lambda p: p.cast("string")), ",")


def _recent(spark: SparkSession, sf: str, region: str) -> DataFrame:
    page = day_records(spark, sf).withColumn("pos", F.col("seq"))
    return d.recent_per_site(page, registry(spark, sf).filter(F.col("region") == region), 10)


def _problems(spark: SparkSession, sf: str) -> DataFrame:
    return d.conflict_problems(raw_day_records(spark, sf))


def _early_problems(spark: SparkSession, sf: str) -> DataFrame:
    return d.conflict_problems(raw_day_records(spark, sf).filter("value in ('signup', 'purchase') and period <= 2"))


def _names(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer")
    return customers.select(F.when(F.col("c_custkey") % 3 == 1, F.col("c_name")).otherwise(F.concat(F.lit("shop of "), "c_name")).alias("name"))


def _shops(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(F.col("c_name").alias("site_name"), F.concat(F.lit("http://shop/"), F.col("c_custkey").cast("string")).alias("site_url"))


def _numbered(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Day records with two numbers for a value, some out of range or repeated, and contracts that ask for two, of every
    third site for three, with an approved exception."""
    two = lambda n: F.format_string("%02d", n + 1)
    rows = day_records(spark, sf).withColumn("value", F.concat_ws(",", two(F.col("seq") % 53), two(F.col("seq") % 7)))
    exceptions = F.create_map(F.lit("5"), F.struct(F.lit(True).alias("approved"), F.lit(2).alias("count")), F.lit("6"), F.struct(F.lit(False).alias("approved"), F.lit(2).alias("count")))
    return rows, registry(spark, sf).withColumns({"count": F.when(F.col("ord") % 3 == 0, 3).otherwise(2), "allow_repeats": F.col("ord") % 4 == 0, "exceptions": exceptions})


def _twins(spark: SparkSession, sf: str) -> DataFrame:
    """Day records, and those of every fourth site again under two other names."""
    rows = day_records(spark, sf)
    twins = rows.withColumn("site_name", F.explode(F.when(F.expr("cast(substring(site_name, 5) AS int) % 4 = 0"), F.array("site_name", F.concat("site_name", F.lit("a")), F.concat("site_name", F.lit("b")))).otherwise(F.array("site_name"))))
    return twins


QUERIES = {
    "site_pair_runs": _pairs,
    "ranked_matches": lambda s, p: d.rank_matches(_pairs(s, p)),
    "site_run_status_counts": lambda s, p: d.run_counts(day_records(s, p)),
    "site_run_values": lambda s, p: d.pair_run_values(day_records(s, p)).select("name_a", "name_b", "period", "value"),
    "site_run_clusters": lambda s, p: d.run_clusters(day_records(s, p)).select("period", F.array_join("values", ",").alias("values"), "sites"),
    "same_period_groups": lambda s, p: d.same_period_groups(day_list_records(s, p)),
    "same_period_group_members": lambda s, p: d.group_members(day_list_records(s, p), d.same_period_groups(day_list_records(s, p)), ["period", "value"]).select("site_name", "period", "value"),
    "cross_period_groups": lambda s, p: d.cross_period_groups(day_list_records(s, p)),
    "exact_copy_groups": lambda s, p: d.cross_period_groups(table(s, p, "documents").select(F.md5(F.col("text").cast("binary")).alias("value"), "doc_id", (F.col("doc_id")).alias("period"))),
    "same_site_conflicts": lambda s, p: d.same_site_conflicts(raw_day_records(s, p)).select("site_name", "period", "first_value", "value", "seq"),
    "completeness_gaps": lambda s, p: d.completeness_gaps(day_records(s, p), REQUESTED).select("site_name", "site_url", _joined("missing").alias("missing")),
    "readiness_gaps": lambda s, p: d.readiness_gaps(day_records(s, p), registry(s, p), 3),
    "no_common_period_pairs": lambda s, p: d.no_common_period_pairs(day_records(s, p).filter("period <= 2")),
    "disjoint_period_classes": lambda s, p: d.disjoint_classes(day_records(s, p).withColumn("period", (F.col("period") / 5).cast("int"))).select(_joined("periods").alias("periods"), "sites", _joined("theirs").alias("theirs"), "their_sites"),
    "readiness_problems": lambda s, p: d.readiness_problems(*_numbered(s, p), 3),
    "site_run_classes": lambda s, p: d.run_class_counts(_twins(s, p)),
    "site_run_class_pairs": lambda s, p: d.site_pair_runs(_twins(s, p)),
    "resolve_url": lambda s, p: d.resolve_urls(_names(s, p), _shops(s, p)),
    "filter_periods": lambda s, p: d.filter_periods(day_records(s, p), REQUESTED).select("site_name", "period", "value"),
    "recent_range": lambda s, p: day_records(s, p).groupBy("site_name").agg(F.max("period").alias("latest")).select("site_name", _joined(d.recent_range(F.col("latest"), 4)).alias("periods")),
    "latest_period": lambda s, p: d.latest_period(day_records(s, p)),
    "recent_per_site_head": lambda s, p: _recent(s, p, "top").select("site_name", "period"),
    "recent_per_site_tail": lambda s, p: _recent(s, p, "bottom").select("site_name", "period"),
    "merge_problems": lambda s, p: d.merge_problems(_early_problems(s, p), _early_problems(s, p).filter("name like '%1%'")).select("kind", "name", "url", "reason"),
    "duplicate_conclusion": lambda s, p: d.conclusion(d.run_counts(day_records(s, p)), _problems(s, p)),
}

_RUNS = """
x1 AS (SELECT a.site_name AS name_a, a.site_url AS url_a, b.site_name AS name_b, b.site_url AS url_b, a.period,
            a.period - row_number() OVER (PARTITION BY a.site_name, a.site_url, b.site_name, b.site_url ORDER BY a.period) AS g
     FROM r1 a JOIN r1 b ON a.period = b.period AND a.value = b.value AND (a.site_name, a.site_url) < (b.site_name, b.site_url)),
x2 AS (SELECT name_a, url_a, name_b, url_b, CAST(count(*) AS INTEGER) AS run_length, CAST(max(period) AS INTEGER) AS last_period FROM x1 GROUP BY name_a, url_a, name_b, url_b, g HAVING count(*) >= 3),
runs AS (SELECT name_a, url_a, name_b, url_b, CASE WHEN run_length >= 6 THEN 'reject' ELSE 'suspect' END AS status, run_length, last_period - run_length + 1 AS first_period, last_period
         FROM x2 QUALIFY row_number() OVER (PARTITION BY name_a, url_a, name_b, url_b ORDER BY run_length DESC, last_period DESC) = 1)
"""
_TWINS = """
tw AS (SELECT site_name || unnest(CASE WHEN CAST(site_name[5:] AS INTEGER) % 4 = 0 THEN ['', 'a', 'b'] ELSE [''] END) AS site_name, site_url, period, value FROM r1),
ch AS (SELECT site_name, site_url, list((period, value) ORDER BY period) AS chain FROM tw GROUP BY 1, 2),
cl AS (SELECT site_name, site_url, row_number() OVER (PARTITION BY chain ORDER BY site_name, site_url) AS nth, count(*) OVER (PARTITION BY chain) AS sites FROM ch)
"""
_PROBLEMS = """
x AS (SELECT *, first_value(value) OVER (PARTITION BY site_name, site_url, period ORDER BY seq) AS f FROM raw),
problems AS (SELECT 1 FROM x WHERE f IS DISTINCT FROM value)
"""
_EARLY_PROBLEMS = """
x AS (SELECT *, first_value(value) OVER (PARTITION BY site_name, site_url, period ORDER BY seq) AS f FROM raw WHERE value IN ('signup', 'purchase') AND period <= 2),
problems AS (SELECT 'conflict' AS kind, site_name AS name, site_url AS url, 'period ' || period || ' has two values: ' || f || ' | ' || value AS reason FROM x WHERE f <> value)
"""
_RECENT = """
x AS (SELECT r.site_name, r.period, row_number() OVER (PARTITION BY r.site_name ORDER BY r.seq{desc}) AS nth, coalesce(g.recent_history_count, 10) AS n
      FROM r1 r JOIN reg g USING (site_name, site_url) WHERE g.region = '{region}')
SELECT site_name, period FROM x WHERE nth <= n
"""

ORACLES = {
    "site_pair_runs": sql(f"{_RUNS} SELECT * FROM runs"),
    "ranked_matches": sql(f"{_RUNS} SELECT * FROM runs"),
    "site_run_status_counts": sql(f"{_RUNS} SELECT status, run_length, count(*) AS pairs FROM runs GROUP BY 1, 2"),
    "site_run_values": sql(f"{_RUNS} SELECT name_a, name_b, period, value FROM runs JOIN r1 ON site_name = name_a AND site_url = url_a AND period BETWEEN first_period AND last_period"),
    "site_run_clusters": sql("""
x AS (SELECT a.period, a.value || ',' || b.value || ',' || c.value AS "values" FROM r1 a JOIN r1 b ON a.site_name = b.site_name AND b.period = a.period + 1 JOIN r1 c ON a.site_name = c.site_name AND c.period = a.period + 2)
SELECT period, "values", count(*) AS sites FROM x GROUP BY 1, 2 HAVING count(*) >= 2"""),
    "same_period_groups": sql("SELECT period, value, count(*) AS members FROM r2 GROUP BY 1, 2 HAVING count(*) >= 2"),
    "same_period_group_members": sql("SELECT site_name, period, value FROM r2 QUALIFY count(*) OVER (PARTITION BY period, value) >= 2"),
    "cross_period_groups": sql("SELECT value, count(DISTINCT period) AS periods, count(*) AS members FROM r2 GROUP BY 1 HAVING count(DISTINCT period) >= 2"),
    "exact_copy_groups": "SELECT md5(text) AS value, count(DISTINCT doc_id) AS periods, count(*) AS members FROM documents GROUP BY 1 HAVING count(DISTINCT doc_id) >= 2",
    "same_site_conflicts": sql("""
x AS (SELECT *, first_value(value) OVER (PARTITION BY site_name, site_url, period ORDER BY seq) AS first_value FROM raw)
SELECT site_name, period, first_value, value, seq FROM x WHERE first_value IS DISTINCT FROM value"""),
    "completeness_gaps": sql(f"""
x AS (SELECT s.site_name, s.site_url, p.period FROM (SELECT DISTINCT site_name, site_url FROM r1) s, (SELECT unnest({REQUESTED}) AS period) p)
SELECT site_name, site_url, string_agg(CAST(x.period AS VARCHAR), ',' ORDER BY x.period) AS missing FROM x ANTI JOIN r1 USING (site_name, site_url, period) GROUP BY 1, 2"""),
    "readiness_gaps": sql("""
x AS (SELECT g.site_name, g.site_url, coalesce(g.recent_history_count, 3) AS need, g.disabled, (SELECT max(period) FROM r1 WHERE r1.site_name = g.site_name) AS top FROM reg g),
y AS (SELECT x.*, (SELECT count(*) FROM r1 WHERE r1.site_name = x.site_name AND r1.period > x.top - x.need) AS found FROM x)
SELECT site_name, site_url, CAST(need AS INTEGER) AS need, CAST(found AS INTEGER) AS found,
       concat_ws(',', CASE WHEN found < need THEN 'incomplete' END, CASE WHEN disabled THEN 'not enabled' END) AS reason FROM y WHERE found < need OR disabled"""),
    "no_common_period_pairs": sql("""
x AS (SELECT DISTINCT site_name, site_url FROM r1 WHERE period <= 2)
SELECT a.site_name AS name_a, a.site_url AS url_a, b.site_name AS name_b, b.site_url AS url_b FROM x a JOIN x b ON (a.site_name, a.site_url) < (b.site_name, b.site_url)
WHERE NOT EXISTS (SELECT 1 FROM r1 p JOIN r1 q ON p.period = q.period WHERE p.period <= 2 AND p.site_name = a.site_name AND q.site_name = b.site_name)"""),
    "disjoint_period_classes": sql("""
x AS (SELECT list_sort(list(DISTINCT period // 5)) AS p FROM r1 GROUP BY site_name, site_url), c AS (SELECT p, count(*) AS n FROM x GROUP BY p)
SELECT array_to_string(a.p, ',') AS periods, a.n AS sites, array_to_string(b.p, ',') AS theirs, b.n AS their_sites FROM c a JOIN c b ON a.p < b.p AND NOT list_has_any(a.p, b.p)"""),
    "readiness_problems": sql("""
x AS (SELECT site_name, site_url, period, [seq % 53 + 1, seq % 7 + 1] AS v, CASE WHEN ord % 3 = 0 AND period <> 5 THEN 3 ELSE 2 END AS wanted, ord % 4 = 0 AS repeats FROM r1 JOIN reg USING (site_name, site_url)),
y AS (SELECT g.site_name, g.site_url, coalesce(g.recent_history_count, 3) AS need, g.disabled, (SELECT max(period) FROM r1 WHERE r1.site_name = g.site_name) AS top FROM reg g),
z AS (SELECT y.*, (SELECT count(*) FROM r1 WHERE r1.site_name = y.site_name AND r1.period > y.top - y.need) AS found FROM y)
SELECT site_name, site_url, CAST(NULL AS INTEGER) AS period, 'incomplete' AS reason FROM z WHERE found < need UNION ALL SELECT site_name, site_url, NULL, 'not enabled' FROM z WHERE disabled
UNION ALL SELECT site_name, site_url, period, 'not a number' FROM x WHERE v[1] > 49 UNION ALL SELECT site_name, site_url, period, 'wrong size' FROM x WHERE wanted = 3
UNION ALL SELECT site_name, site_url, period, 'repeats' FROM x WHERE v[1] = v[2] AND NOT repeats"""),
    "site_run_class_pairs": sql(f"{_RUNS.replace('FROM r1 a JOIN r1 b', 'FROM tw a JOIN tw b').replace('x1 AS', f'x0 AS (SELECT 1), {_TWINS.strip()}, x1 AS', 1).strip().replace('x0 AS (SELECT 1)', 'x AS (SELECT 1)', 1)} SELECT * FROM runs"),
    "site_run_classes": sql(f"""x AS (SELECT 1), {_TWINS.strip()},
x1 AS (SELECT ca.site_name AS name_a, ca.site_url AS url_a, cb.site_name AS name_b, cb.site_url AS url_b, ca.sites AS sites_a, cb.sites AS sites_b, a.period,
     a.period - row_number() OVER (PARTITION BY ca.site_name, ca.site_url, cb.site_name, cb.site_url ORDER BY a.period) AS g
     FROM cl ca JOIN cl cb ON ca.nth = 1 AND cb.nth = 1 AND ((ca.site_name, ca.site_url) < (cb.site_name, cb.site_url) OR ca.sites > 1 AND (ca.site_name, ca.site_url) = (cb.site_name, cb.site_url))
     JOIN tw a ON a.site_name = ca.site_name AND a.site_url = ca.site_url JOIN tw b ON b.site_name = cb.site_name AND b.site_url = cb.site_url AND a.period = b.period AND a.value = b.value),
x2 AS (SELECT name_a, url_a, name_b, url_b, sites_a, sites_b, CAST(count(*) AS INTEGER) AS run_length, max(period) AS last_period FROM x1 GROUP BY name_a, url_a, name_b, url_b, sites_a, sites_b, g HAVING count(*) >= 3),
x3 AS (SELECT * FROM x2 QUALIFY row_number() OVER (PARTITION BY name_a, url_a, name_b, url_b ORDER BY run_length DESC, last_period DESC) = 1)
SELECT CASE WHEN run_length >= 6 THEN 'reject' ELSE 'suspect' END AS status, run_length, sites_a, sites_b, count(*) AS "rows" FROM x3 GROUP BY ALL"""),
    "resolve_url": """
WITH n AS (SELECT DISTINCT CASE WHEN c_custkey % 3 = 1 THEN c_name ELSE 'shop of ' || c_name END AS name FROM customer),
t AS (SELECT c_name AS target, 'http://shop/' || c_custkey AS url FROM customer),
e AS (SELECT name, max(url) AS url FROM n JOIN t ON name = target GROUP BY name HAVING count(*) = 1),
f AS (SELECT name, max(url) AS url FROM n JOIN t ON contains(target, name) OR contains(name, target) WHERE name NOT IN (SELECT name FROM e) GROUP BY name HAVING count(*) = 1)
SELECT n.name, coalesce(e.url, f.url, '') AS url FROM n LEFT JOIN e USING (name) LEFT JOIN f ON f.name = n.name""",
    "filter_periods": sql("SELECT site_name, period, value FROM r1 WHERE period BETWEEN 3 AND 6"),
    "recent_range": sql("SELECT site_name, array_to_string(range(greatest(1, max(period) - 3), max(period) + 1), ',') AS periods FROM r1 GROUP BY 1"),
    "latest_period": sql("SELECT max(period) AS latest FROM r1"),
    "recent_per_site_head": sql(_RECENT.format(region="top", desc="")),
    "recent_per_site_tail": sql(_RECENT.format(region="bottom", desc=" DESC")),
    "merge_problems": sql(f"{_EARLY_PROBLEMS} SELECT DISTINCT kind, name, url, reason FROM problems"),
    "duplicate_conclusion": sql(f"""{_RUNS}, {_PROBLEMS},
y AS (SELECT count(*) FILTER (status = 'reject') AS rejects, count(*) FILTER (status = 'suspect') AS suspects, (SELECT count(*) FROM problems) AS problems FROM runs)
SELECT CASE WHEN problems > 0 THEN 'incomplete' WHEN rejects > 0 THEN 'reject' WHEN suspects > 0 THEN 'suspect' ELSE 'clean' END AS conclusion,
       CAST(CASE WHEN rejects > 0 THEN 6 WHEN suspects > 0 THEN 5 ELSE 0 END AS INTEGER) AS code, rejects, suspects, problems FROM y"""),
}
