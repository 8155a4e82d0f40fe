"""Queries of sections, evidence and contract functions, with their SQL; pages as in ``segment_queries``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as t
from ..operators import reconcile as r
from ..operators import sections as s
from ..operators import segments as g
from .segment_queries import _R, pages
from .views import table



def _framed(spark: SparkSession, sf: str, lines: str = "") -> DataFrame:
    """Pages behind a heading and before an end: a fifth without either, another with two headings."""
    docs = pages(spark, sf)
    head = F.when(F.col("doc") % 5 == 1, "").when(F.col("doc") % 5 == 2, "== 绝杀十码 ==\n== 绝杀十码 ==\n").otherwise("== 绝杀十码 ==\n")
    end = F.when(F.col("doc") % 5 == 3, "").otherwise("\n-- end --")
    return docs.withColumns({"content": F.concat(F.lit("intro\n"), head, "content", end), "anchor": F.lit("== 绝杀十码 =="), "stop_anchor": F.lit("-- end --")})


def _ids(spark: SparkSession, sf: str) -> DataFrame:
    docs = _framed(spark, sf)
    html = F.concat(F.lit("<p>x</p><div id=\"a\">"), F.replace("content", F.lit("\n"), F.lit("<br>")), F.when(F.col("doc") % 5 == 4, "").otherwise("</div><div id=\"b\">1期 十码 01 02 03</div>"))
    return s.id_section(docs.select("doc", html.alias("html"), "keywords", "count", "region", "window", F.lit("a").alias("from_id"), F.lit("b").alias("to_id")))


def _history(spark: SparkSession, sf: str) -> DataFrame:
    docs = pages(spark, sf)
    gap = F.repeat(F.lit("."), F.when(F.col("doc") % 3 == 0, F.lit(700)).otherwise(F.lit(50)))
    content = F.concat(F.when(F.col("doc") % 7 == 1, "").otherwise("The Title"), gap, F.lit("Author\n"), "content")
    return s.article_history_window(docs.withColumns({"content": content, "title": F.lit("The Title"), "author": F.lit("Author")}))


def _suggested(spark: SparkSession, sf: str) -> DataFrame:
    """The site's name stands before the first row (or not), or without its first character."""
    docs = pages(spark, sf)
    name = F.when(F.col("doc") % 3 == 0, "屠龙刀").when(F.col("doc") % 3 == 1, "龙刀").otherwise("x")
    return s.anchor_suggestions(docs.withColumns({"content": F.concat(name, F.lit("\n"), "content"), "site_name": F.lit("屠龙刀")}))


def _evidence(spark: SparkSession, sf: str) -> DataFrame:
    docs = pages(spark, sf)
    sources = docs.select("doc", F.lit("page").alias("kind"), F.lit("u").alias("url"), "content", F.sha2(F.when(F.col("doc") % 9 == 0, F.lit("old")).otherwise(F.col("content")), 256).alias("fingerprint"))
    moved = g.extract(docs).withColumn("start", F.when(F.col("doc") % 10 == 3, F.col("start") + 1).otherwise(F.col("start")))
    return r.evidence_violations(r.with_evidence(moved.filter("value is not null"), sources))


def _identity(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("site"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("url"))
    return r.identity_violations(c.withColumn("name", F.when(F.col("site") % 9 == 0, F.concat("name", F.lit("!"))).otherwise(F.col("name"))), c).select("site", "name", "own_name")


def _what_if(spark: SparkSession, sf: str) -> DataFrame:
    own = table(spark, sf, "supplier").select(F.col("s_name").alias("site_name"), F.lit(10).alias("count"), F.lit("top").alias("region"))
    new = table(spark, sf, "supplier").filter("s_suppkey % 4 = 0").select(F.when(F.col("s_suppkey") % 8 == 0, F.concat("s_name", F.lit("?"))).otherwise(F.col("s_name")).alias("site_name"), F.lit(5).alias("count"), F.lit(None).cast("string").alias("region"))
    found, unknown = r.what_if(own, new, ["count", "region"])
    return found.unionByName(unknown.select("site_name", F.lit(None).cast("int").alias("count"), F.lit("unknown").alias("region")))


def _deduped(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").select(F.col("l_suppkey").cast("string").alias("url"), F.lit("n").alias("name"), F.dayofmonth("l_shipdate").alias("period"), F.col("l_returnflag").alias("numbers"), F.col("l_orderkey").alias("seq"))
    return r.dedupe_results(rows)


def _labels(spark: SparkSession, sf: str) -> DataFrame:
    """Contract texts of customers: risk, direction, periods and keywords."""
    n = F.col("c_custkey")
    words = F.array(F.when(n % 2 == 0, "絕殺十碼").otherwise("穩殺！ "), F.lit(" "))
    return table(spark, sf, "customer").select(
        "c_custkey",
        t.risk_reason(F.when(n % 3 == 0, "a"), words, F.when(n % 5 == 0, "d"), n % 7 == 0).alias("risk"),
        t.normalize_region(F.when(n % 4 == 0, " 顶部").when(n % 4 == 1, "Lower").otherwise("left")).alias("region"),
        F.array_join(F.transform(t.parse_periods(F.concat(n.cast("string"), F.lit("， 07期 x"))), lambda p: F.coalesce(p.cast("string"), F.lit("?"))), ",").alias("periods"),
        t.normalize_keyword(words[0]).alias("keyword"),
        t.contract_hash(F.concat(F.lit('{"b": '), n.cast("string"), F.lit(', "a": "码"}'))).alias("contract"),
    )


QUERIES = {
    "header_keyword_section": lambda x, p: s.header_keyword_section(_framed(x, p).withColumn("stop_anchor", F.lit(None).cast("string"))),
    "unique_anchor_section": lambda x, p: s.unique_anchor_section(_framed(x, p)),
    "heading_section": lambda x, p: s.heading_section(_framed(x, p).withColumns({"heading_pattern": F.lit("^== .*十码"), "stop": F.lit("\n-- end")})),
    "id_section": _ids,
    "article_history_window": _history,
    "anchor_suggestions": _suggested,
    "evidence_violations": _evidence,
    "identity_violations": _identity,
    "what_if_contracts": _what_if,
    "dedupe_results": _deduped,
    "contract_functions": _labels,
}

_NONE = "CAST(NULL AS INTEGER) AS period, CAST(NULL AS VARCHAR) AS value"
_GOOD = "SELECT site AS doc, period, value, CAST(NULL AS VARCHAR) AS problem FROM w WHERE nth <= 5"
_SITES = "(SELECT DISTINCT site FROM l)"


def _with_problems(cases: str, bad: str) -> str:
    return f"{_R} {_GOOD} AND NOT ({bad}) UNION ALL SELECT site, {_NONE}, CASE {cases} END FROM {_SITES} WHERE {bad}"


ORACLES = {
    "header_keyword_section": _with_problems("WHEN true THEN 'anchor not found'", "site % 5 = 1"),
    "unique_anchor_section": _with_problems("site % 5 WHEN 1 THEN 'anchor not found' WHEN 2 THEN 'several anchors' ELSE 'stop anchor not found' END", "site % 5 IN (1, 2, 3)").replace("END END", "END"),
    "heading_section": _with_problems("site % 5 WHEN 1 THEN 'no heading' WHEN 2 THEN 'several headings' ELSE 'no stop' END", "site % 5 IN (1, 2, 3)").replace("END END", "END"),
    "id_section": _with_problems("WHEN true THEN 'end id'", "site % 5 = 4"),
    "article_history_window": _with_problems("WHEN site % 7 = 1 THEN 'no title' ELSE 'title too far'", "site % 7 = 1 OR site % 3 = 0"),
    "anchor_suggestions": f"{_R} SELECT DISTINCT site AS doc, unnest(CASE site % 3 WHEN 0 THEN ['屠龙刀', '龙刀', '屠龙'] ELSE ['龙刀'] END) AS anchor FROM w WHERE site % 3 < 2",
    "evidence_violations": f"""{_R}, e AS (SELECT site AS doc, period, a, printf('%03d', period) AS p FROM w WHERE nth <= 5)
SELECT doc, period, 'altered' AS violation FROM e WHERE doc % 9 = 0 UNION ALL SELECT doc, period, 'another period' FROM e WHERE doc % 10 = 3 AND period < 10 AND false UNION ALL SELECT doc, period, 'another period' FROM e WHERE doc % 10 = 3 AND period >= 100""",
    "identity_violations": "SELECT c_custkey AS site, c_name || '!' AS name, c_name AS own_name FROM customer WHERE c_custkey % 9 = 0",
    "what_if_contracts": "SELECT s_name AS site_name, CASE WHEN s_suppkey % 8 = 4 THEN 5 ELSE 10 END AS count, 'top' AS region FROM supplier UNION ALL SELECT s_name || '?', NULL, 'unknown' FROM supplier WHERE s_suppkey % 8 = 0",
    "dedupe_results": "SELECT CAST(l_suppkey AS VARCHAR) AS url, 'n' AS name, CAST(day(l_shipdate) AS INTEGER) AS period, l_returnflag AS numbers, min(l_orderkey) AS seq FROM lineitem GROUP BY ALL",
    "contract_functions": """
SELECT c_custkey, concat_ws(',', CASE WHEN c_custkey % 3 > 0 THEN 'no anchor' END, CASE WHEN c_custkey % 3 > 0 AND c_custkey % 2 = 0 AND c_custkey % 5 > 0 THEN 'broad keywords' END, CASE WHEN c_custkey % 7 = 0 THEN 'ambiguity allowed' END) AS risk,
       CASE c_custkey % 4 WHEN 0 THEN 'top' WHEN 1 THEN 'bottom' ELSE '' END AS region, CASE WHEN c_custkey BETWEEN 1 AND 999 THEN CAST(c_custkey AS VARCHAR) ELSE '?' END || ',7,?' AS periods,
       CASE WHEN c_custkey % 2 = 0 THEN '绝杀10码' ELSE '稳杀' END AS keyword, sha256('{"a":"码","b":' || c_custkey || '}') AS contract FROM customer""",
}
