"""Queries of reconciliation and of sources and sinks, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as t
from ..operators import reconcile as r
from ..sources import landed as s
from ..sources import sinks
from .views import SQL as VIEWS
from .views import day_records, registry, shared_path, sql, table

REQUESTED = [2, 3, 4]


def _found(spark: SparkSession, sf: str) -> DataFrame:
    """Documents of a source as documents of a site, with the length class of each as a period's value."""
    d = table(spark, sf, "documents")
    return d.select(F.col("source").alias("site"), F.col("doc_id").alias("doc"), (F.col("doc_id") % 50).cast("int").alias("period"), F.substring(F.md5(F.col("text").cast("binary")), 1, 1).alias("value"), (F.col("doc_id") % 7).alias("priority"), F.col("doc_id").alias("ord"))


def _errors(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    reason = F.when(F.col("event_id") % 97 == 0, "候选不唯一: 2").when(F.col("event_type") == "error", "timed out").when(F.col("event_type") == "click", "没有找到指定期数").otherwise("HTTP Error 404")
    return e.select(F.concat(F.lit("site"), F.col("user_id").cast("string")).alias("site"), F.col("event_id").alias("doc"), reason.alias("reason"))


def _results(spark: SparkSession, sf: str) -> DataFrame:
    """Three numbers of each line item as a supplier's numbers for a day of the month."""
    k = F.col("l_partkey")
    items = table(spark, sf, "lineitem")
    return items.select(F.col("l_suppkey").alias("site"), F.dayofmonth("l_shipdate").alias("period"), F.array(*[F.format_string("%02d", x) for x in (k % 55 + 1, F.expr("l_partkey div 49 % 49 + 1"), F.expr("l_partkey div 7 % 49 + 1"))]).alias("numbers")).distinct()


def _all_results(spark: SparkSession, sf: str, site: str = "l_suppkey", period: str = "dayofmonth(l_shipdate)") -> DataFrame:
    """Like ``_results``, of all line items."""
    k = F.col("l_partkey")
    numbers = F.array(*[F.format_string("%02d", x) for x in (k % 55 + 1, F.expr("l_partkey div 49 % 49 + 1"), F.expr("l_partkey div 7 % 49 + 1"))])
    return table(spark, sf, "lineitem").select(F.col(site).alias("site"), F.expr(period).cast("int").alias("period"), numbers.alias("numbers")).distinct()


def _valid(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as sites: their numbers are the same on every day, so a site fails by the numbers themselves."""
    rows = _all_results(spark, sf, "l_partkey")
    exceptions = F.create_map(F.lit("3"), F.struct(F.lit(True).alias("approved"), F.lit(4).alias("count")))
    rules = rows.select("site").distinct().select("site", F.lit(3).alias("count"), (F.col("site") % 2 == 0).alias("allow_repeats"), F.when(F.col("site") % 5 == 0, exceptions).alias("exceptions"))
    bad = r.result_violations(rows, rules, list(range(1, 32))).filter("violation <> 'missing'")
    return r.valid_results(rows, bad).select("site", "period", F.array_join("numbers", ",").alias("numbers"))


def _all_valid(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as sites, their lines as periods: suppliers of all line items have two values for some day each."""
    rows = _all_results(spark, sf, "l_orderkey", "l_linenumber")
    exceptions = F.create_map(F.lit("3"), F.struct(F.lit(True).alias("approved"), F.lit(4).alias("count")))
    rules = rows.select("site").distinct().select("site", F.lit(3).alias("count"), (F.col("site") % 2 == 0).alias("allow_repeats"), F.when(F.col("site") % 5 == 0, exceptions).alias("exceptions"))
    bad = r.result_violations(rows, rules, [1, 2, 3, 4, 5, 6, 7]).filter("violation <> 'missing'")
    return r.valid_results(rows, bad).select("site", "period", F.array_join("numbers", ",").alias("numbers"))


def _rules(spark: SparkSession, sf: str) -> DataFrame:
    exceptions = F.create_map(F.lit("3"), F.struct(F.lit(True).alias("approved"), F.lit(4).alias("count")))
    return table(spark, sf, "supplier").select(F.col("s_suppkey").alias("site"), F.lit(3).alias("count"), (F.col("s_suppkey") % 2 == 0).alias("allow_repeats"), F.when(F.col("s_suppkey") % 5 == 0, exceptions).alias("exceptions"))


def _histories(spark: SparkSession, sf: str) -> DataFrame:
    rows = day_records(spark, sf).filter("period <= 6")
    listed = lambda keep: rows.filter(keep).groupBy(F.col("site_name").alias("site")).agg(F.transform(F.sort_array(F.collect_list(F.struct("period"))), lambda x: x["period"]).alias("periods"))
    a, b = listed((F.length("site_name") % 2 == 0) | (F.col("period") < 5)), listed((F.length("site_name") % 2 == 1) | (F.col("period") > 2))
    joined = r.reconcile_histories(a, b)
    return joined.select("site", F.array_join(F.transform("periods", lambda p: p.cast("string")), ",").alias("periods"), "conflict")


def _states(spark: SparkSession, sf: str) -> DataFrame:
    d = day_records(spark, sf)
    ok = F.col("value") != "error"
    return d.select("site_name", "site_url", F.col("period").alias("round"), ok.alias("ok"), F.when(ok, F.col("value")).alias("value"), F.when(~ok, F.concat(F.lit("timed out "), F.col("period").cast("string"))).alias("reason"))


def _sites(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    rows = day_records(spark, sf).filter(f"period = 1 and value = '{kind}'")
    return rows.select("site_name", "site_url", F.when(F.crc32("site_name") >= 0, F.lit("timed out")).alias("reason"))


def _failures(spark: SparkSession, sf: str) -> DataFrame:
    rows = day_records(spark, sf).filter("period <= 2 and value = 'error'")
    return rows.select(F.col("site_name").alias("name"), F.when(F.col("period") == 2, F.col("site_url")).otherwise(F.concat("site_url", F.lit("x"))).alias("url"), F.lit("HTTP Error 503 here").alias("reason"))


def _contracts(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers as JSON contracts, many of them broken in one way."""
    n = F.col("s_suppkey")
    n_text = n.cast("string")
    raw = F.concat(
        F.lit('{"name":"'), F.when(n % 10 == 9, F.lit("same")).otherwise(F.col("s_name")), F.lit('","url":"'), F.when(n % 11 == 3, F.lit("")).otherwise(F.concat(F.lit("http://s/"), n_text)),
        F.lit('","region":"'), F.when(n % 7 == 2, F.lit("left")).otherwise(F.lit("top")), F.lit('","disabled":'), F.when(n % 6 == 1, F.lit('"false"')).when(n % 6 == 2, F.lit("true")).otherwise(F.lit("false")),
        F.lit(',"count":'), F.when(n % 13 == 4, F.lit("0")).when(n % 13 == 5, F.lit("true")).otherwise(F.lit("10")), F.lit("}"),
    )
    return table(spark, sf, "supplier").select(n.cast("int").alias("ord"), raw.alias("raw"))


def _period_files(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Day records as result files, one for each period: some lines lack the period, some have another."""
    line = F.concat(F.lit("01，02,03 "), "site_name", F.when(F.col("seq") % 3 == 0, "").when(F.col("seq") % 3 == 1, F.concat(F.lit(" "), F.col("period").cast("string"), F.lit("期"))).otherwise(F.lit(" 40 期")))
    rows = day_records(spark, sf).withColumn("line", line)
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("seq", "line"))), lambda x: x["line"]), "\n")
    return s.read_period_files(rows.groupBy(F.concat(F.lit("/in/"), F.col("period").cast("string"), F.lit("期-杀数字-成功.txt")).alias("path")).agg(text.alias("text")))


def _round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Long rows to one JSON map for each site and back."""
    rows = day_records(spark, sf).select("site_name", "site_url", "period", F.lit("success").alias("state"), "value", F.lit(None).cast("string").alias("reason"))
    docs = s.history_documents(rows)
    value = F.concat(F.lit('{"sites":[{"name":"'), "site_name", F.lit('","url":"'), "site_url", F.lit('","fingerprint":'), "fingerprint", F.lit("}]}"))
    return s.read_history(docs.select(value.alias("value"))).select("site_name", "site_url", "period", "state", "value")


def _append(spark: SparkSession, sf: str) -> DataFrame:
    rows = day_records(spark, sf)
    one = lambda p: rows.filter(f"period = {p}").select(F.col("site_name").alias("name"), "value")
    return s.append_results(one(1), one(2)).drop("stored")


def _stored(spark: SparkSession, sf: str) -> tuple[str, DataFrame]:
    """Two rounds of all days, written: the second repeats some lines, changes others and brings new ones, and is then
    written once more."""
    at = shared_path(spark)
    rows = day_records(spark, sf).select(F.concat_ws("@", "site_name", "period").alias("name"), F.col("site_url").alias("url"), "value", "seq")
    failed = rows.filter("value = 'error'").select("name", "url", F.concat(F.lit("timed out "), F.col("seq").cast("string")).alias("reason"))
    changed = rows.withColumn("value", F.when(F.col("seq") % 5 == 0, F.concat("value", F.lit("!"))).otherwise(F.col("value")))
    sinks.store_round(rows.filter("seq % 3 < 2"), failed, registry(spark, sf), at, "first")
    conflicts = sinks.store_round(changed, failed.filter("seq % 2 = 0"), registry(spark, sf), at, "second")
    sinks.store_round(changed, failed.filter("seq % 2 = 0"), registry(spark, sf), at, "second")
    return at, conflicts


def _stored_history(spark: SparkSession, sf: str) -> tuple[str, DataFrame]:
    at = shared_path(spark)
    bad = F.col("value") == "error"
    rows = day_records(spark, sf).select("site_name", "site_url", "period", F.when(bad, "failed").otherwise("success").alias("state"), F.when(~bad, F.concat(F.lit('a"b\\c '), "value")).alias("value"), F.when(bad, "timed out").alias("reason"))
    contracts = registry(spark, sf).select("site_name", "site_url", "ord", F.concat(F.lit('{"region": "'), "region", F.lit('", "b": '), F.col("ord").cast("string"), F.lit(', "a": true}')).alias("raw"))
    sinks.write_history(rows, contracts, at, "one")
    sinks.write_history(rows, contracts, at, "two")
    return at, s.history_documents(rows, contracts)


def _failed_runs(spark: SparkSession, sf: str) -> DataFrame:
    runs = _states(spark, sf).select(F.col("site_name").alias("site"), F.col("round").alias("period"), "ok", "reason", (F.length("site_name") > 4).alias("receipt"))
    found = s.all_periods_failed(runs, registry(spark, sf).select(F.col("site_name").alias("site")), [5, 6])
    return found.select("site", F.array_join(F.transform("reasons", lambda x: F.concat_ws(": ", x["period"], x["reason"])), "|").alias("reasons"))


def _fallback(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents")
    landed = d.select((F.expr("doc_id div 4")).alias("site"), (F.col("doc_id") % 4).cast("int").alias("source_rank"), F.md5(F.col("text").cast("binary")).alias("content"), (F.col("n_chars") % 3 == 0).alias("usable"), F.when(F.col("n_chars") % 3 == 1, "404").when(F.col("n_chars") % 15 == 2, "500").alias("error"))
    return s.source_fallback(landed)


def _versions(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    c = table(spark, sf, "customer").select(F.col("c_name").alias("site_name"), F.concat(F.lit("http://c/"), F.col("c_custkey").cast("string")).alias("site_url"), F.col("c_mktsegment").alias("contract"), "c_custkey")
    old = c.filter("c_custkey % 5 > 0")
    new = c.filter("c_custkey % 7 > 0").withColumn("contract", F.when(F.col("c_custkey") % 11 == 0, "NEW").otherwise(F.col("contract")))
    return old, new


def _blocks(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    own = registry(spark, sf)
    blocks = own.select(F.col("ord").alias("block"), F.col("site_name").alias("name"), F.when(F.col("ord") % 4 == 0, F.lit("http://moved")).otherwise(F.col("site_url")).alias("url"), F.when(F.col("ord") % 3 == 0, "top").alias("region"))
    return r.match_failed_blocks(blocks, own)


def _posts(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations as pages of a user's posts, four conversations a user."""
    turns = table(spark, sf, "conversations")
    text = F.when(F.col("turn") % 5 == 3, "").otherwise(F.col("role"))
    post = F.to_json(F.struct((F.col("conv_id") * 100 + F.col("turn")).cast("string").alias("id"), text.alias("text")))
    listed = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("turn", post.alias("p")))), lambda x: x["p"]), ",")
    pages = turns.groupBy("conv_id").agg(F.concat(F.lit('{"posts":['), listed, F.lit("]}")).alias("json"))
    return s.forum_documents(pages.select(F.expr("conv_id div 4").alias("user"), (F.col("conv_id") % 4).alias("page"), "json"))


def _releases(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part")
    posts = parts.select((F.col("p_partkey") % 40).alias("user"), F.col("p_type").alias("kind"), F.col("p_partkey").alias("ord"), F.col("p_brand").alias("id"), F.col("p_name").alias("title"))
    contracts = parts.filter("p_partkey < 40").select(F.col("p_partkey").alias("site"), F.col("p_partkey").alias("user"), F.lit("ECONOMY").alias("kind"), F.array(F.lit("r")).alias("keywords"), F.lit(2).alias("first_n"))
    return s.release_selection(posts, contracts)


#: Errors that fail their site, and errors that look like them.
HARD = ["3期 候选不唯一：1 | 2", "候选冲突", "号码有重复", "跨周期候选", "同时存在数字期号"]
SOFT = ["没有找到正文锚点", "冲突", "身份", "重复号码", "timed out", "候选"]

QUERIES = {
    "cross_document_conflict": lambda x, p: r.cross_document_conflicts(_found(x, p)),
    "choose_document": lambda x, p: r.choose_documents(_found(x, p).withColumn("period", F.col("doc") % 3), _found(x, p)),
    "site_errors": lambda x, p: r.site_errors(_errors(x, p)),
    "error_kinds": lambda x, p: r.site_errors(table(x, p, "events").select(F.col("event_id").cast("string").alias("site"), F.lit("d").alias("doc"), F.get(F.array(*[F.lit(a) for a in HARD + SOFT]), F.pmod("event_id", F.lit(len(HARD + SOFT))).cast("int")).alias("reason"))).select("site", "failed"),
    "failure_summary": lambda x, p: r.failure_summary(_errors(x, p)),
    "result_violations": lambda x, p: r.result_violations(_results(x, p), _rules(x, p), REQUESTED),
    "valid_results": _valid,
    "result_violations_all": lambda x, p: r.result_violations(_all_results(x, p), _rules(x, p), REQUESTED),
    "valid_results_all": _all_valid,
    "reconcile_histories": _histories,
    "retry_merge": lambda x, p: r.retry_merge(_states(x, p)),
    "retry_scope": lambda x, p: r.retry_scope(registry(x, p), _sites(x, p, "view"), _sites(x, p, "error")),
    "success_rate_gate": lambda x, p: r.success_rate_gate(_states(x, p)),
    "failed_block_match": lambda x, p: _blocks(x, p)[0],
    "failed_block_rest": lambda x, p: _blocks(x, p)[1].select("block"),
    "rendered_consensus": lambda x, p: r.rendered_consensus(_found(x, p).withColumn("doc", F.col("doc") % 3).filter("period < 3")).select("site", "docs", "conflict"),
    "registry_violations": lambda x, p: s.registry_violations(_contracts(x, p)),
    "registry_diff": lambda x, p: s.registry_diff(*_versions(x, p)),
    "active_sites": lambda x, p: s.active_sites(_versions(x, p)[0], _versions(x, p)[1].withColumn("restored", F.col("c_custkey") % 2 == 0)).select("site_name"),
    "region_problems": lambda x, p: s.region_problems(table(x, p, "supplier").select(F.col("s_name").alias("site_name"), F.lit("u").alias("site_url"), F.when(F.col("s_suppkey") % 3 == 0, "上").when(F.col("s_suppkey") % 3 == 1, "left").alias("region"))),
    "read_pages": lambda x, p: s.read_pages(x, f"{p}/pages.parquet").select("url", "page_id"),
    "period_file_records": lambda x, p: _period_files(x, p)[0].select("site_name", "period", "value"),
    "period_file_rejects": lambda x, p: _period_files(x, p)[1].select(F.regexp_extract("raw", "(site\\d+)", 1).alias("site_name"), F.regexp_extract("path", "(\\d+)期", 1).cast("int").alias("period")),
    "history_round_trip": _round_trip,
    "append_results": _append,
    "stored_results": lambda x, p: sinks.stored_results(x, f"{_stored(x, p)[0]}/results"),
    "stored_conflicts": lambda x, p: _stored(x, p)[1].select("name", "value", "stored"),
    "stored_failures": lambda x, p: sinks.read_lines(x, f"{_stored(x, p)[0]}/failures").select(F.regexp_extract("value", r"^(\S+) ", 1).alias("name"), F.regexp_extract("value", r"\[(.*?)\]", 1).alias("category")),
    "stored_history": lambda x, p: sinks.stored_history(x, _stored_history(x, p)[0]),
    "history_documents": lambda x, p: _stored_history(x, p)[1].select("site_name", "id", "contract", "pick", "click_first", "failures", "latest", "fingerprint"),
    "failure_rows": lambda x, p: s.failure_rows(_failures(x, p), registry(x, p)),
    "failure_line_round_trip": lambda x, p: s.read_failure_lines(s.failure_lines(s.failure_rows(_failures(x, p), registry(x, p)).filter("url not like '%x'")).select(F.lit("f").alias("file"), F.crc32("value").alias("line_no"), "value")).select("name", "region", "url", "category", "reason"),
    "round_report": lambda x, p: s.round_report(_states(x, p).filter("ok"), _errors(x, p)),
    "all_periods_failed": _failed_runs,
    "receipts": lambda x, p: s.receipts(_states(x, p).filter("round = 1 and ok"), _states(x, p).filter("round = 2 and not ok"), registry(x, p).withColumn("contract", F.sha2("site_name", 256))),
    "source_fallback": _fallback,
    "forum_documents": _posts,
    "release_selection": _releases,
}

_FOUND = "WITH f AS (SELECT source AS site, doc_id AS doc, CAST(doc_id % 50 AS INTEGER) AS period, left(md5(text), 1) AS value, doc_id % 7 AS priority FROM documents)"
_ERR = "WITH e AS (SELECT 'site' || user_id AS site, CASE WHEN event_id % 97 = 0 THEN '候选不唯一: 2' WHEN event_type = 'error' THEN 'timed out' WHEN event_type = 'click' THEN '没有找到指定期数' ELSE 'HTTP Error 404' END AS reason FROM events)"
_RES = """
WITH v AS (SELECT DISTINCT l_suppkey AS site, CAST(day(l_shipdate) AS INTEGER) AS period, [l_partkey % 55 + 1, l_partkey // 49 % 49 + 1, l_partkey // 7 % 49 + 1] AS n FROM lineitem),
bad AS (SELECT site, period, 'not a number' AS violation FROM v WHERE n[1] > 49 UNION SELECT site, period, 'wrong size' FROM v WHERE site % 5 = 0 AND period = 3
 UNION SELECT site, period, 'repeats' FROM v WHERE site % 2 = 1 AND len(list_distinct(n)) < 3 UNION SELECT site, period, 'two values' FROM v GROUP BY site, period HAVING count(*) > 1)"""
def _all(site: str, period: str) -> str:
    """Results of all line items and what is wrong with them."""
    return f"""
WITH v AS (SELECT DISTINCT {site} AS site, CAST({period} AS INTEGER) AS period, [l_partkey % 55 + 1, l_partkey // 49 % 49 + 1, l_partkey // 7 % 49 + 1] AS n FROM lineitem),
bad AS (SELECT site, period, 'not a number' AS violation FROM v WHERE n[1] > 49 UNION SELECT site, period, 'wrong size' FROM v WHERE site % 5 = 0 AND period = 3
 UNION SELECT site, period, 'repeats' FROM v WHERE site % 2 = 1 AND len(list_distinct(n)) < 3 UNION SELECT site, period, 'two values' FROM v GROUP BY site, period HAVING count(*) > 1)"""


_ST = "st AS (SELECT site_name, site_url, period AS round, value <> 'error' AS ok, nullif(value, 'error') AS value, CASE WHEN value = 'error' THEN 'timed out ' || period END AS reason FROM r1)"
_FAIL = "fl AS (SELECT site_name AS name, CASE WHEN period = 2 THEN site_url ELSE site_url || 'x' END AS url, period FROM r1 WHERE period <= 2 AND value = 'error'), fr AS (SELECT name, coalesce((SELECT region FROM reg WHERE site_url = fl.url), 'unknown') AS region, url, 'transient network' AS category, 'HTTP Error 503 here' AS reason FROM fl)"
_BLOCKS = "b AS (SELECT ord AS block, site_name AS name, CASE WHEN ord % 4 = 0 THEN 'http://moved' ELSE site_url END AS url, CASE WHEN ord % 3 = 0 THEN 'top' END AS region FROM reg), m AS (SELECT b.block, b.name, b.url FROM b JOIN reg ON b.name = site_name AND b.url = site_url AND NOT disabled AND (b.region IS NULL OR b.region = reg.region))"
_x = lambda body: sql(body if body.lstrip().startswith("SELECT") else "x AS (SELECT 1), " + body)

ORACLES = {
    "error_kinds": f"SELECT CAST(event_id AS VARCHAR) AS site, event_id % {len(HARD + SOFT)} < {len(HARD)} AS failed FROM events",
    "cross_document_conflict": f"{_FOUND} SELECT site, period, count(DISTINCT value) AS \"values\", min(value) || ' | ' || max(value) AS preview FROM f GROUP BY 1, 2 HAVING count(DISTINCT value) > 1",
    "choose_document": f"{_FOUND} SELECT site, doc, CAST(1 AS BIGINT) AS n, priority FROM f QUALIFY row_number() OVER (PARTITION BY site ORDER BY priority DESC, doc) = 1",
    "site_errors": f"{_ERR} SELECT site, bool_or(starts_with(reason, '候选')) AS failed, count(*) AS errors, min(reason) FILTER (starts_with(reason, '候选')) AS reason FROM e GROUP BY 1",
    "failure_summary": f"{_ERR} SELECT CASE WHEN starts_with(reason, '候选') THEN 'ambiguous' WHEN reason = 'timed out' THEN 'transient network' WHEN starts_with(reason, '没有') THEN 'no such period' ELSE 'other' END AS category, count(*) AS failures FROM e GROUP BY 1",
    "result_violations": f"""{_RES} SELECT * FROM bad UNION ALL SELECT DISTINCT site, period, 'period not requested' FROM v WHERE period NOT IN (2, 3, 4)
UNION ALL SELECT s_suppkey, CAST(p AS INTEGER), 'missing' FROM supplier, (SELECT unnest([2, 3, 4]) AS p) WHERE NOT EXISTS (SELECT 1 FROM v WHERE site = s_suppkey AND period = p)""",
    "valid_results": """
WITH v AS (SELECT DISTINCT l_partkey AS site, CAST(day(l_shipdate) AS INTEGER) AS period, [l_partkey % 55 + 1, l_partkey // 49 % 49 + 1, l_partkey // 7 % 49 + 1] AS n FROM lineitem),
bad AS (SELECT site FROM v WHERE n[1] > 49 OR site % 5 = 0 AND period = 3 OR site % 2 = 1 AND len(list_distinct(n)) < 3)
SELECT site, period, array_to_string(list_transform(n, lambda x: printf('%02d', x)), ',') AS numbers FROM v WHERE site NOT IN (SELECT site FROM bad)""",
    "result_violations_all": f"""{_all("l_suppkey", "day(l_shipdate)")} SELECT * FROM bad UNION ALL SELECT DISTINCT site, period, 'period not requested' FROM v WHERE period NOT IN (2, 3, 4)
UNION ALL SELECT s_suppkey, CAST(p AS INTEGER), 'missing' FROM supplier, (SELECT unnest([2, 3, 4]) AS p) WHERE NOT EXISTS (SELECT 1 FROM v WHERE site = s_suppkey AND period = p)""",
    "valid_results_all": f"{_all('l_orderkey', 'l_linenumber')} SELECT site, period, array_to_string(list_transform(n, lambda x: printf('%02d', x)), ',') AS numbers FROM v WHERE site NOT IN (SELECT site FROM bad)",
    "reconcile_histories": _x("""
y AS (SELECT site_name AS site, list(period ORDER BY period) FILTER (length(site_name) % 2 = 0 OR period < 5) AS a, list(period ORDER BY period) FILTER (length(site_name) % 2 = 1 OR period > 2) AS b FROM r1 WHERE period <= 6 GROUP BY 1),
z AS (SELECT site, CASE WHEN a IS NULL THEN b WHEN b IS NULL THEN a WHEN list_has_all(b, a) THEN b WHEN list_has_all(a, b) THEN a END AS p FROM y)
SELECT site, array_to_string(p, ',') AS periods, p IS NULL AS conflict FROM z"""),
    "retry_merge": _x(f"{_ST} SELECT site_name, site_url, ok, value, reason, round FROM st QUALIFY row_number() OVER (PARTITION BY site_name, site_url ORDER BY ok DESC, round DESC) = 1"),
    "retry_scope": _x("SELECT site_name, site_url FROM r1 WHERE period = 1 AND value = 'error'"),
    "success_rate_gate": _x(f"{_ST} SELECT count(*) AS total, count(*) FILTER (ok) AS succeeded, count(*) FILTER (ok) * 100 > count(*) * 80 AS open FROM st"),
    "failed_block_match": _x(f"{_BLOCKS} SELECT block, name, url FROM m"),
    "failed_block_rest": _x(f"{_BLOCKS} SELECT block FROM b WHERE block NOT IN (SELECT block FROM m)"),
    "rendered_consensus": f"{_FOUND}, m AS (SELECT site, doc % 3 AS doc, list_sort(list(DISTINCT (period, value))) AS m FROM f WHERE period < 3 GROUP BY 1, 2) SELECT site, count(*) AS docs, count(DISTINCT m) > 1 AS conflict FROM m GROUP BY 1",
    "registry_violations": """
WITH n AS (SELECT CAST(s_suppkey AS INTEGER) AS n FROM supplier), c AS (SELECT count(*) FILTER (n % 10 = 9 AND n % 6 <> 2) AS same FROM n)
SELECT n AS ord, 'no url' AS violation FROM n WHERE n % 11 = 3 UNION ALL SELECT n, 'region' FROM n WHERE n % 7 = 2 UNION ALL SELECT n, 'disabled is no boolean' FROM n WHERE n % 6 = 1
UNION ALL SELECT n, 'count is no positive integer' FROM n WHERE n % 13 IN (4, 5) UNION ALL SELECT n, 'name is not unique' FROM n, c WHERE n % 10 = 9 AND n % 6 <> 2 AND same > 1""",
    "registry_diff": """
SELECT c_name AS site_name, 'http://c/' || c_custkey AS site_url, CASE WHEN c_custkey % 5 = 0 THEN 'added' WHEN c_custkey % 7 = 0 THEN 'removed' ELSE 'changed' END AS change
FROM customer WHERE (c_custkey % 5 = 0) <> (c_custkey % 7 = 0) OR (c_custkey % 5 > 0 AND c_custkey % 7 > 0 AND c_custkey % 11 = 0)""",
    "active_sites": "SELECT c_name AS site_name FROM customer WHERE c_custkey % 5 > 0 AND (c_custkey % 7 = 0 OR c_custkey % 2 = 0)",
    "region_problems": "SELECT s_name AS site_name, 'u' AS site_url, CASE WHEN s_suppkey % 3 = 1 THEN 'region unknown' ELSE 'region missing' END AS reason FROM supplier WHERE s_suppkey % 3 > 0",
    "read_pages": "SELECT split_part(url, '#', 1) AS url, min(page_id) AS page_id FROM pages GROUP BY 1",
    "period_file_records": _x("SELECT site_name, period, '01,02,03' AS value FROM r1 WHERE seq % 3 < 2"),
    "period_file_rejects": _x("SELECT site_name, period FROM r1 WHERE seq % 3 = 2"),
    "history_round_trip": _x("SELECT site_name, site_url, period, 'success' AS state, value FROM r1"),
    "append_results": _x("SELECT b.site_name AS name, b.value, CASE WHEN a.value IS NULL THEN 'append' WHEN a.value = b.value THEN 'noop' ELSE 'conflict' END AS action FROM r1 b LEFT JOIN r1 a ON a.site_name = b.site_name AND a.period = 1 WHERE b.period = 2"),
    "stored_results": _x("""
y AS (SELECT site_name || '@' || period AS name, value, seq FROM r1)
SELECT name, value FROM y WHERE seq % 3 < 2 UNION ALL SELECT name, value || CASE WHEN seq % 5 = 0 THEN '!' ELSE '' END FROM y WHERE seq % 3 = 2"""),
    "stored_conflicts": _x("SELECT site_name || '@' || period AS name, value || '!' AS value, value AS stored FROM r1 WHERE seq % 3 < 2 AND seq % 5 = 0"),
    "stored_failures": _x("""
SELECT site_name || '@' || period AS name, 'transient network' AS category FROM r1 WHERE value = 'error' AND seq % 2 = 0
UNION ALL SELECT site_name || '@' || period, 'other' FROM r1 WHERE seq % 3 < 2 AND seq % 5 = 0"""),
    "stored_history": _x("""SELECT site_name, site_url, period, CASE WHEN value = 'error' THEN 'failed' ELSE 'success' END AS state, CASE WHEN value <> 'error' THEN 'a"b' || chr(92) || 'c ' || value END AS value, CASE WHEN value = 'error' THEN 'timed out' END AS reason FROM r1"""),
    "history_documents": _x("""
y AS (SELECT *, row_number() OVER (ORDER BY ord, site_name) AS place FROM reg)
SELECT site_name, printf('s%03d_', any_value(place)) || site_name AS id, sha256('{"a":true,"b":' || any_value(ord) || ',"region":"' || any_value(region) || '"}') AS contract,
       any_value(region) AS pick, false AS click_first, count(*) FILTER (value = 'error') AS failures, max(period) AS latest,
       '{' || coalesce(string_agg('"' || period || '":"a' || chr(92) || '"b' || chr(92) || chr(92) || 'c ' || value || '"', ',' ORDER BY period DESC) FILTER (value <> 'error'), '') || '}' AS fingerprint
FROM r1 JOIN y USING (site_name, site_url) GROUP BY site_name"""),
    "failure_rows": _x(f"{_FAIL} SELECT * FROM fr"),
    "failure_line_round_trip": _x(f"{_FAIL} SELECT name, region, url, category, reason FROM fr WHERE url NOT LIKE '%x'"),
    "round_report": f"{_ERR.replace('WITH', 'WITH ' + VIEWS.strip() + ',', 1)} SELECT 'success' AS section, '' AS category, count(*) AS n FROM r1 WHERE value <> 'error' UNION ALL SELECT 'failure', CASE WHEN starts_with(reason, '候选') THEN 'ambiguous' WHEN reason = 'timed out' THEN 'transient network' WHEN starts_with(reason, '没有') THEN 'no such period' ELSE 'other' END, count(*) FROM e GROUP BY 1, 2",
    "all_periods_failed": _x(f"""{_ST},
b AS (SELECT g.site_name AS site, p, s.ok AND length(g.site_name) > 4 AS ok, CASE WHEN s.round IS NULL THEN 'in neither file of this run' WHEN length(g.site_name) <= 4 THEN 'no receipt of this run' ELSE s.reason END AS reason
      FROM reg g CROSS JOIN (SELECT unnest([5, 6]) AS p) q LEFT JOIN st s ON s.site_name = g.site_name AND s.round = q.p)
SELECT site, string_agg(p || ': ' || reason, '|' ORDER BY p) AS reasons FROM b GROUP BY 1 HAVING NOT coalesce(bool_or(ok), false)"""),
    "receipts": _x(f"{_ST} SELECT DISTINCT site_name, site_url, sha256(site_name) AS contract FROM st WHERE round = 1 AND ok AND site_name NOT IN (SELECT site_name FROM st WHERE round = 2 AND NOT ok)"),
    "source_fallback": """
WITH l AS (SELECT doc_id // 4 AS site, CAST(doc_id % 4 AS INTEGER) AS k, md5(text) AS content, n_chars % 3 = 0 AS usable, n_chars % 15 = 2 AS hard FROM documents),
b AS (SELECT site, min(k) FILTER (usable) AS u, min(k) FILTER (hard) AS h, arg_min(content, k) FILTER (usable) AS content FROM l GROUP BY 1)
SELECT site, CASE WHEN u IS NOT NULL AND (h IS NULL OR h > u) THEN u END AS source_rank, CASE WHEN u IS NOT NULL AND (h IS NULL OR h > u) THEN content END AS content,
       CASE WHEN u IS NULL AND h IS NULL THEN 'no usable source' WHEN u IS NULL OR h < u THEN '500' END AS problem FROM b""",
    "forum_documents": """
WITH p AS (SELECT conv_id // 4 AS user, conv_id % 4 AS page, CAST(conv_id * 100 + turn AS VARCHAR) AS id, turn, role, CAST(row_number() OVER (PARTITION BY conv_id // 4 ORDER BY conv_id, turn) - 1 AS INTEGER) AS post FROM conversations)
SELECT "user", post, id, role AS content, CAST(100 - page AS INTEGER) AS priority FROM p WHERE turn % 5 <> 3""",
    "release_selection": """
WITH f AS (SELECT p_partkey % 40 AS site, p_brand AS id, p_partkey FROM part WHERE p_type = 'ECONOMY' AND contains(p_name, 'r') QUALIFY row_number() OVER (PARTITION BY p_partkey % 40 ORDER BY p_partkey) <= 2),
g AS (SELECT site, count(DISTINCT id) AS ids, min(id) AS one FROM f GROUP BY 1)
SELECT p_partkey AS site, CASE WHEN ids = 1 THEN one END AS id, CASE WHEN ids IS NULL THEN 'no release' WHEN ids > 1 THEN 'several releases' END AS problem FROM part LEFT JOIN g ON p_partkey = site WHERE p_partkey < 40""",
}
