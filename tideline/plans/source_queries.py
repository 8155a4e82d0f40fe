"""Queries of readers and of column functions on data that Spark has written itself, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import text as t
from ..operators import duplicates as d
from ..operators import reconcile as r
from ..operators import segments as g
from ..sources import landed as s
from .duplicate_queries import _RUNS
from .segment_queries import _R, pages
from .views import day_records, raw_day_records, shared_path, sql, table

WIDE = "０１２３４５６７８９ＡＢＣＤＥＦＧＨＩＪＫＬＭＮＯＰＱＲＳＴＵＶＷＸＹＺａｂｃｄｅｆｇｈｉｊｋｌｍｎｏｐｑｒｓｔｕｖｗｘｙｚ"
NARROW = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def _registry_file(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers as one JSON array in a file, every third of them disabled."""
    at, n = shared_path(spark), F.col("s_suppkey")
    entry = F.to_json(F.struct(F.col("s_name").alias("name"), (n % 3 == 0).alias("disabled")))
    rows = table(spark, sf, "supplier").agg(F.transform(F.sort_array(F.collect_list(F.struct("s_suppkey", entry.alias("e")))), lambda x: x["e"]).alias("es"))
    rows.select(F.concat(F.lit("[\n"), F.array_join("es", ",\n"), F.lit("]"))).write.text(at)
    return s.read_registry(spark, at).select("ord", F.get_json_object("raw", "$.name").alias("name"))


def _encoded(spark: SparkSession, sf: str) -> DataFrame:
    """Pages in UTF-8, and in a charset that they name themselves."""
    html, odd = F.col("html"), F.col("page_id") % 2 == 1
    named = F.concat(F.lit('<meta charset="iso-8859-1">'), F.regexp_replace(html, "[^\\x00-\\xff]", "?"))
    files = table(spark, sf, "pages").select(F.col("page_id").cast("string").alias("path"), F.when(odd, F.encode(named, "ISO-8859-1")).otherwise(F.encode(html, "UTF-8")).alias("content"))
    return s.decode_pages(files).select("path", F.md5(F.col("text").cast("binary")).alias("text_md5"))


def _discovered(spark: SparkSession, sf: str) -> DataFrame:
    """A folder of files for each day, named by two globs that overlap."""
    at = shared_path(spark)
    day_records(spark, sf).select("period", F.concat_ws(" ", "value", "site_name").alias("line")).repartition("period").write.partitionBy("period").text(at)
    found = s.discover_inputs(spark, [f"{at}/period=*/*.txt", f"{at}/period=1*/*"])
    return found.select(F.regexp_extract("path", r"period=(\d+)", 1).cast("int").alias("period"))


def _articles(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as article records, alone or among the sections of landing data; some of another author."""
    n = F.col("doc_id")
    body = F.when(n % 3 == 0, F.base64(F.substring("text", 1, 30).cast("binary"))).otherwise(F.col("text"))
    author = F.when(n % 7 == 0, F.lit("other")).otherwise(F.col("source"))
    record = F.struct(n.cast("string").alias("id"), author.alias("author"), F.col("source").alias("name"), F.col("lang").alias("title"), body.alias("body"))
    landing = F.struct(F.create_map(F.lit("a"), F.array(), F.coalesce("lang", F.lit("none")), F.array(record)).alias("sectionData"))
    landed = table(spark, sf, "documents").select(n.alias("site"), n.cast("string").alias("article_id"), F.col("source").alias("author"), F.when(n % 2 == 0, F.to_json(record)).otherwise(F.to_json(landing)).alias("json"))
    return s.article_documents(landed).select("site", F.md5(F.col("content").cast("binary")).alias("content_md5"), "problem")


def _progress(spark: SparkSession, sf: str) -> DataFrame:
    """What an observation of all day records has counted once they have been written."""
    seen = Observation("progress")
    r.progress(day_records(spark, sf).select((F.col("value") != "error").alias("ok")), seen).write.format("noop").mode("overwrite").save()
    told = seen.get
    return spark.createDataFrame([(told["done"], told["succeeded"], told["failed"])], "done long, succeeded long, failed long")


def _report(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return d.duplicate_report(day_records(spark, sf), d.conflict_problems(raw_day_records(spark, sf)))


QUERIES = {
    "read_registry": _registry_file,
    "decode_pages": _encoded,
    "discover_inputs": _discovered,
    "article_documents": _articles,
    "progress_metrics": _progress,
    "duplicate_report": lambda x, p: _report(x, p)["summary"],
    "duplicate_report_parts": lambda x, p: _report(x, p)["cross_period"].select(F.lit("cross period").alias("part"), "value", F.col("periods").alias("n")).unionByName(_report(x, p)["same_period"].select(F.lit("same period").alias("part"), "value", F.col("members").alias("n"))).unionByName(
        _report(x, p)["problems"].select(F.lit("problem").alias("part"), F.col("name").alias("value"), F.lit(1).cast("long").alias("n"))
    ),
    "halfwidth": lambda x, p: table(x, p, "pages").select("page_id", t.halfwidth(F.translate("url", NARROW, WIDE)).alias("url")),
    "period_key": lambda x, p: table(x, p, "part").select("p_partkey", t.period_key(F.concat(F.lit("第0"), F.translate(F.col("p_partkey").cast("string"), "0123456789", "０１２３４５６７８９"), F.lit("期"))).alias("key"), t.period_key(F.col("p_brand")).alias("brand_key")),
    "unique_keep_order": lambda x, p: table(x, p, "events").groupBy("user_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("event_id", "event_type"))), lambda e: e["event_type"]).alias("all")).select("user_id", F.array_join(t.unique_keep_order(F.flatten(F.array(F.array(F.lit("")), F.col("all")))), ",").alias("kinds")),
    # Odd suppliers' rows run from old to new: read from the top, their windows hold nothing but old periods.
    "stale_window": lambda x, p: g.extract(pages(x, p).withColumn("region", F.lit("top"))),
}

# Base64 decoded, as ``landed._plain`` says.
_PADDED = "CASE WHEN contains({0}, '=') THEN {0} ELSE rpad({0}, CAST((length({0}) + 3) // 4 * 4 AS INTEGER), '=') END"
_DECODED = f"try(decode(from_base64({_PADDED})))"
_PLAIN = f"CASE WHEN length({{0}}) >= 8 AND regexp_full_match({{0}}, '[A-Za-z0-9+/]+={{{{0,2}}}}') AND NOT regexp_matches({_DECODED}, '[\\x00-\\x08\\x0e-\\x1f\\x{{{{fffd}}}}]') THEN {_DECODED} ELSE {{0}} END"

ORACLES = {
    "read_registry": "SELECT CAST(row_number() OVER (ORDER BY s_suppkey) - 1 AS INTEGER) AS ord, s_name AS name FROM supplier QUALIFY s_suppkey % 3 <> 0",
    "decode_pages": """SELECT CAST(page_id AS VARCHAR) AS path, md5(CASE WHEN page_id % 2 = 1 THEN '<meta charset="iso-8859-1">' || regexp_replace(html, '[^\\x{00}-\\x{ff}]', '?', 'g') ELSE html END) AS text_md5 FROM pages""",
    "discover_inputs": sql("SELECT DISTINCT period FROM r1"),
    "article_documents": f"""WITH x AS (SELECT doc_id AS site, source, lang, doc_id % 7 <> 0 OR source IS NULL AS fits, CASE WHEN doc_id % 3 = 0 THEN base64(encode(text[1:30])) ELSE text END AS body FROM documents)
SELECT site, CASE WHEN fits THEN md5(concat_ws(chr(10), source, {_PLAIN.format("lang")}, {_PLAIN.format("body")})) END AS content_md5, CASE WHEN NOT fits THEN 'no such article' END AS problem FROM x""",
    "progress_metrics": sql("SELECT count(*) AS done, count(*) FILTER (value <> 'error') AS succeeded, count(*) FILTER (value = 'error') AS failed FROM r1"),
    "duplicate_report": sql(f"""{_RUNS},
y AS (SELECT site_name, value <> first_value(value) OVER (PARTITION BY site_name, site_url, period ORDER BY seq) AS odd FROM raw),
z AS (SELECT count(*) FILTER (status = 'reject') AS rejects, count(*) FILTER (status = 'suspect') AS suspects, (SELECT count(*) FROM y WHERE odd) AS problems FROM runs)
SELECT CASE WHEN problems > 0 THEN 'incomplete' WHEN rejects > 0 THEN 'reject' WHEN suspects > 0 THEN 'suspect' ELSE 'clean' END AS conclusion,
       CAST(CASE WHEN rejects > 0 THEN 6 WHEN suspects > 0 THEN 5 ELSE 0 END AS INTEGER) AS code, rejects, suspects, problems FROM z"""),
    "duplicate_report_parts": sql("""
x AS (SELECT 1), y AS (SELECT site_name, value <> first_value(value) OVER (PARTITION BY site_name, site_url, period ORDER BY seq) AS odd FROM raw)
SELECT 'cross period' AS part, value, count(DISTINCT period) AS n FROM r1 GROUP BY value HAVING count(DISTINCT period) >= 2
UNION ALL SELECT 'same period', value, count(*) FROM r1 GROUP BY period, value HAVING count(*) >= 2 UNION ALL SELECT 'problem', site_name, 1 FROM y WHERE odd"""),
    "halfwidth": "SELECT page_id, url FROM pages",
    "period_key": "SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS key, coalesce(nullif(ltrim(regexp_replace(p_brand, '[^0-9]', '', 'g'), '0'), ''), CASE WHEN regexp_matches(p_brand, '[0-9]') THEN '0' ELSE '' END) AS brand_key FROM part",
    "unique_keep_order": "SELECT user_id, string_agg(event_type, ',' ORDER BY first) AS kinds FROM (SELECT user_id, event_type, min(event_id) AS first FROM events GROUP BY 1, 2) GROUP BY 1",
    "stale_window": f"{_R} SELECT site AS doc, period, value, n * 22 AS start, CAST(NULL AS VARCHAR) AS problem FROM w WHERE site % 2 = 1 OR nth <= 5",
}
