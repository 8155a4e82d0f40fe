"""Queries of segment extraction and windows, with their SQL.

Texts are written in Spark from line items: for each supplier a page of rows like ``365期 十码 01.02.03 开:??``, from new
to old for even suppliers (whose window is at the top), from old to new for odd ones. What the rows were written from is what extraction must return, so the SQL states that and no pattern.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as t
from ..operators import evidence as e
from ..operators import identity as i
from ..operators import segments as g
from ..operators import what_if as w
from .views import table


def rows_written(spark: SparkSession, sf: str) -> DataFrame:
    """site, period and three numbers of each row."""
    items = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("site"), (F.col("l_orderkey") % 365 + 1).cast("int").alias("period")).agg(F.min("l_partkey").alias("k"))
    two = lambda c: F.format_string("%02d", c % 49 + 1)
    return items.select("site", "period", two(F.col("k")).alias("a"), two(F.expr("k div 49")).alias("b"), two(F.expr("k div 7")).alias("c"))


def pages(spark: SparkSession, sf: str, form: str = "%03d期 十码 %s.%s.%s 开:??") -> DataFrame:
    """doc, content and a contract for each supplier: ten-number keyword, three numbers, five rows from its end."""
    rows = rows_written(spark, sf).withColumn("line", F.format_string(form, "period", "a", "b", "c"))
    place = F.when(F.col("site") % 2 == 0, -F.col("period")).otherwise(F.col("period")).alias("place")
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(place, "line"))), lambda x: x["line"]), "\n")
    return rows.groupBy(F.col("site").alias("doc")).agg(joined.alias("content")).select(
        "doc",
        "content",
        F.array(t.normalize_keyword(F.lit("十碼"), folded=False)).alias("keywords"),
        F.lit(3).alias("count"),
        F.when(F.col("doc") % 2 == 0, "top").otherwise("bottom").alias("region"),
        F.lit(5).alias("window"),
    )


def _groups(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers glued together or without their zero: nothing for strict reading, all of them for relaxed."""
    rows = rows_written(spark, sf).withColumn("text", F.format_string("2026-10-27 09:00 %s.%s%s.%s 开:猪08", "a", "b", "c", F.expr("period % 9 + 1")))
    return rows.select("site", "period", F.size(g.number_groups(F.col("text"))).alias("strict"), F.array_join(g.number_groups(F.col("text"), relaxed=True)[0], ",").alias("relaxed"))


def _late_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers behind the mark of the result: behind a placeholder they count, on a result's own line they don't."""
    text = F.when(F.col("period") % 3 == 0, F.format_string("开:0000 %s %s %s", "a", "b", "c")).when(F.col("period") % 3 == 1, F.format_string("开:05 %s %s %s", "a", "b", "c")).otherwise(F.format_string("开:05 44 45 46\n%s,%s,%s 12期 01 02 03", "a", "b", "c"))
    return rows_written(spark, sf).select("site", "period", F.array_join(F.try_element_at(g.number_groups(text), F.lit(1)), ",").alias("value"))


def _turns(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations").select(F.col("conv_id").alias("doc"), F.col("turn").cast("int").alias("start"), (F.col("turn") % 4).cast("int").alias("period"), F.col("role").alias("value"))
    return turns.withColumns({"seam": F.lit(None).cast("int"), "region": F.when(F.col("doc") % 2 == 0, "top").otherwise("bottom"), "window": F.lit(2)})


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(F.col("o_custkey").alias("doc"), F.col("o_orderkey").alias("start"), F.dayofyear("o_orderdate").alias("period"))


def _steps(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(F.col("o_custkey").alias("doc"), F.col("o_orderkey").alias("start"), F.when(F.col("o_orderkey") % 10 < 5, 365).otherwise(1).alias("period"))


def _scoped(spark: SparkSession, sf: str) -> DataFrame:
    """Pages between the row of one period and that of another; some suppliers lack either."""
    anchors = {"anchor": F.format_string("%03d期", F.col("doc") % 365 + 180 - F.col("doc") % 180), "stop_anchor": F.when(F.col("doc") % 4 > 0, F.lit("010期"))}
    return g.scope_by_anchor(pages(spark, sf).withColumns(anchors)).select("doc", "offset", F.length("content").alias("chars"), "problem")


def _sections(spark: SparkSession, sf: str) -> DataFrame:
    """Pages between headings; a twentieth of them without a stop, another with two headings, some of unknown contract."""
    n = F.col("doc")
    wrapped = F.concat(F.lit("intro\n# rows\n"), F.when(n % 20 == 7, "# rows\n").otherwise(""), "content", F.when(n % 20 == 11, "").otherwise("\n# end\n"), F.lit("300期 十码 01.02.03 开"))
    docs = pages(spark, sf).select("doc", F.when(n % 20 == 13, "other").otherwise("ten").alias("contract"), wrapped.alias("content"))
    contracts = spark.createDataFrame([("ten", "# rows\n", "\n# end\n", "(\\d{3})期 十码 ([\\d.]+) 开", 3, "top", 4)], "contract string, heading string, stop string, pattern string, count int, region string, window int")
    return g.section_rows(docs, contracts)


def _parts(spark: SparkSession, sf: str) -> DataFrame:
    rows = rows_written(spark, sf)
    left = rows.select("site", "period", F.concat_ws(",", "a", "b", "c").alias("value"))
    right = rows.filter("period % 5 > 0").select("site", "period", F.concat_ws(",", "c", "a", F.when(F.col("period") % 7 == 0, F.lit("49")).otherwise(F.lit("48"))).alias("value"))
    shifted = right.withColumn("value", F.array_join(F.transform(F.split("value", ","), lambda x: F.format_string("%02d", (x.cast("int") + 24) % 49 + 1)), ","))
    return g.merge_parts(left, shifted)


def _identity(spark: SparkSession, sf: str) -> DataFrame:
    rows = rows_written(spark, sf)
    segment = F.concat(F.format_string("%03d期:", "period"), F.when(F.col("period") % 2 == 0, "屠龍 ").otherwise(F.repeat(F.lit("文"), 50)), F.when(F.col("period") % 3 == 0, "【絕殺】").otherwise(""), F.lit("屠龍"))
    return g.identity_rows(rows.select(F.col("site").alias("doc"), "period", F.col("period").alias("start"), segment.alias("segment"), F.lit("屠龍").alias("author"), F.lit("絕殺").alias("row_anchor"))).select("doc", "period", "ambiguous")


def _gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Each customer's orders numbered in order, one number missing and named by the title."""
    rows = table(spark, sf, "orders").selectExpr("o_custkey AS doc", "cast(row_number() over (partition by o_custkey order by o_orderkey) as int) AS start", "o_custkey % 4 + 2 AS gap")
    return g.placeholder_repair(rows.select("doc", "start", F.when(F.col("start") != F.col("gap"), F.col("start")).alias("period"), F.when(F.col("doc") % 3 == 0, F.col("gap") + 1).otherwise(F.col("gap")).cast("int").alias("title_period")))


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("doc")
    heading = F.when(n % 5 == 0, "no such line").otherwise(F.element_at(F.split("content", "\n"), 2))
    return g.exact_section(pages(spark, sf).select("doc", "content", heading.alias("heading"), F.element_at(F.split("content", "\n"), -3).alias("ending"))).select("doc", F.length("section").alias("chars"), "problem")


def _tiers(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select(F.col("source").alias("site"), F.col("doc_id").alias("doc"), (F.col("doc_id") % 3 * 10).alias("priority"), F.col("doc_id").alias("ord"), (F.col("n_chars") % 5).alias("n_periods"))
    return g.available_by_tier(docs)


def _spans(spark: SparkSession, sf: str) -> DataFrame:
    rows = rows_written(spark, sf).withColumn("s", F.concat(F.lit("<span class='p'>"), F.col("period").cast("string"), F.lit("期</span> <SPAN>"), F.concat_ws(".", "a", "b", "c"), F.lit("</SPAN>")))
    markup = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("period", "s"))), lambda x: x["s"]), "\n")
    return g.span_rows(rows.groupBy(F.col("site").cast("string").alias("url")).agg(markup.alias("html")), 6)


def _posts(spark: SparkSession, sf: str) -> DataFrame:
    """Turns of eight conversations at a time as the posts of one user, two rows each."""
    turns = table(spark, sf, "conversations").select(F.expr("conv_id div 8").alias("doc"), F.lit("posts").alias("sequence"), (F.col("conv_id") % 8 * 1000 + F.col("turn")).cast("int").alias("post"), F.explode(F.array(F.lit(0), F.lit(1))).alias("start"))
    rows = turns.withColumns({"period": (F.col("post") * 2 + F.col("start")).cast("int"), "value": F.lit("v"), "seam": F.lit(None).cast("bigint"), "region": F.when(F.col("doc") % 2 == 0, "top").otherwise("bottom"), "window": F.lit(5)})
    return g.sequence_window(rows).filter("in_window").select("doc", "post", "start")


def _override(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("doc"),
        F.when(F.col("c_custkey") % 2 == 0, "user_post").otherwise("page").alias("kind"),
        (F.col("c_custkey") % 3 > 0).alias("identity_verified"),
        F.col("c_nationkey").alias("user_id"),
        (F.col("c_custkey") % 25).alias("wanted_user"),
        F.lit("api").alias("identity_source"),
        F.col("c_mktsegment").alias("user_name"),
        F.lit("BUILDING").alias("site_name"),
        F.lit("anchor").alias("anchor"),
    )
    return g.scope_override(rows).select("doc", "anchor")


def _dispatch(spark: SparkSession, sf: str) -> DataFrame:
    sites = table(spark, sf, "customer").select(F.col("c_name").alias("site"), F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("contract"))
    contracts = spark.createDataFrame([("HOUSEHOLD",), ("MACHINERY",)], "contract string")
    return g.contract_dispatch(sites, contracts)[1]


def _anchored(spark: SparkSession, sf: str) -> DataFrame:
    """Pages with a head and a tail around their column of rows; a twentieth of them without the line that ends it."""
    n = F.col("doc")
    tail = F.concat(F.when(n % 20 == 7, "").otherwise("\n终点"), F.lit("\n300期 十码 01.02.03 开:??"))
    content = F.concat(F.repeat(F.lit("x"), (n % 7).cast("int")), F.lit("\n栏目\n"), "content", tail)
    rows = pages(spark, sf).withColumns({"content": content, "anchor": F.lit("栏目"), "stop_anchor": F.lit("终点"), "kind": F.lit("page"), "url": F.concat(F.lit("http://h/Topic/"), n.cast("string")), "source_url_pattern": F.lit("/topic/")})
    return rows.withColumn("fingerprint", F.sha2("content", 256))


def _evidence(spark: SparkSession, sf: str) -> DataFrame:
    return e.extract_located(_anchored(spark, sf)).select("doc", "period", "value", "problem", "evidence.anchor", "evidence.section_start", "evidence.section_end", "evidence.candidate_start")


def _spoilt(spark: SparkSession, sf: str) -> DataFrame:
    """Evidence that is moved, cut, re-dated, taken from elsewhere or altered, by the period."""
    k, at, end = F.col("period") % 11, F.col("evidence.candidate_start"), F.col("evidence.section_end")
    found = e.extract_located(_anchored(spark, sf)).filter("value is not null")
    changed = (
        F.col("evidence")
        .withField("candidate_start", F.when(k == 0, at + 22).when(k == 4, end).otherwise(at))
        .withField("section_end", F.when(k == 1, at + 8).otherwise(end))
        .withField("source_url", F.when(k == 3, "http://h/other").otherwise(F.col("evidence.source_url")))
        .withField("fingerprint", F.when(k == 5, F.sha2(F.lit("x"), 256)).otherwise(F.col("evidence.fingerprint")))
        .withField("source_kind", F.when(k == 6, F.lit(None)).otherwise(F.col("evidence.source_kind")))
    )
    spoilt = found.withColumn("evidence", changed).withColumns({"period": F.when(k == 2, F.col("period") + 1).otherwise(F.col("period")), "value": F.when(k == 7, "01,02,50").otherwise(F.col("value"))})
    return e.evidence_violations(spoilt, _anchored(spark, sf))


def _signed(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """A page of an author for each supplier, ten numbers a row, from new to old for even ones; of odd ones every 13th
    period's row has a second signature, and every ninth page names another author."""
    rows = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("site"), (F.col("l_orderkey") % 365 + 1).cast("int").alias("period")).agg((F.min("l_partkey") % 40 + 1).cast("int").alias("m"))
    odd = F.col("site") % 2 == 1
    numbers = F.array_join(F.transform(F.sequence("m", F.col("m") + 9), lambda x: F.format_string("%02d", x)), ".")
    line = F.concat(F.format_string("%03d期 屠龙 ", "period"), F.when(odd & (F.col("period") % 13 == 0), "横财 ").otherwise(""), F.lit("绝杀十码 "), numbers, F.lit(" 开:??"))
    place = F.when(odd, F.col("period")).otherwise(-F.col("period")).alias("place")
    texts = rows.groupBy("site").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(place, line.alias("line")))), lambda x: x["line"]), "\n").alias("body"))
    who = F.when(F.col("site") % 9 == 4, "独占").otherwise("屠龙")
    pages_ = texts.select(F.col("site").alias("doc"), F.concat(F.lit("首页\n作者："), who, F.lit("\n399期：【绝杀十码】\n"), "body").alias("content"), F.lit("屠龙").alias("author"), F.lit("横财").alias("row_anchor"), F.when(odd, "bottom").otherwise("top").alias("region"), F.lit(5).alias("window"))
    return i.identity_candidates(pages_.withColumns({"requested": F.array(F.lit(26)), "skip_repeats": F.lit(False)}))


def _what_if(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Other windows, sizes and regions for some of the suppliers, and a name that nobody has."""
    docs = pages(spark, sf)
    n = F.col("site")
    registry = docs.select(F.col("doc").alias("site"), "keywords", "count", "region", "window")
    words = F.lit(None).cast("array<string>").alias("keywords")
    own = registry.filter("site % 2 = 0 or site % 5 = 0").select("site", words, F.when(n % 5 == 0, 4).alias("count"), F.when(n % 14 == 0, "left").alias("region"), F.when(n % 3 == 0, 8).when(n % 3 == 1, 3).alias("window"))
    none = own.limit(1).select(F.lit(-1).cast("bigint").alias("site"), words, *[F.lit(None).cast(kind).alias(c) for c, kind in (("count", "int"), ("region", "string"), ("window", "int"))])
    return w.what_if_extraction(docs.select(F.col("doc").alias("site"), "doc", "content"), registry, own.unionByName(none), list(range(1, 366)))


def _titled(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Each customer's orders as rows, dates as periods, and a title that names the period of the second order."""
    rows = table(spark, sf, "orders").selectExpr("o_custkey AS doc", "o_orderkey AS start", "cast(365 - o_orderkey % 300 as int) AS period", "cast(min(365 - o_orderkey % 300) over (partition by o_custkey) as int) AS title_period", "case when o_custkey % 2 = 0 then 'top' else 'bottom' end AS region", "4 AS window")
    return g.titled_cycle_rows(rows)


def _span_values(spark: SparkSession, sf: str) -> DataFrame:
    """Two rows of spans for every third period: the same value again for even ones, another for odd ones."""
    rows = rows_written(spark, sf)
    again = F.when(F.col("period") % 3 > 0, F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1)))
    each = rows.select("*", F.explode(again).alias("k")).withColumn("v", F.when((F.col("k") == 1) & (F.col("period") % 2 == 1), F.concat_ws(".", "c", F.lit("49"), "a")).otherwise(F.concat_ws(".", "a", "b", "c")))
    span = F.concat(F.lit("<span>"), F.col("period").cast("string"), F.lit("期</span><span>"), "v", F.lit("</span>"))
    markup = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("period", "k", span.alias("s")))), lambda x: x["s"]), "\n")
    return g.span_values(each.groupBy(F.col("site").cast("string").alias("url")).agg(markup.alias("html")), 9, 3)


QUERIES = {
    "segments": lambda s, p: g.segments(pages(s, p).select("doc", "content")),
    "number_groups": _groups,
    "number_groups_late": _late_groups,
    "extract": lambda s, p: g.extract(pages(s, p)),
    "candidate_evidence": _evidence,
    "candidate_evidence_violations": _spoilt,
    "identity_candidates": lambda s, p: _signed(s, p)[0],
    "identity_problems": lambda s, p: _signed(s, p)[1],
    "what_if_extraction": lambda s, p: _what_if(s, p)[0].drop("doc"),
    "what_if_coverage": lambda s, p: w.coverage(_what_if(s, p)[0], list(range(1, 366))).drop("doc"),
    "what_if_violations": lambda s, p: _what_if(s, p)[1],
    "titled_cycle_rows": lambda s, p: _titled(s, p)[0],
    "titled_cycle_problems": lambda s, p: _titled(s, p)[1],
    "span_values": _span_values,
    "available_periods": lambda s, p: g.available_periods(g.candidate_rows(pages(s, p))),
    "diagnose_miss": lambda s, p: g.diagnose_miss(pages(s, p).withColumns({"count": F.when(F.col("doc") % 3 == 0, 4).otherwise(3), "keywords": F.when(F.col("doc") % 5 == 0, F.array(F.lit("五"))).otherwise(F.col("keywords"))}), [20, 21, 200]),
    "nearest_periods": lambda s, p: g.nearest_periods(rows_written(s, p), [100, 300], 20).select("site", "period", "distance", "nth"),
    "turn_windows": lambda s, p: g.direction_window(_turns(s, p)).select("doc", "start", "in_window"),
    "sequence_window": _posts,
    "cycle_seam": lambda s, p: g.cycle_seam(_orders(s, p)),
    "cycle_blocks": lambda s, p: g.cycle_blocks(_steps(s, p)),
    "current_cycle_rows": lambda s, p: g.current_cycle_rows(_steps(s, p)).select("doc", "start", "period"),
    "scope_by_anchor": _scoped,
    "section_contract": _sections,
    "merge_parts": _parts,
    "identity_rows": _identity,
    "placeholder_repair": _gaps,
    "exact_section": _lines,
    "available_by_tier": _tiers,
    "span_rows": _spans,
    "scope_override": _override,
    "contract_dispatch": _dispatch,
}

_R = """
WITH k AS (SELECT l_suppkey AS site, CAST(l_orderkey % 365 + 1 AS INTEGER) AS period, min(l_partkey) AS k FROM lineitem GROUP BY 1, 2),
r AS (SELECT site, period, printf('%02d', CAST(k % 49 + 1 AS INTEGER)) AS a, printf('%02d', CAST(k // 49 % 49 + 1 AS INTEGER)) AS b, printf('%02d', CAST(k // 7 % 49 + 1 AS INTEGER)) AS c FROM k),
l AS (SELECT *, printf('%03d', period) || '期 十码 ' || a || '.' || b || '.' || c || ' 开:??' AS line, a || ',' || b || ',' || c AS value, a <> b AND b <> c AND a <> c AS clean,
             CAST(row_number() OVER (PARTITION BY site ORDER BY CASE WHEN site % 2 = 0 THEN -period ELSE period END) - 1 AS INTEGER) AS n, count(*) OVER (PARTITION BY site) AS rows FROM r),
w AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY CASE WHEN site % 2 = 0 THEN n ELSE -n END) AS nth FROM l WHERE clean)
"""

_SIGNED = """
WITH k AS (SELECT l_suppkey AS site, CAST(l_orderkey % 365 + 1 AS INTEGER) AS period, min(l_partkey) % 40 + 1 AS m FROM lineitem GROUP BY 1, 2),
x AS (SELECT *, site % 2 = 1 AS odd, site % 2 = 1 AND period % 13 = 0 AS amb, array_to_string(list_transform(range(m, m + 10), lambda x: printf('%02d', CAST(x AS INTEGER))), ',') AS value FROM k WHERE site % 2 = 0 OR site % 9 <> 4),
y AS (SELECT *, NOT amb AND row_number() OVER (PARTITION BY site, amb ORDER BY period DESC) <= 5 AS sel FROM x), v AS (SELECT *, min(period) FILTER (sel) OVER (PARTITION BY site) AS edge FROM y),
problems AS (SELECT site AS doc, period, 'two signatures' AS problem FROM v WHERE amb AND (period = 26 OR period >= edge) UNION ALL SELECT DISTINCT site, CAST(NULL AS INTEGER), 'another author' FROM k WHERE site % 2 = 1 AND site % 9 = 4)"""
_WHAT_IF = f"""{_R},
c AS (SELECT *, CASE site % 3 WHEN 0 THEN 8 WHEN 1 THEN 3 ELSE 5 END AS wide FROM w WHERE (site % 2 = 0 OR site % 5 = 0) AND site % 14 > 0),
d AS (SELECT site, period, CASE WHEN nth <= 5 THEN value END AS before, CASE WHEN site % 5 > 0 AND nth <= wide THEN value END AS after FROM c),
changes AS (SELECT *, CASE WHEN before IS NULL THEN 'found' WHEN after IS NULL THEN 'lost' ELSE 'same' END AS change FROM d WHERE before IS NOT NULL OR after IS NOT NULL)"""
_TITLED = """
WITH o AS (SELECT o_custkey AS doc, o_orderkey AS start, CAST(365 - o_orderkey % 300 AS INTEGER) AS period, min(365 - o_orderkey % 300) OVER (PARTITION BY o_custkey) AS title FROM orders),
n AS (SELECT * FROM o QUALIFY row_number() OVER (PARTITION BY doc ORDER BY CASE WHEN doc % 2 = 0 THEN start ELSE -start END) <= 4), t AS (SELECT *, bool_or(period = title) OVER (PARTITION BY doc) AS titled FROM n)"""

ORACLES = {
    "segments": f"{_R} SELECT site AS doc, n, n * 22 AS start, period, line || CASE WHEN n < rows - 1 THEN chr(10) ELSE '' END AS segment FROM l",
    "number_groups": f"{_R} SELECT site, period, 0 AS strict, a || ',' || b || ',' || c || ',0' || (period % 9 + 1) AS relaxed FROM r",
    "number_groups_late": f"{_R} SELECT site, period, CASE WHEN period % 3 <> 1 THEN value END AS value FROM l",
    "extract": f"{_R} SELECT site AS doc, period, value, n * 22 AS start, CAST(NULL AS VARCHAR) AS problem FROM w WHERE nth <= 5",
    "candidate_evidence": f"""{_R}
SELECT site AS doc, period, value, CAST(NULL AS VARCHAR) AS problem, '栏目' AS anchor, CAST(site % 7 + 1 AS INTEGER) AS section_start, CAST(site % 7 + 4 + rows * 22 AS INTEGER) AS section_end, CAST(site % 7 + 4 + n * 22 AS INTEGER) AS candidate_start
FROM w WHERE nth <= 5 AND site % 20 <> 7 UNION ALL SELECT DISTINCT site, CAST(NULL AS INTEGER), NULL, 'stop anchor not found', NULL, CAST(NULL AS INTEGER), CAST(NULL AS INTEGER), CAST(NULL AS INTEGER) FROM l WHERE site % 20 = 7""",
    "candidate_evidence_violations": f"""{_R}, v AS (SELECT site AS doc, CASE WHEN period % 11 = 2 THEN period + 1 ELSE period END AS period, CASE WHEN period % 11 = 7 THEN '01,02,50' ELSE value END AS value,
 CASE period % 11 WHEN 0 THEN CASE WHEN n = rows - 1 THEN 'out of range' ELSE 'another period' END WHEN 1 THEN 'another section' WHEN 2 THEN 'another period' WHEN 3 THEN 'another URL'
 WHEN 4 THEN 'out of range' WHEN 5 THEN 'altered' WHEN 6 THEN 'incomplete' WHEN 7 THEN 'another value' END AS violation FROM w WHERE nth <= 5 AND site % 20 <> 7)
SELECT * FROM v WHERE violation IS NOT NULL""",
    "identity_candidates": f"{_SIGNED} SELECT site AS doc, period, value FROM v WHERE sel AND site NOT IN (SELECT doc FROM problems)",
    "identity_problems": f"{_SIGNED} SELECT * FROM problems",
    "what_if_extraction": f"{_WHAT_IF} SELECT * FROM changes",
    "what_if_coverage": f"{_WHAT_IF} SELECT site, CAST(count(before) AS INTEGER) AS found_before, CAST(count(after) AS INTEGER) AS found_after, CAST(365 - count(before) AS INTEGER) AS missing_before, CAST(365 - count(after) AS INTEGER) AS missing_after FROM changes GROUP BY site",
    "what_if_violations": f"{_R} SELECT CAST(-1 AS BIGINT) AS site, 'unknown site' AS violation UNION ALL SELECT DISTINCT site, 'region' FROM l WHERE site % 14 = 0",
    "titled_cycle_rows": f"{_TITLED} SELECT doc, start, period FROM t WHERE titled",
    "titled_cycle_problems": f"{_TITLED} SELECT DISTINCT doc, 'the title''s period is not in the window' AS problem FROM t WHERE NOT titled",
    "span_values": f"""{_R}, e AS (SELECT site, period, unnest(CASE WHEN period % 3 > 0 THEN [0] ELSE [0, 1] END) AS k, value, c || ',49,' || a AS other FROM l),
f AS (SELECT site, period, CASE WHEN k = 1 AND period % 2 = 1 THEN other ELSE value END AS v FROM e QUALIFY row_number() OVER (PARTITION BY site ORDER BY period, k) <= 9)
SELECT CAST(site AS VARCHAR) AS url, period, CASE WHEN count(DISTINCT v) = 1 THEN min(v) END AS value, CASE WHEN count(DISTINCT v) > 1 THEN 'ambiguous' END AS problem FROM f GROUP BY site, period""",
    "available_periods": f"{_R} SELECT site AS doc, period, n * 22 AS pos FROM w WHERE nth <= 5",
    "diagnose_miss": f"""{_R} SELECT l.site AS doc, l.period, CASE WHEN l.site % 5 = 0 THEN 'keyword' WHEN l.site % 3 = 0 THEN 'wrong size' WHEN NOT l.clean THEN 'repeats' ELSE 'outside window' END AS reasons
FROM l LEFT JOIN w ON w.site = l.site AND w.period = l.period AND w.nth <= 5 WHERE l.period IN (20, 21, 200) AND (l.site % 5 = 0 OR l.site % 3 = 0 OR w.site IS NULL)""",
    "nearest_periods": f"""{_R}, d AS (SELECT site, period, CAST(least(abs(period - 100), abs(period - 300)) AS INTEGER) AS distance FROM r)
SELECT site, period, distance, CAST(row_number() OVER (PARTITION BY site ORDER BY distance, period DESC) AS INTEGER) AS nth FROM d QUALIFY nth <= 20""",
    "turn_windows": """
WITH t AS (SELECT conv_id AS doc, CAST(turn AS INTEGER) AS start, turn % 4 AS period, role AS value, CASE WHEN conv_id % 2 = 0 THEN turn ELSE -turn END AS o FROM conversations),
f AS (SELECT *, row_number() OVER (PARTITION BY doc, period, value ORDER BY o) = 1 AS first FROM t)
SELECT doc, start, first AND row_number() OVER (PARTITION BY doc, first ORDER BY o) <= 2 AS in_window FROM f""",
    "sequence_window": """
WITH t AS (SELECT conv_id // 8 AS doc, CAST(conv_id % 8 * 1000 + turn AS INTEGER) AS post, unnest([0, 1]) AS start FROM conversations)
SELECT doc, post, start FROM t QUALIFY row_number() OVER (PARTITION BY doc ORDER BY CASE WHEN doc % 2 = 0 THEN post * 2 + start ELSE -(post * 2 + start) END) <= 5""",
    "cycle_seam": """
WITH o AS (SELECT o_custkey AS doc, o_orderkey AS start, CAST(dayofyear(o_orderdate) AS INTEGER) AS period FROM orders),
j AS (SELECT *, CASE WHEN period - lag(period) OVER (PARTITION BY doc ORDER BY start) >= 300 THEN start END AS j FROM o)
SELECT doc, start, period, min(j) OVER (PARTITION BY doc) AS seam FROM j""",
    "cycle_blocks": """
WITH o AS (SELECT o_custkey AS doc, o_orderkey AS start, CASE WHEN o_orderkey % 10 < 5 THEN 365 ELSE 1 END AS period FROM orders),
s AS (SELECT *, coalesce(CAST(lag(period) OVER (PARTITION BY doc ORDER BY start) = 365 AND period = 1 AS INTEGER), 0) AS s FROM o),
b AS (SELECT doc, start, period, CAST(sum(s) OVER (PARTITION BY doc ORDER BY start) AS INTEGER) AS block FROM s)
SELECT doc, start, period, block, max(block) OVER (PARTITION BY doc) + 1 AS blocks FROM b""",
    "current_cycle_rows": """
WITH o AS (SELECT o_custkey AS doc, o_orderkey AS start, CASE WHEN o_orderkey % 10 < 5 THEN 365 ELSE 1 END AS period FROM orders),
s AS (SELECT *, coalesce(CAST(lag(period) OVER (PARTITION BY doc ORDER BY start) = 365 AND period = 1 AS INTEGER), 0) AS s FROM o),
b AS (SELECT doc, start, period, sum(s) OVER (PARTITION BY doc ORDER BY start) AS block FROM s)
SELECT doc, start, period FROM b QUALIFY block = 0 AND max(block) OVER (PARTITION BY doc) <= 1""",
    "scope_by_anchor": f"""{_R}, x AS (SELECT site AS doc, max(rows) AS rows, max(n) FILTER (period = site % 365 + 180 - site % 180) AS a, max(n) FILTER (period = 10) AS s, site % 4 > 0 AS stops FROM l GROUP BY site),
p AS (SELECT *, CASE WHEN a IS NULL THEN 'anchor not found' WHEN stops AND (s IS NULL OR s <= a) THEN 'stop anchor not found' END AS problem FROM x)
SELECT doc, CASE WHEN problem IS NULL THEN a * 22 END AS "offset", CAST(CASE WHEN problem IS NULL THEN CASE WHEN stops THEN (s - a) * 22 ELSE rows * 22 - 1 - a * 22 END END AS INTEGER) AS chars, problem FROM p""",
    "section_contract": f"""{_R}
SELECT site AS doc, period, CASE WHEN clean THEN value END AS value, CASE WHEN NOT clean THEN 'repeats' END AS problem FROM l WHERE n < 4 AND site % 20 NOT IN (7, 11, 13)
UNION ALL SELECT DISTINCT site, CAST(NULL AS INTEGER), CAST(NULL AS VARCHAR), CASE site % 20 WHEN 7 THEN 'several headings' WHEN 11 THEN 'no stop' ELSE 'unknown contract' END FROM l WHERE site % 20 IN (7, 11, 13)""",
    "merge_parts": f"""{_R}, m AS (SELECT site, period, list_concat([a, b, c], list_transform([c, a, CASE WHEN period % 7 = 0 THEN '49' ELSE '48' END], lambda x: printf('%02d', (CAST(x AS INTEGER) + 24) % 49 + 1))) AS v FROM r WHERE period % 5 > 0)
SELECT site, period, CASE WHEN len(list_distinct(v)) = 6 THEN array_to_string(v, ',') END AS value, CASE WHEN len(list_distinct(v)) < 6 THEN 'repeats' END AS problem FROM m""",
    "identity_rows": f"{_R} SELECT site AS doc, period, period % 2 = 0 AND period % 3 = 0 AS ambiguous FROM r WHERE period % 2 = 0 OR period % 3 = 0",
    "placeholder_repair": """
WITH o AS (SELECT o_custkey AS doc, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS INTEGER) AS start, o_custkey % 4 + 2 AS gap FROM orders)
SELECT doc, start, CASE WHEN start <> gap OR doc % 3 > 0 THEN start END AS period, CAST(CASE WHEN doc % 3 = 0 THEN gap + 1 ELSE gap END AS INTEGER) AS title_period FROM o""",
    "exact_section": f"""{_R}, x AS (SELECT site AS doc, max(rows) AS rows FROM l GROUP BY 1)
SELECT doc, CAST(CASE WHEN doc % 5 <> 0 THEN (rows - 5) * 22 - 1 END AS INTEGER) AS chars, CASE WHEN doc % 5 = 0 THEN 'heading' END AS problem FROM x""",
    "available_by_tier": """
SELECT source AS site, doc_id AS doc, doc_id % 3 * 10 AS priority, n_chars % 5 AS n_periods FROM documents WHERE n_chars % 5 > 0
QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id % 3 DESC, n_chars % 5 DESC, doc_id) = 1""",
    "span_rows": f"{_R} SELECT CAST(site AS VARCHAR) AS url, CAST(row_number() OVER (PARTITION BY site ORDER BY period) - 1 AS INTEGER) AS n, period, a || '.' || b || '.' || c AS value FROM r QUALIFY n < 6",
    "scope_override": "SELECT c_custkey AS doc, CASE WHEN c_custkey % 2 = 0 AND c_custkey % 3 > 0 AND c_nationkey = c_custkey % 25 AND c_mktsegment = 'BUILDING' THEN NULL ELSE 'anchor' END AS anchor FROM customer",
    "contract_dispatch": "SELECT c_name AS site, c_mktsegment AS contract, 'unknown contract' AS problem FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'HOUSEHOLD', 'MACHINERY')",
}
