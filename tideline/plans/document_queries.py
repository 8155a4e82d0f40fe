"""Queries of document expansion and of text functions, with their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as t
from ..operators import documents as d
from .views import table


def _pages(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages")


def _wrapped(spark: SparkSession, sf: str) -> DataFrame:
    """Pages with payloads, frames and scripts of each other, made of the landed ones."""
    rows = _pages(spark, sf).select("page_id", t.drop_fragment(F.col("url")).alias("own"), "html")
    n = F.col("page_id")
    url = F.concat(F.lit("http://w.example/"), n.cast("string"), F.lit("/index.html"))
    call = F.concat(F.lit("<script>strdecode('"), F.base64(F.substring("own", 1, 40).cast("binary")), F.lit("')</script>"))
    frame = F.concat(F.lit('<iframe src="/'), (n + 1).cast("string"), F.lit('/index.html"></iframe><script src="../x.js"></script>'))
    return rows.select("page_id", url.alias("url"), F.concat("html", F.when(n % 3 == 0, call).otherwise(""), F.when(n % 4 == 0, frame).otherwise("")).alias("html"))


def _expanded(spark: SparkSession, sf: str) -> DataFrame:
    pages = _wrapped(spark, sf)
    return d.expand_pages(pages, pages)


def _chain(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers' pages: each leads to the next, every 17th twice, every 23rd back to its start."""
    n = F.col("s_suppkey")
    page = lambda x: F.concat(F.lit("p"), x.cast("string"))
    rows = table(spark, sf, "supplier")
    links = rows.filter("s_suppkey % 7 <> 3").select(page(n).alias("url"), F.explode(F.when(n % 17 == 0, F.array(page(n + 1), page(n + 2))).when(n % 23 == 0, F.array(page(n))).otherwise(F.array(page(n + 1)))).alias("next"))
    starts = rows.filter("s_suppkey % 5 = 0").select(F.col("s_name").alias("site"), page(n).alias("url"))
    return d.page_chain(starts, links, 4)


def _labelled_links(spark: SparkSession, sf: str) -> DataFrame:
    """A list page for each supplier with links to its line items' days as periods."""
    items = table(spark, sf, "lineitem").select("l_suppkey", "l_linenumber", (F.dayofmonth("l_shipdate")).alias("p")).distinct()
    return items.select(F.concat(F.lit("http://list/"), F.col("l_suppkey").cast("string")).alias("url"), F.concat(F.lit("http://art/"), F.col("l_linenumber").cast("string")).alias("href"), F.concat(F.format_string("%03d", "p"), F.lit("期 十碼 "), F.when(F.col("l_linenumber") < 4, "稳").otherwise("穩殺")).alias("label"))


def _usable(spark: SparkSession, sf: str) -> DataFrame:
    docs = _expanded(spark, sf).withColumn("site", F.substring("fingerprint", 1, 1))
    registry = docs.select("site").distinct().withColumn("allowed_source_types", F.when(F.col("site") < "8", F.array(F.lit("inline_script"), F.lit("iframe"))).otherwise(F.array(F.lit("decoded_script"))))
    return d.parseable_documents(docs, registry).groupBy("site", "kind").agg(F.count(F.lit(1)).alias("n"))


def _by_source(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    docs = table(spark, sf, "documents").select(F.col("source").alias("site"), F.concat(F.lit("http://d/"), F.col("doc_id").cast("string")).alias("url"), F.col("text").alias("content"))
    n = F.regexp_extract("site", "(\\d+)", 1).cast("int")
    pattern = F.when(n % 3 == 0, "[13579]$").when(n % 3 == 1, "^ftp:")
    return docs, docs.select("site").distinct().withColumns({"source_pattern": pattern, "anchor": F.lit("Released"), "stop_anchor": F.lit("Apache")})


def _case(number: Column, texts: list[str]) -> Column:
    """The text of a row's number, with the number itself in place of #."""
    pick = F.get(F.array(*[F.lit(x) for x in texts]), F.pmod(number, F.lit(len(texts))).cast("int"))
    return F.replace(pick, F.lit("#"), number.cast("string"))


#: Cases that the given tables lack, by a row's number, and what must come out: also what the SQL says.
LINKS = [("../#.js", "http://h/a/#.js"), ("./b/./#/..", "http://h/a/b/b/"), ("/#/../x?y=../#", "http://h/x?y=../#"), ("../../../#", "http://h/#"), ("?q=#", "http://h/a/b/c.html?q=#"), ("//o/#/../x", "http://o/#/../x"), ("x/#/", "http://h/a/b/x/#/"), ("ftp://o/../#", "ftp://o/../#")]
IDENTITIES = [("http://h/topic/t#/rest", "t#"), ("http://h/x/Article/Lottery/#?y=1", "#"), ("http://h/post/12/n#", "n#"), ("http://h/article/#/", "#"), ("http://h/", ""), ("http://h", "")]
NAMES = [("楼主：丙# 作者：丁#", "丁#"), ("12期《甲#》 12期【乙#】", "乙#"), ("12期【稳杀#】 13期【乙#公开】", "乙#"), ("012期『丙#』 12期《丁#》", "丁#"), ("<title>17图库</title>", "页"), ("<title> 某 站# </title>text", "某站#"), ("发帖人: 昵称：戊# 准", "戊#"), ("text", "页")]
BOXES = [
    ('<p>A#</p><div class="top box">a<br>b#<script>var z = 1</script><div>c</div>&lt;d</div>', "a\nb#\nc\n<d", None),
    ('<div class="box">x<div class="box">y#</div></div>', None, "duplicate"),
    ('<div class="box">x</div><div class="box">#</div>', None, "duplicate"),
    ('<div class="boxes">#</div>', None, "missing"),
    ('<div class="box">#', None, "unclosed"),
    ('<div class="box">#</div> A#', None, "anchor"),
    ('A# <div class="box">x#</div>', "x#", None),
]


def _boxes(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("o_orderkey")
    return d.container_text(table(spark, sf, "orders").select(n.cast("string").alias("url"), _case(n, [b for b, *_ in BOXES]).alias("html"), F.concat(F.lit("A"), n.cast("string")).alias("anchor")), "box")


def _expected(number: str, values: list[str | None]) -> str:
    quoted = [("NULL" if x is None else "'" + x.replace("'", "''") + "'") for x in values]
    return f"replace([{', '.join(quoted)}][{number} % {len(values)} + 1], '#', CAST({number} AS VARCHAR))"


QUERIES = {
    "joined_links": lambda s, p: table(s, p, "orders").select("o_orderkey", d.absolute_url(_case(F.col("o_orderkey"), [a for a, _ in LINKS]), F.lit("http://h/a/b/c.html?k=/v#z")).alias("url")),
    "source_identities": lambda s, p: table(s, p, "orders").select("o_orderkey", d.source_identity(_case(F.col("o_orderkey"), [a for a, _ in IDENTITIES])).alias("identity")),
    "display_names": lambda s, p: table(s, p, "orders").select("o_orderkey", d.display_name(_case(F.col("o_orderkey"), [a for a, _ in NAMES]), F.lit("页")).alias("name")),
    "container_cases": _boxes,
    "page_fingerprint": lambda s, p: _pages(s, p).select("page_id", d.fingerprint(F.col("html")).alias("fingerprint")),
    "page_host": lambda s, p: _pages(s, p).select("page_id", t.host(F.col("url")).alias("host"), t.origin(F.col("url")).alias("origin"), t.drop_fragment(F.col("url")).alias("plain_url")),
    "page_slug": lambda s, p: _pages(s, p).select("page_id", t.site_slug(F.col("url")).alias("slug"), d.source_identity(F.col("url")).alias("identity")),
    "page_links": lambda s, p: d.anchor_links(_pages(s, p)).select("url", "n", "href", "label"),
    "page_scripts": lambda s, p: _pages(s, p).select("page_id", F.posexplode(d.inline_scripts(F.col("html"))).alias("n", "body")),
    "visible_document": lambda s, p: _pages(s, p).select("page_id", F.md5(d.visible_document(F.col("html")).cast("binary")).alias("content_md5")),
    "page_documents": lambda s, p: _expanded(s, p).groupBy("kind", "priority", "parseable", "authorization").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("content")).alias("chars")),
    "decoded_payloads": lambda s, p: _wrapped(s, p).select("page_id", F.explode(d.decoded_payloads(F.col("html"))).alias("payload")),
    "child_region": lambda s, p: _wrapped(s, p).select("page_id", d.child_region(F.col("html"), F.concat(F.lit("http://w.example/"), (F.col("page_id") + 1).cast("string"), F.lit("/index.html"))).alias("region")),
    "page_text": lambda s, p: _pages(s, p).select("page_id", t.html_to_text(F.col("html")).alias("text")),
    "display_name": lambda s, p: _pages(s, p).select("page_id", d.display_name(F.col("html"), F.col("url")).alias("name")),
    "container_scope": lambda s, p: d.container_text(_pages(s, p), "ad"),
    "page_chain": _chain,
    "period_link_index": lambda s, p: d.period_link_index(_labelled_links(s, p), ["十码", "稳杀"]),
    "follow_links": lambda s, p: d.follow_links(d.period_link_index(_labelled_links(s, p), ["十码", "稳杀"]), table(s, p, "region").select(F.concat(F.lit("http://art/"), (F.col("r_regionkey") + 3).cast("string")).alias("url"), F.col("r_name").alias("html"))),
    "parseable_documents": _usable,
    "source_url_filter": lambda s, p: d.source_url_filter(*_by_source(s, p))[0].select("site", "url"),
    "source_url_problems": lambda s, p: d.source_url_filter(*_by_source(s, p))[1],
    "split_contracts": lambda s, p: d.split_contracts(*_by_source(s, p)),
}

_URL = "'http://w.example/' || {} || '/index.html'"
_W = f"""
WITH w0 AS (SELECT page_id, regexp_replace(url, '#.*$', '') AS own, html FROM pages),
w AS (SELECT page_id, {_URL.format('page_id')} AS url, html || CASE WHEN page_id % 3 = 0 THEN '<script>strdecode(''' || base64(encode(own[1:40])) || ''')</script>' ELSE '' END
      || CASE WHEN page_id % 4 = 0 THEN '<iframe src="/' || (page_id + 1) || '/index.html"></iframe><script src="../x.js"></script>' ELSE '' END AS html, own[1:40] AS payload FROM w0)"""
_VISIBLE = "regexp_replace(regexp_replace(regexp_replace({0}, '<script\\b[^>]*>.*?</script\\s*>', '', 'gis'), '<iframe\\b[^>]*>.*?</iframe\\s*>', '', 'gis'), '<(?:style|noscript)\\b[^>]*>.*?</(?:style|noscript)\\s*>', '', 'gis')"
_E = f"""{_W},
e AS (SELECT page_id, url, html, payload, 'page' AS k FROM w UNION ALL SELECT f.page_id, f.url, f.html, f.payload, 'iframe' FROM w p JOIN w f ON f.page_id = p.page_id + 1 WHERE p.page_id % 4 = 0),
sc AS (SELECT k, unnest(list_filter(list_transform(list_zip(regexp_extract_all(html, '<script\\b([^>]*)>(.*?)</script\\s*>', 1, 'is'), regexp_extract_all(html, '<script\\b([^>]*)>(.*?)</script\\s*>', 2, 'is')),
        lambda x: CASE WHEN contains(x[1], 'src=') THEN '' ELSE trim(x[2], chr(10) || chr(13) || chr(9) || ' ') END), lambda y: y <> '')) AS content FROM e),
docs AS (
SELECT k AS kind, CASE k WHEN 'page' THEN 100 ELSE 90 END AS priority, true AS parseable, CASE k WHEN 'page' THEN '' ELSE 'iframe' END AS "authorization", {_VISIBLE.format('html')} AS content FROM e
UNION ALL SELECT k || '_source', 0, false, '', html FROM e
UNION ALL SELECT CASE k WHEN 'page' THEN 'decoded_inline_stream' ELSE 'iframe_stream' END, CASE k WHEN 'page' THEN 80 ELSE 65 END, true, CASE k WHEN 'page' THEN 'decoded_script' ELSE 'iframe' END, payload FROM e WHERE page_id % 3 = 0
UNION ALL SELECT 'decoded_inline_component', 0, false, '', payload FROM e WHERE page_id % 3 = 0
UNION ALL SELECT CASE k WHEN 'page' THEN 'inline_script' ELSE 'iframe_script' END, CASE k WHEN 'page' THEN 70 ELSE 60 END, true, CASE k WHEN 'page' THEN 'inline_script' ELSE 'iframe' END, content FROM sc)"""
_INDEX = """
WITH l AS (SELECT DISTINCT 'http://list/' || l_suppkey AS url, 'http://art/' || l_linenumber AS href, CAST(day(l_shipdate) AS INTEGER) AS period FROM lineitem WHERE l_linenumber >= 4),
i AS (SELECT url, period, CASE WHEN count(DISTINCT href) = 1 THEN min(href) END AS href, CAST(count(DISTINCT href) AS INTEGER) AS candidates FROM l GROUP BY 1, 2)"""
_SOURCE_N = "CAST(regexp_extract(source, '(\\d+)', 1) AS INTEGER)"

ORACLES = {
    "joined_links": f"SELECT o_orderkey, {_expected('o_orderkey', [b for _, b in LINKS])} AS url FROM orders",
    "source_identities": f"SELECT o_orderkey, {_expected('o_orderkey', [b for _, b in IDENTITIES])} AS identity FROM orders",
    "display_names": f"SELECT o_orderkey, {_expected('o_orderkey', [b for _, b in NAMES])} AS name FROM orders",
    "container_cases": f"SELECT CAST(o_orderkey AS VARCHAR) AS url, {_expected('o_orderkey', [b for _, b, _ in BOXES])} AS text, {_expected('o_orderkey', [c for *_, c in BOXES])} AS problem FROM orders",
    "page_fingerprint": "SELECT page_id, sha256(html) AS fingerprint FROM pages",
    "page_host": "SELECT page_id, lower(regexp_extract(url, '^\\w+://([^/?#]*)', 1)) AS host, regexp_extract(url, '^(\\w+://[^/?#]*)', 1) AS origin, split_part(url, '#', 1) AS plain_url FROM pages",
    "page_slug": """
WITH x AS (SELECT page_id, trim(regexp_extract(url, '^\\w+://[^/?#]*([^?#]*)', 1), '/') AS path FROM pages)
SELECT page_id, left(trim(regexp_replace(regexp_replace(path, '\\.html?$', '', 'i'), '[^A-Za-z0-9]+', '_', 'g'), '_'), 64) AS slug, string_split(path, '/')[-1] AS identity FROM x""",
    "page_links": """
WITH x AS (SELECT url, regexp_extract_all(html, '<a\\b[^>]*?href=["'']([^"'']*)["''][^>]*>(.*?)</a\\s*>', 1, 'is') AS h, regexp_extract_all(html, '<a\\b[^>]*?href=["'']([^"'']*)["''][^>]*>(.*?)</a\\s*>', 2, 'is') AS l FROM pages),
y AS (SELECT url, unnest(h) AS h, unnest(l) AS l, CAST(generate_subscripts(h, 1) - 1 AS INTEGER) AS n FROM x)
SELECT url, n, regexp_extract(url, '^(\\w+://[^/?#]*)', 1) || h AS href, trim(regexp_replace(regexp_replace(l, '<[^>]+>', '', 'g'), '\\s+', ' ', 'g')) AS label FROM y WHERE trim(regexp_replace(l, '<[^>]+>', '', 'g')) <> ''""",
    "page_scripts": """
WITH x AS (SELECT page_id, regexp_extract_all(html, '<script\\b[^>]*>(.*?)</script\\s*>', 1, 'is') AS b FROM pages)
SELECT page_id, CAST(generate_subscripts(b, 1) - 1 AS INTEGER) AS n, trim(unnest(b)) AS body FROM x""",
    "visible_document": f"SELECT page_id, md5({_VISIBLE.format('html')}) AS content_md5 FROM pages",
    "page_documents": f"{_E} SELECT kind, CAST(priority AS INTEGER) AS priority, parseable, \"authorization\", count(*) AS n, CAST(sum(length(content)) AS BIGINT) AS chars FROM docs GROUP BY ALL",
    "decoded_payloads": f"{_W} SELECT page_id, payload FROM w WHERE page_id % 3 = 0",
    "child_region": f"""{_W}, m AS (SELECT page_id, html, list_min(list_filter([instr(html, '/' || (page_id + 1) || '/index.html'), instr(html, 'index.html')], lambda x: x > 0)) AS place FROM w)
SELECT page_id, CASE WHEN place IS NULL THEN '' WHEN place - 1 < length(html) / 2.0 THEN 'top' ELSE 'bottom' END AS region FROM m""",
    "container_scope": """
SELECT url, CASE WHEN len(regexp_extract_all(html, '<div class="ad">')) = 1 THEN replace(replace(replace(regexp_replace(regexp_extract(html, '<div class="ad">(.*?)</div>', 1, 's'), '<[^>]+>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&') END AS text,
       CASE WHEN NOT contains(html, '<div class="ad">') THEN 'missing' WHEN len(regexp_extract_all(html, '<div class="ad">')) > 1 THEN 'duplicate' END AS problem FROM pages""",
    "page_chain": """
WITH RECURSIVE l AS (SELECT 'p' || s_suppkey AS url, CASE WHEN s_suppkey % 17 = 0 THEN 2 ELSE 1 END AS ways, CASE WHEN s_suppkey % 17 <> 0 AND s_suppkey % 23 = 0 THEN 'p' || s_suppkey ELSE 'p' || (s_suppkey + 1) END AS next FROM supplier WHERE s_suppkey % 7 <> 3),
c AS (SELECT s_name AS site, 'p' || s_suppkey AS url, 1 AS page, ['p' || s_suppkey] AS seen FROM supplier WHERE s_suppkey % 5 = 0
      UNION ALL SELECT site, l.next, page + 1, list_append(seen, l.next) FROM c JOIN l USING (url) WHERE ways = 1 AND NOT list_contains(seen, l.next) AND page < 4)
SELECT site, url, page, CASE WHEN ways > 1 THEN 'conflict' WHEN list_contains(seen, next) THEN 'loop' WHEN next IS NOT NULL AND page = 4 THEN 'limit' END AS problem FROM c LEFT JOIN l USING (url)""",
    "period_link_index": f"{_INDEX} SELECT url, period, href, candidates FROM i",
    "follow_links": f"{_INDEX} SELECT i.url AS list_url, period, href AS url, r_name AS html FROM i JOIN region ON href = 'http://art/' || (r_regionkey + 3)",
    "parseable_documents": f"""{_E} SELECT left(sha256(content), 1) AS site, kind, count(*) AS n FROM docs WHERE parseable AND trim(content) <> ''
AND ("authorization" = '' OR CASE WHEN left(sha256(content), 1) < '8' THEN "authorization" IN ('inline_script', 'iframe') ELSE "authorization" = 'decoded_script' END) GROUP BY 1, 2""",
    "source_url_filter": f"SELECT source AS site, 'http://d/' || doc_id AS url FROM documents WHERE {_SOURCE_N} % 3 = 2 OR {_SOURCE_N} % 3 = 0 AND doc_id % 2 = 1",
    "source_url_problems": f"SELECT DISTINCT source AS site, 'no document fits the source pattern' AS reason FROM documents WHERE {_SOURCE_N} % 3 = 1 OR {_SOURCE_N} % 3 = 0 AND source NOT IN (SELECT source FROM documents WHERE doc_id % 2 = 1)",
    "split_contracts": "SELECT source AS site FROM documents GROUP BY 1 HAVING bool_or(contains(text, 'Released')) AND bool_or(contains(text, 'Apache')) AND NOT bool_or(contains(text, 'Released') AND contains(text, 'Apache'))",
}
