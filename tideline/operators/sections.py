"""Sections of pages by headings, anchors, ids or authors, composed of the segment operators.

All take ``docs(doc, content, keywords, count, region, window, ...)`` as ``candidate_rows`` does; whatever keeps a section
from being cut is a problem row, and no other part of the page is taken instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as t
from . import segments as g

HEADING_REACH = 600


def _judged(docs: DataFrame, section: Column, problem: Column) -> tuple[DataFrame, DataFrame]:
    """Documents cut to their section, and the problems of the others."""
    rows = docs.withColumns({"__problem": problem, "__section": section})
    good = rows.filter("__problem is null").withColumn("content", F.col("__section")).drop("__problem", "__section")
    return good, rows.filter("__problem is not null").select("doc", F.col("__problem").alias("problem"))


def _with_values(good: DataFrame, bad: DataFrame) -> DataFrame:
    """doc, period, value and problem of the sections and of what has none."""
    found = g.extract(good).select("doc", "period", "value", "problem")
    return found.unionByName(bad.select("doc", F.lit(None).cast("int").alias("period"), F.lit(None).cast("string").alias("value"), "problem"))


def _times(text: Column, part: Column) -> Column:
    """How often a part occurs: the text is longer by so many of them than without it."""
    return ((F.length(text) - F.length(F.replace(text, part, F.lit("")))) / F.length(part)).cast("int")


def header_keyword_section(docs: DataFrame) -> DataFrame:
    """Sections whose header - what stands between ``anchor`` and the first row - has a keyword; rows need none. The stop is
    optional."""
    scoped = g.scope_by_anchor(docs)
    cut = scoped.filter("problem is null").drop("problem", "offset")
    header = F.element_at(F.split("content", g.BOUNDARY), 1)
    plain = t.normalize_keyword(header, folded=False)
    good, bad = _judged(cut, F.col("content"), F.when(~F.exists("keywords", lambda k: F.contains(plain, k)), "keyword not in header"))
    rest = scoped.filter("problem is not null").select("doc", "problem")
    return _with_values(good.withColumn("keywords", F.array().cast("array<string>")), bad.unionByName(rest))


def unique_anchor_section(docs: DataFrame) -> DataFrame:
    """Sections from an ``anchor`` that occurs exactly once to a stop that must follow; every row needs a keyword."""
    times = _times(F.col("content"), F.col("anchor"))
    once, many = _judged(docs, F.col("content"), F.when(times == 0, "anchor not found").when(times > 1, "several anchors").when(F.coalesce("stop_anchor", F.lit("")) == "", "no stop configured"))
    scoped = g.scope_by_anchor(once)
    rest = scoped.filter("problem is not null").select("doc", "problem")
    return _with_values(scoped.filter("problem is null").drop("problem", "offset"), many.unionByName(rest))


def id_section(docs: DataFrame) -> DataFrame:
    """``docs(doc, html, from_id, to_id, ...)``: what stands between two element ids that each occur once, as text."""
    mark = lambda c: F.concat(F.lit('id="'), c, F.lit('"'))
    first, second = mark(F.col("from_id")), mark(F.col("to_id"))
    start, end = F.instr("html", first), F.instr("html", second)
    problem = F.when(_times(F.col("html"), first) != 1, "start id").when(_times(F.col("html"), second) != 1, "end id").when(end < start, "order")
    inner = F.substring("html", start, F.greatest(end - start, F.lit(0)))
    tail = F.regexp_replace(F.regexp_replace(inner, "^[^>]*>", ""), "<[^<>]*$", "")
    good, bad = _judged(docs.withColumn("content", F.lit("")), t.html_to_text(tail), problem)
    return _with_values(good.drop("html"), bad)


def heading_section(docs: DataFrame) -> DataFrame:
    """``docs(doc, content, heading_pattern, stop, ...)``: from the one line that fits the pattern to the stop."""
    lines = F.split("content", "\n")
    fits = F.transform(lines, lambda x: F.rlike(x, F.col("heading_pattern")))
    at = F.array_position(fits, True).cast("int")
    rest = F.array_join(F.slice(lines, at + 1, F.greatest(F.size(lines) - at, F.lit(0))), "\n")
    number = F.size(F.filter(fits, lambda x: x))
    problem = F.when(number == 0, "no heading").when(number > 1, "several headings").when(~F.contains(rest, F.col("stop")), "no stop")
    good, bad = _judged(docs, F.element_at(F.split(rest, F.concat(F.lit("\\Q"), "stop", F.lit("\\E")), 2), 1), problem)
    return _with_values(good, bad)


def article_history_window(docs: DataFrame) -> DataFrame:
    """``docs(doc, content, title, author, ...)``: from a title at most HEADING_REACH characters before the author on."""
    author = F.instr("content", F.col("author"))
    before = F.substring("content", F.lit(1), F.greatest(author - 1, F.lit(0)))
    title = author - F.instr(F.reverse(before), F.reverse("title")) - F.length("title") + 1
    found = F.instr(F.reverse(before), F.reverse("title")) > 0
    problem = F.when(author == 0, "no author").when(~found, "no title").when(author - title > HEADING_REACH, "title too far")
    good, bad = _judged(docs, F.substring("content", author, F.length("content")), problem)
    return _with_values(good, bad)


def anchor_suggestions(docs: DataFrame) -> DataFrame:
    """Parts of a document's ``site_name`` (all of it, or without its first or last character) that would do as anchors: with
    them the values are the same as without, and there are some: doc, anchor."""
    name = F.col("site_name")
    parts = F.array_distinct(F.filter(F.array(name, F.expr("substring(site_name, 2)"), F.expr("left(site_name, length(site_name) - 1)")), lambda x: F.length(x) >= 2))
    values = lambda rows: F.sort_array(F.collect_list(F.struct("period", "value")))
    whole = g.extract(docs).filter("value is not null").groupBy("doc").agg(values(None).alias("all"))
    tried = docs.withColumn("anchor", F.explode(parts)).withColumns({"stop_anchor": F.lit(None).cast("string"), "own": F.col("doc"), "doc": F.concat_ws("\u0001", F.col("doc").cast("string"), "anchor")})
    scoped = g.scope_by_anchor(tried).filter("problem is null").drop("problem", "offset")
    names = tried.select("doc", "own", "anchor")
    cut = g.extract(scoped).filter("value is not null").groupBy("doc").agg(values(None).alias("some")).join(names, "doc").drop("doc")
    return cut.join(whole, cut["own"] == whole["doc"]).filter(F.col("some") == F.col("all")).select("doc", "anchor")
