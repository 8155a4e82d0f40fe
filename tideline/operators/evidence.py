"""Where accepted values come from: offsets carried from the page to the value, and a check that starts from them alone.

A document's place (its source, fingerprint, and where its section begins and ends) is made once, when the page is cut to
its section, and rides along through segments, windows and the choice of a candidate. Nothing is parsed twice to find it.
The check, in turn, trusts no extraction: it reads the page at the stored offsets and reads the value again from there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as t
from . import segments as g

#: What is wrong with evidence, in the order in which it is looked for.
VIOLATIONS = ["incomplete", "altered", "another URL", "out of range", "another section", "another period", "another value", "not reproduced"]


def located(docs: DataFrame) -> DataFrame:
    """``docs(doc, kind, url, content, fingerprint, anchor, stop_anchor, ...)`` cut to their sections, with ``place``; see
    ``scope_by_anchor`` for offset and problem. Offsets count characters of the whole content from 0, ends are exclusive."""
    scoped = g.scope_by_anchor(docs)
    place = F.struct(
        F.col("kind").alias("source_kind"),
        F.col("url").alias("source_url"),
        "fingerprint",
        F.coalesce("anchor", F.lit("")).alias("anchor"),
        F.col("offset").alias("section_start"),
        (F.col("offset") + F.length("content")).alias("section_end"),
    )
    return scoped.withColumn("place", place)


def extract_located(docs: DataFrame, strict: bool = True, prefer_pending: bool = False, allow_repeats: bool = False) -> DataFrame:
    """Values of all periods of ``docs`` with their evidence: doc, period, value, problem, evidence (place and
    candidate_start). A document without its section is one row with null period, value and evidence."""
    scoped = located(docs)
    found = g.extract(scoped.filter("problem is null").drop("problem"), strict, prefer_pending, allow_repeats)
    evidence = F.struct("place.*", (F.col("place.section_start") + F.col("start")).alias("candidate_start"))
    none = scoped.filter("problem is not null").select("doc", F.lit(None).cast("int").alias("period"), F.lit(None).cast("string").alias("value"), "problem", F.lit(None).alias("evidence"))
    return found.select("doc", "period", "value", "problem", F.when(F.col("value").isNotNull(), evidence).alias("evidence")).unionByName(none)


def evidence_violations(found: DataFrame, docs: DataFrame) -> DataFrame:
    """The first of ``VIOLATIONS`` of every value of ``found(doc, period, value, evidence)`` that has one: doc, period,
    value, violation.

    ``docs`` are those of ``extract_located`` with ``source_url_pattern`` (matched anywhere, whatever the case; null or
    empty: any URL). A value counts as reproduced if extraction from the stored section, cut out of the page by its
    offsets, chooses it again for its period at the stored start.
    """
    e = lambda name: F.col(f"evidence.{name}")
    by_doc = found.filter("value is not null").groupBy("doc").agg(F.collect_list(F.struct("period", "value", "evidence")).alias("__found"))
    # A page meets all its values in one row and is cut to its section there; rows of values that carry it are never sorted.
    met = located(by_doc.join(docs, "doc", "left").withColumn("__whole", F.col("content")))
    pages = met.select("doc", "__found", F.col("content").alias("section"), F.col("__whole").alias("content"), F.sha2("__whole", 256).alias("own_hash"), "source_url_pattern", "keywords", "count", "region", "window", F.struct("place.section_start", "place.section_end").alias("own_section"))
    each = pages.select("doc", "content", "own_hash", "source_url_pattern", "count", "own_section", F.explode("__found").alias("f")).select("*", "f.period", "f.value", "f.evidence")
    piece = F.substring("content", e("candidate_start") + 1, e("section_end") - e("candidate_start"))
    read = each.withColumn("segment", F.when(e("section_end") > e("candidate_start"), F.split(piece, g.BOUNDARY, 2)[0]))
    values = F.transform(g.groups_for_count(g.owned_text(F.col("segment")), F.col("count")), lambda x: F.array_join(x, ","))
    pattern = F.coalesce(F.nullif("source_url_pattern", F.lit("")), F.lit(""))
    names = ("source_kind", "source_url", "fingerprint", "section_start", "section_end", "candidate_start")
    blank: Column = F.lit(False)
    for name in names:
        blank = blank | e(name).isNull() | (e(name).cast("string") == "")
    checks = [
        blank,
        ~F.col("own_hash").eqNullSafe(e("fingerprint")),
        ~F.rlike(e("source_url"), F.concat(F.lit("(?i)"), pattern)),
        (e("section_start") < 0) | (e("section_end") <= e("section_start")) | (e("candidate_start") < e("section_start")) | (e("candidate_start") >= e("section_end")) | (e("section_end") > F.length("content")),
        ~F.struct(e("section_start"), e("section_end")).eqNullSafe(F.col("own_section")),
        ~t.try_period(F.regexp_extract("segment", g.HEAD, 1)).eqNullSafe(F.col("period")),
        ~F.coalesce(F.array_contains(values, F.col("value")), F.lit(False)),
    ]
    first = F.lit(None).cast("string")
    for check, name in zip(reversed(checks), reversed(VIOLATIONS[:-1]), strict=True):
        first = F.when(check, name).otherwise(first)
    judged = read.withColumn("violation", first).select("doc", "period", "value", "violation", (e("candidate_start") - e("section_start")).alias("at"))
    # Sections that a value rightly names are extracted again, each once, whatever the number of values that name it.
    named = g._let(F.col("own_section"), lambda own: F.exists("__found", lambda x: F.struct(x["evidence"]["section_start"], x["evidence"]["section_end"]).eqNullSafe(own)))
    # Not a filter, which would be pushed below the cutting of the page and do it again for each value.
    sections = pages.select("doc", F.when(named, F.col("section")).alias("content"), "keywords", "count", "region", "window")
    again = g.extract(sections).select("doc", "period", F.col("value").alias("again"), "start")
    lost = F.when(~F.col("again").eqNullSafe(F.col("value")) | ~F.col("start").eqNullSafe(F.col("at")), VIOLATIONS[-1])
    return judged.join(again, ["doc", "period"], "left").select("doc", "period", "value", F.coalesce("violation", lost).alias("violation")).filter("violation is not null")
