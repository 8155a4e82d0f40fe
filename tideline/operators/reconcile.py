"""Reconciliation of what several documents, runs or rounds say, with everything in doubt kept as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import text as t

SITE = ["site_name", "site_url"]
# What marks a document's error as one that fails its site.
HARD_MARKERS = ["候选不唯一", "候选冲突", "号码有重复", "跨周期候选", "同时存在数字期号"]


def cross_document_conflicts(found: DataFrame) -> DataFrame:
    """``found(site, doc, period, value)``: periods for which a site's documents give different values, whatever their
    priority: site, period, values (how many), preview (the smallest and the largest)."""
    each = found.groupBy("site", "period", "value").agg(F.count(F.lit(1)).alias("docs"))
    return each.groupBy("site", "period").agg(F.count(F.lit(1)).alias("values"), F.concat_ws(" | ", F.min("value"), F.max("value")).alias("preview")).filter("values > 1")


def choose_documents(found: DataFrame, docs: DataFrame) -> DataFrame:
    """The document of each site that gives most periods; then higher priority, then the earlier one (``ord``)."""
    sizes = found.groupBy("site", "doc").agg(F.count_distinct("period").alias("n"))
    ranked = sizes.join(docs.select("site", "doc", "priority", "ord"), ["site", "doc"])
    best = F.max_by(F.struct("doc", "n", "priority"), F.struct("n", "priority", (-F.col("ord")).alias("o")))
    return ranked.groupBy("site").agg(best.alias("b")).select("site", "b.doc", "b.n", "b.priority")


def site_errors(errors: DataFrame) -> DataFrame:
    """``errors(site, doc, reason)``: a site fails if one of its documents' errors is a hard one; others are skipped.

    The reason is that of the first hard error: of the highest ``priority``, then the smallest ``ord``, where ``errors``
    has them, then the smallest text."""
    place = [(-F.col("priority")).alias("p")] * ("priority" in errors.columns) + ["ord"] * ("ord" in errors.columns)
    hard = F.lit(False)
    for mark in HARD_MARKERS:
        hard = hard | F.contains("reason", F.lit(mark))
    return errors.withColumn("hard", hard).groupBy("site").agg(F.bool_or("hard").alias("failed"), F.count(F.lit(1)).alias("errors"), F.min(F.when(F.col("hard"), F.struct(*place, "reason")))["reason"].alias("reason"))


def result_violations(results: DataFrame, registry: DataFrame, requested: list[int]) -> DataFrame:
    """What is wrong with ``results(site, period, numbers)``: site, period, violation.

    ``registry(site, count, allow_repeats, exceptions)`` says how many numbers a site has; ``exceptions`` maps a period to
    an approved other count. Periods that a site lacks and periods with two values are violations too.
    """
    rules = registry.select("site", "count", "allow_repeats", "exceptions")
    rows = results.join(rules, "site")
    exception = F.try_element_at("exceptions", F.col("period").cast("string"))
    wanted = F.when(exception["approved"], exception["count"]).otherwise(F.col("count"))
    checks = F.array_compact(
        F.array(
            F.when(~F.col("period").isin(requested), "period not requested"),
            F.when(~F.forall("numbers", lambda x: (F.length(x) == 2) & t.valid_number(x)), "not a number"),
            F.when(F.size("numbers") != wanted, "wrong size"),
            F.when(~F.col("allow_repeats") & t.has_repeats(F.col("numbers")), "repeats"),
        )
    )
    bad = rows.select("site", "period", F.explode(checks).alias("violation")).distinct()
    twice = results.groupBy("site", "period").agg(F.count_distinct("numbers").alias("n")).filter("n > 1").select("site", "period", F.lit("two values").alias("violation"))
    wanted_rows = registry.select("site", F.explode(F.array(*[F.lit(p).cast("int") for p in sorted(set(requested))])).alias("period"))
    missing = wanted_rows.join(results.select("site", "period").distinct(), ["site", "period"], "left_anti").select("site", "period", F.lit("missing").alias("violation"))
    return bad.unionByName(twice).unionByName(missing)


def valid_results(results: DataFrame, violations: DataFrame) -> DataFrame:
    """All results of sites without any violation: a site counts as a whole or not at all."""
    return results.join(violations.select("site").distinct(), "site", "left_anti")


def identity_violations(results: DataFrame, registry: DataFrame) -> DataFrame:
    """``results(site, name, url)`` whose name or URL isn't the registry's."""
    own = registry.select("site", F.col("name").alias("own_name"), F.col("url").alias("own_url"))
    return results.join(own, "site").filter(~F.col("name").eqNullSafe(F.col("own_name")) | ~F.col("url").eqNullSafe(F.col("own_url"))).select("site", "name", "url", "own_name", "own_url")


def with_evidence(selected: DataFrame, docs: DataFrame) -> DataFrame:
    """``selected(doc, period, value, start)`` with where it was found: fingerprint, candidate_start and the piece there.

    Offsets come from extraction itself; nothing is parsed twice. ``docs(doc, kind, url, content, fingerprint)``.
    """
    own = docs.select("doc", "kind", "url", "fingerprint", "content")
    piece = F.substring("content", F.col("start") + 1, F.lit(80))
    return selected.join(own, "doc").select("doc", "period", "value", F.col("kind").alias("source_kind"), F.col("url").alias("source_url"), "fingerprint", F.col("start").alias("candidate_start"), piece.alias("piece"), (F.sha2("content", 256) == F.col("fingerprint")).alias("intact"))


def evidence_violations(evidence: DataFrame) -> DataFrame:
    """Evidence that is incomplete, altered, or doesn't show its period and first number at its place."""
    label = t.try_period(F.regexp_extract("piece", r"^0?(\d{1,3})\s*[期棋]", 1))
    checks = F.array_compact(
        F.array(
            F.when(F.col("candidate_start").isNull() | F.col("fingerprint").isNull(), "incomplete"),
            F.when(~F.col("intact"), "altered"),
            F.when(~label.eqNullSafe(F.col("period")), "another period"),
            F.when(~F.contains("piece", F.substring_index("value", ",", 1)), "another value"),
        )
    )
    return evidence.select("doc", "period", F.explode(checks).alias("violation"))


def reconcile_histories(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two ways of getting a site's ``(site, periods)``: equal, or one the other's subset in the same order - then the
    longer counts; else a conflict with null periods."""
    both = a.select("site", F.col("periods").alias("a")).join(b.select("site", F.col("periods").alias("b")), "site", "full")
    within = lambda x, y: (F.filter(y, lambda p: F.array_contains(x, p)) == x) & (F.size(F.array_except(x, y)) == 0)
    taken = F.when(F.col("a").isNull(), F.col("b")).when(F.col("b").isNull(), F.col("a")).when(within(F.col("a"), F.col("b")), F.col("b")).when(within(F.col("b"), F.col("a")), F.col("a"))
    return both.withColumn("periods", taken).select("site", "periods", F.col("periods").isNull().alias("conflict"))


def dedupe_results(results: DataFrame) -> DataFrame:
    """Each (url, name, period, numbers) once: the row with the smallest seq."""
    return results.groupBy("url", "name", "period", "numbers").agg(F.min("seq").alias("seq"))


def failure_summary(failures: DataFrame) -> DataFrame:
    return failures.groupBy(t.failure_category(F.col("reason")).alias("category")).agg(F.count(F.lit(1)).alias("failures"))


def retry_scope(registry: DataFrame, results: DataFrame, failures: DataFrame) -> DataFrame:
    """Sites without a result whose failure may pass."""
    passing = failures.filter(t.is_transient(F.col("reason"))).select(*SITE).distinct()
    return registry.select(*SITE).join(passing, SITE, "left_semi").join(results.select(*SITE), SITE, "left_anti")


def retry_merge(states: DataFrame) -> DataFrame:
    """``states(site_name, site_url, round, ok, value, reason)``: a success stays, else the last round's reason counts."""
    last = F.max_by(F.struct("ok", "value", "reason", "round"), F.struct("ok", "round"))
    return states.groupBy(*SITE).agg(last.alias("s")).select(*SITE, "s.ok", "s.value", "s.reason", "s.round")


def match_failed_blocks(blocks: DataFrame, registry: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``blocks(block, name, url, region)`` matched to the one enabled site of that name, URL and, if given, region; and
    the blocks that match none or several."""
    own = registry.filter(~F.coalesce("disabled", F.lit(False))).select(F.col("site_name").alias("name"), F.col("site_url").alias("url"), F.col("region").alias("own_region"))
    met = blocks.join(own, ["name", "url"]).filter(F.col("region").isNull() | (F.col("region") == F.col("own_region")))
    one = met.groupBy("block").agg(F.count(F.lit(1)).alias("n"), F.max("name").alias("name"), F.max("url").alias("url")).filter("n = 1").drop("n")
    return one, blocks.join(one, "block", "left_anti")


def success_rate_gate(states: DataFrame, percent: int = 80) -> DataFrame:
    """One row: total, succeeded, and whether strictly more than ``percent`` of the sites succeeded."""
    counts = states.agg(F.count(F.lit(1)).alias("total"), F.count_if("ok").alias("succeeded"))
    return counts.withColumn("open", F.col("succeeded") * 100 > F.col("total") * percent)


def progress(states: DataFrame, name: str | Observation = "progress") -> DataFrame:
    """``states(ok)`` with counters of what passes, to be read from an observation of that name."""
    return states.observe(name, F.count(F.lit(1)).alias("done"), F.count_if("ok").alias("succeeded"), F.count_if(~F.col("ok")).alias("failed"))


def rendered_consensus(values: DataFrame) -> DataFrame:
    """``values(site, doc, period, value)`` of rendered documents: sites whose documents' value maps differ conflict."""
    maps = values.groupBy("site", "doc").agg(F.to_json(F.sort_array(F.collect_set(F.struct("period", "value")))).alias("m"))
    return maps.groupBy("site").agg(F.count_distinct("m").alias("maps"), F.count(F.lit(1)).alias("docs")).withColumn("conflict", F.col("maps") > 1)


def what_if(registry: DataFrame, overrides: DataFrame, fields: list[str]) -> tuple[DataFrame, DataFrame]:
    """The registry with ``fields`` of named sites replaced where an override isn't null, and the names it doesn't have."""
    new = overrides.select("site_name", *[F.col(f).alias(f"__{f}") for f in fields])
    keep: list[Column] = [F.coalesce(f"__{c}", F.col(c)).alias(c) if c in fields else F.col(c) for c in registry.columns]
    return registry.join(new, "site_name", "left").select(*keep), overrides.select("site_name").join(registry.select("site_name"), "site_name", "left_anti")
