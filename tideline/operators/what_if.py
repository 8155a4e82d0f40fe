"""What other contracts would have found: old and new contracts as variants of one extraction pass, with nothing written."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import segments as g

FIELDS = ["keywords", "count", "region", "window"]


def contract_variants(registry: DataFrame, overrides: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``registry(site, keywords, count, region, window)`` and ``overrides`` of the same columns for some sites (null: as it
    was) -> variants (site, variant "before" or "after", the fields) of the sites named, and violations (site, violation).

    A name that the registry lacks is a violation, and so is a new contract whose numbers aren't positive, whose region
    isn't top or bottom, or that has two overrides; such a site has no variant "after".
    """
    named = overrides.groupBy("site").agg(F.count(F.lit(1)).alias("n"), F.first(F.struct(*FIELDS)).alias("new"))
    merged = F.when(F.col("n") == 1, F.struct(*[F.coalesce(f"new.{f}", f).alias(f) for f in FIELDS]))
    joined = registry.join(named.hint("shuffle_hash"), "site").withColumn("after", merged)
    checks = F.array_compact(
        F.array(
            F.when(F.col("after.count") <= 0, "count is not positive"),
            F.when(F.col("after.window") <= 0, "window is not positive"),
            F.when(F.col("after").isNotNull() & ~F.coalesce(F.col("after.region").isin("top", "bottom"), F.lit(False)), "region"),
        )
    )
    judged = joined.withColumn("checks", checks)
    variant = lambda name, row: F.struct(F.lit(name).alias("variant"), *[row(f).alias(f) for f in FIELDS])
    before, after = variant("before", F.col), variant("after", lambda f: F.col(f"after.{f}"))
    both = F.when(F.col("after").isNotNull() & (F.size("checks") == 0), F.array(before, after)).otherwise(F.array(before))
    variants = judged.select("site", F.explode(both).alias("v")).select("site", "v.*")
    twice = named.filter("n > 1").select("site", F.lit("two overrides").alias("violation"))
    unknown = named.join(registry.select("site"), "site", "left_anti").select("site", F.lit("unknown site").alias("violation"))
    violations = judged.select("site", F.explode("checks").alias("violation")).unionByName(unknown).unionByName(twice)
    return variants, violations


def what_if_extraction(docs: DataFrame, registry: DataFrame, overrides: DataFrame, requested: list[int]) -> tuple[DataFrame, DataFrame]:
    """``docs(site, doc, content)`` read once with both contracts of every site named: changes (site, doc, period, before,
    after, change) for the requested periods that either finds, and ``contract_variants``' violations.

    change is "found", "lost", "changed" or "same". Periods that neither finds are missing under both; see ``coverage``.
    """
    variants, violations = contract_variants(registry, overrides)
    # Both variants stand on one row of a document, so its text is read once and split into two only for the windows.
    by_site = variants.groupBy("site").agg(F.collect_list(F.struct("variant", *FIELDS)).alias("variants")).filter(F.exists("variants", lambda v: v["variant"] == "after"))
    # Contracts are looked up in a map: texts are neither sorted nor kept to meet them, however many sites there are.
    rows = docs.join(by_site.hint("shuffle_hash"), "site").select("site", "doc", "content", F.explode("variants").alias("v"))
    keyed = rows.select(F.struct("site", F.col("doc").alias("page"), "v.variant").alias("doc"), "content", *[F.col(f"v.{f}").alias(f) for f in FIELDS])
    found = g.extract(keyed).filter("value is not null").filter(F.col("period").isin(requested))
    each = found.groupBy(F.col("doc.site").alias("site"), F.col("doc.page").alias("doc"), "period").agg(F.max(F.when(F.col("doc.variant") == "before", F.col("value"))).alias("before"), F.max(F.when(F.col("doc.variant") == "after", F.col("value"))).alias("after"))
    change = F.when(F.col("before").isNull(), "found").when(F.col("after").isNull(), "lost").when(F.col("before") != F.col("after"), "changed").otherwise("same")
    return each.withColumn("change", change), violations


def coverage(changes: DataFrame, requested: list[int]) -> DataFrame:
    """Per site and document: how many requested periods are found and missing before and after."""
    n = len(set(requested))
    counts = changes.groupBy("site", "doc").agg(F.count("before").cast("int").alias("found_before"), F.count("after").cast("int").alias("found_after"))
    return counts.select("*", (F.lit(n) - F.col("found_before")).alias("missing_before"), (F.lit(n) - F.col("found_after")).alias("missing_after"))
