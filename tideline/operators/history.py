"""Rolling history of what each site published, with failures kept beside successes.

``history(site_name, site_url, period, state, value, reason)``: state is "success" (value set) or "failed" (reason set);
a site and period has one row. A round brings ``results`` (value set) and ``failures`` for requested periods.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SITE = ["site_name", "site_url"]
KEY = [*SITE, "period"]
COLUMNS = [*KEY, "state", "value", "reason"]
NO_REASON = "no reason given"


def expand_failures(failures: DataFrame, requested: list[int]) -> DataFrame:
    """A failure without a period counts for every requested one; a blank reason gets a standard one."""
    periods = F.when(F.col("period").isNotNull(), F.array("period")).otherwise(F.array(*[F.lit(p).cast("int") for p in requested]) if requested else F.array().cast("array<int>"))
    reason = F.when(F.trim("reason") == "", None).otherwise(F.col("reason"))
    return failures.select(*SITE, F.explode(periods).alias("period"), F.coalesce(reason, F.lit(NO_REASON)).alias("reason"))


def as_states(results: DataFrame, failures: DataFrame) -> DataFrame:
    """A round's results and (expanded) failures in the form of the history."""
    good = results.select(*KEY, F.lit("success").alias("state"), "value", F.lit(None).cast("string").alias("reason"))
    bad = failures.select(*KEY, F.lit("failed").alias("state"), F.lit(None).cast("string").alias("value"), "reason")
    return good.unionByName(bad)


def round_violations(results: DataFrame, failures: DataFrame, requested: list[int], registry: DataFrame | None = None) -> DataFrame:
    """Why a round must be refused as a whole: rows of site, period, violation; none if it may be merged."""
    states = as_states(results, failures)
    per_key = states.groupBy(*KEY).agg(
        F.count_distinct(F.when(F.col("state") == "success", F.col("value"))).alias("values"),
        F.count_distinct(F.when(F.col("state") == "failed", F.col("reason"))).alias("reasons"),
        F.bool_or((F.col("state") == "success") & (F.coalesce(F.trim("value"), F.lit("")) == "")).alias("blank"),
        F.count_distinct("state").alias("states"),
    )
    if registry is None:
        known = per_key.withColumn("enabled", F.lit(True))
    else:
        own = registry.select(*SITE, (~F.coalesce("disabled", F.lit(False))).alias("is_enabled"))
        known = per_key.join(own, SITE, "left").withColumn("enabled", F.coalesce("is_enabled", F.lit(False)))
    rules = F.array_compact(
        F.array(
            F.when(~F.col("period").isin(requested) if requested else F.lit(True), "period not requested"),
            F.when(~F.col("enabled"), "site not enabled"),
            F.when(F.col("blank"), "empty value"),
            F.when(F.col("values") > 1, "two values"),
            F.when(F.col("reasons") > 1, "two reasons"),
            F.when(F.col("states") > 1, "success and failure"),
        )
    )
    return known.select(*KEY, F.explode(rules).alias("violation"))


def merge_round(history: DataFrame, results: DataFrame, failures: DataFrame) -> DataFrame:
    """The history after a round: a new state replaces the old one of its site and period, the rest stays."""
    new = as_states(results, failures).groupBy(*KEY).agg(F.max(F.struct("state", "value", "reason")).alias("new"))
    old = history.select(*KEY, F.struct("state", "value", "reason").alias("old"))
    return old.join(new, KEY, "full").select(*KEY, F.coalesce("new", "old").alias("s")).select(*KEY, "s.state", "s.value", "s.reason")


def retain(history: DataFrame, touched: DataFrame, n: int = 10) -> DataFrame:
    """Sites that a round touched keep the n periods up to their latest one; other sites are left as they are."""
    marked = history.join(touched.select(*SITE).distinct().withColumn("touched", F.lit(True)), SITE, "left")
    top = F.max("period").over(Window.partitionBy(*SITE))
    return marked.withColumn("top", top).filter(F.col("touched").isNull() | (F.col("period") > F.col("top") - n)).select(*COLUMNS)


def update(history: DataFrame, results: DataFrame, failures: DataFrame, requested: list[int], registry: DataFrame | None = None, n: int = 10) -> DataFrame:
    """Expand, check, merge and retain. A round with any violation is refused; an empty one changes nothing."""
    expanded = expand_failures(failures, requested)
    bad = round_violations(results, expanded, requested, registry).limit(5).collect()
    if bad:
        raise ValueError(f"round refused: {[(r['site_name'], r['period'], r['violation']) for r in bad]}")
    touched = results.select(*SITE).unionByName(expanded.select(*SITE))
    return retain(merge_round(history, results, expanded), touched, n)


def contract_drift(stored: DataFrame, registry: DataFrame) -> DataFrame:
    """Sites whose stored contract hash (``contract``) isn't the registry's."""
    own = registry.select(*SITE, F.col("contract").alias("current"))
    return stored.join(own, SITE).filter(~F.col("contract").eqNullSafe(F.col("current"))).select(*SITE, "contract", "current")


def history_violations(history: DataFrame, registry: DataFrame | None = None, n: int = 10, base_period: int | None = None) -> DataFrame:
    """What is wrong with a stored history: rows of site, period (null for a whole site) and violation."""
    key_counts = Window.partitionBy(*KEY)
    top = F.max("period").over(Window.partitionBy(*SITE))
    rows = history.withColumns({"n_rows": F.count(F.lit(1)).over(key_counts), "n_states": F.size(F.collect_set("state").over(key_counts)), "top": top})
    rules = F.array_compact(
        F.array(
            F.when((F.col("state") == "failed") & F.col("value").isNotNull(), "failure with a value"),
            F.when((F.col("state") == "failed") & (F.coalesce(F.trim("reason"), F.lit("")) == ""), "failure without a reason"),
            F.when((F.col("state") == "success") & (F.coalesce(F.trim("value"), F.lit("")) == ""), "success without a value"),
            F.when(~F.coalesce(F.col("state").isin("success", "failed"), F.lit(False)), "unknown state"),
            F.when(F.col("n_states") > 1, "success and failure"),
            F.when((F.col("n_rows") > 1) & (F.col("n_states") == 1), "two rows"),
            F.when(F.col("period") <= F.col("top") - n, "outside the window"),
        )
    )
    found = rows.select(*KEY, F.explode(rules).alias("violation")).distinct()
    if base_period is not None:
        late = history.agg(F.max("period").alias("period")).filter(~F.col("period").eqNullSafe(F.lit(base_period)))
        found = found.unionByName(late.select(F.lit("").alias("site_name"), F.lit("").alias("site_url"), "period", F.lit("base period isn't the latest").alias("violation")))
    if registry is not None:
        enabled = registry.filter(~F.coalesce("disabled", F.lit(False)))
        absent = enabled.join(history.select(*SITE).distinct(), SITE, "left_anti")
        found = found.unionByName(absent.select(*SITE, F.lit(None).cast("int").alias("period"), F.lit("enabled site is missing").alias("violation")))
    return found


def enabled_only(history: DataFrame, registry: DataFrame) -> DataFrame:
    """The rows of sites that are enabled under just this name and URL."""
    return history.join(registry.filter(~F.coalesce("disabled", F.lit(False))).select(*SITE), SITE, "left_semi")


def dropped_sites(history: DataFrame, registry: DataFrame) -> DataFrame:
    """Sites that ``enabled_only`` drops: "old address" if an enabled site has the name, else "no target"."""
    enabled = registry.filter(~F.coalesce("disabled", F.lit(False)))
    gone = history.select(*SITE).distinct().join(enabled.select(*SITE), SITE, "left_anti")
    names = enabled.select("site_name").distinct().withColumn("moved", F.lit(True))
    return gone.join(names, "site_name", "left").select(*SITE, F.when(F.col("moved"), "old address").otherwise("no target").alias("reason"))


def carry_site_attributes(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """``(site, id, ord)`` of both: known sites keep id and place, new ones come after them with unique ids.

    A new id that is taken gets the suffix _2, _3, ... in order of the new sites.
    """
    new = incoming.join(stored.select(*SITE), SITE, "left_anti")
    taken = stored.groupBy("id").agg(F.count(F.lit(1)).alias("before"))
    nth = F.row_number().over(Window.partitionBy("id").orderBy("ord", *SITE))
    last = stored.agg(F.coalesce(F.max("ord"), F.lit(0)).alias("last"))
    numbered = new.withColumn("nth", nth).join(taken, "id", "left").withColumn("copy", F.col("nth") + F.coalesce("before", F.lit(0)))
    # A single row is attached, so this join stays as large as its left side.
    placed = numbered.join(F.broadcast(last), F.lit(True))
    fresh = placed.select(*SITE, F.when(F.col("copy") > 1, F.concat("id", F.lit("_"), F.col("copy").cast("string"))).otherwise(F.col("id")).alias("id"), (F.col("last") + 1 + F.col("ord")).cast("int").alias("ord"))
    return stored.select(*SITE, "id", F.col("ord").cast("int").alias("ord")).unionByName(fresh)


def registry_merge(full: DataFrame, active: DataFrame) -> DataFrame:
    """``full(ord, disabled, raw)`` with the raw entries of its active rows replaced, in order, by ``active(ord, raw)``.

    Disabled rows keep their place. An active row without a replacement, or the other way round, fails the job.
    """
    nth = F.row_number().over(Window.partitionBy("lane").orderBy("ord"))
    mine = full.filter("not disabled").withColumn("lane", F.lit(0)).withColumn("nth", nth).select("ord", "nth")
    theirs = active.withColumn("lane", F.lit(0)).withColumn("nth", nth).select("nth", F.col("raw").alias("new"))
    paired = mine.join(theirs, "nth", "full").select(F.when(F.col("ord").isNull() | F.col("new").isNull(), F.raise_error(F.lit("numbers of active entries differ")).cast("int")).otherwise(F.col("ord")).alias("ord"), "new")
    return full.join(paired, "ord", "left").select("ord", "disabled", F.coalesce("new", "raw").alias("raw"))


def size_violations(history: DataFrame, registry: DataFrame) -> DataFrame:
    """Stored values whose number of tokens isn't the site's ``count``, nor the count approved for that period.

    ``exceptions`` of the registry is a map of period to (approved, count).
    """
    sized = history.filter("state = 'success'").join(registry.select(*SITE, "count", "exceptions"), SITE)
    exception = F.try_element_at("exceptions", F.col("period").cast("string"))
    wanted: Column = F.when(exception["approved"], exception["count"]).otherwise(F.col("count"))
    tokens = F.size(F.split(F.trim("value"), "[,.\\s]+"))
    return sized.withColumns({"wanted": wanted, "tokens": tokens}).filter("tokens <> wanted").select(*KEY, "wanted", "tokens")
