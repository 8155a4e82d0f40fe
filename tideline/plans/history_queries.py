"""Queries of history maintenance, with their SQL: days before 20 are the history, later days a round."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import history as h
from ..streaming import keyed, rounds
from .views import day_records, registry, shared_path, sql, table

SPLIT = 20
ROUND = [20, 21, 22, 23, 24, 25, 26, 27, 28, 29, 30, 31]


def states(spark: SparkSession, sf: str) -> DataFrame:
    """Day records as states: an error is a failure."""
    bad = F.col("value") == "error"
    none = F.lit(None).cast("string")
    return day_records(spark, sf).select(*h.KEY, F.when(bad, "failed").otherwise("success").alias("state"), F.when(bad, none).otherwise(F.col("value")).alias("value"), F.when(bad, "page error").otherwise(none).alias("reason"))


def _history(spark: SparkSession, sf: str) -> DataFrame:
    return states(spark, sf).filter(F.col("period") < SPLIT)


def _round(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Every third site's days from 18 on: some replace what the history has."""
    new = states(spark, sf).filter((F.col("period") >= SPLIT - 2) & (F.crc32("site_name") % 3 == 0))
    flipped = new.withColumn("value", F.when((F.col("period") < SPLIT) & (F.col("state") == "success"), F.concat(F.lit("new "), "value")).otherwise(F.col("value")))
    return flipped.filter("state = 'success'").select(*h.KEY, "value"), flipped.filter("state = 'failed'").select(*h.KEY, "reason")


def _merged(spark: SparkSession, sf: str) -> DataFrame:
    return h.merge_round(_history(spark, sf), *_round(spark, sf))


def _updated(spark: SparkSession, sf: str) -> DataFrame:
    good, bad = _round(spark, sf)
    return h.update(_history(spark, sf), good, bad, [SPLIT - 2, SPLIT - 1, *ROUND])


def _streamed(spark: SparkSession, sf: str) -> DataFrame:
    """The same history and round as ``merge_round`` with retention, as a stream of files."""
    at = shared_path(spark)
    _history(spark, sf).write.parquet(f"{at}/history/version=-1")
    h.as_states(*_round(spark, sf)).coalesce(2).write.parquet(f"{at}/rounds")
    stream = spark.readStream.schema(rounds.SCHEMA).parquet(f"{at}/rounds")
    rounds.start_updates(stream, f"{at}/history", f"{at}/checkpoint").awaitTermination()
    return rounds.latest_history(spark, f"{at}/history")


def _keyed(spark: SparkSession, sf: str) -> str:
    """The same history and round, the history as the state of a stream: the folder of its changes and checkpoint."""
    at = shared_path(spark)
    h.as_states(*_round(spark, sf)).coalesce(2).write.parquet(f"{at}/rounds")
    stream = spark.readStream.schema(rounds.SCHEMA).parquet(f"{at}/rounds")
    changes = keyed.site_changes(stream, _history(spark, sf), requested=[SPLIT - 2, SPLIT - 1, *ROUND])
    keyed.start_site_updates(changes, f"{at}/changes", f"{at}/checkpoint").awaitTermination()
    return at


def _failures(spark: SparkSession, sf: str) -> DataFrame:
    rows = states(spark, sf).filter("state = 'failed' and period <= 3")
    return rows.select("site_name", "site_url", F.when(F.col("period") == 3, None).otherwise(F.col("period")).cast("int").alias("period"), F.when(F.col("period") == 2, "").otherwise(F.col("reason")).alias("reason"))


def _broken_round(spark: SparkSession, sf: str) -> DataFrame:
    raw = states(spark, sf).filter("period <= 4")
    good = raw.filter("state = 'success'").select(*h.KEY, "value")
    doubled = good.unionByName(good.filter("period = 2").withColumn("value", F.lit("other")))
    bad = raw.filter("state = 'failed'").select(*h.KEY, "reason").unionByName(good.filter("period = 1 and value = 'click'").select(*h.KEY, F.lit("lost").alias("reason")))
    return h.round_violations(doubled, bad, [1, 2, 3], registry(spark, sf))


def _contracts(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, sf, "supplier").select(F.col("s_name").alias("site_name"), F.concat(F.lit("http://s/"), F.col("s_suppkey").cast("string")).alias("site_url"), "s_suppkey", "s_nationkey")
    stored = rows.withColumn("contract", F.sha2(F.concat_ws("|", "site_name", "s_nationkey"), 256))
    current = rows.withColumn("contract", F.sha2(F.concat_ws("|", "site_name", F.when(F.col("s_suppkey") % 4 == 0, F.col("s_nationkey") + 1).otherwise(F.col("s_nationkey"))), 256))
    return stored, current


def _carried(spark: SparkSession, sf: str) -> DataFrame:
    reg = registry(spark, sf).withColumn("id", F.concat(F.lit("s"), (F.col("ord") % 20).cast("string")))
    return h.carry_site_attributes(reg.filter("ord < 40 and ord >= 20"), reg.filter("ord >= 30 and ord < 60"))


def _merged_registry(spark: SparkSession, sf: str) -> DataFrame:
    full = registry(spark, sf).select("ord", "disabled", F.concat(F.lit("old "), "site_name").alias("raw"))
    active = full.filter("not disabled").select("ord", F.concat(F.lit("new "), "raw").alias("raw"))
    return h.registry_merge(full, active)


def _sizes(spark: SparkSession, sf: str) -> DataFrame:
    from .views import day_list_records

    rows = day_list_records(spark, sf).select(*h.KEY, F.lit("success").alias("state"), "value", F.lit(None).cast("string").alias("reason"))
    exceptions = F.create_map(F.lit("5"), F.struct(F.lit(True).alias("approved"), F.lit(2).alias("count")), F.lit("6"), F.struct(F.lit(False).alias("approved"), F.lit(2).alias("count")))
    return h.size_violations(rows, registry(spark, sf).withColumns({"count": F.lit(1), "exceptions": exceptions}))


QUERIES = {
    "expand_failures": lambda s, p: h.expand_failures(_failures(s, p), [1, 2, 3]),
    "merge_round": _merged,
    "retain_last_10": lambda s, p: h.retain(_history(s, p), _history(s, p)),
    "update_history": _updated,
    "merge_round_stream": _streamed,
    "site_history_stream": lambda s, p: keyed.site_history(s, f"{_keyed(s, p)}/checkpoint"),
    "site_changes_stream": lambda s, p: s.read.parquet(f"{_keyed(s, p)}/changes").select(*h.COLUMNS),
    "round_violations": _broken_round,
    "contract_drift": lambda s, p: h.contract_drift(*_contracts(s, p)),
    "history_violations": lambda s, p: h.history_violations(states(s, p).unionByName(states(s, p).filter("period = 30 and state = 'success'").withColumn("value", F.lit("x"))), registry(s, p), 10),
    "enabled_only": lambda s, p: h.enabled_only(_history(s, p), registry(s, p)),
    "dropped_sites": lambda s, p: h.dropped_sites(_history(s, p).withColumn("site_url", F.when(F.col("site_name").endswith("3"), F.concat("site_url", F.lit("/old"))).otherwise(F.col("site_url"))), registry(s, p)),
    "carry_site_attributes": _carried,
    "registry_merge": _merged_registry,
    "size_violations": _sizes,
}

_S = """
x AS (SELECT site_name, site_url, period, CASE WHEN value = 'error' THEN 'failed' ELSE 'success' END AS state, nullif(value, 'error') AS value, CASE WHEN value = 'error' THEN 'page error' END AS reason FROM r1)
"""
_M = f"""{_S},
n AS (SELECT site_name, site_url, period, state, CASE WHEN period < 20 AND state = 'success' THEN 'new ' || value ELSE value END AS value, reason FROM x WHERE period >= 18 AND ('x' || site_name) IN (SELECT 'x' || site_name FROM crc)),
m AS (SELECT * FROM n UNION ALL SELECT * FROM x WHERE period < 20 AND (site_name, period) NOT IN (SELECT (site_name, period) FROM n))
"""


def _crc_sites() -> str:
    """DuckDB has no crc32, so the sites of the round are listed by rule here."""
    import zlib

    names = ", ".join(f"('site{i}')" for i in range(20_000) if zlib.crc32(f"site{i}".encode()) % 3 == 0)
    return f"x0 AS (SELECT 1), crc(site_name) AS (VALUES {names})"


def _with_crc(text: str) -> str:
    return sql(f"{_M} {text}").replace("\nx AS", f"\n{_crc_sites()},\nx AS", 1)


_KEPT = "SELECT site_name, site_url, period, state, value, reason FROM m QUALIFY site_name NOT IN (SELECT site_name FROM n) OR period > max(period) OVER (PARTITION BY site_name, site_url) - 10"

ORACLES = {
    "expand_failures": sql(f"""{_S}
SELECT site_name, site_url, CAST(unnest(CASE WHEN period = 3 THEN [1, 2, 3] ELSE [period] END) AS INTEGER) AS period, CASE WHEN period = 2 THEN 'no reason given' ELSE reason END AS reason FROM x WHERE state = 'failed' AND period <= 3"""),
    "merge_round": _with_crc("SELECT * FROM m"),
    "retain_last_10": sql(f"{_S} SELECT * FROM x WHERE period < 20 QUALIFY period > max(period) OVER (PARTITION BY site_name, site_url) - 10"),
    "update_history": _with_crc(_KEPT),
    "merge_round_stream": _with_crc(_KEPT),
    "site_history_stream": _with_crc(_KEPT),
    "site_changes_stream": _with_crc(f"SELECT * FROM ({_KEPT}) WHERE site_name IN (SELECT site_name FROM n)"),
    "round_violations": sql(f"""{_S},
g AS (SELECT site_name, site_url, period, value FROM x WHERE state = 'success' AND period <= 4), g2 AS (SELECT * FROM g UNION ALL SELECT site_name, site_url, period, 'other' FROM g WHERE period = 2),
b AS (SELECT site_name, site_url, period, reason FROM x WHERE state = 'failed' AND period <= 4 UNION ALL SELECT site_name, site_url, period, 'lost' FROM g WHERE period = 1 AND value = 'click'),
k AS (SELECT DISTINCT site_name, site_url, period FROM g2 UNION SELECT DISTINCT site_name, site_url, period FROM b)
SELECT *, 'period not requested' AS violation FROM k WHERE period > 3
UNION ALL SELECT k.*, 'site not enabled' FROM k JOIN reg USING (site_name, site_url) WHERE disabled
UNION ALL SELECT site_name, site_url, period, 'two values' FROM g2 GROUP BY ALL HAVING count(DISTINCT value) > 1
UNION ALL SELECT site_name, site_url, period, 'two reasons' FROM b GROUP BY ALL HAVING count(DISTINCT reason) > 1
UNION ALL SELECT DISTINCT site_name, site_url, period, 'success and failure' FROM g2 SEMI JOIN b USING (site_name, site_url, period)"""),
    "contract_drift": """
SELECT s_name AS site_name, 'http://s/' || s_suppkey AS site_url, sha256(s_name || '|' || s_nationkey) AS contract, sha256(s_name || '|' || (s_nationkey + 1)) AS current FROM supplier WHERE s_suppkey % 4 = 0""",
    "history_violations": sql(f"""{_S},
y AS (SELECT * FROM x UNION ALL SELECT site_name, site_url, period, state, 'x', reason FROM x WHERE period = 30 AND state = 'success')
SELECT site_name, site_url, period, 'two rows' AS violation FROM y GROUP BY 1, 2, 3 HAVING count(*) > 1
UNION ALL SELECT DISTINCT site_name, site_url, period, 'outside the window' FROM (SELECT *, max(period) OVER (PARTITION BY site_name, site_url) AS top FROM y) WHERE period <= top - 10"""),
    "enabled_only": sql(f"{_S} SELECT x.* FROM x SEMI JOIN (SELECT * FROM reg WHERE NOT disabled) USING (site_name, site_url) WHERE period < 20"),
    "dropped_sites": sql(f"""{_S},
h AS (SELECT DISTINCT site_name, CASE WHEN site_name LIKE '%3' THEN site_url || '/old' ELSE site_url END AS site_url FROM x WHERE period < 20)
SELECT h.*, CASE WHEN site_name IN (SELECT site_name FROM reg WHERE NOT disabled) THEN 'old address' ELSE 'no target' END AS reason FROM h ANTI JOIN (SELECT * FROM reg WHERE NOT disabled) USING (site_name, site_url)"""),
    "carry_site_attributes": sql("""
x AS (SELECT *, 's' || (ord % 20) AS id FROM reg), o AS (SELECT * FROM x WHERE ord >= 20 AND ord < 40), n AS (SELECT * FROM x WHERE ord >= 40 AND ord < 60)
SELECT site_name, site_url, id, ord FROM o UNION ALL
SELECT site_name, site_url, CASE WHEN id IN (SELECT id FROM o) THEN id || '_2' ELSE id END, CAST((SELECT coalesce(max(ord), 0) FROM o) + 1 + ord AS INTEGER) FROM n"""),
    "registry_merge": sql("SELECT ord, disabled, CASE WHEN disabled THEN 'old ' ELSE 'new old ' END || site_name AS raw FROM reg"),
    "size_violations": sql("""
x AS (SELECT site_name, site_url, period, CASE WHEN period = 5 THEN 2 ELSE 1 END AS wanted, len(string_split(value, ',')) AS tokens FROM r2)
SELECT site_name, site_url, period, CAST(wanted AS INTEGER) AS wanted, CAST(tokens AS INTEGER) AS tokens FROM x WHERE wanted <> tokens"""),
}
