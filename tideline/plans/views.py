"""Period records seen in general tables: what the registered queries run on.

``records(site_name, site_url, period, value, seq)`` is the fact table of the library: a source (site) publishes one
value for each period.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession) -> str:
    """A new path in the folder that all executors share."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = f"file://{tempfile.gettempdir()}"
    return f"{base.rstrip('/')}/tideline-{uuid.uuid4().hex}"


def _site(user: str) -> list[Column]:
    name = F.concat(F.lit("site"), F.col(user).cast("string"))
    return [name.alias("site_name"), F.concat(F.lit("http://host"), (F.col(user) % 7).cast("string"), F.lit("/"), name).alias("site_url")]


def raw_day_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a record of its user's day, ``seq`` in order of time."""
    return table(spark, sf_dir, "events").select(*_site("user_id"), F.dayofmonth("ts").alias("period"), F.col("event_type").alias("value"), F.col("event_id").alias("seq"), "ts")


def day_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record for each user and day: the first event type of the day."""
    rows = raw_day_records(spark, sf_dir)
    return rows.groupBy("site_name", "site_url", "period").agg(F.min_by("value", F.struct("ts", "seq")).alias("value"), F.min("seq").alias("seq"))


def day_list_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record for each user and day: all event types of the day in order."""
    types = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("ts", "seq", "value"))), lambda x: x["value"]), ",")
    return raw_day_records(spark, sf_dir).groupBy("site_name", "site_url", "period").agg(types.alias("value"), F.min("seq").alias("seq"))


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A contract for each user that has events: window sizes and directions derived from the user's number."""
    users = table(spark, sf_dir, "events").select("user_id").distinct()
    n = F.col("user_id")
    return users.select(
        *_site("user_id"),
        F.when(n % 2 == 0, "top").otherwise("bottom").alias("region"),
        F.when(n % 5 == 0, F.lit(5)).alias("recent_history_count"),
        (n % 11 == 0).alias("disabled"),
        n.cast("int").alias("ord"),
    )


#: The same views for DuckDB, put before each query.
SQL = """
raw AS (SELECT 'site' || user_id AS site_name, 'http://host' || (user_id % 7) || '/site' || user_id AS site_url,
               CAST(day(ts) AS INTEGER) AS period, event_type AS value, event_id AS seq, ts FROM events),
r1 AS (SELECT site_name, site_url, period, arg_min(value, (ts, seq)) AS value, min(seq) AS seq FROM raw GROUP BY ALL),
r2 AS (SELECT site_name, site_url, period, string_agg(value, ',' ORDER BY ts, seq) AS value, min(seq) AS seq FROM raw GROUP BY site_name, site_url, period),
reg AS (SELECT DISTINCT 'site' || user_id AS site_name, 'http://host' || (user_id % 7) || '/site' || user_id AS site_url,
               CASE WHEN user_id % 2 = 0 THEN 'top' ELSE 'bottom' END AS region, CASE WHEN user_id % 5 = 0 THEN 5 END AS recent_history_count,
               user_id % 11 = 0 AS disabled, CAST(user_id AS INTEGER) AS ord FROM events)
"""


def sql(query: str) -> str:
    return f"WITH {SQL.strip()},\n{query.strip()}" if query.strip().startswith(("x AS", "x1 AS")) else f"WITH {SQL.strip()}\n{query.strip()}"
