"""History updates from a stream of rounds.

Every micro-batch is merged into the newest version of the history by the batch operators and written as the next
version, named after the batch. A batch that is run again finds its version there and leaves it. Late rounds need no
watermark: a period outside its site's window is dropped by the same rule that drops old ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import history as h

SCHEMA = "site_name string, site_url string, period int, state string, value string, reason string"


def _versions(spark: SparkSession, path: str) -> dict[int, str]:
    """Complete versions by batch number; Spark's own file listing, so any store that Spark reads will do."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(root):
        return {}
    found = {}
    for entry in files.listStatus(root):
        name = entry.getPath().getName()
        if name.startswith("version=") and files.exists(jvm.org.apache.hadoop.fs.Path(entry.getPath(), "_SUCCESS")):
            found[int(name.split("=")[1])] = entry.getPath().toString()
    return found


def latest_history(spark: SparkSession, path: str) -> DataFrame:
    versions = _versions(spark, path)
    return spark.read.schema(SCHEMA).parquet(versions[max(versions)]) if versions else spark.createDataFrame([], SCHEMA)


def apply_round(batch: DataFrame, batch_id: int, path: str, n: int = 10, requested: list[int] | None = None, registry: DataFrame | None = None) -> None:
    """Merge one micro-batch of states, as a round is merged: failures without a period count for every requested one (and
    for none where none are named), and a batch with anything that ``round_violations`` lists is refused as a whole, which
    stops the stream and leaves the history as it was; with a ``registry``, sites that it doesn't know or has disabled
    are such a violation. Any partitioning of a batch gives the same version."""
    spark = batch.sparkSession
    versions = _versions(spark, path)
    if batch_id in versions:
        return
    before = [v for v in versions if v < batch_id]
    old = spark.read.schema(SCHEMA).parquet(versions[max(before)]) if before else spark.createDataFrame([], SCHEMA)
    results = batch.filter("state = 'success'").select(*h.KEY, "value").distinct()
    failures = h.expand_failures(batch.filter("state = 'failed'").select(*h.KEY, "reason"), requested or []).distinct()
    wrong = h.round_violations(results, failures, requested or [], registry)
    if requested is None:
        wrong = wrong.filter("violation <> 'period not requested'")
    first = wrong.orderBy(*h.KEY, "violation").first()
    if first:
        raise ValueError(f"round {batch_id} is refused: {first['violation']} at {[first[k] for k in h.KEY]}")
    new = h.retain(h.merge_round(old, results, failures), batch.select(*h.SITE), n)
    new.write.mode("overwrite").parquet(f"{path}/version={batch_id}")


def start_updates(rounds: DataFrame, path: str, checkpoint: str, n: int = 10, requested: list[int] | None = None, registry: DataFrame | None = None) -> StreamingQuery:
    """Keep the history under ``path`` up to date with a stream of states; ends when all present input is taken in."""
    return (
        rounds.writeStream.foreachBatch(lambda batch, batch_id: apply_round(batch, batch_id, path, n, requested, registry))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def windowed_counts(events: DataFrame, lateness: str = "1 hour", width: str = "1 day") -> DataFrame:
    """Successes and failures of a stream of timed states by window: state is kept no longer than ``lateness``."""
    return events.withWatermark("ts", lateness).groupBy(F.window("ts", width), "state").agg(F.count(F.lit(1)).alias("n"))
