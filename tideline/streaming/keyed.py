"""The history as keyed state: one site's window lives in the state store, and a round touches the sites it names.

No version of the whole history is ever written. A micro-batch meets the windows of its own sites in the RocksDB store,
which Spark commits with the batch; a batch that fails, or runs again after a restart, starts from the last commit. The
store itself is read as a table, so the history at hand is the state and nothing beside it.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from ..operators import history as h

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
WINDOW = "period int, state string, value string, reason string"
CHANGES = "site_name string, site_url string, period int, state string, value string, reason string"
NO_REASON = h.NO_REASON
#: A period of one site: its state, value and reason.
State = tuple[str, str | None, str | None]


def refusal(new: dict[int, set[State]], requested: list[int] | None, enabled: bool) -> str | None:
    """The first reason, in alphabetical order, why what a round says of one site can't be merged; the rules are those of
    ``history.round_violations``."""
    found = set()
    for period, states in new.items():
        values = {v for s, v, _ in states if s == "success"}
        if requested is not None and period not in requested:
            found.add("period not requested")
        if any(not (v or "").strip(" ") for v in values):
            found.add("empty value")
        if len({v for v in values if v is not None}) > 1:
            found.add("two values")
        if len({r for s, _, r in states if s == "failed" and r is not None}) > 1:
            found.add("two reasons")
        if len({s for s, *_ in states}) > 1:
            found.add("success and failure")
    if new and not enabled:
        found.add("site not enabled")
    return min(found, default=None)


def merged(window: dict[int, State], new: dict[int, set[State]], n: int) -> dict[int, State]:
    """A site's window after a round: new states replace old ones, and the n periods up to the latest stay."""
    after = window | {period: next(iter(states)) for period, states in new.items()}
    top = max(after, default=0)
    return {period: after[period] for period in sorted(after) if period > top - n}


class SiteWindows(StatefulProcessor):
    """Merges rounds into the window of each site and tells the window of every site that a round touches."""

    def __init__(self, n: int, requested: list[int] | None):
        self.n, self.requested = n, requested

    def init(self, handle) -> None:
        self.window = handle.getListState("window", WINDOW)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        rows = initialState.astype(object).where(initialState.notna(), None)
        self.window.put([(int(r.period), r.state, r.value, r.reason) for r in rows.itertuples()])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new: dict[int, set[State]] = {}
        enabled = True
        for batch in rows:
            for r in batch.astype(object).where(batch.notna(), None).itertuples():
                enabled = enabled and bool(r.enabled)
                if r.state == "success":
                    new.setdefault(int(r.period), set()).add(("success", r.value, None))
                else:
                    reason = r.reason if (r.reason or "").strip(" ") else NO_REASON
                    for period in [int(r.period)] if r.period is not None else self.requested or []:
                        new.setdefault(period, set()).add(("failed", None, reason))
        wrong = refusal(new, self.requested, enabled)
        if wrong:
            raise ValueError(f"the round is refused: {wrong} at {list(key)}")
        window = {p: (s, v, r) for p, s, v, r in self.window.get()} if self.window.exists() else {}
        after = merged(window, new, self.n)
        self.window.put([(p, *state) for p, state in after.items()])
        yield pd.DataFrame([(*key, p, *state) for p, state in after.items()], columns=[f.split()[0] for f in CHANGES.split(", ")])

    def close(self) -> None:
        pass


def site_changes(rounds: DataFrame, history: DataFrame | None = None, registry: DataFrame | None = None, n: int = 10, requested: list[int] | None = None) -> DataFrame:
    """The windows of the sites that each micro-batch of ``rounds(site_name, site_url, period, state, value, reason)``
    touches, after it.

    ``history`` is where the state begins; it is read once, with the first batch. A failure without a period counts for
    every requested one. With a ``registry``, rounds of sites that it doesn't know or has disabled are refused; it is
    joined to each batch, so a registry that is read from files is as new as the batch. A period below its site's window
    is dropped, however late it comes. Anything that can't be merged fails the batch, which leaves all state as it was.
    """
    # The processes that run a stream's Python need not have this package: what they call goes to them by value.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    rounds.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    if registry is None:
        known = rounds.withColumn("enabled", F.lit(True))
    else:
        own = registry.groupBy(*h.SITE).agg(F.bool_or(~F.coalesce("disabled", F.lit(False))).alias("on"))
        known = rounds.join(own, h.SITE, "left").withColumn("enabled", F.coalesce("on", F.lit(False))).drop("on")
    start = history.select(*h.COLUMNS).groupBy(*h.SITE) if history is not None else None
    return known.groupBy(*h.SITE).transformWithStateInPandas(SiteWindows(n, requested), outputStructType=CHANGES, outputMode="Update", timeMode="None", initialState=start)


def start_site_updates(changes: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write the ``site_changes`` of each micro-batch under ``path``, one folder for each batch; a batch that runs again
    writes the same folder again. Ends when all present input is taken in."""
    return (
        changes.writeStream.foreachBatch(lambda batch, batch_id: batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}"))
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def site_history(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The history as the state store of a stream's last commit has it."""
    stored = spark.read.format("statestore").option("stateVarName", "window").load(checkpoint)
    element = F.col("list_element")
    return stored.select(F.col("key.site_name"), F.col("key.site_url"), element["period"].alias("period"), element["state"].alias("state"), element["value"].alias("value"), element["reason"].alias("reason"))
