"""Exact top-k inner products, vectors processed by descending length.

Vectors are quantised to integers, so scores are exact. A rotation by the singular vectors of all vectors puts most of
every inner product into the first coordinates; their partial sums plus a Cauchy-Schwarz bound of the rest show for
most candidates that they can't reach a query's k-th best score so far, and only the others are scored in full.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import python_ready, table, written

#: Vectors of a data block and queries of a query block: what a task holds at a time.
DATA_BLOCK, QUERY_BLOCK = 8192, 2048
#: Longest vectors that every query meets first, for a first bound.
HEAD = 1024
STRIPE = 512
#: Pairs of a stripe are scored as a whole where more than one in so many is left.
DENSE = 20


def quantised(vectors: DataFrame, vector: str, scale: int = 256) -> DataFrame:
    """vec_id, v (floor(scale * x) of every component) and its length norm.

    Vectors that are null or hold null or non-finite components take no part, nor do rows without vec_id; of rows
    that repeat a vec_id the smallest vector counts. Vectors so long that a score could leave 62 bits fail the job.
    """
    x = F.col("x")
    finite = x.isNotNull() & F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("x")).filter(F.col("vec_id").isNotNull() & finite)
    whole = F.transform("x", lambda c: F.floor(c * F.lit(float(scale))))
    length = F.sqrt(F.aggregate("x", F.lit(0.0), lambda sum_, c: sum_ + F.pow(F.floor(c * F.lit(float(scale))).cast("double"), F.lit(2.0))))
    sized = rows.select("vec_id", whole.alias("v"), F.when(length < 2.0**31, length).otherwise(F.raise_error(F.lit("a vector is too long for 64-bit scores")).cast("double")).alias("norm"))
    return sized.groupBy("vec_id").agg(F.min(F.struct("v", "norm")).alias("r")).select("vec_id", "r.v", "r.norm")


def _moments(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            x = _matrix(batch.column(0).to_pylist(), width)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(list(total)), pa.array(range(width), pa.int32())], names=["m", "i"])

    return run


def _matrix(rows: list, width: int) -> np.ndarray:
    """Rows as a matrix; shorter vectors end in zeros."""
    out = np.zeros((len(rows), width))
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def rotation(rows: DataFrame, width: int) -> np.ndarray:
    """Right singular vectors of all vectors, strongest first: from the sums of outer products that tasks return, a
    matrix as large as the dimension squared."""
    parts = rows.select("v").mapInArrow(_moments(width), "m array<double>, i int")
    summed = parts.select("i", F.posexplode("m").alias("j", "x")).groupBy("i", "j").agg(F.sum("x").alias("x"))
    gram = np.zeros((width, width))
    for i, j, x in summed.collect():
        gram[i, j] = x
    return np.linalg.svd(gram)[0]


class _Best:
    """The k best scores of each query so far, ties to the smaller id."""

    #: Less than any score.
    NONE = -(2**62)

    def __init__(self, queries: int, k: int):
        self.k = k
        self.score = np.full((queries, k), self.NONE, np.int64)
        self.ids = np.full((queries, k), np.iinfo(np.int64).max)

    def add(self, q: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        """Take in scored pairs of query and id, no pair twice."""
        some = np.unique(q)
        q = np.concatenate([np.repeat(some, self.k), q])
        ids = np.concatenate([self.ids[some].ravel(), ids])
        score = np.concatenate([self.score[some].ravel(), score])
        order = np.lexsort((ids, -score, q))
        q, ids, score = q[order], ids[order], score[order]
        nth = np.arange(len(q)) - np.searchsorted(q, q)
        top = nth < self.k
        self.score[q[top], nth[top]], self.ids[q[top], nth[top]] = score[top], ids[top]

    @property
    def bound(self) -> np.ndarray:
        return np.where(self.score[:, -1] == self.NONE, -np.inf, self.score[:, -1])


def search_block(queries: pd.DataFrame, data: pd.DataFrame, turn: np.ndarray, k: int, first: int) -> tuple[_Best, np.ndarray, int]:
    """The k best candidates of every query among ``data``; ``floor``, if the queries have it, is a score their k-th best
    is known to reach. Also returns the query ids and how many pairs were scored in full."""
    width = len(turn)
    data = data.sort_values(["norm", "vec_id"], ascending=[False, True])
    q, d = _matrix(queries["v"].tolist(), width), _matrix(data["v"].tolist(), width)
    q_ids, d_ids, q_norm, d_norm = (x.to_numpy() for x in (queries["vec_id"], data["vec_id"], queries["norm"], data["norm"]))
    q_turned, d_turned = q @ turn, d @ turn
    q_rest, d_rest = np.linalg.norm(q_turned[:, first:], axis=1), np.linalg.norm(d_turned[:, first:], axis=1)
    exact = max(np.abs(q).max(initial=0), np.abs(d).max(initial=0)) ** 2 * width < 2**53
    best, scored = _Best(len(q), k), 0
    floor = queries["floor"].fillna(-np.inf).to_numpy(np.float64) if "floor" in queries else np.full(len(q), -np.inf)
    for lo in range(0, len(d), STRIPE):
        at = slice(lo, lo + STRIPE)
        need = np.maximum(best.bound, floor)
        slack = 1e-9 * q_norm * d_norm[lo] + 1e-6  # of rounding in the rotated coordinates
        live = np.flatnonzero(q_norm * d_norm[lo] + slack >= need)
        if not len(live):
            break  # vectors that follow are shorter still
        partial = q_turned[live, :first] @ d_turned[at, :first].T
        may = partial + q_rest[live][:, None] * d_rest[at][None, :] + slack[live][:, None] >= need[live][:, None]
        may &= q_ids[live][:, None] != d_ids[at][None, :]
        count = int(may.sum())
        if not count:
            continue
        scored += count
        if exact and count * DENSE > may.size:
            # Where many pairs are left, one product of matrices is cheaper than the pairs one by one.
            full = q[live] @ d[at].T
            may &= full >= need[live][:, None]
            qi, di = np.nonzero(may)
            score = full[qi, di]
            qi, di = live[qi], di + lo
        else:
            qi, di = np.nonzero(may)
            qi, di = live[qi], di + lo
            score = np.einsum("ij,ij->i", q[qi], d[di]) if exact else np.einsum("ij,ij->i", q[qi].astype(np.int64), d[di].astype(np.int64))
            enter = score >= need[qi]
            qi, di, score = qi[enter], di[enter], score[enter]
        if len(qi):
            best.add(qi, d_ids[di], score.astype(np.int64))
    return best, q_ids, scored


def _block_search(turn: np.ndarray, k: int, first: int):
    def run(key: tuple, queries: pd.DataFrame, data: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(data):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        best, q_ids, _ = search_block(queries, data, turn, k, first)
        qi, nth = np.nonzero(best.score > _Best.NONE)
        return pd.DataFrame({"query_id": q_ids[qi], "vec_id": best.ids[qi, nth], "score": best.score[qi, nth]})

    return run


def _blocks(rows: DataFrame, size: str, wanted: int, name: str) -> DataFrame:
    """``rows`` with ``block``, written: ``wanted`` blocks or more of about equal numbers of rows, cut by descending
    ``size``, and by hash among rows of one size. A block is a range partition, whose number is stored with its rows."""
    return written(rows.repartitionByRange(wanted, F.desc(size), F.xxhash64("vec_id")).withColumn("block", F.spark_partition_id()), name)


def _streamed(turn: np.ndarray, k: int, first: int):
    """Rows of blocks in order, those of a block's vectors before those of the queries that want it: a task holds one
    block and so many queries at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def searched() -> pa.RecordBatch:
            best, q_ids, _ = search_block(pd.concat(asked), pd.concat(block), turn, k, first)
            qi, nth = np.nonzero(best.score > _Best.NONE)
            return pa.RecordBatch.from_arrays([pa.array(q_ids[qi]), pa.array(best.ids[qi, nth]), pa.array(best.score[qi, nth])], names=["query_id", "vec_id", "score"])

        now, block, asked = None, [], []
        for batch in batches:
            rows = batch.to_pandas()
            at, is_query = rows["at"].to_numpy(), rows["is_query"].to_numpy()
            edges = np.flatnonzero(np.append(True, (at[1:] != at[:-1]) | (is_query[1:] != is_query[:-1]))) if len(rows) else []
            for lo, hi in zip(edges, [*edges[1:], len(rows)], strict=True):
                if at[lo] != now:
                    if asked:
                        yield searched()
                    now, block, asked = at[lo], [], []
                for part in range(lo, hi, QUERY_BLOCK):
                    (asked if is_query[lo] else block).append(rows.iloc[part : min(hi, part + QUERY_BLOCK)])
                    if sum(map(len, asked)) >= QUERY_BLOCK:
                        yield searched()
                        asked = []
        if asked:
            yield searched()

    return run


def top_inner_products(vectors: DataFrame, vector: str, is_query: Column, k: int = 5, scale: int = 256, first: int | None = None) -> DataFrame:
    """For each vec_id of ``vectors`` where ``is_query`` holds, its k best others: query_id, rank, vec_id, score.

    ``is_query`` may use vec_id only. See ``quantised`` for what takes part; shorter vectors end in zeros. Queries with
    fewer than k others get all. Ties go to the smaller vec_id. Other columns are not read.

    The longest vectors give every query a first bound; by Cauchy-Schwarz that says how long a vector must be to matter
    to it. Data blocks are cut by length and stay where they are; queries, in blocks by that least length, are copied to
    the longest data blocks, as many as may matter. No block grows with the data.
    """
    spark = vectors.sparkSession
    python_ready(spark)
    rows = written(quantised(vectors, vector, scale), "vectors")
    about = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("width"), F.count_if(is_query).alias("q")).first()
    schema = "query_id long, vec_id long, score long"
    if not about["q"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    turn = rotation(rows, max(1, about["width"]))
    first = first or max(1, len(turn) // 4)
    query_blocks, data_blocks = math.ceil(about["q"] / QUERY_BLOCK), math.ceil(about["n"] / DATA_BLOCK)
    search = _block_search(turn, k, first)
    queries = rows.filter(is_query)
    head = rows.orderBy(F.desc("norm"), "vec_id").limit(HEAD).select(F.col("vec_id").alias("vec_id"), F.col("v").alias("v"), F.col("norm").alias("norm"), F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("head_qb"))
    dealt = queries.withColumn("qb", F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks)).cast("int"))
    seen = dealt.groupBy("qb").cogroup(head.groupBy("head_qb")).applyInPandas(search, schema)
    floors = seen.groupBy("query_id").agg(F.min("score").alias("floor"), F.count(F.lit(1)).alias("n")).filter(F.col("n") == k).select(F.col("query_id").alias("vec_id"), "floor")
    # The least length of a vector that can reach the bound, a little less for rounding.
    least = F.coalesce(F.greatest((F.col("floor") * (1 - 1e-9) - 1e-6) / F.col("norm"), F.lit(0.0)), F.lit(0.0))
    bounded = written(queries.join(floors, "vec_id", "left").withColumn("least", F.when(F.col("norm") > 0, least).otherwise(0.0)), "bounded")
    asked = _blocks(bounded, "least", query_blocks, "queries").withColumnRenamed("block", "qb")
    data = _blocks(rows, "norm", data_blocks, "data")
    # One number for each block on the driver: the longest vector of a data block, the least need of a query block.
    longest = dict(data.groupBy("block").agg(F.max("norm")).collect())
    needs = dict(asked.groupBy("qb").agg(F.min("least")).collect())
    by_length = sorted(longest, key=lambda b: -longest[b])
    lengths = np.array([-longest[b] for b in by_length])
    # In order of length, the blocks that queries meet are a run from the first.
    met = spark.createDataFrame([(q, int(np.searchsorted(lengths, -need, "right"))) for q, need in needs.items()], "qb int, met int")
    order = spark.createDataFrame([(b, i) for i, b in enumerate(by_length)], "block int, at int")
    fields = ["at", "is_query", "vec_id", "v", "norm", "floor"]
    copies = asked.join(met, "qb").filter("met > 0").withColumn("at", F.explode(F.sequence(F.lit(0), F.col("met") - 1))).withColumn("is_query", F.lit(True))
    blocks = data.join(order, "block").withColumns({"is_query": F.lit(False), "floor": F.lit(None).cast("long")})
    dealt = blocks.select(fields).unionByName(copies.select(fields)).repartition(len(by_length), "at")
    found = dealt.sortWithinPartitions("at", "is_query").mapInArrow(_streamed(turn, k, first), schema)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op7_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_inner_products(table(spark, sf_dir, "embeddings"), "embedding", F.col("vec_id") % 50 == 0)


OP7_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, d.vec_id, CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(d.v AS DOUBLE[])) AS BIGINT) AS score FROM v q JOIN v d ON q.vec_id <> d.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
