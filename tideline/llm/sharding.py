"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

Every source partition permutes its rows, a matrix says how many of them each shard gets, the rows are exchanged and
permuted again inside their shard. Row ``i`` of the matrix is drawn from the multivariate hypergeometric law that a
uniform permutation of all rows induces, so the result is a uniform permutation although no step orders all rows.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import table, text_or_empty, without, written

#: Bytes that a bin of a shard holds on average, as far as strings go, and rows.
BIN_BYTES, BIN_ROWS = 32 << 20, 100_000
#: A communication matrix of at most so many counts is sent to the tasks whole.
MATRIX_CELLS = 2_000_000


def shard_sizes(n_rows: int, n_shards: int) -> list[int]:
    """Sizes that differ by one at most."""
    return [n_rows // n_shards + (i < n_rows % n_shards) for i in range(n_shards)]


def _stirling_error(n: float) -> float:
    """log(n!) less Stirling's approximation of it; by its series where the difference itself would cancel."""
    if n <= 15:
        return math.lgamma(n + 1) - (n + 0.5) * math.log(n) + n - 0.5 * math.log(2 * math.pi) if n else 0.0
    x = 1 / n
    return x * (1 / 12 - x * x * (1 / 360 - x * x * (1 / 1260 - x * x * (1 / 1680 - x * x / 1188))))


def _deviance(x: float, mean: float, off: float) -> float:
    """x log(x / mean) + mean - x, where ``off`` = x - mean; near the mean by a series, in which nothing cancels."""
    if abs(off) >= 0.1 * (x + mean):
        return x * math.log(x / mean) - off if x else mean
    v = off / (x + mean)
    total, power, j = off * v, 2 * x * v, 1
    while True:
        power *= v * v
        more = total + power / (2 * j + 1)
        if more == total:
            return total
        total, j = more, j + 1


def _log_binomial(x: int, n: int, share: tuple[int, int], off: float) -> float:
    """Log probability of x successes in n at the rate share[0] / share[1]; ``off`` = x - n * rate."""
    rate, rest = share[0] / share[1], (share[1] - share[0]) / share[1]
    if n == 0:
        return 0.0
    if x == 0:
        return n * (math.log1p(-rate) if rate < 0.5 else math.log(rest))
    if x == n:
        return n * (math.log1p(-rest) if rest < 0.5 else math.log(rate))
    left = _stirling_error(n) - _stirling_error(x) - _stirling_error(n - x)
    return left - _deviance(x, n * rate, off) - _deviance(n - x, n * rest, -off) - 0.5 * (math.log(2 * math.pi) + math.log(x) + math.log1p(-x / n))


def log_hypergeometric(good: int, bad: int, draws: int, k: int) -> float:
    """Log probability of k good ones among ``draws`` from good + bad, as a quotient of three binomial probabilities at
    the rate of the draws, so that no large logarithms are subtracted. Deviations from means are exact quotients."""
    n = good + bad
    share = draws, n
    off = (k * n - good * draws) / n
    return _log_binomial(k, good, share, off) + _log_binomial(draws - k, bad, share, -off) - _log_binomial(draws, n, share, 0.0)


def _hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """One draw, by inversion outward from the mode in runs of growing length: some standard deviations of steps."""
    low, high = max(0, draws - bad), min(draws, good)
    if low == high:
        return low
    mode = min(max((draws + 1) * (good + 1) // (good + bad + 2), low), high)
    up = down = math.exp(log_hypergeometric(good, bad, draws, mode))
    u, a, b, run = rng.random() - up, mode, mode, 32
    while u > 0 and (a > low or b < high):
        # Neighbours' probabilities by their quotients, first above, then below what is done.
        k = np.arange(b, min(b + run, high), dtype=np.float64)
        if len(k):
            p = up * np.cumprod((good - k) / (k + 1) * ((draws - k) / (bad - draws + k + 1)))
            at = int(np.searchsorted(np.cumsum(p), u))
            if at < len(p):
                return b + 1 + at
            u, up, b = u - p.sum(), p[-1], b + len(p)
        k = np.arange(a, max(a - run, low), -1, dtype=np.float64)
        if len(k):
            p = down * np.cumprod(k / (good - k + 1) * ((bad - draws + k) / (draws - k + 1)))
            at = int(np.searchsorted(np.cumsum(p), u))
            if at < len(p):
                return a - 1 - at
            u, down, a = u - p.sum(), p[-1], a - len(p)
        run *= 2
    return mode


def communication_matrix(rows: list[int], shards: list[int], seed: int) -> list[list[int]]:
    """Rows that each source partition sends to each shard; row and column sums are exactly the arguments."""
    rng, left, out = np.random.default_rng(seed), list(shards), []
    for n in rows:
        line, still = [], n
        rest = sum(left)
        for j, room in enumerate(left):
            rest -= room
            take = still if j == len(left) - 1 else _hypergeometric(rng, room, rest, still)
            line.append(take)
            still -= take
        left = [a - b for a, b in zip(left, line, strict=True)]
        out.append(line)
    return out


def _width(docs: DataFrame) -> Column:
    """Bytes of a row: of its strings, and eight for every other column."""
    text = [F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)).cast("long") for f in docs.schema.fields if f.dataType.typeName() in ("string", "binary")]
    return reduce(lambda a, b: a + b, text, F.lit(8 * (len(docs.columns) - len(text))).cast("long"))


def shuffle_to_shards(docs: DataFrame, n_shards: int = 8, seed: int = 20240229, bin_rows: int = BIN_ROWS, bin_bytes: int = BIN_BYTES) -> DataFrame:
    """All rows of ``docs`` with ``shard`` (0 to n_shards - 1) and ``slot`` (gapless from 0 within the shard).

    Shard sizes differ by one at most. The order is a uniform one, fixed by ``seed`` and the numbering of the written
    rows. The first write numbers and permutes each source partition, so later steps read stored numbers and a lost
    executor can't change the outcome. The driver sees one count for each source partition and nothing else.

    A shard is put in order in bins of about ``bin_rows`` rows and ``bin_bytes`` bytes at most, chosen by random key, so
    no task holds a shard; rows cross the network once. Rows with null columns or equal to others are rows like any
    other; an empty table gives an empty result; columns named shard or slot are replaced.
    """
    spark = docs.sparkSession
    rows = without(docs, "shard", "slot")
    numbered = rows.select(F.struct("*").alias("doc"), _width(rows).alias("width"), F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("uid"))
    permuted = (
        numbered.withColumns({"first": F.xxhash64(F.lit(seed), "uid"), "second": F.xxhash64(F.lit(seed + 1), "uid")})
        .sortWithinPartitions("first", "uid")
        .withColumn("place", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("first")
    )
    stored = written(permuted, "permuted")
    counts = sorted((r["part"], r["n"], r["bytes"]) for r in stored.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum("width").alias("bytes")).collect())
    n, size = sum(c for _, c, _ in counts), sum(b for *_, b in counts)
    matrix = communication_matrix([c for _, c, _ in counts], shard_sizes(n, n_shards), seed)
    ends = spark.createDataFrame(
        [(part, np.cumsum(line).tolist()) for (part, *_), line in zip(counts, matrix, strict=True)],
        "part int, ends array<bigint>",
    )
    if len(counts) * n_shards <= MATRIX_CELLS:
        ends = F.broadcast(ends)
    bins = max(1, math.ceil(n / n_shards / bin_rows), math.ceil(size / n_shards / bin_bytes))
    dealt = (
        stored.join(ends, "part")
        .withColumn("shard", F.expr("cast(size(filter(ends, e -> e <= place)) as int)"))
        .withColumn("bin", F.expr(f"pmod(second, {bins})"))
        .drop("ends", "part", "place", "width")
    )
    before = Window.partitionBy("shard").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("shard", "bin").count().select("shard", "bin", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("shard", "bin").orderBy("second", "uid")
    return (
        dealt.withColumn("nth", F.row_number().over(inside))
        .join(starts, ["shard", "bin"])
        .select("doc.*", "shard", (F.col("start") + F.col("nth") - 1).alias("slot"))
    )


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shuffle_to_shards(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(
        "doc_id",
        (F.octet_length(text_or_empty()) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text_or_empty()).cast("long").alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
