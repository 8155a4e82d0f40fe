"""Periodic runs of words, found by recompression.

The words of a batch of texts are one sequence of numbers, with a number of its own between texts. It is compressed by
turns: blocks of one symbol become a symbol of symbol and length, then pairs of a left and a right symbol become one.
Equal symbols of a level stand for equal words, and every level keeps where its symbols begin below. So two places are
compared by climbing while symbols agree and coming down where they differ, a step or a block on each level: a query of
the longest common extension costs as many steps as there are levels, and thousands of queries are answered at once.

A run of period p and exponent of at least e agrees with itself p words on over (e - 1) p places, so it covers a place of
a grid of that width. Grids of all periods have n log n places in all. Where a place agrees, extensions to both sides give
the run exactly. No suffix array is made, and no text is looked at again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import python_ready, table, text_or_empty, without

MIN_LENGTH = 6
MIN_EXPONENT = 4
#: Levels end at so few symbols; the last one is walked.
TOP = 16
#: Grid places that are looked at together.
CHUNK = 2_000_000


@dataclass
class _Level:
    """Symbols, and how the next level is made of them: where its symbols begin (``first``, with the end as last), and
    which of them holds each symbol (``up``); ``blocks`` tells blocks from pairs."""

    symbols: np.ndarray
    first: np.ndarray | None = None
    up: np.ndarray | None = None
    blocks: bool = False

    def to_next(self, begins: np.ndarray, blocks: bool) -> np.ndarray:
        starts = np.flatnonzero(begins)
        self.first = np.append(starts, len(begins))
        self.up = np.append(np.cumsum(begins) - 1, len(starts))
        self.blocks = blocks
        return starts


def _side(symbols: np.ndarray, turn: int) -> np.ndarray:
    """A random half of all symbols, another one at each turn."""
    x = (symbols.astype(np.uint64) + np.uint64(turn + 1)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(40) & np.uint64(1)).astype(bool)


class Grammar:
    """The run-length grammar of a sequence of numbers below ``distinct``. Its first and last number must occur nowhere
    else, so that no extension leaves it."""

    def __init__(self, sequence: np.ndarray, distinct: int):
        self.levels = [_Level(sequence.astype(np.int64))]
        self.fresh, turn = distinct, 0
        while len(now := self.levels[-1].symbols) > TOP:
            begins = np.append(True, now[1:] != now[:-1])
            if not begins.all():
                starts = self.levels[-1].to_next(begins, True)
                sizes = np.diff(self.levels[-1].first)
                self._push(now[starts], sizes > 1, sizes)
                now = self.levels[-1].symbols
            side = _side(now, turn)
            turn += 1
            pair = max((side[:-1] & ~side[1:], ~side[:-1] & side[1:]), key=np.count_nonzero)
            if pair.any():
                starts = self.levels[-1].to_next(np.append(True, ~pair), False)
                self._push(now[starts], np.append(pair, False)[starts], now[np.minimum(starts + 1, len(now) - 1)])

    def _push(self, symbols: np.ndarray, new: np.ndarray, second: np.ndarray) -> None:
        """A level whose ``new`` symbols are named by the pairs of ``symbols`` and ``second``, the others as they were."""
        width = int(second.max()) + 1
        names, number = np.unique(symbols[new] * width + second[new], return_inverse=True)
        symbols[new] = self.fresh + number
        self.fresh += len(names)
        self.levels.append(_Level(symbols))

    def extension(self, left: np.ndarray, right: np.ndarray, back: bool = False) -> np.ndarray:
        """For each pair of places, ``left`` < ``right``: how many numbers agree from there on, or before there."""
        sign, x, y = (-1 if back else 1), left.astype(np.int64), right.astype(np.int64)
        stopped, live = np.zeros(len(x), np.int64), np.arange(len(x))
        for k, level in enumerate(self.levels):
            ahead = level.symbols
            live, gone = self._split(live, ahead[x[live] - back] == ahead[y[live] - back])
            stopped[gone] = k
            if not len(live):
                break
            if level.first is None:
                while len(live):
                    x[live] += sign
                    y[live] += sign
                    live, gone = self._split(live, ahead[x[live] - back] == ahead[y[live] - back])
                    stopped[gone] = k
                break
            i, j = x[live], y[live]
            inside = (level.first[level.up[i]] != i) | (level.first[level.up[j]] != j)
            by, ends = self._steps(level, i, j, back)
            i, j = i + sign * by * inside, j + sign * by * inside
            over = inside & ends
            x[live[over]], y[live[over]], stopped[live[over]] = i[over], j[over], k
            live, i, j = live[~over], i[~over], j[~over]
            x[live], y[live] = level.up[i], level.up[j]
        for k in range(int(stopped.max(initial=0)), 0, -1):
            below, on = self.levels[k - 1], np.flatnonzero(stopped >= k)
            i, j = below.first[x[on]], below.first[y[on]]
            same = below.symbols[i - back] == below.symbols[j - back]
            by = self._steps(below, i, j, back)[0] * same
            x[on], y[on] = i + sign * by, j + sign * by
        return (x - left) * sign

    @staticmethod
    def _split(live: np.ndarray, same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return live[same], live[~same]

    @staticmethod
    def _steps(level: _Level, i: np.ndarray, j: np.ndarray, back: bool) -> tuple[np.ndarray, np.ndarray]:
        """Where the symbols ahead agree: how many of them to pass, and whether those behind them differ for sure.

        Of two blocks the shorter rest is passed; rests of unlike length end the agreement. A symbol that ends a pair at
        one place begins none at the other, so one step leaves both places at the edge of a symbol of the next level.
        """
        if not level.blocks:
            return np.ones(len(i), np.int64), np.zeros(len(i), bool)
        if back:
            a, b = i - level.first[level.up[i - 1]], j - level.first[level.up[j - 1]]
        else:
            a, b = level.first[level.up[i] + 1] - i, level.first[level.up[j] + 1] - j
        return np.minimum(a, b), a != b


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def _grid(begins: np.ndarray, sizes: np.ndarray, min_length: int, exponent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and periods of the grids of all texts, in chunks."""
    sizes = np.where(sizes >= min_length, sizes, 0)
    most = sizes // exponent
    ends = np.cumsum(most)
    at, total = 0, int(ends[-1]) if len(ends) else 0
    while at < total:
        # A stretch of (text, period), cut where it has enough places.
        stretch = np.arange(at, min(total, at + CHUNK // 4))
        text = np.searchsorted(ends, stretch, "right")
        period = stretch - (ends[text] - most[text]) + 1
        width = np.maximum((exponent - 1) * period, min_length - period)
        places = (sizes[text] - period - 1) // width + 1
        some = max(1, int(np.searchsorted(np.cumsum(places), CHUNK, "right")))
        text, period, width, places = text[:some], period[:some], width[:some], places[:some]
        at += some
        number = np.arange(int(places.sum())) - np.repeat(np.cumsum(places) - places, places)
        yield np.repeat(begins[text], places) + number * np.repeat(width, places), np.repeat(period, places)


def runs_of(texts: list[list[bytes]], min_length: int = MIN_LENGTH, exponent: int = MIN_EXPONENT) -> list[np.ndarray]:
    """The runs of each sequence of words as rows of start, length and smallest period, by start, then period."""
    numbers = _Numbers()
    sizes = np.array([len(t) for t in texts], np.int64)
    begins = np.cumsum(sizes + 1) - sizes
    sequence = np.empty(int((sizes + 1).sum()) + 1, np.int64)
    for words, at in zip(texts, begins.tolist(), strict=True):
        sequence[at : at + len(words)] = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
    gaps = np.append(begins - 1, len(sequence) - 1)
    sequence[gaps] = len(numbers) + np.arange(len(gaps))
    found = []
    grammar = None
    for place, period in _grid(begins, sizes, min_length, exponent):
        hit = sequence[place] == sequence[place + period]
        place, period = place[hit], period[hit]
        # A run agrees at more places than one, so beside this one too.
        hit = (sequence[place + 1] == sequence[place + 1 + period]) | (sequence[place - 1] == sequence[place - 1 + period])
        place, period = place[hit], period[hit]
        if not len(place):
            continue
        grammar = grammar or Grammar(sequence, len(numbers) + len(gaps))
        before = grammar.extension(place, place + period, back=True)
        length = before + grammar.extension(place, place + period) + period
        is_run = length >= np.maximum(min_length, exponent * period)
        found.append(np.stack([place - before, length, period], axis=1)[is_run])
    rows = np.unique(np.concatenate(found), axis=0) if found else np.empty((0, 3), np.int64)
    # A stretch found by several periods has the smallest, which divides the others.
    rows = rows[np.append(True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1))] if len(rows) else rows
    rows = rows[np.lexsort((rows[:, 2], rows[:, 0]))]
    text = np.searchsorted(begins, rows[:, 0], "right") - 1
    rows[:, 0] -= begins[text] if len(rows) else 0
    cuts = np.searchsorted(text, np.arange(len(texts) + 1))
    return [rows[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]


def collapsed(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """``words`` without those that a run contains after its first period."""
    if not len(runs):
        return words
    depth = np.zeros(len(words) + 1, np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
    return list(compress(words, (np.cumsum(depth[:-1]) == 0).tolist()))


RUNS = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))


def _find(min_length: int, exponent: int):
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t or b"").split() for t in batch.column(1).cast(pa.binary()).to_pylist()]
            runs = runs_of(texts, min_length, exponent)
            flat = np.concatenate([*runs, np.empty((0, 3), np.int64)])
            offsets = pa.array(np.append(0, np.cumsum([len(r) for r in runs])).astype(np.int32))
            parts = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(flat[:, i])) for i in range(3)], names=["start", "length", "period"])
            left = [b" ".join(collapsed(words, r)) for words, r in zip(texts, runs, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, parts).cast(kind), pa.array(left, pa.binary()).cast(pa.string())], names=["doc", "runs", "collapsed"])

    return run


def periodic_runs(docs: DataFrame, text: str = "text", min_length: int = MIN_LENGTH, exponent: int = MIN_EXPONENT) -> DataFrame:
    """``docs`` with ``runs`` (array of start, length, period, in words, by start, then period) and ``collapsed`` (the
    words that no run contains after its first period, joined by one space).

    Words are split at ASCII white space. A run is a stretch with smallest period q of at least ``min_length`` words and
    ``exponent`` (2 or more) periods that can't be extended. Null, empty and blank texts have no run and collapse to an empty text.
    Rows keep their other columns, repeated rows are treated alike, and columns named runs or collapsed are replaced.
    Texts are worked on one batch at a time and never shuffled; a text is one task's.
    """
    if exponent < 2 or min_length < 3:
        raise ValueError("runs have two periods and three words at least")
    python_ready(docs.sparkSession)
    rest = without(docs, "runs", "collapsed")
    rows = rest.select(F.struct("*").alias("doc"), F.col(f"`{text}`").cast("string").alias("text"))
    schema = T.StructType([rows.schema["doc"], T.StructField("runs", RUNS), T.StructField("collapsed", T.StringType())])
    found = rows.mapInArrow(_find(min_length, exponent), schema)
    return found.select(*[F.col(f"doc.`{c}`").alias(c) for c in rest.columns], "runs", "collapsed")


#: White space between words.
GAP = r"[\x20\x09-\x0D]+"


def with_repetition(docs: DataFrame) -> DataFrame:
    """doc_id and text of ``docs``, where one document in ten, by the CRC-32 of its id, goes on repeating its words from
    some place on. A null id leaves the text as it is."""
    h = "crc32(cast(cast(doc_id AS STRING) AS BINARY))"
    words = F.filter(F.split(text_or_empty(), GAP), lambda w: w != "")
    rows = docs.select("doc_id", "text", F.expr(f"{h} % 10 = 0").alias("odd"), F.expr(f"{h} div 10").alias("g"))
    rows = rows.withColumn("words", F.when(F.col("odd"), words))
    rows = rows.withColumn("n", F.size("words").cast("long"))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    rows = rows.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    again = F.transform(F.sequence(F.col("a"), F.col("n") - 1), lambda i: F.get("words", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))
    repeated = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a").cast("int")), again), " ")
    return rows.select("doc_id", F.when(F.col("odd") & (F.col("n") > 0), repeated).otherwise(F.col("text")).alias("text"))


def _digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: number of runs, the longest one, digests of all runs and of the collapsed text."""
    found = periodic_runs(with_repetition(table(spark, sf_dir, "documents")))
    # Greatest length, then smallest start, then smallest period.
    best = F.array_max(F.transform("runs", lambda r: F.struct(r.length, (-r.start).alias("before"), (-r.period).alias("denser"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    every = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), _digest(every).alias("runs_sha256"), _digest(F.col("collapsed")).alias("collapsed_sha256"))
    start, period, exponent = (-F.col("best.before")).alias("start"), (-F.col("best.denser")).alias("period"), F.expr("1000 * best.length div -best.denser").alias("exponent_milli")
    return rows.select("doc_id", "n_runs", start, F.col("best.length").alias("length"), period, exponent, "runs_sha256", "collapsed_sha256")
