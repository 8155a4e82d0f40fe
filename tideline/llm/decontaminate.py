"""Benchmark decontamination: windows of documents within a small edit distance of a benchmark item.

Texts are sequences of lower-cased words. A window starts at any word and is as long as an item (shorter at a text's
end); what is reported may end up to ``k`` words earlier or later, where the distance is least. The CGK embedding walks a sequence at random - a bit of (step, word) says whether to move on - which maps edit
distance to Hamming distance; repeated samples of a few places of the embedding, hashed, meet in an LSH table for
sequences that are close; what meets is verified by exact edit distance.

Characters of scripts without blanks are words of their own. Items of fewer than five words are matched exactly, by lookup.

Windows are embedded only if they can be within reach: an edit destroys at most two of an item's word pairs, so a window
within ``k`` edits of an item of ``m`` words shares at least m - 1 - 2k pairs with the items of that length.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import python_ready, rows_of, small_or_shuffled, table, unpacked

#: Edits allowed, in percent of an item's words.
EDIT_PERCENT = 20
#: Items of fewer words say little about where a text is from: they are matched exactly, and only if the caller wants them.
MIN_WORDS = 5
#: Repetitions of the walk and places sampled from each.
REPEATS, SAMPLES = 24, 3
#: Characters of benchmark text that go to the tasks at a time; a larger benchmark takes more passes.
BLOCK_CHARS = 8_000_000

#: Thai to Lao, Myanmar, Khmer, kana, Han with its extensions: scripts written without blanks.
_UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff"
_WORD = re.compile(rf"(?=\w)[{_UNSPACED}]|(?:(?![{_UNSPACED}])\w)+")


_HAS_UNSPACED = re.compile(f"[{_UNSPACED}]").search


def benchmark_words(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


def edits_allowed(words: int, percent: int = EDIT_PERCENT) -> int:
    return words * percent // 100


def prefix_distance(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Least Levenshtein distance of ``item`` to a prefix of ``text``, and the length of that prefix (the longest one of
    at most the item's length, else the shortest). A whole column of the table at a time, as bits of an integer."""
    m = len(item)
    if not m:
        return 0, 0
    places: dict[int, int] = defaultdict(int)
    for i, x in enumerate(item.tolist()):
        places[x] |= 1 << i
    full, last = (1 << m) - 1, 1 << (m - 1)
    up, down, distance = full, 0, m
    best = (m, 0)
    for n, x in enumerate(text.tolist(), 1):
        match = places.get(x, 0)
        diagonal = (((match & up) + up) ^ up) | match | down
        right, left = down | (full & ~(diagonal | up)), up & diagonal
        distance += bool(right & last) - bool(left & last)
        right, left = (right << 1) | 1, left << 1
        up, down = (left | (full & ~(diagonal | right))) & full, right & diagonal & full
        if distance < best[0] or distance == best[0] and n <= m:
            best = distance, n
    return best


class Index:
    """The items of a block: words by number, word pairs by item length, and the LSH tables."""

    def __init__(self, items: list[tuple[int, str]], percent: int, seed: int = 3, min_words: int = MIN_WORDS):
        self.percent = percent
        self.vocabulary: dict[str, int] = {}
        self.items: list[tuple[int, np.ndarray]] = []
        #: By length, the items of fewer than MIN_WORDS words.
        self.short: dict[int, dict[tuple[int, ...], list[int]]] = {}
        for item_id, text in items:
            words = benchmark_words(text or "")
            if len(words) < max(1, min_words):
                continue
            numbers = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
            if len(words) >= MIN_WORDS:
                self.items.append((item_id, np.array(numbers, np.int64)))
            else:
                self.short.setdefault(len(words), {}).setdefault(tuple(numbers), []).append(item_id)
        self.short_heads = {m: np.array(sorted({x[0] for x in own}), np.int64) for m, own in self.short.items()}
        rng = np.random.default_rng(seed)
        self.longest = max((len(x) for _, x in self.items), default=0)
        self.salt = rng.integers(0, 2**63, (REPEATS, 1), dtype=np.uint64)
        self.sampled = rng.random((REPEATS, SAMPLES))
        pairs: dict[int, set[int]] = defaultdict(set)
        v = len(self.vocabulary)
        for _, x in self.items:
            for pair in (x[:-1] * v + x[1:]).tolist():
                pairs[pair].add(len(x))
        self.pairs = np.array(sorted(pairs), np.int64)
        lengths = [sorted(pairs[p]) for p in self.pairs.tolist()]
        self.pair_from = np.cumsum([0] + [len(x) for x in lengths])
        self.pair_lengths = np.array([y for x in lengths for y in x], np.int64)
        self.tables: dict[int, list[int]] = defaultdict(list)
        for i, (_, x) in enumerate(self.items):
            for key in set(self.keys([x], np.array([len(x)]))[:, 0].tolist()):
                self.tables[key].append(i)
        self.table_keys = np.array(sorted(self.tables), np.uint64)

    def met(self, windows: list[np.ndarray], lengths: np.ndarray) -> list[set[int]]:
        """The items that each window meets in a table."""
        found: list[set[int]] = [set() for _ in windows]
        if len(windows) and len(self.table_keys):
            keys = self.keys(windows, lengths)
            hit = self.table_keys[np.minimum(np.searchsorted(self.table_keys, keys), len(self.table_keys) - 1)] == keys
            for r, w in zip(*np.nonzero(hit), strict=True):
                found[w].update(self.tables[int(keys[r, w])])
        return found

    def exact(self, words: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(item_id, start, words) of the short items in a text; occurrences of an item don't overlap."""
        for m, own in self.short.items():
            after: dict[int, int] = {}
            for s in np.flatnonzero(np.isin(words[: max(0, len(words) - m + 1)], self.short_heads[m])).tolist():
                for item_id in own.get(tuple(words[s : s + m].tolist()), ()):
                    if s >= after.get(item_id, 0):
                        after[item_id] = s + m
                        yield item_id, s, m

    def needed(self, m: int) -> int:
        return max(1, m - 1 - 2 * edits_allowed(m, self.percent))

    def starts(self, words: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """(m, starts) of the windows that share enough pairs with the items of m words."""
        if len(words) < 2 or not len(self.pairs):
            return []
        known = np.flatnonzero((words[:-1] >= 0) & (words[1:] >= 0))
        pair = words[known] * len(self.vocabulary) + words[known + 1]
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        hit = self.pairs[at] == pair
        known, at = known[hit], at[hit]
        each = self.pair_from[at + 1] - self.pair_from[at]
        total = int(each.sum())
        if not total:
            return []
        place = np.repeat(known, each)
        m = self.pair_lengths[np.repeat(self.pair_from[at] - np.cumsum(each) + each, each) + np.arange(total)]
        out = []
        for length, n in zip(*np.unique(m, return_counts=True), strict=True):
            length, need, k = int(length), self.needed(int(length)), edits_allowed(int(length), self.percent)
            if n < need:
                continue
            own = place[m == length]
            near = np.flatnonzero(own[need - 1 :] - own[: len(own) - need + 1] <= length + k - 2)
            if len(near):
                # Starts from which the window holds own[j] .. own[j + need - 1].
                lows, highs = np.maximum(own[near + need - 1] - (length + k - 2), 0), own[near]
                found = np.unique(np.concatenate([np.arange(a, b + 1) for a, b in zip(lows.tolist(), highs.tolist(), strict=True)]))
                out.append((length, found[found <= len(words) - (length - k)]))
        return out

    def keys(self, windows: list[np.ndarray], lengths: np.ndarray) -> np.ndarray:
        """LSH keys, (REPEATS, windows), of sequences compared with items of ``lengths`` words."""
        n, width = len(windows), self.longest
        sheet = np.full((n, width + 1), np.uint64(0xFFFFFFFF), np.uint64)  # the end, again and again
        for i, x in enumerate(windows):
            sheet[i, : len(x)] = (x + 1).astype(np.uint64)  # 0: a word no item has
        symbols, first, place = sheet.ravel(), np.arange(n) * (width + 1), np.zeros((REPEATS, n), np.int64)
        steps = int(2 * lengths.max(initial=0))
        walked = np.empty((steps, REPEATS, n), np.uint64)
        for step in range(steps):
            symbol = np.take(symbols, first + np.minimum(place, width), out=walked[step])
            mixed = (symbol + (self.salt + np.uint64(step * 0xD6E8FEB86659FD93 % 2**64))) * np.uint64(0xBF58476D1CE4E5B9)
            mixed ^= mixed >> np.uint64(31)
            mixed *= np.uint64(0x94D049BB133111EB)
            place += (mixed >> np.uint64(63)).view(np.int64)
        out = np.broadcast_to(lengths.astype(np.uint64), (REPEATS, n)) * np.uint64(0x9E3779B97F4A7C15) + self.salt
        for s in range(SAMPLES):
            at = (self.sampled[:, s, None] * (2 * lengths)[None, :]).astype(np.int64)
            taken = np.take_along_axis(walked, at[None], axis=0)[0]
            out = (out ^ (taken + np.uint64(s + 1))) * np.uint64(0x94D049BB133111EB) + at.astype(np.uint64)
        return out ^ (out >> np.uint64(32))


class _Numbers(dict):
    """The number of the word in a white-space separated part: -1 for a word no item has, -2 for no word, and -3 - i for
    several words, whose numbers are ``several[i]``. Remembered for the frequent parts."""

    def __init__(self, vocabulary: dict[str, int]):
        super().__init__()
        self.vocabulary = vocabulary
        self.several: list[np.ndarray] = []

    def forget(self) -> None:
        if len(self) > 500_000:
            self.clear()
            self.several.clear()

    def __missing__(self, part: str) -> int:
        get = self.vocabulary.get
        spaced = part.isascii() or not _HAS_UNSPACED(part)
        if spaced and part.isalpha():
            n = get(part.lower(), -1)
        elif spaced and part[-1] in ",.!?;:" and part[:-1].isalpha():
            n = get(part[:-1].lower(), -1)
        else:
            words = [get(w.lower(), -1) for w in _WORD.findall(part)]
            n = words[0] if len(words) == 1 else -2
            if len(words) > 1:
                self.several.append(np.array(words, np.int64))
                n = -2 - len(self.several)
        self[part] = n
        return n


class Scan:
    """Finds an index's items in texts."""

    def __init__(self, index: Index):
        self.index = index
        self.numbers = _Numbers(index.vocabulary)

    def _words(self, text: str) -> np.ndarray:
        """Numbers of a text's words, -1 for those no item has. Words never span white space, so parts do for most."""
        self.numbers.forget()
        parts = text.split()
        found = np.fromiter(map(self.numbers.__getitem__, parts), np.int64, len(parts))
        many = np.flatnonzero(found <= -3)
        if len(many):
            pieces, last = [], 0
            for at in many.tolist():
                pieces += [found[last:at], self.numbers.several[-3 - int(found[at])]]
                last = at + 1
            found = np.concatenate([*pieces, found[last:]])
        return found[found != -2]

    def __call__(self, texts: list[str]) -> list[tuple[int, int, int, int, int]]:
        """(text, item_id, start, length, distance) with offsets in characters: for each item, the closest windows that
        don't overlap (ties to the first)."""
        index = self.index
        open_: list[tuple[int, int, int, np.ndarray]] = []
        short: list[tuple[int, int, int, int]] = []
        for t, text in enumerate(texts):
            numbers = self._words(text)
            short.extend((t, *x) for x in index.exact(numbers))
            open_.extend((t, m, s, numbers[s : s + m + edits_allowed(m, index.percent)]) for m, starts in index.starts(numbers) for s in starts.tolist())
        best: dict[tuple[int, int], list[tuple[int, int, int]]] = defaultdict(list)
        for lo in range(0, len(open_), 500):
            part = open_[lo : lo + 500]
            met = index.met([x[3][: x[1]] for x in part], np.array([x[1] for x in part]))
            for (t, m, s, window), own in zip(part, met, strict=True):
                for i in own:
                    item = index.items[i][1]
                    if len(item) == m:
                        d, n = prefix_distance(item, window)
                        if d <= edits_allowed(m, index.percent):
                            best[t, i].append((d, s, n))
        out = []
        spans = {t: [w.span() for w in _WORD.finditer(texts[t])] for t in {t for t, _ in best} | {x[0] for x in short}}
        for t, item_id, s, n in short:
            start, end = spans[t][s][0], spans[t][s + n - 1][1]
            out.append((t, item_id, start, end - start, 0))
        for (t, i), found in best.items():
            taken: list[tuple[int, int]] = []
            for d, s, n in sorted(found):
                if all(s + n <= a or b <= s for a, b in taken):
                    taken.append((s, s + n))
                    start, end = spans[t][s][0], spans[t][s + n - 1][1]
                    out.append((t, index.items[i][0], start, end - start, d))
        return out


_LATEST: dict[str, Scan] = {}


def _scanned(shared, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _LATEST:
            _LATEST.clear()
            _LATEST[name] = Scan(shared.value)
        scan = _LATEST[name]
        for batch in batches:
            found = scan([t or "" for t in batch.column(2).to_pylist()])
            which, item, start, length, distance = zip(*found, strict=True) if found else ((),) * 5
            at = pa.array(which, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(item, pa.int64()), *[pa.array(x, pa.int32()) for x in (start, length, distance)]],
                names=["doc_id", "text_hash", "item_id", "start", "length", "distance"],
            )

    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, percent: int = EDIT_PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """Passages of ``docs(doc_id, text, ...)`` within ``percent`` edits of an item of ``benchmark(item_id, text, ...)``.

    One row for each: doc_id, text_hash, item_id, start and length in characters, distance in words; for each document
    and item the closest windows that don't overlap, ties to the first. Items with null text or fewer than ``min_words``
    words are not looked for, those of fewer than MIN_WORDS without edits; null and empty texts hold none; equal rows count once. The benchmark goes to the tasks in
    blocks of bounded size, each a pass over the documents.
    """
    spark = docs.sparkSession
    python_ready(spark)
    items = benchmark.filter("text is not null").select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    chars = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(chars / BLOCK_CHARS))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), F.col("text").cast("string").alias("text")).filter("text is not null")
    passes = []
    for block in range(blocks):
        own = [tuple(r) for r in items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).distinct().collect()]
        index = Index(sorted(own, key=lambda x: (x[0] is None, x[0], x[1])), percent, min_words=min_words)
        shared = spark.sparkContext.broadcast(index)
        passes.append(rows.mapInArrow(_scanned(shared, f"{shared._jbroadcast.id()}/{spark.sparkContext.applicationId}"), "doc_id long, text_hash long, item_id long, start int, length int, distance int"))
    return reduce(DataFrame.unionByName, passes).distinct()


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, percent: int = EDIT_PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """The rows of ``docs`` without a passage of the benchmark, as they are."""
    lost = small_or_shuffled(contaminated(docs, benchmark, percent, min_words).select("doc_id", "text_hash").distinct(), "leaks")
    return unpacked(rows_of(docs, lost, "left_anti"), docs.columns)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), min_words=1)
