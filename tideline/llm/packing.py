"""Best-fit packing of tokenised documents, certified by dual-feasible-function lower bounds.

Pieces of at most one sequence are dealt to partitions of bounded size; each is packed by best-fit decreasing and its
number of sequences compared with a lower bound. Partitions whose count exceeds the bound release their sequences that
have room, partitions that meet it release only their emptiest one; what is released is dealt to partitions anew and
packed again, until the total meets the bound of the whole or a round saves nothing worth while.
"""

from __future__ import annotations

import math
import unicodedata
import zlib
from array import array
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import python_ready, table, written

CAPACITY = 4096
END = 1
#: Pieces that one task packs at a time.
PART_PIECES = 40_000


class Tokenizer:
    """Token ids of texts, equal to those of the tokenizer itself.

    This vocabulary's pre-tokenizer never joins characters across white space, nor letters with what isn't a letter, so a
    text's ids are those of its white-space separated parts, and those of a word with ASCII marks behind it are those of
    the word and of the marks. The distinct parts of a batch are looked up once each; lower-cased words are remembered,
    and a new word of letters goes straight to the byte-pair model. Texts in which that doesn't hold go through the
    tokenizer whole: those with special tokens' marks, with control characters that Arrow takes for white space and the
    tokenizer doesn't, and with parts that begin with a combining mark.
    """

    def __init__(self, path: str, remember: int = 500_000):
        from tokenizers import Tokenizer as Backend

        self.backend, self.remember = Backend.from_file(path), remember
        self.backend.model._resize_cache(0)  # every word comes once
        #: Ids of lower-cased words, of runs of marks, and of other parts; ``older`` holds the words before the last clearing.
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {"": b""}

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.backend.encode_batch_fast(texts, add_special_tokens=False)]

    def _word(self, word: str) -> bytes:
        """Ids of a word of lower-case letters, which to the model is a string of byte letters."""
        known = self.older.get(word)
        if known is None:
            plain = word if word.isascii() else word.encode().decode("latin-1").translate(_BYTE_LETTERS)
            known = array("I", [t.id for t in self.backend.model.tokenize(plain)]).tobytes()
        self.words[word] = known
        return known

    def _part(self, part: str) -> bytes | None:
        """Ids of a part, or None for a part that begins with a combining mark."""
        word = part.rstrip(_MARKS)
        mark = part[len(word) :]
        if not word.isascii():
            if unicodedata.combining(word[0]):
                return None
            whole = not word.isalpha() or "\u03a3" in word or not unicodedata.is_normalized("NFC", word)
        else:
            whole = not word.isalpha() and word != ""
        low = word.lower()
        if whole or not low.isalpha() and word:
            return self._encode([part])[0]
        if mark not in self.marks:
            if len(self.marks) > self.remember:
                self.marks = {"": b""}
            self.marks[mark] = self._encode([mark])[0]
        ids = (self.words.get(low) or self._word(low)) if word else b""
        return ids + self.marks[mark]

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and where each text's begin (one place more than texts)."""
        if len(self.words) > self.remember:
            self.words, self.older = {}, self.words
        texts = pc.fill_null(texts, "")
        split = pc.utf8_split_whitespace(texts)
        found = split.flatten().dictionary_encode()
        parts = [self._part(x) if x else b"" for x in found.dictionary.to_pylist()]
        index = found.indices.to_numpy()
        ends = split.offsets.to_numpy() - split.offsets[0].as_py()
        whole = pc.or_(pc.match_substring(texts, "<|"), pc.match_substring_regex(texts, "[\x1c-\x1f]")).to_numpy(zero_copy_only=False)
        strange = np.array([x is None for x in parts], bool)
        if strange.any():
            whole = whole | np.array([strange[index[a:b]].any() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)], bool)
        parts = [x or b"" for x in parts]
        size = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        pool, begin = np.frombuffer(b"".join(parts), np.uint32), np.cumsum(size) - size
        each = size[index]
        reached = np.concatenate([[0], np.cumsum(each)])
        ids = pool[np.repeat(begin[index] - reached[:-1], each) + np.arange(reached[-1])]
        starts = reached[ends]
        at = np.flatnonzero(whole)
        if not len(at):
            return ids, starts
        own = np.split(ids, starts[1:-1])
        for i, x in zip(at.tolist(), self._encode(texts.take(pa.array(at)).to_pylist()), strict=True):
            own[i] = np.frombuffer(x, np.uint32)
        return np.concatenate(own), np.concatenate([[0], np.cumsum([len(x) for x in own])])


_MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())
#: The letters that stand for bytes in byte-level vocabularies: printable ones for themselves, the rest from 256 on.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_LETTERS = {b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in _SHOWN)}
_TOKENIZERS: dict[str, Tokenizer] = {}


def _pieces(path: str | None, capacity: int, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers

        at = path or public_tokenizers.path("word_bpe_49k.json")
        if at not in _TOKENIZERS:
            _TOKENIZERS[at] = Tokenizer(at)
        for batch in batches:
            if not len(batch):
                continue
            ids, starts = _TOKENIZERS[at](batch.column(1))
            ids = np.insert(ids, starts[1:], END).astype(np.uint32)
            starts = starts + np.arange(len(starts))
            tokens = np.diff(starts)
            number = -(-tokens // capacity)
            which = np.repeat(np.arange(len(tokens)), number)
            piece = np.arange(len(which)) - np.repeat(np.cumsum(number) - number, number)
            start = piece * capacity
            length = np.minimum(tokens[which] - start, capacity)
            first = starts[:-1][which] + start
            raw = memoryview(ids.tobytes())
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(first.tolist(), (first + length).tolist(), strict=True)]
            columns = [batch.column(0).take(pa.array(which)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if keep_ids:
                columns.append(pa.ListArray.from_arrays(pa.array([*first.tolist(), len(ids)], pa.int32()), pa.array(ids.view(np.int32))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def tokenized_pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer_path: str | None = None, keep_ids: bool = True) -> DataFrame:
    """Every document of ``docs(doc_id, text, ...)`` as pieces of at most ``capacity`` ids: doc_id, piece, start,
    length, ids_crc32 and, if asked for, ids. Null text counts as empty: its only id is the end."""
    python_ready(docs.sparkSession)
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_pieces(tokenizer_path, capacity, keep_ids), schema)


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The bin of each item. Open bins are kept by room; the tightest that fits is found in one integer of bits."""
    bins = np.empty(len(lengths), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms, n = 0, 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fits = open_rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                open_rooms &= ~(1 << room)
        else:
            room, b, n = capacity, n, n + 1
        bins[i] = b
        left = room - size
        if left:
            by_room[left].append(b)
            open_rooms |= 1 << left
    return bins


def lower_bound(counts: dict[int, int] | np.ndarray, capacity: int) -> int:
    """The best of the dual-feasible-function bounds on the bins that items need; ``counts[size]`` items of each size.

    For every threshold t up to half the capacity: sizes over capacity - t count as whole bins, sizes from t as they
    are, smaller ones as nothing. And for every k: sizes are rounded by u(k): x(k+1) integral stays, else floor((k+1)x)/k.
    """
    if isinstance(counts, dict):
        dense = np.zeros(capacity + 1, np.int64)
        for size, n in counts.items():
            dense[size] = n
        counts = dense
    sizes = np.arange(capacity + 1, dtype=np.int64)
    volume = np.cumsum(counts * sizes)
    number = np.cumsum(counts)
    best = -(-int(volume[-1]) // capacity)
    t = np.arange(1, capacity // 2 + 1)
    large = number[-1] - number[capacity - t]
    middle = volume[capacity - t] - volume[t - 1]
    best = max(best, int((large + -(-middle // capacity)).max(initial=0)))
    for k in range(1, 21):
        scaled = (k + 1) * sizes
        whole = scaled % capacity == 0
        # In units of 1 / (k * capacity): exact integers.
        value = np.where(whole, sizes * k, scaled // capacity * capacity)
        best = max(best, -(-int((counts * value).sum()) // (k * capacity)))
    return best


def _packed(capacity: int):
    """Pack a group again; keep the earlier packing (``bin``) where the new one isn't better."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "piece", "pid"], ascending=[False, True, True, True], kind="stable").reset_index(drop=True)
        lengths = rows["length"].to_numpy()
        new = best_fit_decreasing(lengths, capacity)
        bins = new
        if rows["bin"].notna().all():
            old = rows.groupby(["part", "bin"]).ngroup().to_numpy()
            bins = old if old.max(initial=-1) <= new.max(initial=-1) else new
        fill = np.bincount(bins, weights=lengths).astype(np.int64)
        bound = lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
        gap = len(fill) - bound
        rows["part"], rows["bin"], rows["gap"] = np.int64(key[0]), bins, gap
        # Of a certified part only the emptiest bin goes on; of others every bin with room.
        go = fill < capacity if gap else np.arange(len(fill)) == int(fill.argmin())
        rows["released"] = go[bins] & (fill[bins] < capacity)
        order = np.argsort(bins, kind="stable")
        before = np.cumsum(lengths[order]) - lengths[order]
        rows.loc[order, "offset"] = before - (np.cumsum(fill) - fill)[bins[order]]
        return rows.drop(columns="grp").astype({"offset": "int64"})

    return run


_STATE = "pid long, doc_id long, piece int, length long, part long, bin long, gap long, released boolean, offset long"


def pack(pieces: DataFrame, capacity: int = CAPACITY, part_pieces: int = PART_PIECES) -> DataFrame:
    """``pieces`` with sequence_id and offset: every piece in one sequence, none over ``capacity``, offsets gapless.

    ``pieces`` must hold lengths from 1 to capacity. Tasks hold at most about ``part_pieces`` pieces whatever the data
    look like: pieces, and later released sequences, are dealt evenly by number, not by any key. Rounds go on until the
    number of sequences meets the bound of all pieces or a round saves nothing. An empty table gives an empty result.
    """
    python_ready(pieces.sparkSession)
    pieces = written(pieces.withColumn("pid", F.monotonically_increasing_id()), "pieces")
    slim = pieces.select("pid", "doc_id", "piece", "length")
    n = slim.count()
    sums = {r["length"]: r["n"] for r in slim.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # capacity rows at most
    bound = lower_bound(sums, capacity)
    parts = max(1, math.ceil(n / part_pieces))
    first = slim.select("pid", "doc_id", "piece", "length", F.lit(None).cast("long").alias("part"), F.lit(None).cast("long").alias("bin"))
    todo, done, settled, taken, turn = first.withColumn("grp", F.pmod(F.xxhash64("pid"), F.lit(parts))), [], 0, None, 0
    while True:
        state = written(todo.groupBy("grp").applyInPandas(_packed(capacity), _STATE), f"round{turn}")
        count = {r["released"]: r["n"] for r in state.filter("offset = 0").groupBy("released").agg(F.count(F.lit(1)).alias("n")).collect()}
        packed = sum(count.values())
        saved = None if taken is None else taken - packed
        last = settled + packed <= bound or not count.get(True) or (saved is not None and saved < 1)
        # turn, part and bin in one number.
        sequence = F.shiftleft(F.lit(turn).cast("long"), 56) + F.shiftleft("part", 32) + F.col("bin")
        done.append((state if last else state.filter("not released")).select("pid", sequence.alias("sequence_id"), "offset"))
        if last:
            break
        settled, taken = settled + count.get(False, 0), count[True]
        loose = state.filter("released")
        parts = max(1, math.ceil(loose.count() / part_pieces))
        turn += 1
        # Whole sequences move together, so a part that can't do better keeps them.
        grp = F.pmod(F.xxhash64(F.lit(turn), "part", "bin"), F.lit(parts))
        todo = loose.select("pid", "doc_id", "piece", "length", "part", "bin", grp.alias("grp"))
    return pieces.join(reduce(DataFrame.unionByName, done), "pid").drop("pid")


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, tokenizer_path: str | None = None, keep_ids: bool = True) -> DataFrame:
    """Tokenise and pack ``docs``: one row for each piece, see ``tokenized_pieces`` and ``pack``.

    Rows with a null or repeated doc_id are documents like others; other columns of ``docs`` are not carried.
    """
    return pack(tokenized_pieces(docs, capacity, tokenizer_path, keep_ids), capacity)


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), keep_ids=False).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
