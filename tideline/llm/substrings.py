"""Substring dedup by content-defined chunking.

A gear rolling hash cuts each text where the hash of the last 32 bytes has low bits zero, so cuts depend on content
alone and an insertion moves the cuts next to it only. Chunks are deduplicated by digest: the first in corpus order
(smallest doc_id, then position) stays. Runs of adjacent chunks that occur earlier are repeated passages; runs too
short to be a passage are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import python_ready, table, without, written

#: Cut where this many top bits of the hash are zero: a cut every 32 bytes on average, after at least MIN_CHUNK.
CUT_BITS = 5
MIN_CHUNK = 16
#: Text without a cut for this long is cut all the same.
MAX_CHUNK = 1024
#: Repeated passages are runs of repeated chunks of at least this many bytes.
MIN_PASSAGE = 88

_GEAR = np.random.default_rng(11).integers(0, 2**32, 256, dtype=np.uint32)


def gear_cuts(data: bytes) -> list[int]:
    """Ends of the chunks of ``data``, the last one included."""
    n = len(data)
    if not n:
        return []
    h = _GEAR[np.frombuffer(data, np.uint8)]
    # Sum of gear[b] << age over the last 32 bytes, by doubling the span five times.
    for span in (1, 2, 4, 8, 16):
        older = np.zeros_like(h)
        older[span:] = h[:-span] if span < n else 0
        h = h + (older << np.uint32(span))
    marks = (np.flatnonzero(h < np.uint32(1 << (32 - CUT_BITS))) + 1).tolist()
    cuts, last = [], 0
    for m in marks:
        while m - last > MAX_CHUNK:
            last += MAX_CHUNK
            cuts.append(last)
        if m - last >= MIN_CHUNK:
            cuts.append(m)
            last = m
    while n - last > MAX_CHUNK:
        last += MAX_CHUNK
        cuts.append(last)
    if last < n:
        cuts.append(n)
    return cuts


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    digest = xxhash.xxh3_128_digest
    for batch in batches:
        which, pos, starts, lengths, digests = [], [], [], [], []
        for i, data in enumerate(batch.column(2).cast(pa.binary()).to_pylist()):
            last = 0
            for k, end in enumerate(gear_cuts(data or b"")):
                pos.append(k)
                starts.append(last)
                lengths.append(end - last)
                digests.append(digest(data[last:end]))
                last = end
            which.extend([i] * (len(pos) - len(which)))
            if len(pos) > 200_000:
                yield _rows(batch, which, pos, starts, lengths, digests)
                which, pos, starts, lengths, digests = [], [], [], [], []
        yield _rows(batch, which, pos, starts, lengths, digests)


def _rows(batch: pa.RecordBatch, which: list, pos: list, starts: list, lengths: list, digests: list) -> pa.RecordBatch:
    at = pa.array(which, pa.int32())
    two = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays(
        [batch.column(0).take(at), batch.column(1).take(at), pa.array(pos, pa.int32()), pa.array(starts, pa.int32()), pa.array(lengths, pa.int32()), pa.array(two[:, 0]), pa.array(two[:, 1])],
        names=["doc_id", "text_hash", "pos", "start", "length", "d1", "d2"],
    )


def chunks(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, pos, start, length (bytes of UTF-8) and digest (d1, d2) of every chunk of every text."""
    python_ready(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_chunked, "doc_id long, text_hash long, pos int, start int, length int, d1 long, d2 long")


def repeated_passages(docs: DataFrame, min_bytes: int = MIN_PASSAGE) -> DataFrame:
    """Passages of ``docs(doc_id, text, ...)`` that occur earlier in the corpus.

    One row for each: doc_id, text_hash, start and length in bytes of UTF-8, chunks, and first_docs, the doc_ids of
    the documents where its chunks occur first (a chunk has one, so the list is no longer than the passage). Corpus order is doc_id, then position, so of any chunk one
    occurrence is never listed. Null and empty texts have no passages; equal rows count once, and rows that repeat a
    doc_id with another text are told apart by their text. Rows with null doc_id come first in the order.
    """
    # A digest shared by many chunks is summed up by partial aggregates; its chunks meet the sum in a join.
    every = written(chunks(docs), "chunks")
    order = F.struct("doc_id", "text_hash", "pos")
    firsts = every.groupBy("d1", "d2").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_doc")).filter("n > 1").drop("n")
    shared = written(every.join(firsts, ["d1", "d2"]), "shared")
    # The first occurrence: in the smallest document, its smallest place.
    heads = shared.filter(F.col("doc_id").eqNullSafe(F.col("first_doc"))).groupBy("d1", "d2").agg(F.min(order).alias("head"))
    later = shared.join(heads, ["d1", "d2"]).filter(~order.eqNullSafe(F.col("head"))).select("doc_id", "text_hash", "pos", "start", "length", "first_doc").distinct()
    nth = F.row_number().over(Window.partitionBy("doc_id", "text_hash").orderBy("pos"))
    runs = later.withColumn("run", F.col("pos") - nth).groupBy("doc_id", "text_hash", "run")
    spans = runs.agg(F.min("start").alias("start"), F.sum("length").cast("int").alias("length"), F.count(F.lit(1)).cast("int").alias("chunks"), F.sort_array(F.collect_set("first_doc")).alias("first_docs"))
    return spans.filter(F.col("length") >= min_bytes).drop("run")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text, spans in zip(batch.column(2).cast(pa.binary()).to_pylist(), batch.column(3).to_pylist(), strict=True):
            kept, last = [], 0
            for span in spans:
                kept.append(text[last : span["start"]])
                last = span["start"] + span["length"]
            # A cut may fall inside a character; what is left of it goes.
            out.append(b"".join([*kept, text[last:]]).decode("utf-8", "ignore"))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string())], names=["their_id", "their_hash", "their_text"])


def remove_repeated_passages(docs: DataFrame, min_bytes: int = MIN_PASSAGE) -> DataFrame:
    """``docs`` without its repeated passages, and ``removed_bytes`` (long); other columns and rows stay as they are."""
    spans = repeated_passages(docs, min_bytes).groupBy(F.col("doc_id").alias("their_id"), F.col("text_hash").alias("their_hash")).agg(F.sort_array(F.collect_list(F.struct("start", "length"))).alias("spans"))
    rest = without(docs, "removed_bytes")
    # A row travels as one struct, so no name of its columns can clash.
    rows = rest.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("own_id"), F.xxhash64("text").alias("own_hash"), F.col("text").alias("own_text"))
    same = F.col("own_id").eqNullSafe(F.col("their_id")) & (F.col("own_hash") == F.col("their_hash"))
    some = rows.drop("row").join(spans, same).select("their_id", "their_hash", "own_text", "spans").dropDuplicates(["their_id", "their_hash"])
    cut = some.mapInArrow(_cut, "their_id long, their_hash long, their_text string")
    text = F.when(F.col("their_hash").isNull(), F.col("own_text")).otherwise(F.col("their_text"))
    fields = [text.alias(c) if c.lower() == "text" else F.col(f"row.`{c}`").alias(c) for c in rest.columns]
    return rows.join(cut, same, "left").select(*fields, F.coalesce(F.octet_length("own_text") - F.octet_length(text), F.lit(0)).cast("long").alias("removed_bytes"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))
