"""MinHash near-dedup: universal hash minima, banding, signature verification, exact confirmation, star components.

A document is the set of its word shingles. Documents with the same words are one class; classes that share a band of
minima are candidates. In a bucket, one class (the hub) is compared with the others: pairs within a component need no more
comparison, so a bucket of thousands of copies costs about its size. Buckets that still hold several components are
finished pairwise if that is few pairs, else by another hub, and at last in blocks: two blocks of a bucket meet in one
task, which compares their signatures as matrices and returns links alone. So no link between components is missed, no
bucket is expanded into all its pairs, and no task holds more than two blocks.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import python_ready, rows_of, table, unpacked, written
from .components import connected_components

#: A bucket is finished at once, by comparing its classes pairwise across components, if that is at most so many pairs
#: for each of its classes.
PAIRS_A_ROW = 6
#: Hub rounds before what is left of a bucket is compared in blocks.
HUB_ROUNDS = 1
#: Classes of a block.
BLOCK = 512


@dataclass(frozen=True)
class NearDup:
    """Links are pairs with 100 * |intersection| >= percent * |union| of ``words``-word shingle sets.

    ``bands`` bands of ``rows`` minima: a pair at the threshold is missed with probability (1 - s^rows)^bands, which is
    3e-5 for both 48 bands of 10 at 0.85 and 56 bands of 8 at 0.8.
    """

    words: int = 5
    percent: int = 80
    bands: int = 56
    rows: int = 8
    seed: int = 7

    @property
    def minima(self) -> int:
        return self.bands * self.rows


class _WordHashes(dict):
    """Hash of each word, remembered for the frequent ones."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_HASHES = _WordHashes()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text, A-Z lowered: bytes.lower and bytes.split know ASCII only, as the definition asks."""
    return text.lower().split()


def shingle_set(words: list[bytes], k: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; fewer than k words make one shingle, none make none."""
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, n)
    k = min(k, n)
    s = np.full(n - k + 1, k, np.uint64)
    for j in range(k):
        s = s * np.uint64(0x9E3779B97F4A7C15) + w[j : n - k + 1 + j]
        s ^= s >> np.uint64(29)
    return np.unique(_mixed(s))


def _features(p: NearDup):
    rng = np.random.default_rng(p.seed)
    # Multiply-shift hashing: x -> a * x mod 2^32 with odd a is universal in its high bits, which decide a minimum.
    mult = (rng.integers(0, 2**32, p.minima, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
    room = np.empty((256, p.minima), np.uint32)
    weight = rng.integers(0, 2**63, p.rows, dtype=np.uint64) | np.uint64(1)
    band_no = np.arange(p.bands, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)

    def minima(shingles: np.ndarray) -> np.ndarray:
        x = (shingles >> np.uint64(32)).astype(np.uint32)
        least = np.full(p.minima, 0xFFFFFFFF, np.uint32)
        for i in range(0, len(x), len(room)):
            part = x[i : i + len(room), None]
            np.minimum(least, np.multiply(part, mult, out=room[: len(part)]).min(axis=0), out=least)
        return least

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                words = words_of(text or b"")
                if not words:
                    out.append((0, None, None, None, None))
                    continue
                digest = xxhash.xxh3_128_digest(b" ".join(words))
                shingles = shingle_set(words, p.words)
                least = minima(shingles)
                keys = _mixed((least.astype(np.uint64).reshape(p.bands, p.rows) * weight).sum(axis=1, dtype=np.uint64) + band_no)
                sign = (_mixed(least.astype(np.uint64)) & np.uint64(0xFF)).astype(np.uint8).tobytes()
                out.append((len(shingles), *np.frombuffer(digest, np.int64).tolist(), keys.view(np.int64), sign))
            n, d1, d2, keys, sign = zip(*out, strict=True) if out else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), pa.array(keys, pa.list_(pa.int64())), pa.array(sign, pa.binary())],
                names=["doc_id", "text_hash", "n_shingles", "d1", "d2", "bands", "sign"],
            )

    return run


def features(docs: DataFrame, p: NearDup) -> DataFrame:
    """doc_id, text_hash, n_shingles, digest of the word sequence (d1, d2), band keys and signature; nulls for no words."""
    python_ready(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("text_hash"))
    return rows.mapInArrow(_features(p), "doc_id long, text_hash long, n_shingles long, d1 long, d2 long, bands array<long>, sign binary")


def _confirm(p: NearDup):
    """Exact similarity on the full sets of both texts, for texts that are those of the classes they stand for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recent: OrderedDict[tuple, np.ndarray | None] = OrderedDict()

        def shingles(node: int, d1: int, d2: int, text: bytes) -> np.ndarray | None:
            key = (node, xxhash.xxh3_64_intdigest(text))
            if key not in recent:
                words = words_of(text)
                own = np.frombuffer(xxhash.xxh3_128_digest(b" ".join(words)), np.int64).tolist() == [d1, d2]
                recent[key] = shingle_set(words, p.words) if own else None
                if len(recent) > 64:
                    recent.popitem(last=False)
            return recent[key]

        for batch in batches:
            c = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            a, b = (c[f"{x}"].to_pylist() for x in ("a", "b"))
            sides = [zip(n, c[f"{x}_d1"].to_pylist(), c[f"{x}_d2"].to_pylist(), c[f"{x}_text"].cast(pa.binary()).to_pylist(), strict=True) for x, n in (("a", a), ("b", b))]
            found = []
            for i, (left, right) in enumerate(zip(*sides, strict=True)):
                x, y = shingles(*left), shingles(*right)
                if x is not None and y is not None:
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    if 100 * both >= p.percent * (len(x) + len(y) - both):
                        found.append(i)
            take = pa.array(found, pa.int32())
            yield pa.RecordBatch.from_arrays([c["a"].take(take), c["b"].take(take)], names=["a", "b"])

    return run


def _shingled(p: NearDup):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(words, p.words).view(np.int64) if np.frombuffer(xxhash.xxh3_128_digest(b" ".join(words)), np.int64).tolist() == [d1, d2] else None for d1, d2, words in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), map(words_of, batch.column(3).cast(pa.binary()).to_pylist()), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["node", "shingles"])

    return run


def class_texts(nodes: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """node, d1, d2 and text of a document of each class: of all rows with the class's first doc_id, so that readers tell
    by d1 and d2 which is its text."""
    keyed = nodes.join(classes.select("node", "first_doc", "d1", "d2"), "node")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.join(keyed, rows["doc_id"].eqNullSafe(keyed["first_doc"])).select("node", "d1", "d2", "text").filter("text is not null")


def _least_agreement(p: NearDup) -> float:
    """Share of equal signature bytes, less chance, that linked sets have: five standard errors below the threshold."""
    share = p.percent / 100
    return share - 5 * (share * (1 - share) / p.minima) ** 0.5


def _agreement(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Estimated similarity of signatures, row by row or all against all as their shapes have it."""
    return (np.count_nonzero(x == y, axis=-1) / x.shape[-1] - 1 / 256) / (1 - 1 / 256)


def _blocks_linked(p: NearDup):
    def run(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[int, int]] = []
        if len(left) and len(right):
            signs = [np.stack([np.frombuffer(x, np.uint8) for x in side["sign"]]) for side in (left, right)]
            sets = [[np.sort(np.asarray(x, np.int64)) for x in side["shingles"]] for side in (left, right)]
            nodes, parts = ([side[c].to_numpy() for side in (left, right)] for c in ("node", "component"))
            for i in range(len(left)):
                may = (parts[1] != parts[0][i]) & ((nodes[1] > nodes[0][i]) if key[1] == key[2] else True)
                at = np.flatnonzero(may)
                at = at[_agreement(signs[0][i][None, :], signs[1][at]) >= _least_agreement(p)]
                for j in at.tolist():
                    x, y = sets[0][i], sets[1][j]
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    if 100 * both >= p.percent * (len(x) + len(y) - both):
                        found.append((int(nodes[0][i]), int(nodes[1][j])))
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return run


def block_links(rows: DataFrame, classes: DataFrame, texts: DataFrame, p: NearDup) -> DataFrame:
    """Links between components among ``rows(key, n, node, component)``: classes of a bucket of n, by their full sets."""
    sets = texts.join(rows.select("node").distinct(), "node", "left_semi").mapInArrow(_shingled(p), "node long, shingles array<long>").filter("shingles is not null").dropDuplicates(["node"])
    full = rows.join(sets, "node").join(classes.select("node", "sign"), "node")
    number = F.ceil(F.col("n") / BLOCK).cast("int")
    placed = written(full.withColumns({"blocks": number, "block": F.pmod(F.xxhash64("node"), number).cast("int")}), "blocks")
    side = ["node", "component", "sign", "shingles"]
    left = placed.select("key", F.col("block").alias("i"), F.explode(F.sequence(F.col("block"), F.col("blocks") - 1)).alias("j"), *side)
    right = placed.select(F.col("key").alias("key_"), F.explode(F.sequence(F.lit(0), F.col("block"))).alias("i_"), F.col("block").alias("j_"), *[F.col(c).alias(c) for c in side])
    return left.groupBy("key", "i", "j").cogroup(right.groupBy("key_", "i_", "j_")).applyInPandas(_blocks_linked(p), "a long, b long").distinct()


def verified(pairs: DataFrame, classes: DataFrame, texts: DataFrame, p: NearDup) -> DataFrame:
    """The ``pairs(a, b)`` of classes that are links: first by signatures, then on full sets of ``texts``, which are
    those of ``class_texts``."""
    spark = pairs.sparkSession
    left = classes.select(F.col("node").alias("a"), F.col("sign").alias("a_sign"), F.col("n_shingles").alias("a_n"))
    right = classes.select(F.col("node").alias("b"), F.col("sign").alias("b_sign"), F.col("n_shingles").alias("b_n"))
    sized = F.least("a_n", "b_n") * 100 >= F.greatest("a_n", "b_n") * p.percent
    signed = pairs.join(left, "a").join(right, "b").filter(sized).select("a", "b", "a_sign", "b_sign")
    near = written(signed.mapInArrow(_agree(p), "a long, b long"), "candidates")
    wanted = near.select(F.col("a").alias("node")).unionByName(near.select(F.col("b").alias("node"))).distinct()
    own = texts.join(wanted, "node", "left_semi")
    side = lambda x: own.select(F.col("node").alias(x), *[F.col(c).alias(f"{x}_{c}") for c in ("d1", "d2", "text")])
    python_ready(spark)
    return near.join(side("a"), "a").join(side("b"), "b").mapInArrow(_confirm(p), "a long, b long").distinct()


def _agree(p: NearDup):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, p.minima) for i in (2, 3))
            found = np.flatnonzero(_agreement(x, y) >= _least_agreement(p))
            take = pa.array(found, pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take)], names=["a", "b"])

    return run


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels(node, component)`` after ``links`` between nodes: components are contracted, then linked."""
    if links.isEmpty():
        return labels
    of = lambda x: labels.select(F.col("node").alias(x), F.col("component").alias(f"{x}_of"))
    ends = links.join(of("a"), "a", "left").join(of("b"), "b", "left").select("a", "b", F.coalesce("a_of", "a").alias("x"), F.coalesce("b_of", "b").alias("y"))
    ends = written(ends, "ends")
    moves = connected_components(ends.select(F.col("x").alias("a"), F.col("y").alias("b"))).select(F.col("node").alias("component"), F.col("component").alias("to"))
    new = ends.select(F.col("a").alias("node")).unionByName(ends.select(F.col("b").alias("node"))).distinct().join(labels, "node", "left_anti").select("node", F.col("node").alias("component"))
    return written(labels.unionByName(new).join(moves, "component", "left").select("node", F.coalesce("to", "component").alias("component")), "labels")


def near_duplicates(docs: DataFrame, p: NearDup = NearDup()) -> DataFrame:
    """Every row of ``docs(doc_id, text, ...)`` as doc_id, n_shingles, component_id, kept, text_hash.

    component_id is the smallest doc_id that links lead to; kept says that it is the row's own. Null or blank texts
    have no shingles and link with nothing. Equal rows get equal results; rows that repeat a doc_id with other texts
    are linked by their own texts. A null doc_id is never a component_id while another is reachable, and such a row is
    kept only if it stands alone.
    """
    # Classes of equal word sequences; their number is assigned once, by writing it.
    feats = written(features(docs, p), "features")
    classes = written(
        feats.filter("n_shingles > 0")
        .groupBy("d1", "d2")
        .agg(F.min("doc_id").alias("first_doc"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"), F.first("sign").alias("sign"))
        .withColumn("node", F.monotonically_increasing_id()),
        "classes",
    )
    banded = classes.select("node", F.explode("bands").alias("key"))
    # Each bucket's hub is drawn by its key: a large group, which shares many buckets, gets many hubs at once.
    drawn = F.min(F.col("node").bitwiseXOR(F.col("key"))).bitwiseXOR(F.col("key"))
    print_ = F.bit_xor(F.xxhash64("node")).alias("print")
    hubs = banded.groupBy("key").agg(drawn.alias("hub"), F.count(F.lit(1)).alias("n"), print_).filter("n > 1")
    # Buckets of the same classes say the same: one of them is enough.
    hubs = hubs.groupBy("n", "print").agg(F.min("key").alias("key"), F.min_by("hub", "key").alias("hub")).select("key", "hub")
    members = written(banded.join(hubs, "key"), "buckets")
    pairs = written(members.filter("node <> hub").select(F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b")).distinct(), "pairs")
    # All that the rounds compare is in some bucket: its texts are looked up once for all of them.
    texts = written(class_texts(members.select("node").distinct(), classes, docs), "texts")
    labels = connected_components(verified(pairs, classes, texts, p))
    still, tested = members.filter("node <> hub").select("key", "node"), pairs  # the hubs have met all others
    for turn in range(HUB_ROUNDS + 1):
        # Only buckets that hold several components can hold links that aren't known yet.
        named = still.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
        sizes = named.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"), F.min(F.col("node").bitwiseXOR(F.xxhash64(F.lit(turn), "key"))).alias("drawn"))
        mixed = (
            sizes.groupBy("key")
            .agg(F.count(F.lit(1)).alias("components"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("within"), F.min("drawn").bitwiseXOR(F.xxhash64(F.lit(turn), "key")).alias("hub"))
            .filter("components > 1")
            .select("key", "hub", "n", (F.col("n") * F.col("n") - F.col("within") <= 2 * PAIRS_A_ROW * F.col("n")).alias("few"))
        )
        still = written(named.join(mixed, "key"), f"open{turn}")
        few, many = still.filter("few"), still.filter("not few")
        other = few.select("key", F.col("node").alias("b"), F.col("component").alias("other"))
        across = few.join(other, "key").filter("node < b and component <> other").select(F.col("node").alias("a"), "b")
        hub_of = many.filter("node = hub").select("key", F.col("component").alias("other"))
        spokes = many.join(hub_of, "key").filter("component <> other").select(F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b"))
        fresh = written((across if turn == HUB_ROUNDS else across.unionByName(spokes)).distinct().join(tested, ["a", "b"], "left_anti"), f"pairs{turn}")
        found = [] if fresh.isEmpty() else [verified(fresh, classes, texts, p)]
        if turn == HUB_ROUNDS and not many.isEmpty():
            found.append(block_links(many.select("key", "n", "node", "component"), classes, texts, p))
        if found:
            labels = merged(labels, written(reduce(DataFrame.unionByName, found), f"links{turn}"))
        tested = tested.unionByName(fresh)
        still = many.filter("node <> hub").select("key", "node")
        if still.isEmpty():
            break
    # Smallest doc_id of each component, then of each class.
    named = classes.select("node", "d1", "d2", "first_doc").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = named.groupBy("component").agg(F.min("first_doc").alias("least_doc"))
    final = named.join(smallest, "component").select("d1", "d2", F.col("least_doc"))
    out = feats.select("doc_id", "text_hash", "n_shingles", "d1", "d2").join(final, ["d1", "d2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("least_doc")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "text_hash")


def drop_near_duplicates(docs: DataFrame, p: NearDup = NearDup()) -> DataFrame:
    """The rows of ``docs`` whose document is the kept one of its group, all their columns as they are.

    Of rows that repeat both doc_id and text, one stays.
    """
    found = near_duplicates(docs, p).filter("kept").select("doc_id", "text_hash").distinct()
    return unpacked(rows_of(docs, found, "left_semi").dropDuplicates(["own_id", "own_hash"]), docs.columns)


#: The contract of op1: 3-word shingles at 0.85.
OP1 = NearDup(words=3, percent=85, bands=48, rows=10)


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), OP1)
