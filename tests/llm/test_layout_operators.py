"""Sharding, packing, WARC, exact search and the pipeline."""

import base64
import gzip
import hashlib
import math
import random
import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.oracle import DATA
from tideline.llm import packing
from tideline.llm.common import shared_folder, written
from tideline.llm.sharding import _hypergeometric, communication_matrix, log_hypergeometric, op4_sharding, shard_sizes, shuffle_to_shards
from tideline.llm.topk import top_inner_products
from tideline.llm.warc import parse_records, plan_records, read_archives, read_records, resolve_revisits, write_archives


def test_matrix_has_exact_sums_and_the_right_mean():
    rows, shards = [30, 0, 50, 20], shard_sizes(100, 8)
    draws = np.array([communication_matrix(rows, shards, s) for s in range(800)])
    assert (draws.sum(axis=2) == rows).all() and (draws.sum(axis=1) == shards).all()
    want = np.outer(rows, shards) / 100
    spread = want * (1 - np.array(rows)[:, None] / 100) * (100 - np.array(shards)[None, :]) / 99
    assert (abs(draws.mean(axis=0) - want) <= 4.5 * np.sqrt(spread / 800) + 1e-9).all()
    assert np.allclose(draws.var(axis=0), spread, rtol=0.35, atol=0.02)


def exact_probability(good, bad, draws, k):
    return Fraction(math.comb(good, k) * math.comb(bad, draws - k), math.comb(good + bad, draws))


@pytest.mark.parametrize(("good", "bad", "draws"), [(5, 3, 4), (40, 60, 30), (3000, 21000, 900), (10**12, 7 * 10**12, 600), (125 * 10**9, 875 * 10**9, 800), (2 * 10**9, 6 * 10**9, 5)])
def test_hypergeometric_probabilities_are_exact(good, bad, draws):
    low, high = max(0, draws - bad), min(draws, good)
    mode = (draws + 1) * (good + 1) // (good + bad + 2)
    for k in {low, high, mode, *range(max(low, mode - 25), min(high, mode + 25))}:
        want = exact_probability(good, bad, draws, k)
        if want > Fraction(1, 10**200):
            assert math.exp(log_hypergeometric(good, bad, draws, k)) == pytest.approx(float(want), rel=1e-11)


def test_hypergeometric_law_at_any_size():
    # Around the mode of 10^12 draws the quotients of neighbours are known, and all probabilities sum to one.
    good, bad, draws = 10**12, 7 * 10**12, 10**10
    mode = (draws + 1) * (good + 1) // (good + bad + 2)
    p = math.exp(log_hypergeometric(good, bad, draws, mode))
    total = 2 * p * sum(math.exp(log_hypergeometric(good, bad, draws, mode + i) - math.log(p)) for i in range(1, 260_000, 10)) * 10
    assert total == pytest.approx(1, rel=2e-3)
    for small in ((5, 3, 4), (40, 60, 30), (900, 100, 500)):
        rng = np.random.default_rng(1)
        seen = np.bincount([_hypergeometric(rng, *small) for _ in range(6000)])
        want = np.array([float(exact_probability(*small, k)) if small[2] - k <= small[1] and k <= small[0] else 0 for k in range(len(seen))]) * 6000
        rare = want < 8
        assert seen[want == 0].sum() == 0
        chi = ((seen - want)[~rare] ** 2 / want[~rare]).sum()
        assert chi < (~rare).sum() + 4.5 * math.sqrt(2 * (~rare).sum()) + 4
    rng = np.random.default_rng(1)
    draws = [_hypergeometric(rng, 2 * 10**9, 6 * 10**9, 4000) for _ in range(400)]
    assert abs(np.mean(draws) - 1000) < 6 and 600 < np.var(draws) < 900


def test_shards_are_a_gapless_uniform_cut(spark):
    docs = spark.range(0, 1003, 1, 5).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "same").alias("text"), F.lit("x").alias("shard"))
    got = shuffle_to_shards(docs, bin_rows=20).collect()
    by_shard = defaultdict(list)
    for r in got:
        by_shard[r.shard].append((r.slot, r.doc_id))
    assert sorted(r.doc_id for r in got) == list(range(1003)) and sorted(map(len, by_shard.values())) == [125] * 5 + [126] * 3
    assert all(sorted(s for s, _ in v) == list(range(len(v))) for v in by_shard.values())
    order = [d for s in sorted(by_shard) for _, d in sorted(by_shard[s])]
    assert abs(np.corrcoef(order, range(1003))[0, 1]) < 0.15
    assert shuffle_to_shards(docs.limit(0)).count() == 0


def test_op4_contract(spark):
    rows = {r.doc_id: r for r in op4_sharding(spark, DATA).collect()}
    for r in spark.read.parquet(f"{DATA}/documents.parquet").collect():
        data = (r.text or "").encode()
        assert (rows[r.doc_id].size, rows[r.doc_id].text_crc32) == (len(data) + 1, zlib.crc32(data))


def test_best_fit_and_bounds():
    rng = np.random.default_rng(2)
    for _ in range(30):
        lengths = rng.integers(1, 101, rng.integers(1, 60))
        bins = packing.best_fit_decreasing(lengths, 100)
        fill = np.bincount(bins, weights=lengths)
        assert fill.max() <= 100 and packing.lower_bound(np.bincount(lengths, minlength=101), 100) <= len(fill)
    assert packing.lower_bound({51: 7}, 100) == 7 and packing.lower_bound({34: 5}, 100) == 3 and packing.lower_bound({}, 100) == 0


def test_pieces_are_those_of_the_tokenizer(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    direct = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = [None, "", "Hello, WORLD. don't", "a\x1cb <|endoftext|> x", "é ́x ΟΔΟΣ", "word " * 9000]
    got = packing.pack_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for i, text in enumerate(texts):
        own = sorted((r.piece, r) for r in got if r.doc_id == i)
        ids = [x for _, r in own for x in r.ids]
        assert ids == [*direct.encode(text or "", add_special_tokens=False).ids, 1]
        assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and r.length == len(r.ids) and r.start == 4096 * k for k, r in own)


@pytest.mark.parametrize("part", [7, 1000])
def test_packing_is_valid_and_close_to_its_bound(spark, part):
    rng = random.Random(3)
    rows = [(i, 0, rng.choice([1, 5, 300, 900, 1500, 2100, 3000, 4096])) for i in range(150)]
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, length long")
    seqs = defaultdict(list)
    for r in packing.pack(pieces, part_pieces=part).collect():
        seqs[r.sequence_id].append((r.offset, r.length))
    assert sum(map(len, seqs.values())) == 150
    for s in seqs.values():
        ends = np.cumsum([n for _, n in sorted(s)])
        assert ends[-1] <= 4096 and [o for o, _ in sorted(s)] == [0, *ends[:-1].tolist()]
    bound = packing.lower_bound(np.bincount([n for *_, n in rows], minlength=4097), 4096)
    assert bound <= len(seqs) <= bound + (8 if part == 7 else 1)
    assert packing.pack(pieces.limit(0)).count() == 0


def test_archives_come_back_as_they_were(spark):
    long = "x" * 1200 + "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n"
    rows = [(1, "http://a\r\nX: y", long, 0), (2, "http://b", long, 0), (2, "http://b", long, 0), (3, None, None, 0), (4, "u", "", 0), (5, "u", "short", 0), (6, "u", "short", 0), (None, "u", long, 0), (7, "u", "é" * 600, 0)]
    path = f"{shared_folder(spark)}/warc"
    write_archives(plan_records(spark.createDataFrame(rows, "page_id long, url string, html string, record_type int")), path)
    got = sorted(((r.page_id or 0), r.record_type, r.refers_to, r.payload_bytes) for r in resolve_revisits(read_archives(spark, f"{path}/*")).collect())
    n = len(long)
    assert got == [(0, "revisit", 2, n), (1, "revisit", 2, n), (2, "response", None, n), (2, "response", None, n), (3, "response", None, 0), (4, "response", None, 0), (5, "response", None, 5), (6, "response", None, 5), (7, "response", None, 1200)]
    assert {r.payload for r in read_archives(spark, f"{path}/*").filter("page_id in (2, 7)").collect()} == {long.encode(), ("é" * 600).encode()}


def foreign(version, fields, block):
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", len(block))])
    return f"WARC/{version}\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


@pytest.mark.parametrize("packing", ["plain", "one stream", "a stream for each record"])
def test_archives_of_others_are_read(spark, tmp_path, packing):
    body = b"\xff\x00binary \r\n\r\nWARC/1.0\r\nContent-Length: 3\r\n\r\nabc WARC/" + bytes(range(256))
    digest = hashlib.sha1(body).hexdigest()
    records = [
        foreign("1.0", [("WARC-Type", "warcinfo"), ("WARC-Record-ID", "<urn:uuid:0>"), ("Content-Type", "application/warc-fields")], b"software: other\r\n"),
        foreign("1.0", [("WARC-Type", "request"), ("WARC-Record-ID", "<urn:uuid:1>"), ("Content-Type", "application/http; msgtype=request")], b"GET / HTTP/1.0\r\n\r\n"),
        foreign("1.0", [("content-type", "application/http;msgtype=response"), ("warc-target-uri", "http://a/?q=1:2"), ("WARC-RECORD-ID", "<urn:uuid:2>"), ("WARC-Type", "response"), ("WARC-Payload-Digest", f"sha1:{digest}")], b"HTTP/1.0 200 OK\r\nX: y\r\n\r\n" + body),
        foreign("1.1", [("WARC-Type", "revisit"), ("WARC-Record-ID", "<urn:uuid:3>"), ("WARC-Refers-To", "<urn:uuid:2>"), ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()), ("Content-Type", "application/http")], b"HTTP/1.0 200 OK\r\n\r\n"),
        foreign("1.1", [("WARC-Type", "response"), ("WARC-Record-ID", "<urn:uuid:4>"), ("Content-Type", "text/dns")], b""),
    ]
    data = {"plain": b"".join(records), "one stream": gzip.compress(b"".join(records)), "a stream for each record": b"".join(map(gzip.compress, records))}[packing]
    at = tmp_path / ("a.warc" + ".gz" * (packing != "plain"))
    at.write_bytes(data)
    got = read_archives(spark, f"file://{at}")
    rows = {r.record_id: r for r in got.collect()}
    assert len(rows) == 3 and bytes(rows["<urn:uuid:2>"].payload) == body and rows["<urn:uuid:2>"].url == "http://a/?q=1:2"
    assert rows["<urn:uuid:3>"].payload is None and bytes(rows["<urn:uuid:4>"].payload) == b""
    full = {(r.record_type, r.payload_bytes, r.payload_digest) for r in resolve_revisits(got).collect()}
    assert full == {("response", len(body), digest), ("revisit", len(body), digest), ("response", 0, hashlib.sha1(b"").hexdigest())}
    assert read_records(spark, f"file://{at}").count() == 5


def test_broken_archives_are_refused():
    whole = foreign("1.0", [("WARC-Type", "response")], b"some block")
    pieces = lambda data: iter(data.split(b"WARC/"))
    assert [b for _, b in parse_records(pieces(whole))] == [b"some block"] and list(parse_records(iter([b""]))) == []
    for bad in (whole[:-9], whole[:-4] + b"more" + whole[-4:], b"WARC/1.0\r\nno length\r\n\r\n"):
        with pytest.raises(ValueError):
            list(parse_records(pieces(bad)))


def test_empty_archives(spark):
    path = f"{shared_folder(spark)}/warc"
    write_archives(plan_records(spark.createDataFrame([], "page_id long, url string, html string, extra int")), path)
    assert resolve_revisits(read_archives(spark, f"{path}/*")).count() == 0


def test_exact_search_equals_brute_force(spark, monkeypatch):
    import tideline.llm.topk as module

    monkeypatch.setattr(module, "DATA_BLOCK", 60)
    monkeypatch.setattr(module, "QUERY_BLOCK", 4)
    monkeypatch.setattr(module, "HEAD", 20)
    rng = np.random.default_rng(5)
    data = rng.normal(size=(300, 12)) * rng.exponential(size=(300, 1)) * np.geomspace(1, 0.05, 12)
    data[50:150] = data[50]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(data.astype(np.float32))] + [(900, None), (920, [1.0, None]), (940, [float("nan")] * 12), (None, [1.0] * 12), (960, [3.0]), (5, [-9.0] * 12), (960, [3.0])]
    v = {i: np.floor(256 * np.array(x)).astype(np.int64) for i, x in rows[:300]}
    v[960] = np.array([768] + [0] * 11)
    v[5] = min(v[5].tolist(), [-2304] * 12)
    v = {i: np.array(x) for i, x in v.items()}
    got = defaultdict(list)
    for r in top_inner_products(spark.createDataFrame(rows, "vec_id long, e array<double>"), "e", F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    for q in [i for i in v if i % 20 == 0]:
        assert got[q] == [(-i, s) for s, i in sorted(((int(v[q] @ v[i]), -i) for i in v if i != q), reverse=True)[:5]]
    assert top_inner_products(spark.createDataFrame(rows[:2], "vec_id long, e array<double>"), "e", F.lit(True)).count() == 2
    assert top_inner_products(spark.createDataFrame([], "vec_id long, e array<double>"), "e", F.lit(True)).count() == 0


def test_pipeline_keeps_columns_and_ends_in_sequences(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns = docs.dtypes
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, DATA), name)
        assert docs.dtypes == columns
    final = corpus_pipeline.STAGES[-1][1](spark, docs, DATA)
    assert final.select("doc_id").distinct().count() == docs.count() and 100 < docs.count() < 200


def test_plain_archives_are_read_whole_by_any_splits(spark, tmp_path):
    block = b"HTTP/1.1 200 OK\r\n\r\n" + foreign("1.0", [("WARC-Type", "response"), ("WARC-Record-ID", "<urn:inner>")], b"nested") * 3
    for name in "ab":
        (tmp_path / f"{name}.warc").write_bytes(b"".join(foreign("1.0", [("WARC-Type", "response"), ("WARC-Record-ID", f"<urn:{name}{i}>"), ("Content-Type", "application/http")], block) for i in range(60)))
    (tmp_path / "c.warc.gz").write_bytes(gzip.compress((tmp_path / "a.warc").read_bytes()))
    before = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for c in before:
            spark.conf.set(c, "100")  # far less than a record
        got = read_archives(spark, f"file://{tmp_path}")
        rows = got.collect()
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    assert len(rows) == 180 and len({r.record_id for r in rows}) == 120 and {bytes(r.payload) for r in rows} == {block.partition(b"\r\n\r\n")[2]}


def test_packing_goes_on_until_a_round_saves_nothing(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(i, 0, rng.randrange(1, 4097)) for i in range(200)]
    names = []
    monkeypatch.setattr(packing, "written", lambda df, name: names.append((name, out := written(df, name))) or out)
    packed = packing.pack(spark.createDataFrame(rows, "doc_id long, piece int, length long"), part_pieces=9)
    n = packed.select("sequence_id").distinct().count()
    rounds = [df for name, df in names if name.startswith("round")]
    sequences = lambda df, released: df.filter("offset = 0").filter("released" if released else "not released").count()
    bound = packing.lower_bound(np.bincount([r[2] for r in rows], minlength=4097), 4096)
    assert n == bound or sequences(rounds[-2], True) == sequences(rounds[-1], True) + sequences(rounds[-1], False) or not sequences(rounds[-1], True)


def test_search_among_vectors_of_one_length(spark, monkeypatch):
    import tideline.llm.topk as module

    monkeypatch.setattr(module, "DATA_BLOCK", 40)
    monkeypatch.setattr(module, "QUERY_BLOCK", 7)
    monkeypatch.setattr(module, "HEAD", 10)
    rng = np.random.default_rng(6)
    data = np.concatenate([rng.permuted(np.tile([3.0, -2.0, 1.0, 0.0], (400, 1)), axis=1), np.zeros((30, 4))])
    v = np.floor(256 * data).astype(int)
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(data)], "vec_id long, e array<double>").withColumn("at", F.lit(1))
    got = defaultdict(list)
    for r in top_inner_products(df, "e", F.col("vec_id") % 5 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    assert got == {q: [(-i, s) for s, i in sorted(((int(v[q] @ v[i]), -i) for i in range(430) if i != q), reverse=True)[:5]] for q in range(0, 430, 5)}
