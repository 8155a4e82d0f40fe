"""Periodic runs against the definition."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.oracle import DATA
from tideline.llm.periodic import Grammar, op11_periodic_runs, periodic_runs, runs_of


def runs_by_definition(words, min_length=6, exponent=4):
    """Maximal stretches of every period, without those that have a smaller one."""
    found, n = [], len(words)
    for q in range(1, n // exponent + 1):
        k = 0
        while k + q < n:
            if words[k] != words[k + q]:
                k += 1
                continue
            start = k
            while k + q < n and words[k] == words[k + q]:
                k += 1
            length = k + q - start
            w = words[start : start + length]
            if length >= max(min_length, exponent * q) and not any(all(w[i] == w[i + p] for i in range(length - p)) for p in range(1, q)):
                found.append((start, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def left_by_definition(words, runs):
    return [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs)]


def some_words(rng, n, letters):
    words = [str(rng.randrange(letters)) for _ in range(n)]
    if n > 10 and rng.random() < 0.7:
        a, q = rng.randrange(n), rng.randint(1, 8)
        b = rng.randint(a, n)
        words[a:b] = [words[min(a + i % q, n - 1)] for i in range(b - a)]
    return words


@pytest.mark.parametrize(("min_length", "exponent"), [(6, 4), (3, 2), (9, 3)])
def test_runs_equal_the_definition(min_length, exponent):
    rng = random.Random(exponent)
    for _ in range(120):
        texts = [some_words(rng, rng.choice([0, 1, 5, 6, 7, 30, 120]), rng.choice([1, 2, 3, 12])) for _ in range(rng.randrange(7))]
        got = runs_of([[w.encode() for w in t] for t in texts], min_length, exponent)
        assert [[tuple(r) for r in g.tolist()] for g in got] == [runs_by_definition(t, min_length, exponent) for t in texts]


def test_extensions_to_both_sides():
    rng = np.random.default_rng(4)
    for letters in (1, 2, 5):
        inner = np.concatenate([rng.integers(0, letters, 300), np.tile(rng.integers(0, letters, 7), 40), np.zeros(90, int), rng.integers(0, letters, 90)])
        s = np.concatenate([[letters], inner, [letters + 1]])
        grammar = Grammar(s, letters + 2)
        i = rng.integers(1, len(s) - 2, 800)
        j = rng.integers(i + 1, len(s) - 1)
        for back in (False, True):
            for a, b, got in zip(i.tolist(), j.tolist(), grammar.extension(i, j, back).tolist(), strict=True):
                n = 0
                while (s[a - 1 - n] == s[b - 1 - n]) if back else (s[a + n] == s[b + n]):
                    n += 1
                assert n == got


def test_odd_rows(spark):
    long = ["a b c"] * 30_000
    rows = [(1, None, 0), (2, "", 0), (3, " \t\n", 0), (4, "x x x x x", 0), (5, "x x x x x x", 0), (6, "A a A a A a A a b", 0), (6, "A a A a A a A a b", 0), (None, "é\x0bé\x0cé\ré é é z", 0), (7, " ".join(long), 0), (8, "w" * 300_000, 0)]
    got = periodic_runs(spark.createDataFrame(rows, "doc_id long, text string, runs int")).collect()
    assert set(got[0].asDict()) == {"doc_id", "text", "runs", "collapsed"}
    seen = sorted((r.doc_id or 0, [tuple(x) for x in r.runs], r.collapsed[:12]) for r in got)
    assert seen == [(0, [(0, 6, 1)], "é z"), (1, [], ""), (2, [], ""), (3, [], ""), (4, [], "x x x x x"), (5, [(0, 6, 1)], "x"), (6, [(0, 8, 2)], "A a b"), (6, [(0, 8, 2)], "A a b"), (7, [(0, 90_000, 3)], "a b c"), (8, [], "w" * 12)]
    assert periodic_runs(spark.createDataFrame([], "text string, doc int, collapsed int")).columns == ["text", "doc", "runs", "collapsed"]


def test_op11_contract(spark):
    rows = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    got = {r.doc_id: r for r in op11_periodic_runs(spark, DATA).collect()}
    assert len(got) == len(rows)
    some = 0
    for r in rows:
        words = [w.decode() for w in (r.text or "").encode().split()]
        h = zlib.crc32(str(r.doc_id).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        if n > 1500:
            continue
        runs = runs_by_definition(words)
        best = max(runs, key=lambda x: (x[1], -x[0], -x[2]), default=None)
        x = got[r.doc_id]
        some += len(runs)
        assert (x.n_runs, x.runs_sha256) == (len(runs), hashlib.sha256("".join(f"{s},{k},{q}\n" for s, k, q in runs).encode()).hexdigest())
        assert (x.start, x.length, x.period, x.exponent_milli) == ((*best, 1000 * best[1] // best[2]) if best else (None,) * 4)
        assert x.collapsed_sha256 == hashlib.sha256(" ".join(left_by_definition(words, runs)).encode()).hexdigest()
    assert some > 5
    assert [f.dataType.simpleString() for f in op11_periodic_runs(spark, DATA).schema] == ["bigint"] * 6 + ["string"] * 2


def test_an_id_of_null_is_not_changed(spark):
    from tideline.llm.periodic import with_repetition

    assert with_repetition(spark.createDataFrame([(None, "a b"), (3, None)], "doc_id long, text string").withColumn("n", F.lit(1))).collect() == [(None, "a b"), (3, None)]
