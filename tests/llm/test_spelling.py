"""Spelling variants against all pairs."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.oracle import connection
from tideline.llm import spelling
from tideline.llm.spelling import LETTERS, near_words, neighbourhood, op12_spelling_variants, roots_of, spelling_variants, word_counts


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[i:] == b[i + 1 :] or (len(a) == len(b) and a[i + 1 :] == b[i + 1 :])


def by_definition(counts):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 5 * counts[w] else None
    rows = set()
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        rows.add((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return rows


def test_variants_equal_all_pairs(spark):
    rng = random.Random(5)
    words = {"".join(rng.choice("abcé") for _ in range(rng.randint(2, 6))) for _ in range(250)}
    for w in list(words):
        i = rng.randrange(len(w))
        words |= {w[:i] + w[i + 1 :] + "ÿ", w[:i] + rng.choice("xyÀ") + w[i:]}
    counts = {w: rng.choice([1, 2, 5, 10, 25, 125, 625]) for w in words if len(w) > 1}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert {tuple(r) for r in spelling_variants(df, LETTERS).collect()} == by_definition(counts)
    assert spelling_variants(df.limit(0), LETTERS).count() == 0
    pairs = near_words(df, LETTERS).collect()
    assert len(pairs) == len(set(pairs)) == sum(one_edit(a, b) for a in counts for b in counts)


def test_neighbourhoods_are_full(spark):
    got = spark.createDataFrame([("ab",)], "w string").select(neighbourhood(F.col("w")).alias("x")).first().x
    s = spelling.SYMBOLS
    want = {"ab", "a", "b", *(x + "b" for x in s), *("a" + x for x in s), *(x + "ab" for x in s), *("a" + x + "b" for x in s), *("ab" + x for x in s)}
    assert len(got) == len(want) and set(got) == want


def test_long_chains_of_forms(spark):
    chain = spark.range(1, 301).selectExpr("cast(id as string) word", "cast(id - 1 as string) form")
    assert {r.root for r in roots_of(chain).collect()} == {"0"}


def count_by_definition(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if h % 199 == 0 and doc_id is not None:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "ÀBCdef×÷ " * 9), (3, "ÀBCdef×÷ " * 9), (None, "Überall überall " * 9), (4, "x" * 100_000 + " "), (5, "abcdefg " * 400), (6, "abcdefG\U0001f600abcdefg" * 5)]
    got = {(r.word, r.n) for r in word_counts(spark.createDataFrame(rows, "doc_id int, text string").withColumn("word", F.lit(1))).collect()}
    assert got == set(count_by_definition(rows).items())


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001"])
def test_op12_contract(spark, folder):
    counts = count_by_definition(connection(folder).execute("SELECT doc_id, text FROM documents").fetchall())
    df = op12_spelling_variants(spark, folder)
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert {tuple(r) for r in df.collect()} == by_definition(counts)
