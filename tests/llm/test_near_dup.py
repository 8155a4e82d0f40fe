"""Near duplicates, components and the pipeline's choice against brute force, and odd inputs."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tideline.llm.components import connected_components
from tideline.llm.near_dup import OP1, NearDup, drop_near_duplicates, near_duplicates


def shingles(text, k):
    words = [w for w in re.split(r"[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def brute(rows, k, percent):
    sets = [(i, shingles(t, k)) for i, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                parent[find(a)] = find(b)
    least = {}
    for n, (i, s) in enumerate(sets):
        r = find(n)
        least[r] = min(least.get(r, i), i)
    return {(i, len(s), least[find(n)], i == least[find(n)]) for n, (i, s) in enumerate(sets)}


def corpus(seed, groups=12, copies=9):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(groups):
        base = rng.choices(vocabulary, k=rng.randint(3, 120))
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(text)))
    return rows


@pytest.mark.parametrize(("p", "seed"), [(OP1, 1), (NearDup(), 2)])
def test_equals_brute_force(spark, p, seed):
    rows = corpus(seed) + [(1000, None), (1001, ""), (1002, " \n"), (1003, "One  TWO"), (1004, "one two"), (1005, "ÉA b c"), (1006, "éA b c")]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), p).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got} == brute(rows, p.words, p.percent)


def test_large_group_around_one_original(spark, monkeypatch):
    """Copies that resemble the original but not each other: hubs and blocks must find the same as brute force."""
    import tideline.llm.near_dup as module

    monkeypatch.setattr(module, "PAIRS_A_ROW", 1)
    monkeypatch.setattr(module, "BLOCK", 16)
    rng = random.Random(4)
    base = [f"b{i}" for i in range(90)]
    rows = [(0, " ".join(base))]
    for i in range(1, 90):
        text = list(base)
        for at in rng.sample(range(90), rng.choice([1, 2, 3, 4])):
            text[at] = f"x{rng.randrange(30)}"
        rows.append((i, " ".join(text)))
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), OP1).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got} == brute(rows, 3, 85)


def test_one_of_each_group_stays_with_all_columns(spark):
    rows = [(5, "a b c d e f", "x"), (3, "a b c d e f", "y"), (3, "a b c d e f", "y"), (None, "q r s", "z"), (7, None, None), (8, "", "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    assert sorted((r.doc_id is None, r.doc_id or 0, r.kept) for r in drop_near_duplicates(docs).select("doc_id", "kept").collect())[0][1:] == (3, "y")
    assert drop_near_duplicates(docs).count() >= 3 and drop_near_duplicates(docs).columns == docs.columns


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(docs, OP1).count() == 0 and drop_near_duplicates(docs).count() == 0


def test_components_of_paths_and_stars(spark):
    rng = random.Random(9)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 200)] + [(rng.randrange(300, 360), rng.randrange(300, 360)) for _ in range(40)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}
    assert connected_components(spark.createDataFrame([], "a long, b long").withColumn("a", F.col("a"))).count() == 0
