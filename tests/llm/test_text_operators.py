"""Line dedup, substring dedup, decontamination, licences and language ID: rules, brute force and odd inputs."""

import random
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.oracle import DATA, assert_agrees
from tideline.llm import catalog, licenses
from tideline.llm.decontaminate import Index, Scan, benchmark_words, contaminated, drop_contaminated, edits_allowed, prefix_distance
from tideline.llm.langid import fit, gram_counts, identify, kneser_ney, training_rows, word_scores
from tideline.llm.licenses import scan_licenses
from tideline.llm.license_templates import TEMPLATES
from tideline.llm.lines import remove_boilerplate
from tideline.llm.substrings import gear_cuts, remove_repeated_passages, repeated_passages

ODD = [(1, None, None, "x"), (2, "", "s", "x"), (None, "a line\nb", "s", "x"), (4, "a line\n" * 4000, "t", "x"), (4, "a line\n" * 4000, "t", "x"), (4, "other", None, None)]
SCHEMA = "doc_id long, text string, source string, score string"


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_agrees_with_sql(spark, name):
    assert_agrees(spark, catalog.QUERIES[name], catalog.ORACLES[name])


def test_lines_on_many_sites_stay_once(spark):
    rows = [(i, f"own {i}\nshared\nshared\ntail {i}", f"s{i}", 0) for i in range(12)] + [(20 + i, "copy of one text\nonly", f"s{i}", 0) for i in range(12)]
    got = {r.doc_id: r.text for r in remove_boilerplate(spark.createDataFrame(rows, "doc_id long, text string, source string, removed_lines int")).collect()}
    assert got[0] == "own 0\nshared\ntail 0" and got[5] == "own 5\ntail 5"
    assert all(got[20 + i] == "copy of one text\nonly" for i in range(12))


def test_blank_lines_and_line_ends_stay(spark):
    rows = [(i, f"own {i}\r\n\r\n \t\r\nshared\r\ntext {i}", f"s{i}") for i in range(14)]
    got = {r.doc_id: r.text for r in remove_boilerplate(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert got[0] == rows[0][1] and got[5] == "own 5\r\n\r\n \t\r\ntext 5"


def test_line_dedup_takes_odd_rows(spark):
    docs = spark.createDataFrame(ODD, SCHEMA)
    assert remove_boilerplate(docs).count() == len(ODD) and remove_boilerplate(docs.limit(0)).count() == 0
    assert {r.text for r in remove_boilerplate(docs).filter("doc_id = 2 or doc_id = 1").collect()} == {None, ""}


def test_cuts_depend_on_content_alone():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 123, 20_000, dtype=np.uint8).tobytes()
    chunk = lambda b: {b[i:j] for i, j in zip([0, *gear_cuts(b)], gear_cuts(b), strict=False)}
    assert b"".join(data[i:j] for i, j in zip([0, *gear_cuts(data)], gear_cuts(data), strict=False)) == data
    assert len(chunk(data) & chunk(data[:7000] + b"inserted" + data[7000:])) > 0.98 * len(chunk(data))
    assert max(np.diff([0, *gear_cuts(b"a" * 5000)])) <= 1024 and gear_cuts(b"") == []


def test_repeated_passages_equal_brute_force(spark):
    rng = random.Random(2)
    words = [f"v{i}" for i in range(900)]
    passage = " ".join(rng.choices(words, k=60))
    rows = [(i, " ".join(rng.choices(words, k=80)) + (f" {passage} " if i % 3 == 0 else "") + " ".join(rng.choices(words, k=80))) for i in range(12)]
    seen, want = {}, set()
    for i, text in rows:
        data, last, run = text.encode(), 0, None
        for k, end in enumerate(gear_cuts(data)):
            c = data[last:end]
            if c in seen:
                if run and run[0] == k - 1:
                    run[0], run[2] = k, run[2] + len(c)
                else:
                    run = [k, last, len(c)]
                    want.add((i, id(run)))
                    seen.setdefault("runs", []).append((i, run))
            else:
                seen[c] = i
            last = end
    want = {(i, r[1], r[2]) for i, r in seen.get("runs", []) if r[2] >= 88}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = repeated_passages(docs).collect()
    assert {(r.doc_id, r.start, r.length) for r in got} == want and {r.doc_id for r in got} == {3, 6, 9}
    cut = {r.doc_id: r for r in remove_repeated_passages(docs).collect()}
    removed = {i: sum(n for d, _, n in want if d == i) for i, _ in rows}
    assert all(cut[i].removed_bytes == removed[i] and len(cut[i].text) == len(text) - removed[i] for i, text in rows) and removed[3] > 0


def test_substring_dedup_takes_odd_rows(spark):
    docs = spark.createDataFrame(ODD, SCHEMA)
    assert remove_repeated_passages(docs).count() == len(ODD) and repeated_passages(docs.limit(0)).count() == 0


def windows(items, text):
    words, found = benchmark_words(text), set()
    number = defaultdict(lambda: -1)
    for _, t in items:
        for w in benchmark_words(t):
            number.setdefault(w, len(number))
    seq = np.array([number.get(w, -1) for w in words])
    for i, t in items:
        item = np.array([number[w] for w in benchmark_words(t)])
        k = edits_allowed(len(item))
        if any(prefix_distance(item, seq[s : s + len(item) + k])[0] <= k for s in range(len(seq))):
            found.add(i)
    return found


def test_decontamination_recall_against_brute_force():
    rng = random.Random(7)
    vocabulary = [f"t{i}" for i in range(500)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(8, 50)))) for i in range(40)]
    texts, want = [], set()
    for n in range(150):
        words = rng.choice(items)[1].split()
        for _ in range(rng.randint(0, len(words) // 5)):
            at = rng.randrange(len(words))
            rng.choice([lambda: words.__setitem__(at, "zz"), lambda: words.insert(at, "zz"), lambda: words.pop(at)])()
        texts.append(" ".join(rng.choices(vocabulary, k=60) + words + rng.choices(vocabulary, k=60)))
        want |= {(n, i) for i in windows(items, texts[-1])}
    got = {(x[0], x[1]) for x in Scan(Index(items, 20))(texts)}
    assert got <= want and len(got) >= 0.95 * len(want) > 100


def edit_distance(a, b):
    """The full table, row by row."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_prefix_distance_is_the_least_of_all_prefixes():
    rng = random.Random(3)
    for _ in range(400):
        item = [rng.randrange(5) for _ in range(rng.randint(1, 12))]
        text = [rng.randrange(-1, 5) for _ in range(rng.randint(0, 15))]
        each = [edit_distance(item, text[:n]) for n in range(len(text) + 1)]
        d, n = prefix_distance(np.array(item), np.array(text, np.int64))
        assert d == min(each) == each[n]
    assert [edits_allowed(n) for n in (4, 5, 9, 10, 50)] == [0, 1, 1, 2, 10]


def test_decontamination_takes_odd_rows(spark):
    docs = spark.createDataFrame([*ODD, (9, "Say: THE quick brown fox jumps, now", "s", "x")], SCHEMA)
    items = spark.createDataFrame([(1, "the quick brown fox jumps"), (2, None), (3, ""), (4, "a")], "item_id long, text string")
    assert [(r.doc_id, r.item_id, r.start, r.length, r.distance) for r in contaminated(docs, items).collect()] == [(9, 1, 5, 25, 0)]
    left = drop_contaminated(docs, items)
    assert left.count() == len(ODD) and left.columns == docs.columns
    assert contaminated(docs, items.limit(0)).count() == 0 and contaminated(docs.limit(0), items).count() == 0


def test_licences(spark):
    rows = [(1, "intro\n" + TEMPLATES[1][1] + "\nend"), (2, TEMPLATES[3][1].replace(" ", "\n")), (3, "the license of software"), (4, None), (5, ""), (1, "intro\n" + TEMPLATES[1][1] + "\nend")]
    got = {(r.doc_id, r.license, r.parts) for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    # Of document 1, its line, the sentence that ends there and its whole text match.
    assert got == {(1, "MIT", 3), (2, "MIT", 1), (3, None, 0), (4, None, 0), (5, None, 0)}


def test_whole_licences_and_sentences(spark):
    folder = Path(licenses.__file__).with_name("license_texts")
    text = lambda name: (folder / f"{name}.txt").read_text()
    bsd2 = next(t for n, t in TEMPLATES if n == "BSD-2-Clause" and t.startswith("BSD 2"))
    rows = [
        (1, text("Apache-2.0") + "\nCopyright 2024 Some Body\n", "Apache-2.0"),
        (2, "MY PROJECT\n\n" + text("GPL-3.0").upper(), "GPL-3.0"),
        (3, text("MPL-2.0").replace("\n", "\r\n"), "MPL-2.0"),
        (4, text("GPL-2.0"), "GPL-2.0"),
        (5, "Copyright (c) 2024, Some Body\n\n" + bsd2.replace(". ", ".\n\n"), "BSD-2-Clause"),
        (6, "This tool was written by us in 2020, on a quiet day. Released under the MIT License. Have fun with it, and tell us!", "MIT"),
        (7, "an ordinary text about the terms of a program, its conditions and its license " * 400, None),
        (8, " ".join(text("GPL-3.0").split()[:1500]), None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, license string")
    assert {(r.doc_id, r.license) for r in scan_licenses(docs).collect()} == {(i, name) for i, _, name in rows}
    assert scan_licenses(docs.limit(0)).count() == 0


def test_ties_between_templates_go_to_the_first(spark):
    twins = [("B", "one two three four five"), ("A", "one two three four five")]
    got = scan_licenses(spark.createDataFrame([(1, "One, two: three four FIVE.")], "doc_id long, text string"), twins).collect()
    assert [(r.license, r.parts, r.score) for r in got] == [("B", 1, 1.0)]


def test_held_out_accuracy_and_rejection(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    odd = spark.createDataFrame([(10**6, None, None), (10**6 + 1, "12 !", None), (10**6 + 2, "xqzjvkw qqqq zzxxv kjhgf wrtpsd bcdfg " * 5, None)], docs.schema)
    got = {r.doc_id: r for r in identify(docs.unionByName(odd), training_rows()).collect()}
    held = [(r.doc_id, r.lang) for r in docs.filter(F.crc32(F.col("doc_id").cast("string")) % 3 == 1).collect()]
    assert sum(got[i].lang_pred == lang for i, lang in held) > 0.98 * len(held)
    assert got[10**6].lang_pred == got[10**6 + 1].lang_pred == "und" and got[10**6].score == 0 and got[10**6 + 2].rejected
    assert sum(r.rejected for i, r in got.items() if i < 10**6) <= 3 and all(0 <= r.score <= 1 for r in got.values())


def by_hand(train, word):
    """Interpolated Kneser-Ney by its definition, in plain Python: log2 probability of a word and its closing blank."""
    seen = defaultdict(int)
    for w in train:
        line = f" {w} "
        for i in range(1, len(line)):
            seen[line[max(0, i - 4) : i + 1]] += 1
    level = {5: {g: n for g, n in seen.items() if len(g) == 5}}
    for n in (4, 3, 2, 1):
        level[n] = {g: c for g, c in seen.items() if len(g) == n and g[0] == " "}
        for longer in level[n + 1]:
            level[n][longer[1:]] = level[n].get(longer[1:], 0) + 1

    def discount(n):
        once, twice = (sum(c == k for c in level[n].values()) for k in (1, 2))
        return min(max(once, 1) / (max(once, 1) + 2 * twice), 0.95)

    def followers(n, context):
        return [c for g, c in level[n].items() if g[:-1] == context]

    def p(gram):
        n = len(gram)
        own = followers(n, gram[:-1])
        below = p(gram[1:]) if n > 1 else 1 / (len(own) + 256)
        if not own:
            return below
        return max(level[n].get(gram, 0) - discount(n), 0) / sum(own) + discount(n) * len(own) / sum(own) * below

    line = f" {word} "
    return sum(np.log2(p(line[max(0, i - 4) : i + 1])) for i in range(1, len(line)))


def test_probabilities_are_those_of_the_definition(spark):
    train = ["banana", "bandana", "band", "ananas", "nab", "a", "banana", "bananas", "an", "and"]
    counts = gram_counts(spark.createDataFrame([("x", " ".join(train[:6])), ("x", " ".join(train[6:])), ("y", "zz")], "lang string, text string"))
    model, words = fit(counts), ["banana", "band", "nanas", "bandanas", "q", "a", "dab"]
    got = model.word_scores(words)[:, model.langs.index("x")]
    assert got == pytest.approx([by_hand(train, w) for w in words], abs=1e-3)


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(0, "abc", None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.rejected) for r in identify(docs, F.lit(True)).collect()] == [("und", True)]
    assert identify(docs.limit(0), F.lit(True)).count() == 0


def test_queries_without_sql_run(spark):
    for name in ("op8_language_id", "op9_decontamination", "op10_substring_dedup"):
        assert catalog.QUERIES[name](spark, DATA).count() >= 0


def test_models_in_tables_use_every_gram(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang")
    docs = docs.unionByName(spark.createDataFrame([(10**6, None, None), (10**6 + 1, "12 !", None), (10**6 + 2, "xqzjvkw qqqq " * 5 + "漢字" * 50, None)], docs.schema)).repartition(3)
    whole = {(r.doc_id, r.text_hash): r for r in identify(docs, training_rows()).collect()}
    tables = {(r.doc_id, r.text_hash): r for r in identify(docs, training_rows(), max_grams=1000).collect()}
    assert whole.keys() == tables.keys()
    for key, a in whole.items():
        b = tables[key]
        assert (a.lang_pred, a.rejected) == (b.lang_pred, b.rejected) and abs(a.score - b.score) < 1e-3 and abs((a.bits or 0) - (b.bits or 0)) < 1e-3
    train = docs.filter(training_rows()).select("lang", "text")
    counts = gram_counts(train)
    words = spark.createDataFrame([("the",), ("qqq",), ("漢字",), ("a",)], "word string")
    model = fit(counts)
    want = dict(zip(["the", "qqq", "漢字", "a"], model.word_scores(["the", "qqq", "漢字", "a"]).tolist(), strict=True))
    for r in word_scores(words, kneser_ney(counts), model.langs).collect():
        assert r.scores == pytest.approx(want[r.word], abs=1e-3)
