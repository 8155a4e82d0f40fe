"""The stages of the pipeline against brute force, and on odd rows."""

from collections import defaultdict

from pyspark.sql import functions as F

import corpus_pipeline
from tests.oracle import DATA

STAGES = dict(corpus_pipeline.STAGES)


def words(text):
    return [w.decode() for w in (text or "").encode().lower().split()]


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_near_dedup_keeps_one_of_each_component(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = docs.collect()
    sets = {r.doc_id: shingles(r.text) for r in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    kept = {r.doc_id: r for r in STAGES["near_dedup"](spark, docs, DATA).collect()}
    assert set(kept) == {i for i in ids if find(i) == i} and len(kept) < len(ids)
    assert all(kept[r.doc_id] == r for r in rows if r.doc_id in kept)


def test_line_dedup_cuts_what_ten_sites_and_texts_share(spark):
    rows = [(i, "\n".join(["shared by all", f"own {i}", "of a few" if i < 9 else "x", " "]), "en", f"s{i}", 1) for i in range(14)]
    rows += [(20 + i, "a copied text\nof two lines", "en", f"t{i}", 27) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    sites, texts, first = defaultdict(set), defaultdict(set), {}
    for i, text, _, source, _ in rows:
        for line in text.split("\n"):
            sites[line].add(source)
            texts[line].add(text)
            first[line] = min(first.get(line, i), i)
    gone = {x for x in sites if x.strip() and len(sites[x]) >= 10 and len(texts[x]) >= 10}
    want = {i: "\n".join(x for x in text.split("\n") if x not in gone or first[x] == i) for i, text, *_ in rows}
    got = {r.doc_id: r for r in STAGES["line_dedup"](spark, docs, DATA).collect()}
    assert gone == {"shared by all"} and {i: r.text for i, r in got.items()} == want
    assert all(r.n_chars == (len(r.text) if want[i] != t else n) for i, t, *_, n in rows for r in [got[i]])


def test_decontamination_drops_what_holds_an_item(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    items = [" ".join(words(r.text)) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    holding = {r.doc_id for r in docs.collect() if any(f" {x} " in f" {' '.join(words(r.text))} " for x in items if x)}
    kept = {r.doc_id for r in STAGES["decontamination"](spark, docs, DATA).select("doc_id").collect()}
    assert not holding & kept and len(kept) > 150


def test_stages_take_odd_rows(spark):
    plain = "some plain words of a text that nobody else has written here at all"
    rows = [(1, None, "en", "a", None), (2, "", "en", "a", 0), (3, plain, "en", "a", 5), (3, plain, "en", "a", 5), (None, plain + " twice", None, None, None), (4, "½ ²", "en", "b", 3), (5, "w " * 100_000, "en", "b", 200_000)]
    rows += [(100 + i, f"{plain} number {'abcdefghij'[i % 10]}", "en", "z", 70) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    odd = docs.select("*", *[F.col("doc_id").alias(c) for c in ("__doc", "row", "own_id", "kept", "removed_lines_", "piece_")])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd, DATA)
        assert out.columns == odd.columns, name
        assert all(r["row"] == r["doc_id"] for r in out.collect()), name
        assert stage(spark, odd.limit(0), DATA).count() == 0, name
    left = {r.doc_id for r in STAGES["language_id"](spark, odd, DATA).collect()}
    assert {3, None, *range(100, 160)} <= left and not left & {1, 2, 4}
    packed = STAGES["packing"](spark, odd, DATA)
    assert packed.select("doc_id").distinct().count() == 66 and STAGES["packing"](spark, odd.limit(0), DATA).count() == 0
