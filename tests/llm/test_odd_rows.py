"""Rows come through operators as they are, whatever their columns are called; numerals are no letters; long texts."""

import time

from pyspark.sql import functions as F

from tideline.llm.decontaminate import drop_contaminated
from tideline.llm.langid import identify, keep_identified, words_of
from tideline.llm.lines import remove_boilerplate
from tideline.llm.near_dup import drop_near_duplicates
from tideline.llm.substrings import remove_repeated_passages

NAMES = ["__doc", "__hash", "__text", "__own", "own_id", "their_id", "own_hash", "row", "kept"]


def odd(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return df.select("*", *[F.col("doc_id").alias(c) for c in NAMES])


def test_columns_that_clash_come_through(spark):
    long = " ".join(f"word{i}" for i in range(60))
    rows = odd(spark, [(1, long, "en", "a"), (2, long + " end", "en", "b"), (3, "quite another text of some words", "en", "c"), (3, "quite another text of some words", "en", "c"), (4, None, "en", "d"), (None, "", None, None)])
    bench = spark.createDataFrame([(1, "quite another text of some words")], "item_id long, text string")
    for out, ids in (
        (drop_near_duplicates(rows), [None, 1, 3, 4]),
        (drop_contaminated(rows, bench), [None, 1, 2, 4]),
        (keep_identified(rows, F.lit(True)), None),
        (remove_repeated_passages(rows).drop("removed_bytes"), [None, 1, 2, 3, 3, 4]),
        (remove_boilerplate(rows).drop("removed_lines"), [None, 1, 2, 3, 3, 4]),
    ):
        assert out.columns == rows.columns
        found = out.collect()
        assert all(r[c] == r["doc_id"] for r in found for c in NAMES)
        if ids:
            assert sorted((r.doc_id for r in found), key=lambda x: x or 0) == ids


def test_numerals_are_no_letters(spark):
    assert words_of("½ ² ①② 12 _") == [] and words_of("a²b½ça É") == ["a", "b", "ça", "é"]
    rows = spark.createDataFrame([(i, "some plain words of a text", "en") for i in range(30)] + [(50, "½ ² ①", "en"), (51, "", None)], "doc_id long, text string, lang string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in identify(rows, F.lit(True)).collect()}
    assert got[50] == ("und", 0.0) and got[51] == ("und", 0.0) and got[3][0] == "en"


def test_texts_of_many_lines_take_their_length(spark):
    lines = [f"line {i}" for i in range(100_000)]
    rows = [(i, "\n".join([*lines, f"own {i}"]), f"site{i}") for i in range(12)]
    began = time.time()
    got = {r.doc_id: (r.removed_lines, r.text) for r in remove_boilerplate(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert got[0][0] == 0 and all(got[i] == (100_000, f"own {i}") for i in range(1, 12))
    assert time.time() - began < 90
