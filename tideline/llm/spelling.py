"""Spelling variants: words one edit apart, found through a reduced alphabet.

Letters are hashed to a few symbols, so a vocabulary of words has fewer reduced words, and an edit of a word is an edit of
its reduced word or none. Every reduced word sends out its full neighbourhood of one edit, itself included; neighbours
that are reduced words of the vocabulary join, and what they bring together is verified on the original strings. With few
symbols a neighbourhood is small: an alphabet of 26 letters would have three times as many neighbours, one of 90 ten times.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, text_or_empty, written

#: Symbols of the reduced alphabet.
SYMBOLS = "abcdefgh"
MIN_LETTERS = 6
MIN_COUNT = 5
#: A form occurs at least so many times as often as its variant.
LEAD = 5
#: One run in so many loses a letter.
TYPO = 199
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RUN = r"[A-Za-zÀ-ÿ]+"


def reduced(word: Column, letters: str) -> Column:
    """``word`` with each of ``letters`` hashed to a symbol."""
    # Multiplicative hashing; neighbours in the alphabet get symbols that lie apart.
    symbols = "".join(SYMBOLS[(ord(c) * 0x9E3779B1 & 0xFFFFFFFF) * len(SYMBOLS) >> 32] for c in letters)
    return F.translate(word, letters, symbols)


def neighbourhood(word: Column) -> Column:
    """The reduced word, and all that come of it by one letter less, another or more."""
    head = lambda i: F.substring(word, F.lit(1), i)
    tail = lambda i: F.substring(word, i + 1, F.length(word))
    inner, gaps = F.sequence(F.lit(0), F.length(word) - 1), F.sequence(F.lit(0), F.length(word))
    less = F.transform(inner, lambda i: F.concat(head(i), tail(i + 1)))
    symbols = F.array(*[F.lit(s) for s in SYMBOLS])
    other = F.flatten(F.transform(inner, lambda i: F.transform(symbols, lambda s: F.concat(head(i), s, tail(i + 1)))))
    more = F.flatten(F.transform(gaps, lambda i: F.transform(symbols, lambda s: F.concat(head(i), s, tail(i)))))
    return F.array_distinct(F.concat(F.array(word), less, other, more))


def near_words(words: DataFrame, letters: str) -> DataFrame:
    """All pairs ``word, near`` (both ways round) of ``words(word)`` that differ by exactly one inserted, deleted or
    replaced code point. ``letters`` are all that words are made of; words are distinct and have two letters or more.

    Reduced words meet as strings, so a pair comes from one neighbour alone; pairs of words come from pairs of reduced
    words, and only words of the same pair of reduced words are compared.
    """
    own = words.select("word", reduced(F.col("word"), letters).alias("code"))
    codes = own.select("code").distinct()
    met = codes.select(F.col("code").alias("from"), F.explode(neighbourhood(F.col("code"))).alias("code")).join(codes, "code")
    left, right = own.select("word", F.col("code").alias("from")), own.select(F.col("word").alias("near"), "code")
    return met.join(left, "from").join(right, "code").filter("word <> near and levenshtein(word, near, 1) = 1").select("word", "near")


def roots_of(forms: DataFrame) -> DataFrame:
    """``word, root`` for ``forms(word, form)``: the last form that is reached from a word. Forms must not lead round.

    Every round doubles the steps that are taken, so a chain of a thousand forms takes ten.
    """
    now = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        then = now.select(F.col("word").alias("root"), F.col("root").alias("on"))
        now = written(now.join(then, "root", "left").select("word", F.coalesce("on", "root").alias("root"), F.col("on").isNotNull().alias("moved")), "roots")
        if now.filter("moved").isEmpty():
            return now.select("word", "root")
        now = now.drop("moved")


def spelling_variants(words: DataFrame, letters: str, lead: int = LEAD) -> DataFrame:
    """``words(word, n)``, distinct and without nulls, as word, form, root, n, n_near, form_n.

    A form is the near word of largest n (the smallest in code-point order among equals) if that is at least ``lead`` times
    the word's own; else it and form_n are null and the word is its own root. An empty table gives an empty one.
    """
    if lead < 2:
        raise ValueError("a form must be more frequent than its variant")
    near = near_words(words, letters).join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    # The largest count, then the smallest string, is the least pair of these.
    best = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    leads = -F.col("best.less") >= lead * F.col("n")
    formed = words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(leads, F.col("best.near")).alias("form"), F.when(leads, -F.col("best.less")).alias("form_n"))
    formed = written(formed, "formed")
    roots = roots_of(formed.filter("form is not null"))
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def word_counts(docs: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT) -> DataFrame:
    """``word, n`` of ``docs(doc_id, text)``: runs of letters, A-Z lowered, one in ``TYPO`` of them short of a letter.

    Null texts have no runs; a null doc_id takes no letter.
    """
    runs = F.regexp_extract_all(F.translate(text_or_empty(), UPPER, LOWER), F.lit(RUN), F.lit(0))
    each = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.explode(runs).alias("run"))
    h = F.crc32(F.concat("doc_id", F.lit(":"), "run").cast("binary"))
    at = (h % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    word = F.when(h % TYPO == 0, shorter).otherwise(F.col("run"))
    return each.select(word.alias("word")).filter(F.length("word") >= min_letters).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)


#: Every code point that a lowered run can have.
LETTERS = LOWER + "".join(map(chr, range(0xC0, 0x100)))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = written(word_counts(table(spark, sf_dir, "documents")), "words")
    return spelling_variants(words, LETTERS)
