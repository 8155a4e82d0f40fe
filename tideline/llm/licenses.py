"""Licence scan: Dice coefficient over word bigrams between parts of a document and licence templates.

The parts are the whole text, its paragraphs, its lines and its sentences; the templates are notices, clauses and whole
licence texts. A part of ``n`` distinct bigrams can reach a Dice coefficient ``t`` only with templates of t/(2-t)*n to
(2-t)/t*n bigrams, so most parts meet no template at all and are dropped before their bigrams are counted against any.
So are, before anything else, texts and parts that are too short or lack every one of a few
words without which no template of that size can be matched. Against whole licence texts go only parts that speak of a
licence at all: that is part of what a match is. All steps are DataFrame functions.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .license_templates import all_templates

#: Least Dice coefficient of a match, in percent.
PERCENT = 80
#: Whole licence texts: templates of so many bigrams and more. Parts that don't hold the word don't match them.
WHOLE, WHOLE_WORD = 400, "licen"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: Column) -> Column:
    """A-Z lowered, everything but ASCII letters and digits turned to single blanks."""
    return F.trim(F.regexp_replace(F.translate(text, UPPER, LOWER), "[^a-z0-9]+", " "))


def bigrams(text: Column) -> Column:
    """Distinct bigrams of the words of a normalised text."""
    words = F.split(text, " ")
    return F.array_distinct(F.zip_with(words, F.slice(words, F.lit(2), F.size(words)), lambda a, b: F.concat_ws(" ", a, b)))


def _paired(text: Column) -> Column:
    """Like ``bigrams``, without the last word that stands alone (``zip_with`` pads the shorter side)."""
    return F.filter(bigrams(text), lambda b: F.contains(b, F.lit(" ")))


def template_bigrams(spark: SparkSession, templates: list[tuple[str, str]]) -> DataFrame:
    """template, license, size and one row for each bigram: a table as small as the templates, whatever the data."""
    rows = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(templates)], "template int, license string, text string")
    # The size comes first, so that the exploded rows don't carry the array along.
    sized = rows.withColumn("grams", _paired(normalised(F.col("text")))).withColumn("template_size", F.size("grams"))
    return sized.select("template", "license", "template_size", F.explode("grams").alias("gram"))


def needles(templates: list[tuple[str, str]], percent: int) -> list[str]:
    """Words of which every part that matches a template holds one.

    A match has at least percent / (200 - percent) of the template's bigrams, so it can't lack a set of more bigrams than
    the rest. Words are chosen greedily until, in every template, so many bigrams hold a chosen word.
    """
    left: list[Counter[str]] = []  # of each template, how many open bigrams hold a word
    having: list[dict[str, set[tuple[str, str]]]] = []
    needs: list[int] = []
    for _, text in templates:
        words = re.sub("[^a-z0-9]+", " ", text.lower()).split()
        grams = set(zip(words, words[1:], strict=False))
        own: dict[str, set[tuple[str, str]]] = defaultdict(set)
        for g in grams:
            for w in g:
                own[w].add(g)
        having.append(own)
        left.append(Counter({w: len(x) for w, x in own.items()}))
        needs.append(len(grams) - -(-len(grams) * percent // (200 - percent)) + 1)
    chosen: list[str] = []
    while any(need > 0 for need in needs):
        gain: Counter[str] = Counter()
        for counts, need in zip(left, needs, strict=True):
            if need > 0:
                gain.update({w: min(need, n) for w, n in counts.items() if n})
        # Long words while they help: they are rarer in other texts.
        word = max(gain, key=lambda w: (len(w) >= 5, gain[w], len(w), w))
        chosen.append(word)
        for i, own in enumerate(having):
            gone = own.pop(word, set())
            needs[i] -= len(gone)
            for g in gone:
                for w in set(g):
                    left[i][w] -= 1
                    own.get(w, set()).discard(g)
    return chosen


@dataclass(frozen=True)
class SizeClass:
    """What a part needs to match a template of a size class: bigrams from least to most, and one of the words."""

    least: int
    most: int
    words: list[str]


def size_classes(templates: list[tuple[str, str]], percent: int) -> list[SizeClass]:
    """Notices and clauses, and whole licence texts."""
    by_size: dict[bool, list[tuple[int, tuple[str, str]]]] = defaultdict(list)
    for t in templates:
        words = re.sub("[^a-z0-9]+", " ", t[1].lower()).split()
        size = len(set(zip(words, words[1:], strict=False)))
        if size:
            by_size[size >= WHOLE].append((size, t))
    return [
        SizeClass(-(-min(n for n, _ in own) * percent // (200 - percent)), max(n for n, _ in own) * (200 - percent) // percent, [WHOLE_WORD] if whole else needles([t for _, t in own], percent))
        for whole, own in sorted(by_size.items())
    ]


def _may_match(text: str, classes: list[SizeClass]) -> Column:
    """Whether a text is long enough for a class and holds one of its words in any case: n bigrams take 2n characters and
    more. The array of one binds the lowered text once for all tests."""

    def test(low: Column) -> Column:
        return reduce(lambda a, b: a | b, [(F.octet_length(low) >= 2 * c.least) & reduce(lambda a, b: a | b, [F.contains(low, F.lit(w)) for w in c.words]) for c in classes])

    return F.exists(F.array(F.lower(text)), test)


def parts_of(text: Column) -> Column:
    """The distinct parts of a text."""
    sentences = F.split(F.regexp_replace(text, "([.!?])[ \t\r\n]+", "$1\x01"), "\x01")
    return F.array_distinct(F.concat(F.array(text), F.split(text, "\n[ \t\r]*\n"), F.split(text, "\n"), sentences))


def scan_parts(docs: DataFrame, templates: list[tuple[str, str]] | None = None, percent: int = PERCENT) -> DataFrame:
    """Every part of ``docs(doc_id, text, ...)`` that matches a template: doc_id, text_hash, part, license, shared and
    sizes (part_size, template_size), for the best template of the part (ties to the first in the list)."""
    templates = all_templates() if templates is None else templates
    grams = template_bigrams(docs.sparkSession, templates)
    classes = size_classes(templates, percent)
    parts = docs.filter(_may_match("text", classes)).select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(parts_of(F.col("text"))).alias("part", "raw"))
    # The bigrams of a part are made once: what a row is exploded into isn't computed again by filters above it.
    counted = F.explode(F.transform(F.array(_paired(normalised(F.col("raw")))), lambda g: F.struct(F.size(g).alias("n"), g.alias("grams")))).alias("made")
    sized = (
        parts.filter(_may_match("raw", classes))
        .select("doc_id", "text_hash", "part", F.contains(F.lower("raw"), F.lit(WHOLE_WORD)).alias("speaks"), counted)
        .select("doc_id", "text_hash", "part", "speaks", F.col("made.n").alias("part_size"), F.col("made.grams").alias("grams"))
        .filter(reduce(lambda a, b: a | b, [F.col("part_size").between(c.least, c.most) for c in classes]))
        .select("doc_id", "text_hash", "part", "part_size", "speaks", F.explode("grams").alias("gram"))
    )
    bounded = (F.col("template_size") * percent <= F.col("part_size") * (200 - percent)) & (F.col("part_size") * percent <= F.col("template_size") * (200 - percent))
    # The templates' bigrams are as many as the templates have, whatever the documents are.
    shared = sized.join(F.broadcast(grams), "gram").filter(bounded & (F.col("speaks") | (F.col("template_size") < WHOLE))).groupBy("doc_id", "text_hash", "part", "part_size", "template", "license", "template_size").agg(F.count(F.lit(1)).alias("n"))
    # Rows that repeat doc_id and text count each shared bigram once for each of them.
    times = docs.groupBy("doc_id", F.xxhash64("text").alias("text_hash")).agg(F.count(F.lit(1)).alias("times")).filter("times > 1")
    same = shared["doc_id"].eqNullSafe(times["doc_id"]) & (shared["text_hash"] == times["text_hash"])
    once = shared.join(times, same, "left").select(*[shared[c] for c in shared.columns if c != "n"], (F.col("n") / F.coalesce("times", F.lit(1))).cast("long").alias("shared"))
    dice = 200 * F.col("shared") >= percent * (F.col("part_size") + F.col("template_size"))
    score = (2.0 * F.col("shared")) / (F.col("part_size") + F.col("template_size"))
    best = F.max(F.struct(score.alias("score"), (-F.col("template")).alias("first"), "license", "shared", "template_size")).alias("best")
    return once.filter(dice).groupBy("doc_id", "text_hash", "part", "part_size").agg(best).select("doc_id", "text_hash", "part", "part_size", "best.license", "best.shared", "best.template_size", "best.score")


def scan_licenses(docs: DataFrame, templates: list[tuple[str, str]] | None = None, percent: int = PERCENT) -> DataFrame:
    """Every row of ``docs(doc_id, text, ...)`` as doc_id, parts (how many matched), license and score of its best part,
    ties to the name. ``templates`` are pairs of a licence's name and a text, by default ``all_templates()``.

    Documents without a match, null and empty texts have 0 parts and null license and score; equal rows get equal
    results.
    """
    found = scan_parts(docs, templates, percent)
    per_doc = found.groupBy(F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__hash")).agg(
        F.count(F.lit(1)).alias("parts"), F.min(F.struct((-F.col("score")).alias("s"), "license")).alias("best")
    )
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"))
    same = F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("text_hash") == F.col("__hash"))
    return rows.join(per_doc, same, "left").select("doc_id", F.coalesce("parts", F.lit(0)).cast("long").alias("parts"), F.col("best.license").alias("license"), (-F.col("best.s")).alias("score"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def _sql() -> str:
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    values = ", ".join(f"({i}, {quoted(a)}, {quoted(b)})" for i, (a, b) in enumerate(all_templates()))
    grams = "list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"
    norm = lambda c: f"string_split(trim(regexp_replace(translate({c}, '{UPPER}', '{LOWER}'), '[^a-z0-9]+', ' ', 'g')), ' ')"
    return f"""
WITH raw(template, license, text) AS (VALUES {values}),
t AS (SELECT template, license, {grams} AS g FROM (SELECT *, {norm("text")} AS w FROM raw)),
p AS (SELECT doc_id, unnest(list_distinct(list_concat([text], string_split_regex(text, '\\n[ \\t\\r]*\\n'), string_split(text, chr(10)),
                                                   string_split(regexp_replace(text, '([.!?])[ \\t\\r\\n]+', '\\1' || chr(1), 'g'), chr(1))))) AS raw FROM documents),
u AS (SELECT doc_id, raw, {grams} AS g FROM (SELECT *, {norm("raw")} AS w FROM p)),
m AS (SELECT doc_id, raw, license, template, len(list_intersect(u.g, t.g)) AS shared, len(u.g) + len(t.g) AS total
      FROM u JOIN t ON (len(t.g) < {WHOLE} OR contains(lower(raw), '{WHOLE_WORD}')) AND len(u.g) * {PERCENT} <= len(t.g) * {200 - PERCENT} AND len(t.g) * {PERCENT} <= len(u.g) * {200 - PERCENT}),
b AS (SELECT doc_id, raw, license, 2.0::DOUBLE * shared / total AS score, row_number() OVER (PARTITION BY doc_id, raw ORDER BY 2.0::DOUBLE * shared / total DESC, template) AS r
      FROM m WHERE 200 * shared >= {PERCENT} * total),
d AS (SELECT doc_id, license, score, count(*) OVER (PARTITION BY doc_id) AS parts, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, license) AS r FROM b WHERE r = 1)
SELECT x.doc_id, coalesce(d.parts, 0) AS parts, d.license, d.score FROM documents x LEFT JOIN d ON x.doc_id = d.doc_id AND d.r = 1
"""


OP5_SQL = _sql()
