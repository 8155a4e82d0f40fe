"""Cross-site line dedup.

A line's spread is the number of distinct sites that carry it. HyperLogLog sketches of sites, one for each line hash,
merge by aggregation; only lines whose estimate lies near the threshold get an exact distinct count. Lines that spread
over enough sites are boilerplate and stay in one place only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_or_shuffled, table, without, written

MIN_SITES = 10
LG_K = 8
#: Estimates within this share of the threshold are counted exactly: over five standard errors of a sketch of 2^LG_K.
NEAR = 0.4


#: Characters that a blank line may have.
BLANKS = " \t\x0b\x0c\r"


def document_lines(docs: DataFrame, site: str = "source") -> DataFrame:
    """One row for each line: doc_id, text_hash, site, pos, line_hash; lines of white space and null texts give none."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.col(site).cast("string").alias("site"), F.split("text", "\n").alias("lines"))
    exploded = rows.select("doc_id", "text_hash", "site", F.posexplode("lines").alias("pos", "line"))
    return exploded.filter(F.btrim("line", F.lit(BLANKS)) != "").select("doc_id", "text_hash", "site", "pos", F.xxhash64("line").alias("line_hash"))


def frequent_lines(docs: DataFrame, site: str = "source", least: int = MIN_SITES) -> DataFrame:
    """``document_lines`` that occur at least ``least`` times in all, written once. A line can't be on more sites than it
    has occurrences, so a plain count, summed up where the lines are, leaves few of them."""
    often = document_lines(docs, site).groupBy("line_hash").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least).select("line_hash")
    return written(document_lines(docs, site).join(small_or_shuffled(often, "often"), "line_hash", "left_semi"), "frequent")


def boilerplate_lines(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """Hashes of those of ``frequent_lines`` on at least ``min_sites`` distinct sites in at least as many distinct texts,
    with the smallest doc_id that has them (``first_doc``).

    The second condition keeps a text that is merely copied to many sites whole: copies are for document dedup.
    Null sites count as no site.
    """
    sketched = written(
        lines.groupBy("line_hash").agg(
            F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LG_K))).alias("sites"),
            F.hll_sketch_estimate(F.hll_sketch_agg("text_hash", F.lit(LG_K))).alias("texts"),
            F.min("doc_id").alias("first_doc"),
        ),
        "sketched",
    )
    least = F.least("sites", "texts")
    sure = sketched.filter(least >= min_sites * (1 + NEAR)).select("line_hash", "first_doc")
    near = sketched.filter((least >= min_sites * (1 - NEAR)) & (least < min_sites * (1 + NEAR))).select("line_hash", "first_doc")
    # Distinct pairs first, so a hot line is many small groups and never one set.
    checked = lines.join(small_or_shuffled(near, "near"), "line_hash")
    exact_sites = checked.filter("site is not null").groupBy("line_hash", "first_doc", "site").agg(F.lit(1).alias("one")).groupBy("line_hash", "first_doc").agg(F.count("one").alias("sites"))
    exact_texts = checked.groupBy("line_hash", "text_hash").agg(F.lit(1).alias("one")).groupBy("line_hash").agg(F.count("one").alias("texts"))
    exact = exact_sites.filter(F.col("sites") >= min_sites).join(exact_texts.filter(F.col("texts") >= min_sites), "line_hash", "left_semi")
    return sure.unionByName(exact.select("line_hash", "first_doc"))


def remove_boilerplate(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """``docs`` with boilerplate lines cut from ``text``, and ``removed_lines`` (int).

    Of each such line, the first occurrence in the document with the smallest doc_id stays. Lines end at a line feed;
    lines of white space alone (a carriage return among it) are never boilerplate. Rows keep their other columns; a null
    text stays null and an empty one empty. Rows that repeat a doc_id are told apart by their text, and equal rows are
    treated alike; a line whose documents all have null doc_id is removed everywhere. A column named removed_lines is
    replaced.
    """
    lines = frequent_lines(docs, site, min_sites)
    hits = lines.join(small_or_shuffled(boilerplate_lines(lines, min_sites), "boilerplate"), "line_hash")
    per_line = hits.groupBy("doc_id", "text_hash", "line_hash").agg(F.sort_array(F.collect_set("pos")).alias("at"), F.first("first_doc").alias("first_doc"))
    dropped = F.when(F.col("doc_id") == F.col("first_doc"), F.expr("slice(at, 2, size(at))")).otherwise(F.col("at"))
    cuts = per_line.groupBy(F.col("doc_id").alias("cut_doc"), F.col("text_hash").alias("cut_hash")).agg(F.flatten(F.collect_list(dropped)).alias("cut"))
    rows = without(docs, "removed_lines").select(F.struct("*").alias("doc"), "doc_id", "text", F.xxhash64("text").alias("text_hash"))
    joined = rows.join(cuts, F.col("doc_id").eqNullSafe(F.col("cut_doc")) & (F.col("text_hash") == F.col("cut_hash")), "left")
    # Lines are split once (as the variable of a lambda) and places compared by hash, so the work grows with the lines.
    kept = F.expr("transform(array(split(text, '\n')), lines -> array_join(transform(array_except(sequence(0, size(lines) - 1), cut), i -> lines[i]), '\n'))[0]")
    fields = {c: F.col(f"doc.`{c}`") for c in docs.columns if c.lower() != "removed_lines"}
    fields["text"] = F.when(F.size(F.coalesce("cut", F.array())) > 0, kept).otherwise(F.col("text"))
    return joined.select(*[v.alias(k) for k, v in fields.items()], F.size(F.coalesce("cut", F.array())).alias("removed_lines"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: doc_id, removed_lines, kept_bytes and kept_md5 of the text that is left."""
    out = remove_boilerplate(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return out.select("doc_id", "removed_lines", F.octet_length("text").cast("long").alias("kept_bytes"), F.md5(F.col("text").cast("binary")).alias("kept_md5"))


OP2_SQL = f"""
WITH l AS (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents),
b AS (SELECT line, min(doc_id) AS first_doc FROM l WHERE trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) <> '' GROUP BY line
      HAVING count(DISTINCT source) >= {MIN_SITES} AND count(DISTINCT text) >= {MIN_SITES}),
m AS (SELECT l.doc_id, l.pos, l.line, b.line IS NOT NULL
        AND NOT (l.doc_id = b.first_doc AND row_number() OVER (PARTITION BY l.doc_id, l.line ORDER BY l.pos) = 1) AS gone
      FROM l LEFT JOIN b ON l.line = b.line),
t AS (SELECT doc_id, CAST(count(*) FILTER (gone) AS INTEGER) AS removed_lines, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS kept FROM m GROUP BY doc_id)
SELECT d.doc_id, coalesce(t.removed_lines, 0) AS removed_lines, CAST(strlen(t.kept) AS BIGINT) AS kept_bytes, md5(t.kept) AS kept_md5
FROM documents d LEFT JOIN t USING (doc_id)
"""
