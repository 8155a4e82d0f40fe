"""From raw documents to packed training sequences, in five stages.

Each stage takes what the one before has kept; ``STAGES`` names them in order. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.common import written
from tideline.llm.decontaminate import drop_contaminated
from tideline.llm.langid import keep_identified, training_rows
from tideline.llm.lines import remove_boilerplate
from tideline.llm.near_dup import NearDup, drop_near_duplicates
from tideline.llm.packing import pack_documents

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language isn't rejected. The models learn from the labelled training rows of ``docs``."""
    return keep_identified(docs, training_rows())


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that many sites share; n_chars follows the text where it has changed."""
    cut = remove_boilerplate(docs)
    n_chars = F.when(F.col("removed_lines") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", n_chars).select(*docs.columns)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity of 0.8 or more."""
    return drop_near_duplicates(docs, NearDup(words=5, percent=80))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), min_words=1)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of all documents, in pieces placed in sequences of 4096."""
    return pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_near),
    ("decontamination", decontaminate),
    ("packing", pack_sequences),
]

#: Kneser-Ney models, MinHash and edit distance are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
