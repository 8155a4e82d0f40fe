"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new path in the folder that all executors share.

    The cluster names that folder in ``spark.checkpoint.dir``. Only a single-JVM session (tests) may go without it:
    there one is made and set.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="tideline-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/tideline-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again: cuts lineage, survives lost executors."""
    path = f"{shared_folder(df.sparkSession)}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_or_shuffled(df: DataFrame, name: str, most_rows: int = 200_000) -> DataFrame:
    """``df`` written, and marked for broadcast if it turns out to have at most ``most_rows`` (narrow) rows."""
    rows = written(df, name)
    return F.broadcast(rows) if rows.count() <= most_rows else rows


def text_or_empty(col: str | Column = "text") -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns that an operator is about to produce, whatever their case."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def rows_of(docs: DataFrame, found: DataFrame, how: str) -> DataFrame:
    """The rows of ``docs`` that have (left_semi) or lack (left_anti) their doc_id and text among ``found(doc_id,
    text_hash)``, with two keys beside them: columns row (all of a row's), own_id and own_hash.

    A row travels as one struct, so no name of its columns can clash. The keys are never null (a null doc_id is ''), so
    what groups by them after the join needs no second shuffle of the texts.
    """
    key = F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit(""))
    rows = docs.select(F.struct("*").alias("row"), key.alias("own_id"), F.xxhash64("text").alias("own_hash"))
    theirs = found.select(key.alias("own_id"), F.col("text_hash").alias("own_hash"))
    return rows.join(theirs, ["own_id", "own_hash"], how)


def unpacked(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of ``rows(row, ...)`` as they were."""
    return rows.select(*[F.col(f"row.`{c}`").alias(c) for c in columns])


_SHIPPED: set[str] = set()


def python_ready(spark: SparkSession, mb: int = 8) -> None:
    """Let Python workers import this package, and get at most ``mb`` MB of rows at a time (a larger row comes whole).

    The package is sent through Spark once for each application, so sessions started elsewhere can use it too.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(mb << 20))
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        package = Path(__file__).resolve().parent.parent
        at = Path(tempfile.mkdtemp(prefix="tideline-")) / "package.zip"
        with zipfile.ZipFile(at, "w") as z:
            for f in sorted(package.rglob("*.py")):
                z.write(f, f.relative_to(package.parent))
        spark.sparkContext.addPyFile(str(at))
        _SHIPPED.add(app)
