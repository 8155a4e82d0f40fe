"""Sinks of rounds and histories with one commit.

``format("tideline_lines")`` takes a column of lines. Every task writes a file of its own name and tells the driver; the
driver commits a run by one small file that lists them. What no commit lists was never written: files of tasks that
failed or ran twice, or of a run that broke off. A run that is committed is not committed again, so repeating it changes
nothing. With ``mode("overwrite")`` a commit takes the place of all before it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow.fs import FileSystem, FileType
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from . import landed


@dataclass
class Written(WriterCommitMessage):
    """A task's file, its lines, and how many there are."""

    file: str
    lines: int


class LinesWriter(DataSourceArrowWriter):
    def __init__(self, path: str, run: str, header: str, replaces: bool):
        self.path, self.run, self.header, self.replaces = path, run, header, replaces

    def _at(self, *parts: str) -> tuple[FileSystem, str]:
        files, root = FileSystem.from_uri(self.path)
        return files, "/".join([root.rstrip("/"), *parts])

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        name, lines = f"{self.run}-{uuid.uuid4().hex}.txt", 0
        files, folder = self._at("lines")
        files.create_dir(folder, recursive=True)
        with files.open_output_stream(f"{folder}/{name}") as out:
            for batch in iterator:
                for value in batch.column(0).to_pylist():
                    out.write(f"{value}\n".encode())
                lines += batch.num_rows
        return Written(name, lines)

    def commit(self, messages: list[Written | None]) -> None:
        done = [m for m in messages if m is not None]
        files, folder = self._at("commits")
        files.create_dir(folder, recursive=True)
        known = sorted(x.base_name for x in files.get_file_info(pa.fs.FileSelector(folder)) if x.type == FileType.File and x.base_name.endswith(".json"))
        same = [x for x in known if x.split("-", 1)[1] == f"{self.run}.json"]
        if same:
            # What the run's own commit lists stays: the driver may ask for it twice.
            with files.open_input_stream(f"{folder}/{same[0]}") as told:
                listed = json.loads(told.read())["files"]
            self.abort([m for m in done if m.file not in listed])
            return
        nth = int(known[-1].split("-", 1)[0]) + 1 if known else 0
        told = {"nth": nth, "run": self.run, "replaces": self.replaces, "header": self.header, "files": [m.file for m in done if m.lines], "lines": sum(m.lines for m in done)}
        # Written aside and moved, so a reader sees a commit as a whole or not at all.
        aside = f"{folder}/.{uuid.uuid4().hex}"
        with files.open_output_stream(aside) as out:
            out.write(json.dumps(told).encode())
        files.move(aside, f"{folder}/{nth:08d}-{self.run}.json")

    def abort(self, messages: list[Written | None]) -> None:
        files, folder = self._at("lines")
        for m in messages:
            if m is not None:
                files.delete_file(f"{folder}/{m.file}")


class LinesSource(DataSource):
    """Options: path, run (letters, digits and dots; names the commit) and header (kept with the commit)."""

    @classmethod
    def name(cls) -> str:
        return "tideline_lines"

    def schema(self) -> str:
        return "value string"

    def writer(self, schema: StructType, overwrite: bool) -> LinesWriter:
        run = self.options.get("run", "")
        if not run or not all(c.isalnum() or c == "." for c in run):
            raise ValueError("a run is named by letters, digits and dots")
        if [f.dataType.typeName() for f in schema.fields] != ["string"]:
            raise ValueError("lines are one column of strings")
        return LinesWriter(self.options["path"], run, self.options.get("header", ""), overwrite)


def write_lines(lines: DataFrame, path: str, run: str, replace: bool = False, header: str = "") -> None:
    """Commit ``lines(value)`` under ``path`` as ``run``. Values hold no line feed (they are replaced by blanks) and nulls
    are left out."""
    lines.sparkSession.dataSource.register(LinesSource)
    rows = lines.filter("value is not null").select(F.regexp_replace("value", "[\r\n]+", " ").alias("value"))
    rows.write.format("tideline_lines").mode("overwrite" if replace else "append").options(path=path, run=run, header=header).save()


def commits(spark: SparkSession, path: str) -> list[dict]:
    """The commits under ``path`` that count, in order: those from the last replacing one on. One for each run."""
    files, root = FileSystem.from_uri(path)
    if files.get_file_info(f"{root.rstrip('/')}/commits").type != FileType.Directory:
        return []
    told = sorted((r.asDict() for r in spark.read.schema("nth int, run string, replaces boolean, header string, files array<string>, lines long").json(f"{path.rstrip('/')}/commits").collect()), key=lambda c: c["nth"])
    last = max((i for i, c in enumerate(told) if c["replaces"]), default=0)
    return told[last:]


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """The committed lines under ``path`` as they are now: later commits don't change a frame that is at hand."""
    names = [f for c in commits(spark, path) for f in c["files"]]
    return spark.read.text([f"{path.rstrip('/')}/lines/{f}" for f in names]) if names else spark.createDataFrame([], "value string")


def stored_results(spark: SparkSession, path: str) -> DataFrame:
    """``name, value`` of a result file: lines of numbers and a name."""
    return read_lines(spark, path).select(F.regexp_extract("value", r"^(\S+) (.*)$", 2).alias("name"), F.regexp_extract("value", r"^(\S+) (.*)$", 1).alias("value"))


def store_round(results: DataFrame, failures: DataFrame, registry: DataFrame, path: str, run: str) -> DataFrame:
    """Write a round: results that ``append_results`` appends go to ``path``/results, failures take the place of those in
    ``path``/failures. Returns the conflicts, as rows of name, value, stored (what the file has) and reason; they are
    failures of the round too.

    ``results(name, url, value, seq)``, ``failures(name, url, reason)``; ``registry`` gives failures their region.
    Failures are committed before results, so a site that is refused is never in neither. A round that is repeated, under
    its own name or another, changes nothing of the results; the conflicts of a repeated round are the same.
    """
    spark = results.sparkSession
    decided = landed.append_results(stored_results(spark, f"{path}/results"), results)
    reason = F.concat(F.lit("the result file has another value: "), "stored", F.lit(", this round has "), "value")
    conflicts = decided.filter("action = 'conflict'").select("name", "value", "stored", reason.alias("reason"))
    urls = results.groupBy("name").agg(F.min("url").alias("url"))
    bad = failures.select("name", "url", "reason").unionByName(conflicts.join(urls, "name").select("name", "url", "reason")).distinct()
    write_lines(landed.failure_lines(landed.failure_rows(bad, registry)), f"{path}/failures", run, replace=True)
    write_lines(decided.filter("action = 'append'").select(F.concat_ws(" ", "value", "name").alias("value")), f"{path}/results", run)
    return conflicts


def write_history(history: DataFrame, registry: DataFrame, path: str, run: str, periods: int = 10, updated_at: str = "") -> None:
    """Replace the history under ``path``: one line of JSON for each site and each failure, the header with the commit."""
    header = landed.history_header(history).first()
    told = {"base_period": header["base_period"], "periods": periods, "updated_at": updated_at, "version": 1}
    sites = landed.history_documents(history, registry)
    line = F.to_json(F.struct(F.lit("site").alias("kind"), "id", F.col("site_name").alias("name"), F.col("site_url").alias("url"), "contract", "pick", "browser", "click_first", F.col("values").alias("fingerprint")))
    failed = history.filter("state = 'failed'")
    bad = F.to_json(F.struct(F.lit("failure").alias("kind"), F.col("site_name").alias("name"), F.col("site_url").alias("url"), F.col("period").cast("string").alias("issue"), F.lit("failed").alias("status"), "reason"))
    write_lines(sites.select(line.alias("value")).unionByName(failed.select(bad.alias("value"))), path, run, replace=True, header=json.dumps(told))


def stored_history(spark: SparkSession, path: str) -> DataFrame:
    """What ``write_history`` wrote, as long rows."""
    lines = read_lines(spark, path)
    kind = F.get_json_object("value", "$.kind")
    whole = lambda name: F.concat(F.lit(f'{{"{name}":['), "value", F.lit("]}"))
    return landed.read_history(lines.filter(kind == "site").select(whole("sites").alias("value")).unionByName(lines.filter(kind == "failure").select(whole("failures").alias("value"))))
