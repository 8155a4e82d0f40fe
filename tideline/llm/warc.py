"""WARC archives with revisit records.

Headers alone are shuffled by payload digest to find, for equal payloads, the one record that keeps the payload; pages
are written as WARC records by Spark's text writer (records are text, their terminator is a line separator to it), as
gzip files, as many as the pages have partitions. The reader takes any archive: files are cut where a version line may
begin, and what a record's Content-Length claims is put together again.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import python_ready, shared_folder, table, text_or_empty

CRLF = "\r\n"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_URN = "urn:x-page:"
#: What every record of every version begins with; archives are cut there.
VERSION = "WARC/"
#: Names of files that Spark reads in one piece.
UNSPLIT = r"\.(gz|gzip|deflate|snappy|lz4|zst)$"


def resolve_originals(headers: DataFrame, min_bytes: int = 1000) -> DataFrame:
    """``headers(page_id, payload_digest, payload_bytes)`` -> one row per payload that several records share:
    ``payload_digest, payload_bytes, original`` (the largest page_id). Smaller payloads are left out."""
    return (
        headers.filter(F.col("payload_bytes") >= min_bytes)
        .groupBy("payload_digest", "payload_bytes")
        .agg(F.max("page_id").alias("original"), F.count(F.lit(1)).alias("records"))
        .filter((F.col("records") > 1) & F.col("original").isNotNull())
        .drop("records")
    )


def plan_records(pages: DataFrame, min_bytes: int = 1000) -> DataFrame:
    """``pages(page_id, url, html, ...)`` as page_id, url, html, payload_digest, payload_bytes, record_type, refers_to.

    A row is a revisit if another row has the same payload of at least ``min_bytes`` and a larger page_id (a null
    page_id is smaller than any other). Rows that share the largest page_id are all responses. Null html is an empty
    payload; a null url stays null; other columns are not carried.

    Revisits are resolved among headers; pages meet the decisions by page_id, so a payload that millions share burdens
    no task with its copies.
    """
    payload = text_or_empty("html")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        payload.alias("html"),
        F.sha1(payload.cast("binary")).alias("payload_digest"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
    )
    headers = rows.select("page_id", "payload_digest", "payload_bytes")
    met = headers.join(resolve_originals(headers, min_bytes), ["payload_digest", "payload_bytes"])
    revisits = met.filter(~F.col("page_id").eqNullSafe(F.col("original"))).select(F.col("page_id").alias("their_id"), F.col("payload_digest").alias("their_digest"), F.col("original").alias("refers_to")).distinct()
    same = F.col("page_id").eqNullSafe(F.col("their_id")) & (F.col("payload_digest") == F.col("their_digest"))
    return rows.join(revisits, same, "left").select(*rows.columns, F.when(F.col("refers_to").isNotNull(), "revisit").otherwise("response").alias("record_type"), "refers_to")


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing for a null value; values can't break out of their line."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), F.regexp_replace(value, "[\r\n]+", " "), F.lit(CRLF)), F.lit(""))


def write_archives(planned: DataFrame, path: str, date: Column | None = None) -> str:
    """Write a record for each row of ``plan_records`` under ``path``; returns the run's id, which is also that of its
    warcinfo record. ``date`` (a string column in WARC's form) is when a record was captured, now if not given.

    Each file is one gzip stream of many records, so records can't be fetched from within a file.
    """
    run = str(uuid.uuid4())
    date = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'") if date is None else date
    revisit = F.col("record_type") == "revisit"
    block = F.concat(F.lit(HTTP_HEAD), F.when(revisit, "").otherwise(F.col("html")))
    urn = lambda c: F.concat(F.lit(f"<{RECORD_URN}"), c.cast("string"), F.lit(">"))
    record = F.concat(
        F.lit(f"{VERSION}1.1{CRLF}"),
        _line("WARC-Type", F.col("record_type")),
        _line("WARC-Record-ID", F.coalesce(urn(F.col("page_id")), F.concat(F.lit("<urn:uuid:"), F.uuid(), F.lit(">")))),
        _line("WARC-Date", date),
        _line("WARC-Warcinfo-ID", F.lit(f"<urn:uuid:{run}>")),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "payload_digest")),
        _line("WARC-Profile", F.when(revisit, REVISIT_PROFILE)),
        _line("WARC-Refers-To", urn(F.col("refers_to"))),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", F.octet_length(block).cast("string")),
        F.lit(CRLF),
        block,
        F.lit(CRLF),
    )
    about = "software: tideline" + CRLF
    info = F.concat(
        F.lit(f"{VERSION}1.1{CRLF}WARC-Type: warcinfo{CRLF}WARC-Record-ID: <urn:uuid:{run}>{CRLF}WARC-Date: "),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        F.lit(f"{CRLF}Content-Type: application/warc-fields{CRLF}Content-Length: {len(about)}{CRLF}{CRLF}{about}{CRLF}"),
    )
    for name, records in (("records", planned.select(record.alias("value"))), ("info", planned.sparkSession.range(1).select(info.alias("value")).coalesce(1))):
        records.write.option("lineSep", CRLF).option("compression", "gzip").text(f"{path}/{name}")
    return run


def parse_records(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (lower-case names, first value of each) and block of every record of archives that were cut behind
    each ``VERSION``. A piece within another record's block is put back; what isn't a whole record is an error."""
    mark, fields, want, have = VERSION.encode(), None, 0, []
    for piece in pieces:
        if fields is not None:
            have.append(mark + piece)
        else:
            if not piece.strip():
                continue
            head, gap, block = piece.partition(b"\r\n\r\n")
            lines = head.replace(b"\r\n ", b" ").replace(b"\r\n\t", b" ").split(b"\r\n")
            fields = {}
            for line in lines[1:]:
                name, colon, value = line.partition(b":")
                if colon:
                    fields.setdefault(name.strip().lower().decode("utf-8", "replace"), value.strip().decode("utf-8", "replace"))
            if not gap or not fields.get("content-length", "").isdigit():
                raise ValueError(f"not a WARC record: {piece[:80]!r}")
            want, have = int(fields["content-length"]), [block]
        got = sum(map(len, have))
        if got >= want:
            block = b"".join(have)
            if block[want:].strip(b"\r\n"):
                raise ValueError("a record is longer than its Content-Length")
            yield fields, block[:want]
            fields, have = None, []
    if fields is not None:
        raise ValueError("a record is cut short")


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows(found: list[tuple[dict[str, str], bytes]]) -> pa.RecordBatch:
        heads = pa.array([list(f.items()) for f, _ in found], pa.map_(pa.string(), pa.string()))
        return pa.RecordBatch.from_arrays([heads, pa.array([b for _, b in found], pa.binary())], names=["fields", "block"])

    found, size = [], 0
    pieces = (x for batch in batches for x in zip(*batch.to_pydict().values(), strict=True))
    for _, of_file in groupby(pieces, key=itemgetter(1)):
        for record in parse_records(value for value, _ in of_file):
            found.append(record)
            size += len(record[1])
            if size > 4 << 20:
                yield rows(found)
                found, size = [], 0
    yield rows(found)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the WARC files (plain or gzip, one stream or one for each record, any version) at ``path``: fields
    (header names in lower case -> value) and block (binary).

    A file is one task's, since only what stands before says whether a version line begins a record or is part of a
    payload: gzip files are read by one, the pieces of a plain file, which several tasks read, are sorted back together.
    Tasks hold a record at a time. A file that ends within a record fails the job.
    """
    python_ready(spark)
    pieces, fields = spark.read.option("lineSep", VERSION).text(path), "fields map<string,string>, block binary"
    whole = F.col("_metadata.file_name").rlike(UNSPLIT)
    value = F.col("value").cast("binary").alias("value")
    packed = pieces.filter(whole).select(value, F.col("_metadata.file_path").alias("file"))
    plain = pieces.filter(~whole).select(value, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("begins"), F.monotonically_increasing_id().alias("nth"))
    plain = plain.repartition("file").sortWithinPartitions("file", "begins", "nth").select("value", "file")
    return packed.mapInArrow(_parsed, fields).unionByName(plain.mapInArrow(_parsed, fields))


def _hex_digest(digest: Column) -> Column:
    """A SHA-1 digest as lower-case hex, which other writers give in base 32: eight letters are ten hex digits."""
    figures = F.translate(F.upper(digest), "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "0123456789ABCDEFGHIJKLMNOPQRSTUV")
    parts = [F.lpad(F.conv(F.substring(figures, at, 8), 32, 16), 10, "0") for at in (1, 9, 17, 25)]
    return F.lower(F.when(F.length(digest) == 32, F.concat(*parts)).otherwise(digest))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Responses and revisits of archives: page_id (null where the record's id isn't one of ``write_archives``), record_id,
    url, record_type, refers_to, refers_to_id, header_digest (of sha1) and payload (binary; null for revisits).

    The payload is what follows the HTTP header of the block, as it is; blocks of other types are payload as a whole.
    """
    block, field = F.col("block"), lambda name: F.col("fields")[name]
    http = F.lower(field("content-type")).startswith("application/http")
    head = F.octet_length(F.substring_index(block.cast("string"), CRLF * 2, 1))
    body = F.substring(block, head + 5, F.octet_length(block))
    page = lambda c: F.nullif(F.regexp_extract(c, f"<{RECORD_URN}(-?[0-9]+)>", 1), F.lit("")).cast("long")
    return (
        read_records(spark, path)
        .filter(field("warc-type").isin("response", "revisit"))
        .select(
            page(field("warc-record-id")).alias("page_id"),
            field("warc-record-id").alias("record_id"),
            field("warc-target-uri").alias("url"),
            field("warc-type").alias("record_type"),
            page(field("warc-refers-to")).alias("refers_to"),
            field("warc-refers-to").alias("refers_to_id"),
            F.nullif(_hex_digest(F.regexp_extract(field("warc-payload-digest"), "(?i)^sha1:(.+)$", 1)), F.lit("")).alias("header_digest"),
            F.when(field("warc-type") == "response", F.when(http, body).otherwise(block)).alias("payload"),
        )
    )


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Records with the digest and length of their full payload: of their own, or of the response a revisit refers to.

    A revisit whose response isn't there keeps its header's digest and has a null length.
    """
    own = records.withColumns({"own_digest": F.sha1("payload"), "own_bytes": F.octet_length("payload").cast("long")}).drop("payload")
    responses = (
        own.filter("record_type = 'response' and record_id is not null")
        .groupBy(F.col("record_id").alias("refers_to_id"), F.col("own_digest").alias("header_digest"))
        .agg(F.max("own_bytes").alias("their_bytes"))
    )
    return own.join(responses, ["refers_to_id", "header_digest"], "left").select(
        "page_id",
        "url",
        F.coalesce("own_bytes", "their_bytes").alias("payload_bytes"),
        F.coalesce("own_digest", "header_digest").alias("payload_digest"),
        "record_type",
        "refers_to",
    )


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/warc"
    write_archives(plan_records(table(spark, sf_dir, "pages")), path)
    return resolve_revisits(read_archives(spark, f"{path}/*")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP3_SQL = """
WITH h AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
o AS (SELECT payload_digest, max(page_id) AS original FROM h WHERE payload_bytes >= 1000 GROUP BY 1 HAVING count(*) > 1)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN original IS NOT NULL AND page_id IS DISTINCT FROM original THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM original THEN original END AS refers_to
FROM h LEFT JOIN o USING (payload_digest)
"""
