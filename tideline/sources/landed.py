"""Readers and writers of registries, landed pages, result files and histories."""

from __future__ import annotations

import gzip
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as t

SITE = ["site_name", "site_url"]
# Directions a contract may state, and the name of a period's result file.
REGIONS = ["top", "bottom", "上", "下", "顶部", "尾部"]
PERIOD_FILE = r"(\d+)期-杀数字-成功\.txt$"
RESULT_LINE = r"^(?U:\s)*([0-9０-９,，.．\s]+?)(?U:\s)+(.+?)(?U:\s)+(\d+(?U:\s)*期)(?U:\s)*$"
CHARSETS = ["utf-8", "gb18030", "big5", "latin-1"]


def read_registry(spark: SparkSession, path: str, active: bool = True) -> DataFrame:
    """A JSON array of contracts, one row each: ord and raw; only those that aren't disabled, if ``active``.

    A missing file or an entry that is no object fails.
    """
    text = spark.read.text(path, wholetext=True)
    entries = text.select(F.posexplode(F.variant_get(F.parse_json("value"), "$", "array<variant>")).alias("ord", "v"))
    raw = F.to_json("v")
    checked = entries.select("ord", F.when(F.startswith(F.schema_of_variant("v"), F.lit("OBJECT")), raw).otherwise(F.raise_error(F.lit("a registry entry is no object"))).alias("raw"))
    return checked.filter(~F.coalesce(F.try_variant_get(F.parse_json("raw"), "$.disabled", "boolean"), F.lit(False))) if active else checked


def _field(name: str, kind: str) -> Column:
    return F.try_variant_get(F.parse_json("raw"), f"$.{name}", kind)


def _kind(name: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(F.parse_json("raw"), f"$.{name}", "variant"))


def registry_violations(registry: DataFrame) -> DataFrame:
    """What is wrong with contracts ``(ord, raw)``: ord, violation. Flags must be JSON booleans, counts JSON integers; active
    names must be unique."""
    absent = lambda n: _kind(n).isNull() | (_kind(n) == "VOID")
    whole = lambda n: absent(n) | ((_kind(n) == "BIGINT") & (_field(n, "long") > 0))
    rules = [
        F.when(F.coalesce(_field("url", "string"), F.lit("")) == "", "no url"),
        F.when(~F.coalesce(_field("region", "string").isin(REGIONS), F.lit(False)), "region"),
        *[F.when(~absent(n) & (_kind(n) != "BOOLEAN"), f"{n} is no boolean") for n in ("disabled", "allow_ambiguous", "allow_duplicate_numbers")],
        *[F.when(~F.coalesce(whole(n), F.lit(False)), f"{n} is no positive integer") for n in ("count", "issue_position_window")],
        F.when(~absent("recent_history_count") & ~F.coalesce((_kind("recent_history_count") == "BIGINT") & _field("recent_history_count", "long").between(1, 10), F.lit(False)), "recent_history_count is not 1 to 10"),
        F.when(F.size(_field("allowed_source_types", "array<string>")) != F.size(F.array_distinct(_field("allowed_source_types", "array<string>"))), "allowed_source_types repeat"),
    ]
    own = registry.select("ord", F.explode(F.array_compact(F.array(*rules))).alias("violation"))
    named = registry.select("ord", _field("name", "string").alias("name"), F.coalesce(_field("disabled", "boolean"), F.lit(False)).alias("off")).filter("name is not null and not off")
    again = named.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("name"))).filter("n > 1").select("ord", F.lit("name is not unique").alias("violation"))
    return own.unionByName(again)


def region_problems(registry: DataFrame) -> DataFrame:
    """Contracts ``(site_name, site_url, region)`` whose region is missing or unknown, one row each."""
    known = t.normalize_region(F.col("region"))
    reason = F.when(F.coalesce(F.trim("region"), F.lit("")) == "", "region missing").when(known == "", "region unknown")
    return registry.select("site_name", "site_url", reason.alias("reason")).filter("reason is not null")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed pages by URL without its fragment, the first of a URL's rows by page_id."""
    pages = spark.read.parquet(path).withColumn("key", t.drop_fragment(F.col("url")))
    return pages.groupBy("key").agg(F.min_by(F.struct("page_id", "html"), "page_id").alias("p")).select(F.col("key").alias("url"), "p.page_id", "p.html")


def _decode(data: bytes, charset: str | None) -> str:
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    if charset:
        return data.decode(charset, "replace")
    named = re.search(rb"charset=[\"']?([\w-]+)", data[:3000], re.I)
    for name in [*([named[1].decode("ascii")] if named else []), *CHARSETS]:
        try:
            return data.decode(name)
        except (UnicodeDecodeError, LookupError):
            continue
    return data.decode("utf-8", "replace")


def decode_pages(files: DataFrame, charset: str | None = None) -> DataFrame:
    """``files(path, content)`` as path and text: unzipped, and decoded by the given charset, else the one the page names,
    else the first that fits. Spark has no decoder for these charsets, so Python decodes Arrow batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([None if x is None else _decode(x, charset) for x in batch.column(1).to_pylist()], pa.string())], names=["path", "text"])

    return files.select("path", "content").mapInArrow(run, "path string, text string")


def discover_inputs(spark: SparkSession, globs: list[str]) -> DataFrame:
    """Files that any of the globs names, each once whatever the case of its path."""
    found = spark.read.format("binaryFile").load(globs).select("path")
    return found.groupBy(F.lower("path").alias("key")).agg(F.min("path").alias("path")).select("path")


def read_period_files(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``files(path, text)`` of lines "numbers name period" as records and as lines that are none.

    In a file named after a period, lines may leave theirs out, and lines with another one are refused.
    """
    default = F.regexp_extract("path", PERIOD_FILE, 1)
    lines = files.select("path", F.nullif(default, F.lit("")).cast("int").alias("of_file"), F.posexplode(F.split(F.regexp_replace("text", "^\ufeff", ""), r"\r\n|\n|\r")).alias("at", "raw")).filter(F.col("raw").rlike(r"(?U)\S"))
    own = F.col("raw").rlike(RESULT_LINE)
    line = F.when(own | F.col("of_file").isNull(), F.col("raw")).otherwise(F.concat("raw", F.lit(" "), F.col("of_file").cast("string"), F.lit("期")))
    parsed = lines.withColumn("line", line).select(
        "path",
        (F.col("at") + 1).alias("line_no"),
        "raw",
        "of_file",
        t.normalize_numbers(F.regexp_extract("line", RESULT_LINE, 1)).alias("value"),
        F.regexp_replace(F.trim(F.regexp_extract("line", RESULT_LINE, 2)), r"(?U)\s+", " ").alias("site_name"),
        F.nullif(F.regexp_replace(F.regexp_extract("line", RESULT_LINE, 3), "[^0-9]", ""), F.lit("")).cast("int").alias("period"),
    )
    good = F.col("period").isNotNull() & F.coalesce(F.col("of_file") == F.col("period"), F.lit(True))
    return parsed.filter(good).select("path", "line_no", "site_name", "period", "value", "raw"), parsed.filter(~good).select("path", "line_no", "raw")


HISTORY_SCHEMA = "base_period int, periods int, updated_at string, version int, sites array<struct<id string, name string, url string, contract string, pick string, fingerprint map<string, string>>>, failures array<struct<name string, url string, issue string, status string, reason string>>, records array<struct<name string, url string, issue string, numbers string>>"


def read_history(docs: DataFrame) -> DataFrame:
    """History documents ``(value)`` of either layout as long rows: site, period, state, value, reason."""
    parsed = docs.select(F.from_json("value", HISTORY_SCHEMA).alias("d"))
    none = F.lit(None).cast("string")
    sites = parsed.select(F.explode("d.sites").alias("s")).select(F.col("s.name").alias("site_name"), F.col("s.url").alias("site_url"), F.explode("s.fingerprint").alias("issue", "value"))
    older = parsed.select(F.explode("d.records").alias("r")).select(F.col("r.name").alias("site_name"), F.col("r.url").alias("site_url"), F.col("r.issue").alias("issue"), F.col("r.numbers").alias("value"))
    good = sites.unionByName(older).select(*SITE, t.try_period(F.col("issue")).alias("period"), F.lit("success").alias("state"), "value", none.alias("reason"))
    bad = parsed.select(F.explode("d.failures").alias("f")).select(F.col("f.name").alias("site_name"), F.col("f.url").alias("site_url"), t.try_period(F.col("f.issue")).alias("period"), F.lit("failed").alias("state"), none.alias("value"), F.col("f.reason").alias("reason"))
    return good.unionByName(bad).filter("period is not null")


def history_documents(history: DataFrame, registry: DataFrame | None = None) -> DataFrame:
    """Long rows as one row for each site: its values by period from new to old (``values``, and ``fingerprint`` as JSON),
    its failures, latest period, id, and what its contract says: hash (contract), pick, browser, click_first.

    ``registry(site_name, site_url, ord, raw)``; a site that it doesn't have has an empty contract and pick. An id is the
    contract's own, else made of the site's place (in the registry's order, then by name) and URL; one that is taken gets
    its place as a suffix. A site and period with two rows fails the job.
    """
    per_key = history.groupBy(*SITE, "period").agg(F.count(F.lit(1)).alias("n"), F.max("state").alias("state"), F.max("value").alias("value"))
    once = per_key.withColumn("value", F.when(F.col("n") > 1, F.raise_error(F.lit("two rows for one site and period"))).otherwise(F.col("value")))
    newest = F.sort_array(F.collect_list(F.when(F.col("state") == "success", F.struct("period", "value"))), asc=False)
    values = F.map_from_entries(F.transform(newest, lambda x: F.struct(x["period"].cast("string"), x["value"])))
    grouped = once.groupBy(*SITE).agg(values.alias("values"), F.count_if(F.col("state") == "failed").alias("failures"), F.max("period").alias("latest"))
    sites = grouped.withColumn("fingerprint", F.to_json("values"))
    if registry is None:
        return sites.withColumn("id", t.site_slug(F.col("site_url")))
    told = registry.select(
        *SITE,
        "ord",
        F.nullif(F.trim(_field("id", "string")), F.lit("")).alias("own_id"),
        t.contract_hash(F.col("raw")).alias("contract"),
        t.normalize_region(_field("region", "string")).alias("pick"),
        F.coalesce(_field("browser", "boolean"), _field("browser_fallback", "boolean"), F.lit(False)).alias("browser"),
        F.coalesce(_field("click_first", "boolean"), _field("position", "string") == "first", F.lit(False)).alias("click_first"),
    )
    joined = sites.join(told, SITE, "left").withColumns({"contract": F.coalesce("contract", F.lit("")), "pick": F.coalesce("pick", F.lit("")), "browser": F.coalesce("browser", F.lit(False)), "click_first": F.coalesce("click_first", F.lit(False))})
    # Sites are as many as the registry has, so their places are counted in one window.
    place = F.row_number().over(Window.orderBy(F.col("ord").isNull(), "ord", *SITE))
    named = joined.withColumn("place", place).withColumn("id", F.coalesce("own_id", F.concat(F.format_string("s%03d_", "place"), t.site_slug(F.col("site_url")))))
    again = F.row_number().over(Window.partitionBy("id").orderBy("place")) > 1
    suffixed = F.concat("id", F.format_string("_%03d", "place"))
    return named.withColumn("again", again).withColumn("id", F.when(F.col("again"), suffixed).otherwise(F.col("id"))).drop("again", "own_id", "ord", "place")


def history_header(history: DataFrame) -> DataFrame:
    """One row: base_period, the latest period of successes and failures (0 if there is none)."""
    return history.agg(F.coalesce(F.max("period"), F.lit(0)).alias("base_period"))


def append_results(existing: DataFrame, new: DataFrame) -> DataFrame:
    """``(name, value)`` of a result file and of a run: what to do with each new row - append, nothing (noop), or a conflict
    with what is ``stored``.

    A line that the file has needs nothing; another value for a name it has is a conflict. Of a new name the first value
    (by ``seq`` where ``new`` has it, else the smallest) is appended, and any other is in conflict with it.
    """
    seq = F.col("seq") if "seq" in new.columns else F.lit(0)
    rows = new.groupBy("name", "value").agg(F.min(seq).alias("seq"))
    first = F.first_value("value").over(Window.partitionBy("name").orderBy("seq", "value"))
    lines = existing.select("name", "value").distinct()
    old = lines.groupBy("name").agg(F.min("value").alias("old"))
    joined = rows.withColumn("first", first).join(old, "name", "left").join(lines.withColumn("there", F.lit(True)), ["name", "value"], "left")
    action = F.when(F.col("there"), "noop").when(F.col("old").isNotNull(), "conflict").when(F.col("value") == F.col("first"), "append").otherwise("conflict")
    return joined.select("name", "value", action.alias("action"), F.when(action == "conflict", F.coalesce("old", "first")).alias("stored"))


def failure_rows(failures: DataFrame, registry: DataFrame) -> DataFrame:
    """``failures(name, url, reason)`` with category and region: by name and URL, else by URL if just one site has it."""
    one = lambda keys: registry.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.max(t.normalize_region(F.col("region"))).alias("r")).filter("n = 1").drop("n")
    exact = one(SITE).toDF("name", "url", "exact")
    by_url = one(["site_url"]).toDF("url", "by_url")
    named = failures.join(exact, ["name", "url"], "left").join(by_url, "url", "left")
    region = F.coalesce(F.nullif("exact", F.lit("")), F.nullif("by_url", F.lit("")), F.lit("unknown"))
    return named.select("name", region.alias("region"), "url", t.failure_category(F.col("reason")).alias("category"), "reason")


def failure_lines(rows: DataFrame) -> DataFrame:
    return rows.select(F.concat_ws(" ", "name", "region", "url", F.concat(F.lit("原因：["), "category", F.lit("] "), "reason")).alias("value"))


def read_failure_lines(lines: DataFrame) -> DataFrame:
    """``lines(file, line_no, value)`` of failure files as blocks: name, region, url, category, reason; of a name the last.

    Lines that begin no block belong to the one before.
    """
    head = r"^(.+?) (?:(top|bottom|unknown) )?(https?://\S+) 原因：(?:\[([^\]]*)\] )?(.*)$"
    block = F.sum(F.col("value").rlike(head).cast("int")).over(Window.partitionBy("file").orderBy("line_no"))
    rows = lines.withColumn("block", block).filter("block > 0")
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line_no", "value"))), lambda x: x["value"]), "\n")
    whole = rows.groupBy("file", "block").agg(text.alias("text"), F.min("line_no").alias("line_no"))
    pattern = "(?s)" + head
    part = lambda i: F.regexp_extract("text", pattern, i)
    parsed = whole.select("file", "line_no", part(1).alias("name"), F.nullif(part(2), F.lit("")).alias("region"), part(3).alias("url"), F.nullif(part(4), F.lit("")).alias("category"), part(5).alias("reason"))
    return parsed.groupBy("file", "name").agg(F.max_by(F.struct("region", "url", "category", "reason", "line_no"), "line_no").alias("b")).select("file", "name", "b.*")


def round_report(results: DataFrame, failures: DataFrame) -> DataFrame:
    """Counts of a round by section: successes, then failures by category."""
    good = results.agg(F.lit("success").alias("section"), F.lit("").alias("category"), F.count(F.lit(1)).alias("n"))
    bad = failures.groupBy(t.failure_category(F.col("reason")).alias("category")).agg(F.count(F.lit(1)).alias("n")).select(F.lit("failure").alias("section"), "category", "n")
    return good.unionByName(bad)


#: Why a period gave nothing where no file says so.
NO_RECEIPT, NO_RECORD = "no receipt of this run", "in neither file of this run"


def all_periods_failed(runs: DataFrame, registry: DataFrame, periods: list[int]) -> DataFrame:
    """Sites of ``registry(site)`` without a success in any of ``periods`` among ``runs(site, period, ok, reason, receipt)``:
    site, reasons (array of period and reason, in order of the periods).

    Only what has a valid receipt counts. A period's reason is the failure's; a row without receipt says that there is
    none, and a site that a run doesn't have is in neither of its files.
    """
    wanted = sorted(set(periods))
    own = runs.filter(F.col("period").isin(wanted)).groupBy("site", "period").agg(F.bool_or(F.col("receipt") & F.col("ok")).alias("ok"), F.min(F.when(F.col("receipt") & ~F.col("ok"), F.coalesce("reason", F.lit("")))).alias("reason"))
    told = own.groupBy("site").agg(F.bool_or("ok").alias("any"), F.map_from_entries(F.collect_list(F.struct("period", F.coalesce("reason", F.lit(NO_RECEIPT)).alias("reason")))).alias("told"))
    failed = registry.select("site").distinct().join(told, "site", "left").filter(~F.coalesce("any", F.lit(False)))
    reasons = F.array(*[F.struct(F.lit(p).alias("period"), F.coalesce(F.try_element_at("told", F.lit(p)), F.lit(NO_RECORD)).alias("reason")) for p in wanted])
    return failed.select("site", reasons.alias("reasons"))


def receipts(results: DataFrame, failures: DataFrame, registry: DataFrame) -> DataFrame:
    """Sites with a success and no failure, with their contract's hash."""
    good = results.select(*SITE).distinct().join(failures.select(*SITE), SITE, "left_anti")
    return good.join(registry.select(*SITE, "contract"), SITE)


def source_fallback(landed: DataFrame) -> DataFrame:
    """``landed(site, source_rank, content, usable, error)``: each site's first usable source; an error other than "404" at
    a lower rank stops the search, and gives the error."""
    stop = F.min(F.when(F.col("error").isNotNull() & (F.col("error") != "404"), F.col("source_rank")))
    best = landed.groupBy("site").agg(stop.alias("stop"), F.min_by(F.struct("source_rank", "content"), F.when(F.col("usable"), F.col("source_rank"))).alias("b"), F.min_by("error", F.when(F.col("error") != "404", F.col("source_rank"))).alias("error"), F.count_if("usable").alias("n"))
    stopped = (F.col("n") == 0) | (F.col("stop") < F.col("b.source_rank"))
    stopped = F.coalesce(stopped, F.lit(False))
    return best.select("site", F.when(~stopped, F.col("b.source_rank")).alias("source_rank"), F.when(~stopped, F.col("b.content")).alias("content"), F.when(stopped, F.coalesce("error", F.lit("no usable source"))).alias("problem"))


def registry_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Entries ``(site_name, site_url, contract)`` added, removed or changed between two versions."""
    joined = before.select(*SITE, F.col("contract").alias("old")).join(after.select(*SITE, F.col("contract").alias("new")), SITE, "full")
    change = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").when(F.col("old") != F.col("new"), "changed")
    return joined.select(*SITE, change.alias("change")).filter("change is not null")


def active_sites(registry: DataFrame, archived: DataFrame) -> DataFrame:
    """The registry without archived entries that haven't been restored."""
    return registry.join(archived.filter(~F.coalesce("restored", F.lit(False))).select(*SITE), SITE, "left_anti")


_ARTICLE = "id string, author string, name string, title string, body string"


def _plain(text: Column) -> Column:
    """Base64 decoded, if it is valid, at least 8 characters and printable; the text itself otherwise."""
    decoded = F.try_to_binary(text, F.lit("base64")).cast("string")
    ok = (F.length(text) >= 8) & text.rlike(r"^[A-Za-z0-9+/]+={0,2}\z") & decoded.isNotNull() & ~decoded.rlike(r"[\x00-\x08\x0e-\x1f\ufffd]")
    return F.when(F.coalesce(ok, F.lit(False)), decoded).otherwise(text)


def article_documents(landed: DataFrame) -> DataFrame:
    """``landed(site, article_id, author, json)``: the record of that id and author in an article's JSON, or anywhere among
    the sections of landing data, as a text of name, title and body; null and a problem if there is none."""
    schema = f"id string, author string, name string, title string, body string, sectionData map<string, array<struct<{_ARTICLE.replace(' string', ': string')}>>>"
    parsed = landed.select("site", "article_id", F.col("author").alias("wanted"), F.from_json("json", schema).alias("d"))
    own = F.array(F.struct(*[F.col(f"d.{c}").alias(c) for c in ("id", "author", "name", "title", "body")]))
    listed = F.flatten(F.coalesce(F.map_values("d.sectionData"), F.array().cast(f"array<array<struct<{_ARTICLE.replace(' string', ': string')}>>>")))
    fits = F.filter(F.concat(own, listed), lambda r: (r["id"] == F.col("article_id")) & (F.col("wanted").isNull() | (r["author"] == F.col("wanted"))))
    record = F.try_element_at(fits, F.lit(1))
    text = F.concat_ws("\n", record["name"], _plain(record["title"]), _plain(record["body"]))
    return parsed.select("site", "article_id", F.when(record.isNotNull(), text).alias("content"), F.when(record.isNull(), "no such article").alias("problem"))


def forum_documents(landed: DataFrame) -> DataFrame:
    """``landed(user, page, json)`` lists of posts as one document each: user, post, content, priority (100 less the page).

    Posts are numbered over all pages of a user; empty ones have a number but no document.
    """
    posts = F.from_json(F.get_json_object("json", "$.posts"), "array<struct<id: string, text: string>>")
    sized = landed.select("user", "page", F.coalesce(posts, F.array().cast("array<struct<id: string, text: string>>")).alias("posts")).withColumn("n", F.size("posts"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("user").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = sized.withColumn("before", before).select("user", "page", "before", F.posexplode("posts").alias("i", "p"))
    return rows.filter(F.col("p.text").rlike(r"(?U)\S")).select("user", (F.col("before") + F.col("i")).cast("int").alias("post"), F.col("p.id").alias("id"), F.col("p.text").alias("content"), (100 - F.col("page")).cast("int").alias("priority"))


def release_selection(posts: DataFrame, contracts: DataFrame) -> DataFrame:
    """``posts(user, kind, ord, id, title)`` fit for ``contracts(site, user, kind, keywords, first_n)``: among a site's first N
    eligible ones there must be one distinct id: site, id, problem."""
    own = contracts.withColumnsRenamed({"kind": "wanted_kind"})
    fit = posts.join(own, "user").filter((F.col("kind") == F.col("wanted_kind")) & (F.coalesce("id", F.lit("")) != "") & F.forall("keywords", lambda k: F.contains("title", k)))
    nth = F.row_number().over(Window.partitionBy("site").orderBy("ord"))
    found = fit.withColumn("nth", nth).filter("nth <= first_n").groupBy("site").agg(F.count_distinct("id").alias("ids"), F.min("id").alias("one"))
    every = contracts.select("site").join(found, "site", "left")
    return every.select("site", F.when(F.col("ids") == 1, F.col("one")).alias("id"), F.when(F.col("ids").isNull(), "no release").when(F.col("ids") > 1, "several releases").alias("problem"))
