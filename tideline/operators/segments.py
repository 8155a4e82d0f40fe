"""Period segments of texts, the number groups in them, and which of them count.

``docs(doc, site, content, ...)`` holds readable texts. A segment runs from a period label to the next one; it yields
ordered groups of numbers; windows keep the first or last rows of a page.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as t

# What a label, its look-alike, a separator and a mark of the result look like.
LABEL = r"\d+(?U:\s)*[期棋]"
LINE_LABEL = r"\n[ \t]*\d+[ \t]*[:：]"
BOUNDARY = rf"(?=(?<!\d){LABEL}|{LINE_LABEL})"
HEAD = r"^0?(\d{1,3})(?U:\s)*[期棋]"
OPENING = r"[=＝]?\s*开\s*[:：]?"
CLOCK = r"(?<!\d)\d{1,2}(?:[ \t]*[:：][ \t]*\d{2}){1,2}(?!\d)"
DATE = r"(?<!\d)\d{4}[./\-年]\d{1,2}[./\-月]\d{1,2}日?(?!\d)"
GROUP = r"(?<!\d)\d+(?:[\s.,，。、;；|/\\+\-]+\d+){2,}(?!\d)"
PLACEHOLDER = r"^\s*(?:[?？0]{2,}|[?？]|0(?=\s|$))"
MASK = "\u0001"
SEAM_JUMP = 300
WINDOW_ROWS = 3


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _segments(text: Column) -> Column:
    """The segments of a text in their order, as an array of n, start, segment and period."""

    def cut(pieces: Column) -> Column:
        ends = F.aggregate(F.transform(pieces, F.length), F.array(F.lit(0)), lambda a, n: F.concat(a, F.array(F.element_at(a, -1) + n)))
        period = lambda x: t.try_period(F.regexp_extract(x, HEAD, 1))
        return _let(ends, lambda at: F.transform(pieces, lambda x, i: F.struct(i.alias("n"), F.get(at, i).alias("start"), x.alias("segment"), period(x).alias("period"))))

    return F.filter(_let(F.split(text, BOUNDARY), cut), lambda x: x["period"].isNotNull())


def segments(docs: DataFrame) -> DataFrame:
    """One row for each segment: doc, n (from 0), start, period, segment, and what ``docs`` has besides content.

    A text is cut before every label and before line starts like "12:". Pieces that begin with a label of 1 to 999 are
    segments; the others, and labels out of range, end the one before and open none.
    """
    carried = [c for c in docs.columns if c != "content"]
    found = docs.select(*carried, F.explode(_segments(F.col("content"))).alias("x"))
    return found.select(*carried, "x.n", "x.start", "x.segment", "x.period")


def owned_text(segment: Column) -> Column:
    """What of a segment belongs to its period: its lines after the label, up to one that has another label."""

    def own(lines: Column) -> Column:
        other = F.transform(F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0))), lambda x: x.rlike(r"(?<!\d)\d+(?U:\s)*[期棋]|^\s*\d+\s*[:：]"))
        return _let(F.array_position(other, True), lambda stop: F.array_join(F.slice(lines, F.lit(1), F.when(stop > 0, stop.cast("int")).otherwise(F.size(lines))), "\n"))

    return _let(F.split(F.regexp_replace(segment, HEAD, ""), "\n"), own)


def _groups(text: Column, relaxed: bool) -> Column:
    masked = F.regexp_replace(F.regexp_replace(F.replace(text, F.lit("杀"), F.lit(" ")), CLOCK, MASK), DATE, MASK)
    found = F.regexp_extract_all(masked, F.lit(GROUP), F.lit(0))
    groups = F.transform(found, lambda g: t.expand_tokens(F.regexp_extract_all(g, F.lit(r"\d+"), F.lit(0)), relaxed))
    return F.filter(groups, lambda g: g.isNotNull())


def number_groups(text: Column, relaxed: bool = False) -> Column:
    """Groups of three or more numbers, longest first.

    Numbers before the mark of the result count. If there are none: behind a placeholder, what follows it; behind a
    result, only what follows its line; both up to the next label. Clock times and full dates are no numbers.
    """
    until_label = lambda x: F.split(x, r"(?<!\d)" + LABEL, 2)[0]

    def behind(after: Column) -> Column:
        line = until_label(F.coalesce(F.regexp_extract(after, r"(?s)\n(.*)", 1), F.lit("")))
        return F.when(after.rlike(PLACEHOLDER), F.regexp_replace(until_label(after), PLACEHOLDER, " ")).otherwise(line)

    def chosen(parts: Column) -> Column:
        later = _groups(F.coalesce(behind(F.try_element_at(parts, F.lit(2))), F.lit("")), relaxed)
        return _let(_groups(parts[0], relaxed), lambda first: F.when(F.size(first) > 0, first).otherwise(later))

    found = _let(F.split(F.translate(text, "０１２３４５６７８９", "0123456789"), OPENING, 2), chosen)
    # A stable sort by length: place breaks ties.
    keyed = F.transform(found, lambda g, i: F.struct((-F.size(g)).alias("k"), i.alias("i"), g.alias("g")))
    return F.transform(F.array_sort(keyed), lambda x: x["g"])


def groups_for_count(text: Column, count: Column) -> Column:
    """Strict groups of ``count`` numbers; relaxed ones only if there is no strict one. Null count: all strict groups."""
    fit = lambda groups: F.filter(groups, lambda x: (count.isNull() | (F.size(x) == count)) & F.forall(x, t.valid_number))
    return _let(fit(number_groups(text)), lambda strict: F.when(count.isNull() | (F.size(strict) > 0), strict).otherwise(fit(number_groups(text, relaxed=True))))


def keyword_match(segment: Column, keywords: Column) -> Column:
    """Whether a segment holds any of the (normalised) keywords; no keywords match everything."""
    held = _let(t.normalize_keyword(segment, folded=False), lambda plain: F.exists(keywords, lambda k: F.contains(plain, k)))
    return (F.coalesce(F.size(keywords), F.lit(0)) <= 0) | held


def cycle_seam(rows: DataFrame) -> DataFrame:
    """``rows(doc, start, period)`` with the start from which a document's rows are last year's (null: none).

    Pages run from new to old; a period that is 300 or more above the one before it begins the year before.
    """
    order = Window.partitionBy("doc").orderBy("start")
    jump = F.col("period") - F.lag("period").over(order) >= SEAM_JUMP
    return rows.withColumn("__jump", F.when(jump, F.col("start"))).withColumn("seam", F.min("__jump").over(Window.partitionBy("doc"))).drop("__jump")


def direction_window(rows: DataFrame, default_rows: int = WINDOW_ROWS) -> DataFrame:
    """``rows(doc, start, period, value, seam, region, window)`` with ``in_window``.

    Rows of the current year, each (period, value) once - the first for "top", the last for "bottom" - are counted from
    that end; the first ``window`` are in. Documents without a direction have no window: null.
    """
    live = (F.col("seam").isNull() | (F.col("start") < F.col("seam"))) & F.col("value").isNotNull()
    bottom = F.col("region") == "bottom"
    same = Window.partitionBy("doc", "__live", "period", "value")
    once = F.when(bottom, F.row_number().over(same.orderBy(F.desc("start")))).otherwise(F.row_number().over(same.orderBy("start")))
    marked = rows.withColumn("__live", live).withColumn("__first", F.col("__live") & (once == 1))
    ranked = Window.partitionBy("doc", "__first")
    nth = F.when(bottom, F.row_number().over(ranked.orderBy(F.desc("start")))).otherwise(F.row_number().over(ranked.orderBy("start")))
    inside = F.col("__first") & (F.col("__nth") <= F.coalesce("window", F.lit(default_rows)))
    return marked.withColumn("__nth", nth).withColumn("in_window", F.when(F.col("region").isin("top", "bottom"), inside)).drop("__live", "__first", "__nth")


def sequence_window(rows: DataFrame, default_rows: int = WINDOW_ROWS) -> DataFrame:
    """Like ``direction_window``, over all posts of a user in post order: ``rows(doc, sequence, post, start, ...)``.

    Rows are counted, not posts: the place of a row is its post's number and its start together.
    """
    placed = rows.withColumns({"__doc": F.col("doc"), "__start": F.col("start"), "doc": F.concat_ws("/", "doc", "sequence"), "start": F.col("post").cast("bigint") * (1 << 32) + F.col("start")})
    return direction_window(placed, default_rows).withColumns({"doc": F.col("__doc"), "start": F.col("__start")}).drop("__doc", "__start")


def _seam(rows: Column) -> Column:
    """``cycle_seam`` of a document's array of segments."""
    following = F.slice(rows, F.lit(2), F.size(rows))
    return F.array_min(F.zip_with(rows, following, lambda a, b: F.when(b["period"] - a["period"] >= SEAM_JUMP, b["start"])))


def _in_window(rows: Column, region: Column, window: Column, default_rows: int = WINDOW_ROWS) -> Column:
    """``direction_window`` of a document's array of rows: an array of ``in_window``."""
    bottom = F.coalesce(region == "bottom", F.lit(False))
    live = lambda x: (x["seam"].isNull() | (x["start"] < x["seam"])) & x["value"].isNotNull()
    keys = F.transform(rows, lambda x: F.when(live(x), F.concat_ws(":", x["period"].cast("string"), x["value"])))

    def marks(counted: Column) -> Column:
        """``counted``: the keys from the window's end on; a key counts where it stands first."""
        most = F.greatest(F.coalesce(window, F.lit(default_rows)), F.lit(0))
        kept = F.slice(F.array_distinct(F.array_compact(counted)), F.lit(1), most)
        return _let(kept, lambda keep: F.transform(counted, lambda k, i: F.coalesce(F.array_contains(keep, k) & (F.array_position(counted, k) == i + 1), F.lit(False))))

    inside = _let(F.when(bottom, F.reverse(keys)).otherwise(keys), marks)
    return F.when(region.isin("top", "bottom"), F.when(bottom, F.reverse(inside)).otherwise(inside))


def _usable(rows: Column) -> Column:
    """A document's array of rows with ``usable``: in the window, or of a period of which the window holds nothing, newer
    than all it holds. Rows of the year before are not."""
    live = lambda x: x["seam"].isNull() | (x["start"] < x["seam"])
    inside = lambda x: F.coalesce(x["in_window"], F.lit(True))
    periods = lambda kept: F.transform(F.filter(rows, kept), lambda x: x["period"])
    state = F.struct(F.array_max(periods(lambda x: live(x) & x["in_window"])).alias("newest"), F.array_distinct(periods(lambda x: live(x) & inside(x) & (F.size(x["groups"]) > 0))).alias("held"))
    newer = lambda x, of: F.coalesce(of["newest"] < x["period"], F.lit(False)) & ~F.array_contains(of["held"], x["period"])
    return _let(state, lambda of: F.transform(rows, lambda x: x.withField("usable", live(x) & (inside(x) | newer(x, of)))))


def candidate_rows(docs: DataFrame, allow_repeats: bool = False) -> DataFrame:
    """Segments of ``docs(doc, content, keywords, count, region, window, ...)``, one row for each doc, with their groups,
    seam and window.

    ``keywords`` are normalised. ``groups`` are those of the wanted size; ``value`` is the first of them without repeats
    (the first of all with ``allow_repeats``), joined by commas, by which rows are told apart in the window. ``usable`` rows
    are those that ``select_candidates`` chooses from. All of it is worked out within the document's own row, so no task
    sorts or keeps the segments of many documents.
    """
    count, keywords, region, window = (F.col(c) for c in ("count", "keywords", "region", "window"))

    def sized(x: Column, seam: Column) -> Column:
        def row(groups: Column) -> Column:
            clean = groups if allow_repeats else F.filter(groups, lambda g: ~t.has_repeats(g))
            value = F.array_join(F.try_element_at(clean, F.lit(1)), ",")
            return F.struct(*[x[c].alias(c) for c in ("n", "start", "segment", "period")], seam.alias("seam"), groups.alias("groups"), value.alias("value"))

        return _let(_let(owned_text(x["segment"]), lambda text: groups_for_count(text, count)), row)

    def found(rows: Column) -> Column:
        # The seam is that of all segments, not only of those with the keywords, so it comes first.
        matching = F.filter(rows, lambda x: keyword_match(x["segment"], keywords))
        return _let(_seam(rows), lambda seam: F.transform(matching, lambda x: sized(x, seam)))

    def windowed(rows: Column) -> Column:
        return _let(_in_window(rows, region, window), lambda marks: F.transform(rows, lambda x, i: x.withField("in_window", F.get(marks, i))))

    carried = [c for c in docs.columns if c != "content"]
    names = ("n", "start", "segment", "period", "seam", "groups", "value", "in_window", "usable")
    rows = _let(_let(_let(_segments(F.col("content")), found), windowed), _usable)
    return docs.select(*carried, F.explode(rows).alias("x")).select(*carried, *[f"x.{c}" for c in names])


def select_candidates(rows: DataFrame, strict: bool = True, prefer_pending: bool = False, allow_repeats: bool = False) -> DataFrame:
    """One value for each document and period of ``candidate_rows``: doc, period, value, start, problem.

    In the window first; rows outside count only if the window holds nothing of the period and nothing but older ones.
    Groups with repeats are out, unless ``allow_repeats``. One distinct group is the value. Of several it is the only one
    whose result is pending if ``prefer_pending``; else they are an "ambiguous" problem if ``strict``; else it is the
    only pending one, or the one nearest the document's end of interest. A column ``place`` of a document comes through.
    """
    carried = [F.first("place").alias("place")] if "place" in rows.columns else []
    usable = rows.filter("usable")
    each = usable.select("doc", "period", "start", "region", "segment", *["place"][: len(carried)], F.posexplode("groups").alias("i", "group"))
    clean = (each if allow_repeats else each.filter(~t.has_repeats(F.col("group")))).withColumns({"value": F.array_join("group", ","), "pending": t.pending_marker(F.col("segment"))})
    at = F.struct("start", "i")
    distinct = clean.groupBy("doc", "period", "value").agg(F.min(at).alias("at"), F.min_by("pending", at).alias("pending"), F.first("region").alias("region"), *carried)
    picked = distinct.groupBy("doc", "period").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("pending").alias("open"),
        F.min_by(F.struct("value", "at"), F.when(F.col("pending"), F.col("at"))).alias("of_open"),
        F.min_by(F.struct("value", "at"), "at").alias("first"),
        F.max_by(F.struct("value", "at"), "at").alias("last"),
        F.first("region").alias("region"),
        *carried,
    )
    any_one = F.when(F.col("region") == "bottom", F.col("last")).otherwise(F.col("first"))
    one = F.when(F.col("n") == 1, F.col("first"))
    if prefer_pending or not strict:
        one = one.when(F.col("open") == 1, F.col("of_open"))
    one = one.otherwise(F.lit(None) if strict else any_one)
    return picked.withColumn("one", one).select("doc", "period", F.col("one.value").alias("value"), F.col("one.at.start").alias("start"), F.when(F.col("one").isNull(), "ambiguous").alias("problem"), *["place"][: len(carried)])


def extract(docs: DataFrame, strict: bool = True, prefer_pending: bool = False, allow_repeats: bool = False) -> DataFrame:
    """Values of all periods of ``docs`` at once; see ``candidate_rows`` and ``select_candidates``."""
    return select_candidates(candidate_rows(docs, allow_repeats), strict, prefer_pending, allow_repeats)


def available_periods(rows: DataFrame) -> DataFrame:
    """Periods of ``candidate_rows`` with a usable group in the window: doc, period, pos (place on the page)."""
    return rows.filter(F.col("value").isNotNull() & F.coalesce("in_window", F.lit(True))).groupBy("doc", "period").agg(F.min("start").alias("pos"))


def nearest_periods(available: DataFrame, wanted: list[int], k: int = 20) -> DataFrame:
    """Of ``available(site, period)`` the k periods nearest to any wanted one, of equally near ones the larger first."""
    distance = F.array_min(F.transform(F.array(*map(F.lit, wanted)), lambda w: F.abs(F.col("period") - w)))
    rows = available.select("site", "period").distinct().withColumn("distance", distance)
    nth = F.row_number().over(Window.partitionBy("site").orderBy("distance", F.desc("period")))
    return rows.withColumn("nth", nth).filter(F.col("nth") <= k)


def diagnose_miss(docs: DataFrame, wanted: list[int]) -> DataFrame:
    """Why wanted periods of ``docs`` gave no value: doc, period, reasons (sorted, joined), for periods that occur."""
    keyed = segments(docs).filter(F.col("period").isin(wanted)).withColumn("groups", number_groups(owned_text(F.col("segment"))))
    right = F.filter("groups", lambda g: (F.size(g) == F.col("count")) | F.col("count").isNull())
    reason = F.when(~keyword_match(F.col("segment"), F.col("keywords")), "keyword").when(F.size("groups") == 0, "no group").when(F.size("right") == 0, "wrong size").when(F.forall("right", t.has_repeats), "repeats")
    hits = extract(docs).filter("value is not null").select("doc", "period")
    told = keyed.withColumn("right", right).select("doc", "period", F.coalesce(reason, F.lit("outside window")).alias("reason")).distinct()
    return told.join(hits, ["doc", "period"], "left_anti").groupBy("doc", "period").agg(F.array_join(F.sort_array(F.collect_set("reason")), ",").alias("reasons"))


def anchor_start(text: Column, anchor: Column) -> Column:
    """Where an anchor stands (from 0): literally, else the start of the first line that holds it when both are
    normalised; null if nowhere."""
    literal = F.instr(text, anchor) - 1
    plain = t.normalize_keyword(anchor, folded=False)
    lines = F.split(text, "\n")
    line = F.array_position(F.transform(lines, lambda x: F.contains(t.normalize_keyword(x, folded=False), plain)), True).cast("int")
    before = F.aggregate(F.slice(lines, F.lit(1), F.greatest(line - 1, F.lit(0))), F.lit(0), lambda a, x: a + F.length(x) + 1)
    return F.when(literal >= 0, literal).when((plain != "") & (line > 0), before)


def scope_by_anchor(docs: DataFrame) -> DataFrame:
    """``docs(doc, content, anchor, stop_anchor, ...)`` cut to the part between their anchors: content, offset, problem.

    The part begins at the period label of the anchor's line, if one stands before it, and ends at the stop anchor. A
    configured anchor or stop that isn't found is a problem, with null content: never the whole page instead.
    """
    start = F.when(F.coalesce("anchor", F.lit("")) == "", F.lit(0)).otherwise(anchor_start(F.col("content"), F.col("anchor")))
    found = docs.withColumn("__at", start)
    line_from = F.col("__at") - F.length(F.substring_index(F.substring("content", F.lit(1), F.col("__at")), "\n", -1))
    head = F.substring("content", line_from + 1, F.col("__at") - line_from)
    label = F.regexp_extract(head, rf"(?s)^.*(?<!\d)({LABEL}(?:(?!(?<!\d){LABEL}).)*)$", 1)
    moved = found.withColumn("__from", F.col("__at") - F.length(label))
    rest = F.substring("content", F.col("__from") + 2, F.length("content"))
    stop = F.when(F.coalesce("stop_anchor", F.lit("")) != "", anchor_start(rest, F.col("stop_anchor")) + 1)
    bounded = moved.withColumn("__stop", stop)
    problem = F.when(F.col("__at").isNull(), "anchor not found").when((F.coalesce("stop_anchor", F.lit("")) != "") & F.col("__stop").isNull(), "stop anchor not found")
    content = F.substring("content", F.col("__from") + 1, F.coalesce("__stop", F.length("content")))
    return bounded.withColumn("problem", problem).select(*[F.col(c) for c in docs.columns if c != "content"], F.when(F.col("problem").isNull(), content).alias("content"), F.when(F.col("problem").isNull(), F.col("__from")).alias("offset"), "problem")


def section_rows(docs: DataFrame, contracts: DataFrame) -> DataFrame:
    """Rows of sections by contract: ``contracts(contract, heading, stop, pattern, count, region, window)`` over
    ``docs(doc, contract, content)`` -> doc, period, value, problem.

    Contracts are data: the heading must occur once, the stop must follow, and ``pattern`` (groups: period, numbers)
    finds the rows, of which the window keeps the first or last. A group with repeats, or of another size, is a problem of
    its row, several values of a period one of the period. Contract names nobody knows give a problem, never a guess.
    """
    known = docs.join(contracts, "contract", "left")
    pieces = known.withColumn("__p", F.split("content", F.concat(F.lit("\\Q"), "heading", F.lit("\\E"))))
    body = F.split(F.element_at("__p", -1), F.concat(F.lit("\\Q"), "stop", F.lit("\\E")), 2)
    cut = pieces.withColumn("__b", body)
    problem = F.when(F.col("heading").isNull(), "unknown contract").when(F.size("__p") < 2, "no heading").when(F.size("__p") > 2, "several headings").when(F.size("__b") < 2, "no stop")
    judged = cut.withColumn("problem", problem)
    bad = judged.filter("problem is not null").select("doc", F.lit(None).cast("int").alias("period"), F.lit(None).cast("string").alias("value"), "problem")
    good = judged.filter("problem is null").withColumn("__s", F.col("__b")[0])
    pairs = F.arrays_zip(F.regexp_extract_all("__s", F.col("pattern"), F.lit(1)).alias("p"), F.regexp_extract_all("__s", F.col("pattern"), F.lit(2)).alias("v"))
    rows = good.select("doc", "count", "region", "window", F.posexplode(pairs).alias("n", "x"))
    nth = F.row_number().over(Window.partitionBy("doc").orderBy(F.when(F.col("region") == "bottom", -F.col("n")).otherwise(F.col("n"))))
    kept = rows.withColumn("nth", nth).filter("nth <= window").select("doc", t.try_period(F.col("x.p")).alias("period"), F.regexp_extract_all("x.v", F.lit(r"\d+"), F.lit(0)).alias("numbers"), "count")
    row_problem = F.when(F.col("period").isNull(), "no period").when(F.size("numbers") != F.col("count"), "wrong size").when(t.has_repeats(F.col("numbers")), "repeats")
    told = kept.select("doc", "period", F.array_join("numbers", ",").alias("value"), row_problem.alias("problem"))
    values = told.groupBy("doc", "period").agg(F.count_distinct("value").alias("values"), F.min("value").alias("value"), F.min("problem").alias("problem"))
    checked = values.select("doc", "period", F.coalesce("problem", F.when(F.col("values") > 1, "ambiguous")).alias("problem"), F.col("value"))
    return checked.select("doc", "period", F.when(F.col("problem").isNull(), F.col("value")).alias("value"), "problem").unionByName(bad)


def identity_rows(rows: DataFrame, within: int = 40) -> DataFrame:
    """Rows of ``rows(doc, period, start, segment, author, row_anchor, ...)`` that the author signed or that hold the row
    anchor, with ``ambiguous`` where both hold: such rows are shown, not ranked.

    The author's name must begin within ``within`` characters of the normalised segment.
    """
    plain = t.normalize_keyword(F.col("segment"), folded=False)
    signed = F.coalesce(F.instr(plain, t.normalize_keyword(F.col("author"), folded=False)).between(1, within + 1), F.lit(False))
    anchored = F.coalesce(F.contains(plain, F.nullif(t.normalize_keyword(F.col("row_anchor"), folded=False), F.lit(""))), F.lit(False))
    return rows.withColumns({"__s": signed, "__a": anchored}).filter("__s or __a").withColumn("ambiguous", F.col("__s") & F.col("__a")).drop("__s", "__a")


def cycle_blocks(rows: DataFrame, last: int = 365) -> DataFrame:
    """``rows(doc, start, period)`` with ``block``: how many steps from ``last`` to 1 lie before, and ``blocks`` in all."""
    order = Window.partitionBy("doc").orderBy("start")
    step = F.coalesce(((F.lag("period").over(order) == last) & (F.col("period") == 1)).cast("int"), F.lit(0))
    counted = rows.withColumn("__step", step).withColumn("block", F.sum("__step").over(order.rowsBetween(Window.unboundedPreceding, 0)).cast("int"))
    return counted.withColumn("blocks", (F.max("block").over(Window.partitionBy("doc")) + 1).cast("int")).drop("__step")


def current_cycle_rows(rows: DataFrame, first: bool = True, last: int = 365) -> DataFrame:
    """The first (or last) block of ``cycle_blocks``; documents with more than one step give a problem and no rows."""
    blocks = cycle_blocks(rows, last)
    wanted = F.lit(0) if first else F.col("blocks") - 1
    return blocks.withColumn("problem", F.when(F.col("blocks") > 2, "several seams")).filter((F.col("block") == wanted) & F.col("problem").isNull()).drop("problem")


def titled_cycle_rows(rows: DataFrame, first: bool = True, last: int = 365) -> tuple[DataFrame, DataFrame]:
    """``rows(doc, start, period, title_period, region, window)``: the rows of ``current_cycle_rows`` that the document's
    window keeps, and the documents that give none: doc, problem.

    The title's period must be one of those in the window: a window that lacks it is another year's, or another article's.
    """
    cycles = cycle_blocks(rows, last)
    several = cycles.filter("blocks > 2").select("doc", F.lit("several seams").alias("problem")).distinct()
    current = current_cycle_rows(rows, first, last)
    place = F.when(F.col("region") == "bottom", -F.col("start")).otherwise(F.col("start"))
    nth = F.row_number().over(Window.partitionBy("doc").orderBy(place))
    whole = Window.partitionBy("doc")
    kept = current.withColumn("__n", nth).filter(F.col("__n") <= F.coalesce("window", F.lit(WINDOW_ROWS))).withColumn("__titled", F.coalesce(F.bool_or(F.col("period") == F.col("title_period")).over(whole), F.lit(False)))
    untitled = kept.filter(~F.col("__titled")).select("doc", F.lit("the title's period is not in the window").alias("problem")).distinct()
    return kept.filter("__titled").select("doc", "start", "period"), several.unionByName(untitled)


def merge_parts(left: DataFrame, right: DataFrame, numbers: int = 6) -> DataFrame:
    """Two columns of a page, ``(site, period, value)`` each, joined by period: value null and a problem unless both
    together are ``numbers`` distinct numbers. Periods that only one side has are left out."""
    both = left.select("site", "period", F.split("value", ",").alias("a")).join(right.select("site", "period", F.split("value", ",").alias("b")), ["site", "period"])
    all_ = F.concat("a", "b")
    problem = F.when(F.size(all_) != numbers, "wrong size").when(t.has_repeats(all_), "repeats")
    return both.withColumn("problem", problem).select("site", "period", F.when(F.col("problem").isNull(), F.array_join(all_, ",")).alias("value"), "problem")


def placeholder_repair(rows: DataFrame) -> DataFrame:
    """``rows(doc, start, period, title_period)``: a document's one row without a period gets the title's, if the row
    before it has the period before that one and no other row has it."""
    order, whole = Window.partitionBy("doc").orderBy("start"), Window.partitionBy("doc")
    gaps = F.count_if(F.col("period").isNull()).over(whole)
    there = F.coalesce(F.bool_or(F.col("period") == F.col("title_period")).over(whole), F.lit(False))
    fits = F.col("period").isNull() & (gaps == 1) & ~there & (F.lag("period").over(order) == F.col("title_period") - 1)
    return rows.withColumn("period", F.when(fits, F.col("title_period")).otherwise(F.col("period")))


def exact_section(docs: DataFrame) -> DataFrame:
    """``docs(doc, content, heading, ending)`` cut to the lines between two headings that each are one whole line, when
    normalised: doc, section, problem."""
    lines = F.split("content", "\n")
    plain = F.transform(lines, lambda x: t.normalize_keyword(x, folded=False))
    times = lambda c: F.size(F.filter(plain, lambda x: x == t.normalize_keyword(F.col(c), folded=False)))
    at = lambda c: F.array_position(plain, t.normalize_keyword(F.col(c), folded=False)).cast("int")
    problem = F.when(times("heading") != 1, "heading").when(times("ending") != 1, "ending").when(at("ending") <= at("heading"), "order")
    rows = docs.select("doc", problem.alias("problem"), F.when(problem.isNull(), F.array_join(F.slice(lines, at("heading") + 1, F.greatest(at("ending") - at("heading") - 1, F.lit(0))), "\n")).alias("section"))
    return rows.select("doc", "section", "problem")


def available_by_tier(found: DataFrame) -> DataFrame:
    """Of ``found(site, doc, priority, ord, n_periods)`` each site's document: highest priority with any period, in it the
    most periods, then the first."""
    some = found.filter("n_periods > 0")
    return some.groupBy("site").agg(F.max_by(F.struct("doc", "priority", "n_periods"), F.struct("priority", "n_periods", (-F.col("ord")).alias("o"))).alias("d")).select("site", "d.doc", "d.priority", "d.n_periods")


def span_rows(pages: DataFrame, window: int) -> DataFrame:
    """``pages(url, html)``: period and value from paired span elements, first ``window``: url, n, period, value."""
    found = pages.select("url", F.regexp_extract_all("html", F.lit(r"(?is)<span\b[^>]*>(.*?)</span\s*>"), F.lit(1)).alias("spans"))
    following = F.slice("spans", F.lit(2), F.size("spans"))
    pairs = F.filter(F.zip_with("spans", following, lambda a, b: F.struct(t.try_period(a).alias("p"), b.alias("v"))), lambda x: x["p"].isNotNull() & x["v"].isNotNull())
    return found.select("url", F.posexplode(F.slice(pairs, 1, window)).alias("n", "x")).select("url", "n", F.col("x.p").alias("period"), F.col("x.v").alias("value"))


def span_values(pages: DataFrame, window: int, count: int) -> DataFrame:
    """``span_rows`` of ``pages`` whose values are ``count`` two-digit numbers, one value for each period: url, period,
    value, problem ("ambiguous", with null value, for a period with several)."""
    read = span_rows(pages, window).withColumn("numbers", F.regexp_extract_all("value", F.lit(r"\d+"), F.lit(0)))
    good = read.filter((F.size("numbers") == count) & F.forall("numbers", lambda x: (F.length(x) == 2) & t.valid_number(x)))
    each = good.groupBy("url", "period").agg(F.collect_set(F.array_join("numbers", ",")).alias("values"))
    return each.select("url", "period", F.when(F.size("values") == 1, F.col("values")[0]).alias("value"), F.when(F.size("values") > 1, "ambiguous").alias("problem"))


def scope_override(docs: DataFrame) -> DataFrame:
    """``anchor`` dropped for posts of users whose identity is verified and fits id, source and name; kept otherwise."""
    sure = (F.col("kind") == "user_post") & F.col("identity_verified") & (F.col("user_id") == F.col("wanted_user")) & (F.col("identity_source") == "api") & (F.col("user_name") == F.col("site_name"))
    return docs.withColumn("anchor", F.when(F.coalesce(sure, F.lit(False)), None).otherwise(F.col("anchor")))


def contract_dispatch(registry: DataFrame, contracts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``registry(site, contract)`` joined with the contract table, and a problem for every name it doesn't know."""
    named = registry.filter("contract is not null")
    problems = named.join(contracts.select("contract"), "contract", "left_anti").select("site", "contract", F.lit("unknown contract").alias("problem"))
    return named.join(contracts, "contract"), problems
