"""Rows of an article that its author, or another signature of the same article, has signed.

A page is its author's if its head says so. A row counts if the row anchor, or else the author's name, stands near its
beginning. A row with both signatures is in doubt: it takes no place in the window, but where it lies inside the window, or
is of a period that was asked for, its document fails instead of giving a value that may be another's.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as t
from . import segments as g

# Lines of the head, how far into a row its signature may begin, the size of its groups, how an author line
# begins, and what a title and a row must say (normalised and not).
HEAD_LINES, WITHIN, NUMBERS = 20, 40, 10
AUTHOR = "作者"
TITLE = r"(?<!\d)0?(\d{1,3})\s*(?:期|[:：]).{0,60}绝杀\s*(?:十|10|⑩)\s*码"
TEN_NUMBERS = "绝杀(?:十|10)码"


def _head(docs: DataFrame) -> DataFrame:
    """``docs`` with problem: whose head doesn't name the author or, for rows at the bottom, has no title of the period."""
    lines = F.slice(F.filter(F.transform(F.split("content", "\n"), lambda x: F.trim(x)), lambda x: x != ""), 1, HEAD_LINES)
    plain = lambda x: t.normalize_keyword(x, folded=False)
    told = F.transform(lines, lambda x: F.struct(x.alias("line"), plain(x).alias("plain")))
    rows = docs.withColumns({"__lines": told, "__who": plain(F.col("author")), "__other": F.nullif(plain(F.coalesce("row_anchor", F.lit(""))), F.lit(""))})
    top = F.col("region") == "top"
    named = F.exists("__lines", lambda x: (x["plain"] == F.col("__who")) | F.startswith(x["plain"], F.concat(F.lit(AUTHOR), "__who")))
    named_top = F.exists("__lines", lambda x: F.contains(x["plain"], F.col("__who")) & x["plain"].rlike(TEN_NUMBERS))
    # A title that follows the author's name on its line belongs to a head or author line.
    before = lambda x: F.regexp_extract(x, f"(?s)^(.*?){TITLE}", 1)
    titled = F.exists("__lines", lambda x: x["line"].rlike(TITLE) & ~F.contains(plain(before(x["line"])), F.col("__who")))
    problem = (
        F.when(F.coalesce("__who", F.lit("")) == "", "no author")
        .when(~F.col("region").isin("top", "bottom"), "no direction")
        .when(top & ~named_top, "another author")
        .when(~top & ~named, "another author")
        .when(~top & ~titled, "no title")
    )
    return rows.withColumn("problem", problem).drop("__lines")


def _signed(rows: Column) -> Column:
    """Of a document's segments those that are signed, or ambiguous: start, segment, period, ambiguous."""
    who, other, bottom = F.col("__who"), F.col("__other"), F.col("region") == "bottom"

    def judged(x: Column, plain: Column) -> Column:
        at_other, at_who = F.coalesce(F.instr(plain, other), F.lit(0)), F.instr(plain, who)
        both = F.coalesce(bottom & (other != who) & (at_other > 0) & (at_who > 0), F.lit(False))
        near = F.when(bottom & (at_other > 0), at_other).otherwise(at_who).between(1, WITHIN + 1)
        return F.struct(x["start"].alias("start"), x["segment"].alias("segment"), x["period"].alias("period"), both.alias("ambiguous"), (near & (~bottom | plain.rlike(TEN_NUMBERS))).alias("near"))

    told = F.transform(rows, lambda x: g._let(t.normalize_keyword(x["segment"], folded=False), lambda plain: judged(x, plain)))
    return F.filter(told, lambda x: x["ambiguous"] | x["near"])


def _asked(x: Column) -> Column:
    return F.coalesce(F.array_contains("requested", x["period"]), F.lit(False))


def _counted(rows: Column, most: Column) -> Column:
    """The first ``most`` of a document's rows that count, in the order given: start, period, groups, repeats. Numbers are
    read up to the last of them only."""
    bottom = F.col("region") == "bottom"
    none = F.array().cast("array<struct<start:int,period:int,groups:array<string>,repeats:boolean>>")

    def with_groups(x: Column, then: Callable[[Column, Column], Column]) -> Column:
        ten = F.filter(g.number_groups(x["segment"]), lambda n: (F.size(n) == NUMBERS) & F.forall(n, t.valid_number))
        found = F.array_distinct(F.transform(ten, lambda n: F.array_join(n, ",")))
        return g._let(found, lambda groups: g._let(F.exists(groups, lambda n: t.has_repeats(F.split(n, ","))), lambda repeats: then(groups, repeats)))

    def step(taken: Column, x: Column) -> Column:
        def tried(groups: Column, repeats: Column) -> Column:
            counts = (bottom | (F.size(groups) > 0)) & ~(F.coalesce("skip_repeats", F.lit(False)) & repeats & ~_asked(x))
            one = F.struct(x["start"].alias("start"), x["period"].alias("period"), groups.alias("groups"), repeats.alias("repeats"))
            return F.when(counts, F.concat(taken, F.array(one))).otherwise(taken)

        return F.when(x["ambiguous"] | (F.size(taken) >= most), taken).otherwise(with_groups(x, tried))

    return F.aggregate(rows, none, step)


def identity_candidates(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``docs(doc, content, author, row_anchor, region, window, requested, skip_repeats)``, one row for each doc -> values
    (doc, period, value) and problems (doc, period, problem; period null for a whole document). A document with a problem
    gives no value.

    Rows have ten numbers and the author's name, or the row anchor where one is set, beginning within 40 characters of the
    normalised segment. The window keeps the last ``window`` rows (default 3) for "bottom", the first for "top"; rows with
    both signatures are not counted, and with ``skip_repeats`` neither are rows with repeats that aren't ``requested`` (an
    array of periods). In the window a row with repeats or with several groups is a problem of its document.

    A page is read once, within its own row.
    """
    bottom = F.col("region") == "bottom"
    window = F.greatest(F.coalesce("window", F.lit(g.WINDOW_ROWS)), F.lit(0))
    headed = _head(docs)
    signed = headed.withColumn("__rows", F.when(F.col("problem").isNull(), _signed(g._segments(F.col("content")))))
    # One row more than an empty window holds tells whether any counts.
    ordered = F.when(bottom, F.reverse("__rows")).otherwise(F.col("__rows"))
    counted = signed.withColumn("__counted", _counted(ordered, F.greatest(window, F.lit(1))))
    chosen = counted.withColumn("__chosen", F.slice("__counted", F.lit(1), window))

    problem = lambda period, text: F.struct(period.alias("period"), text.alias("problem"))
    edge = F.array_min(F.transform("__chosen", lambda x: x["start"]))
    doubtful = g._let(edge, lambda at: F.filter("__rows", lambda x: x["ambiguous"] & (_asked(x) | F.coalesce(x["start"] >= at, F.lit(False)))))
    trouble = lambda x: F.when(x["repeats"], "repeats").when(bottom & (F.size(x["groups"]) > 1), "several groups")
    taken = F.flatten(F.transform(F.filter("__chosen", lambda x: trouble(x).isNull()), lambda x: F.transform(x["groups"], lambda v: F.struct(x["period"].alias("period"), v.alias("value")))))
    valued = chosen.withColumn("__values", F.array_distinct(taken))
    periods = F.transform("__values", lambda x: x["period"])
    several = g._let(periods, lambda every: F.filter(F.array_distinct(every), lambda p: F.size(F.filter(every, lambda q: q == p)) > 1))
    bad = F.concat(
        F.array_distinct(F.transform(doubtful, lambda x: problem(x["period"], F.lit("two signatures")))),
        F.array_distinct(F.filter(F.transform("__chosen", lambda x: problem(x["period"], trouble(x))), lambda x: x["problem"].isNotNull())),
        F.transform(several, lambda p: problem(p, F.lit("several values"))),
        F.when((F.col("region") == "top") & (F.size("__counted") == 0), F.array(problem(F.lit(None).cast("int"), F.lit("no signed row")))).otherwise(F.array().cast("array<struct<period:int,problem:string>>")),
    )
    whole = F.array(problem(F.lit(None).cast("int"), F.col("problem")))
    judged = valued.withColumn("__problems", F.when(F.col("problem").isNotNull(), whole).otherwise(bad)).select("doc", "__values", "__problems")
    # Conditions stand inside what is exploded: as filters they would be pushed below, and all of the above worked out again.
    each = lambda array, name: judged.select("doc", F.explode(array).alias("x")).select("doc", "x.period", f"x.{name}")
    return each(F.when(F.size("__problems") == 0, F.col("__values")), "value"), each(F.when(F.size("__problems") > 0, F.col("__problems")), "problem")
