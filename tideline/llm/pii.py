"""Personal data: expressions propose spans, checksums and ranges confirm them, words nearby move their score.

All of it is column expressions on one row, so nothing is shuffled and no Python runs. A text is cut by a pattern into
matches and the pieces between them; places are running sums of their lengths. Patterns are written so that Java's engine
needs neither a step back nor a stack that grows with the match: loops go over single characters only, and a match may
begin where a run of its first characters begins or where the last match ended, which is where the leftmost one begins.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, text_or_empty, without

#: Code points before and after a span, as far as the next proposal of its kind, in which words count.
BEFORE, AFTER = 40, 20
#: Least score of a span of a kind that isn't among the four base ones.
LEAST_SCORE = 50


@dataclass(frozen=True)
class Kind:
    """How spans of a kind are found and scored (in hundredths).

    ``hint`` is in every text that has a match. ``pattern`` runs on the text after ``loose`` characters have become
    ``stand_in``, one for one. ``means`` is the same rule in plain form, for other engines. Words of ``more`` nearby add
    ``gain``, words of ``less`` take ``loss``.
    """

    name: str
    base: bool
    hint: str
    pattern: str
    means: str
    score: int
    more: str
    gain: int
    less: str = ""
    loss: int = 0
    loose: str = ""
    stand_in: str = ""


_LOCAL, _LABEL = "A-Za-z0-9._%+-", "A-Za-z0-9-"
KINDS = [
    Kind(
        "email",
        True,
        "@",
        rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[{_LABEL}]++\.[{_LABEL}.]++",
        rf"[{_LOCAL}]+@[{_LABEL}]+(\.[{_LABEL}]+)+",
        90,
        "email|mail|contact|write",
        10,
        # A dot that isn't between two label characters ends a domain, but not what stands before the sign.
        loose=rf"\.(?![{_LABEL}])|(?<![{_LABEL}])\.",
        stand_in="_",
    ),
    Kind(
        "ip",
        True,
        r"[0-9]\.[0-9]",
        r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
        60,
        "ip|host|server|address|client|login",
        20,
        "version|release|section|chapter",
        30,
    ),
    Kind(
        "card",
        True,
        r"[0-9][0-9\x20-]{14}",
        r"[0-9][0-9\x20-]++",
        r"[0-9]([\x20-]?[0-9])+",
        70,
        "card|credit|debit|visa|mastercard|payment|karte|carte|tarjeta",
        20,
        "order|invoice|tracking|serial|isbn",
        20,
        # A separator that isn't between two digits ends a number.
        loose=r"[\x20-](?![0-9])|(?<![0-9])[\x20-]",
        stand_in="_",
    ),
    Kind("phone", True, r"\+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]", 60, "phone|tel|telephone|call|mobile|fax|contact", 20),
    Kind("iban", False, "[A-Z]{2}[0-9]{2}", r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){10,36}", r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){10,36}", 80, "iban|bank|account|konto|compte|cuenta", 15),
    Kind("ssn", False, "[0-9]-[0-9]{2}-[0-9]", "[0-9]{3}-[0-9]{2}-[0-9]{4}", "[0-9]{3}-[0-9]{2}-[0-9]{4}", 30, "ssn|social|security", 40),
]

# How long an account number of each country is.
IBAN_LENGTHS = (
    "AD 24, AE 23, AL 28, AT 20, AZ 28, BA 20, BE 16, BG 22, BH 22, BR 29, BY 28, CH 21, CR 22, CY 28, CZ 24, DE 22, DK 18, DO 28, EE 20, EG 29, ES 24, FI 18, FO 18, FR 27, GB 22, "
    "GE 22, GI 23, GL 18, GR 27, GT 28, HR 21, HU 28, IE 22, IL 23, IQ 23, IS 26, IT 27, JO 30, KW 30, KZ 20, LB 28, LC 32, LI 21, LT 20, LU 20, LV 21, MC 27, MD 24, ME 22, MK 19, "
    "MR 27, MT 31, MU 30, NL 18, NO 15, PK 24, PL 28, PS 29, PT 25, QA 29, RO 24, RS 22, SA 24, SC 31, SE 24, SI 19, SK 24, SM 27, ST 25, SV 28, TL 23, TN 24, TR 26, UA 29, VA 22, "
    "VG 24, XK 20"
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def luhn(digits: Column) -> Column:
    """Whether a string of digits ends in its Luhn check digit."""
    back = F.reverse(digits)

    def worth(i: Column) -> Column:
        v = F.substring(back, i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, v * 2 - F.when(v > 4, 9).otherwise(0)).otherwise(v)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda a, i: a + worth(i)) % 10 == 0


def mod97(account: Column) -> Column:
    """Remainder by 97 of an account number of capitals and digits, its first four characters moved to the end and its
    letters read as 10 to 35."""
    turned = F.concat(F.substring(account, 5, 99), F.substring(account, 1, 4))

    def step(a: Column, i: Column) -> Column:
        value = F.instr(F.lit(f"0123456789{UPPER}"), F.substring(turned, i, F.lit(1))) - 1
        return (a * F.when(value > 9, 100).otherwise(10) + value) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often a lambda within asks for it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running_sums(sizes: Column) -> Column:
    """Sums of the elements of an array of integers up to each of them. Blocks are summed first, so an array of a million
    elements is no square of work."""
    block, none = 512, F.array().cast("array<int>")
    number = F.ceil(F.size(sizes) / block).cast("int")

    def within(blocks: Column, totals: Column) -> Column:
        def of_block(xs: Column, b: Column) -> Column:
            before = F.struct(_added(F.slice(totals, F.lit(1), b)).alias("sum"), none.alias("sums"))
            return F.aggregate(xs, before, lambda a, x: F.struct((a["sum"] + x).alias("sum"), F.array_append(a["sums"], a["sum"] + x).alias("sums")))["sums"]

        return F.flatten(F.transform(blocks, of_block))

    def in_blocks(s: Column) -> Column:
        return F.transform(F.when(number > 0, F.sequence(F.lit(0), number - 1)).otherwise(none), lambda b: F.slice(s, b * block + 1, F.lit(block)))

    return _let(sizes, lambda s: _let(in_blocks(s), lambda blocks: _let(F.transform(blocks, _added), lambda totals: within(blocks, totals))))


def _added(xs: Column) -> Column:
    return F.aggregate(xs, F.lit(0), lambda a, x: a + x)


def _account(match: Column) -> Column:
    """What of a match can be the account number: as many characters as its country has, in groups of four or in one."""
    length = F.element_at(F.str_to_map(F.lit(IBAN_LENGTHS), F.lit(", "), F.lit(" ")), F.substring(match, 1, 2)).cast("int")
    grouped = F.substring(match, 5, 1) == " "
    return F.left(match, length + F.when(grouped, F.floor((length - 1) / 4).cast("int")).otherwise(0))


def _confirmed(kind: str, match: Column, before: Column, after: Column) -> tuple[Column, Column]:
    """Whether a match is one of its kind, and how many of its code points are."""
    digits, whole = F.regexp_replace(match, "[^0-9]", ""), F.length(match)
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda part: F.length(F.ltrim(part, F.lit("0"))) < 4) & F.forall(F.split(match, r"\."), lambda part: F.right(F.concat(F.lit("00"), part), F.lit(3)).cast("int") < 256), whole
    if kind == "card":
        return F.when(F.length(digits).between(16, 19), luhn(digits)).otherwise(False), whole
    if kind == "phone":
        return F.length(digits).between(8, 15), whole
    if kind == "ssn":
        numbers = ~match.rlike("^(000|666|9)|-00-|-0000$")
        return numbers & ~before.rlike("[0-9-]$") & ~after.rlike("^[0-9-]"), whole
    if kind == "iban":
        account = _account(match)
        bare = F.translate(account, " ", "")
        groups = account.rlike("^([A-Z0-9]{4} )*[A-Z0-9]{1,4}$") | account.rlike("^[A-Z0-9]+$")
        alone = ~before.rlike("[A-Za-z0-9]$") & ~F.concat(F.substring(match, F.length(account) + 1, F.lit(1)), after).rlike("^[A-Za-z0-9]")
        length = F.element_at(F.str_to_map(F.lit(IBAN_LENGTHS), F.lit(", "), F.lit(" ")), F.substring(match, 1, 2)).cast("int")
        return F.coalesce(F.when(groups & alone & (F.length(bare) == length), mod97(bare) == 1), F.lit(False)), F.length(account)
    return F.lit(True), whole


def _scored(kind: Kind, before: Column, after: Column) -> Column:
    near = F.translate(F.concat(F.right(F.concat(F.lit(" "), before), F.lit(BEFORE + 1)), F.lit("|"), F.left(F.concat(after, F.lit(" ")), F.lit(AFTER + 1))), UPPER, LOWER)
    has = lambda words: near.rlike(f"[^a-z]({words})[^a-z]")
    score = F.lit(kind.score) + F.when(has(kind.more), kind.gain).otherwise(0)
    return score - F.when(has(kind.less), kind.loss).otherwise(0) if kind.less else score


SPANS = "array<struct<kind: string, start: int, end: int, score: int>>"


def _spans(kind: Kind) -> Column:
    """Spans of a kind from its columns of matches and of pieces."""
    matches, pieces = F.col(f"{kind.name}_matches"), F.col(f"{kind.name}_pieces")
    ends = running_sums(F.zip_with(matches, F.slice(pieces, F.lit(1), F.size(matches)), lambda m, p: F.length(m) + F.length(p)))
    both = F.arrays_zip(matches.alias("match"), F.slice(pieces, F.lit(1), F.size(matches)).alias("before"), F.slice(pieces, F.lit(2), F.size(matches)).alias("after"), ends.alias("until"))

    def span(x: Column) -> Column:
        match, before, after = x["match"], x["before"], x["after"]
        is_one, length = _confirmed(kind.name, match, before, after)
        start = x["until"] - F.length(match)
        return F.when(is_one, F.struct(F.lit(kind.name).alias("kind"), start.alias("start"), (start + length).alias("end"), _scored(kind, before, after).alias("score")))

    found = F.filter(F.transform(both, span), lambda s: s.isNotNull() if kind.base else s.isNotNull() & (s["score"] >= LEAST_SCORE))
    return F.when(matches.isNotNull(), found.cast(SPANS)).otherwise(F.array().cast(SPANS))


def find_personal_data(docs: DataFrame, text: str = "text", kinds: list[Kind] = KINDS) -> DataFrame:
    """``docs`` with ``personal``: an array of kind, start, end (code points, end exclusive) and score (hundredths), by
    kind as ``KINDS`` lists them, then start.

    Spans of one kind don't overlap, spans of two kinds may. Base kinds keep every confirmed span whatever its score, the
    others need ``LEAST_SCORE``. A null or empty text has none. Rows keep their other columns, equal rows are treated
    alike, and a column named personal is replaced.
    """
    rest = without(docs, "personal")
    rows = rest.select(F.struct("*").alias("doc"), text_or_empty(F.col(f"`{text}`").cast("string")).alias("text"))
    cut = [F.col("doc")]
    for kind in kinds:
        hint = F.col("text").contains(kind.hint) if kind.hint == "@" else F.col("text").rlike(kind.hint)
        ready = F.regexp_replace("text", kind.loose, kind.stand_in) if kind.loose else F.col("text")
        cut.append(F.when(hint, F.regexp_extract_all(ready, F.lit(kind.pattern), F.lit(0))).alias(f"{kind.name}_matches"))
        # Pieces come from the text as it is prepared: its words are those of the text.
        cut.append(F.when(hint, F.split(ready, kind.pattern)).alias(f"{kind.name}_pieces"))
    spans = rows.select(*cut).select("doc", *[_spans(kind).alias(kind.name) for kind in kinds])
    return spans.select(*[F.col(f"doc.`{c}`").alias(c) for c in rest.columns], F.concat(*[F.col(kind.name) for kind in kinds]).alias("personal"))


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: counts of the base kinds, a digest of their spans, all spans, and the scores of these."""
    found = find_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "personal")
    base = [k.name for k in KINDS if k.base]
    told = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    of_base = F.filter("personal", lambda s: s["kind"].isin(base))
    of = lambda kind: F.filter("personal", lambda s: s["kind"] == kind)
    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in base]
    scores = F.array_join(F.transform("personal", lambda s: s["score"].cast("string")), ",")
    return found.select("doc_id", *counts, F.sha2(told(of_base).cast("binary"), 256).alias("base_sha256"), told(F.col("personal")).alias("spans"), scores.alias("scores"))


def _sql() -> str:
    """The rule in SQL: plain patterns, places by running sums over the matches of a text."""
    cases, scores, cuts = [], [], []
    rules = {
        "email": "true",
        "ip": "len(list_filter(string_split(m, '.'), lambda x: length(ltrim(x, '0')) > 3 OR CAST(right('00' || x, 3) AS INTEGER) > 255)) = 0",
        "card": "length(digits) BETWEEN 16 AND 19 AND list_sum(list_transform(range(1, length(digits) + 1),"
        " lambda i: CAST((CASE WHEN i % 2 = 0 THEN '0246813579' ELSE '0123456789' END)[CAST(reverse(digits)[i] AS INTEGER) + 1] AS INTEGER))) % 10 = 0",
        "phone": "length(digits) BETWEEN 8 AND 15",
        "iban": "n IS NOT NULL AND regexp_matches(a, '^(([A-Z0-9]{4} )*[A-Z0-9]{1,4}|[A-Z0-9]+)$') AND length(bare) = n"
        " AND NOT regexp_matches(before, '[A-Za-z0-9]$') AND NOT regexp_matches(substr(m, length(a) + 1, 1) || after, '^[A-Za-z0-9]')"
        f" AND list_reduce(list_transform(string_split(substr(bare, 5) || left(bare, 4), ''), lambda c: instr('0123456789{UPPER}', c) - 1),"
        " lambda a, v: (a * CASE WHEN v > 9 THEN 100 ELSE 10 END + v) % 97) = 1",
        "ssn": "NOT regexp_matches(m, '^(000|666|9)|-00-|-0000$') AND NOT regexp_matches(before, '[0-9-]$') AND NOT regexp_matches(after, '^[0-9-]')",
    }
    for order, kind in enumerate(KINDS):
        cuts.append(f"SELECT no, {order} AS place, regexp_extract_all(t, '{kind.means}') AS ms, string_split_regex(t, '{kind.means}') AS ps FROM d")
        cases.append(f"WHEN {order} THEN {rules[kind.name]}")
        less = f" - CASE WHEN regexp_matches(near, '[^a-z]({kind.less})[^a-z]') THEN {kind.loss} ELSE 0 END" if kind.less else ""
        scores.append(f"WHEN {order} THEN {kind.score} + CASE WHEN regexp_matches(near, '[^a-z]({kind.more})[^a-z]') THEN {kind.gain} ELSE 0 END{less}")
    names = [k.name for k in KINDS]
    base = [i for i, k in enumerate(KINDS) if k.base]
    counts = ", ".join(f"count(s) FILTER (place = {i}) AS n_{names[i]}" for i in base)
    lengths = ", ".join(f"'{x[:2]}': {x[3:]}" for x in IBAN_LENGTHS.split(", "))
    near = f"translate(right(' ' || before, {BEFORE + 1}) || '|' || left(after || ' ', {AFTER + 1}), '{UPPER}', '{LOWER}')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS no, doc_id, coalesce(text, '') AS t FROM documents),
c AS ({" UNION ALL ".join(cuts)}),
u AS (SELECT no, place, unnest(ms) AS m, generate_subscripts(ms, 1) AS i, ps FROM c),
p AS (SELECT no, place, m, ps[i] AS before, ps[i + 1] AS after, CAST(sum(length(m) + length(ps[i])) OVER (PARTITION BY no, place ORDER BY i) AS BIGINT) AS until FROM u),
k AS (SELECT *, regexp_replace(m, '[^0-9]', '', 'g') AS digits, (MAP {{{lengths}}})[left(m, 2)] AS n, {near} AS near FROM p),
a AS (SELECT *, left(m, CAST(n + CASE WHEN substr(m, 5, 1) = ' ' THEN (n - 1) // 4 ELSE 0 END AS BIGINT)) AS a FROM k),
b AS (SELECT *, replace(a, ' ', '') AS bare FROM a),
r AS (SELECT *, until - length(m) AS s, until - length(m) + CASE WHEN place = {names.index("iban")} THEN length(a) ELSE length(m) END AS e, CASE place {" ".join(scores)} END AS score
      FROM b WHERE CASE place {" ".join(cases)} END),
f AS (SELECT *, CASE place {" ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(names))} END || ':' || s || ':' || e AS told FROM r WHERE place IN ({", ".join(map(str, base))}) OR score >= {LEAST_SCORE})
SELECT doc_id, {counts},
       sha256(coalesce(string_agg(told, ',' ORDER BY place, s) FILTER (place IN ({", ".join(map(str, base))})), '')) AS base_sha256,
       coalesce(string_agg(told, ',' ORDER BY place, s), '') AS spans, coalesce(string_agg(CAST(score AS VARCHAR), ',' ORDER BY place, s), '') AS scores
FROM d LEFT JOIN f USING (no) GROUP BY no, doc_id
"""


OP13_SQL = _sql()
