"""Identity rows, titled cycles, spans and what-if: every branch on literal pages."""

import pytest
from pyspark.sql import functions as F

from tideline.functions import text as t
from tideline.operators import identity as i
from tideline.operators import segments as g
from tideline.operators import what_if as w

TEN = "01.02.03.04.05.06.07.08.09.10"
OTHER = "11.12.13.14.15.16.17.18.19.20"
TWICE = "01.01.03.04.05.06.07.08.09.10"


def page(*rows, who="作者：屠龙", title="399期：【绝杀十码】"):
    return "\n".join([who, title, *rows])


def row(period, numbers=TEN, sign="屠龙"):
    return f"{period:03d}期 {sign} 绝杀十码 {numbers} 开:??"


def run(spark, content, region="bottom", requested=(), window=2, skip=False, anchor="横财", author="屠龙"):
    docs = spark.createDataFrame([("d", content, author, anchor, region, window, list(requested), skip)], "doc string, content string, author string, row_anchor string, region string, window int, requested array<int>, skip_repeats boolean")
    values, problems = i.identity_candidates(docs)
    return sorted((r.period, r.value) for r in values.collect()), sorted(((r.period or 0), r.problem) for r in problems.collect())


N = TEN.replace(".", ",")


@pytest.mark.parametrize(
    ("content", "options", "want"),
    [
        (page(row(1), row(2), row(3)), {}, ([(2, N), (3, N)], [])),
        (page(row(3), row(2), row(1), who="x"), {"region": "top"}, ([(2, N), (3, N)], [])),
        (page(row(1), who="作者：别人"), {}, ([], [(0, "another author")])),
        # a row within the head is a title too; one behind the author's name is not
        (page(row(1), title="no title"), {}, ([(1, N)], [])),
        (page(*["x"] * 20, row(1), title="no title"), {}, ([], [(0, "no title")])),
        (page(*["x"] * 20, row(1), title="屠龙 399期：绝杀十码"), {}, ([], [(0, "no title")])),
        (page(row(1)), {"author": " "}, ([], [(0, "no author")])),
        (page(row(1)), {"region": "left"}, ([], [(0, "no direction")])),
        # the row anchor counts like the author; a row without either, or with the name too far in, does not
        (page(row(1, sign="横财"), row(2), row(3, sign="别人"), row(4, sign="文" * 50 + "屠龙")), {}, ([(1, N), (2, N)], [])),
        # two signatures: no place in the window; fatal inside it or when asked for
        (page(row(1, sign="横财 屠龙"), row(2), row(3)), {}, ([(2, N), (3, N)], [])),
        (page(row(1), row(2, sign="横财 屠龙"), row(3)), {}, ([], [(2, "two signatures")])),
        (page(row(1, sign="横财 屠龙"), row(2), row(3)), {"requested": (1,)}, ([], [(1, "two signatures")])),
        # repeats and several groups inside the window
        (page(row(1, TWICE), row(2), row(3)), {}, ([(2, N), (3, N)], [])),
        (page(row(1), row(2, TWICE), row(3)), {}, ([], [(2, "repeats")])),
        (page(row(1), row(2, TWICE), row(3)), {"skip": True}, ([(1, N), (3, N)], [])),
        (page(row(1), row(2, TWICE), row(3)), {"skip": True, "requested": (2,)}, ([], [(2, "repeats")])),
        (page(row(1), row(2, TEN + " / x " + OTHER)), {}, ([], [(2, "several groups")])),
        # a row without ten numbers holds its place at the bottom, and none at the top
        (page(row(1), row(2, "01.02.03"), row(3)), {}, ([(3, N)], [])),
        (page(row(3), row(2, "01.02.03"), row(1)), {"region": "top"}, ([(1, N), (3, N)], [])),
        (page("屠龙 绝杀十码"), {"region": "top"}, ([], [(0, "no signed row")])),
    ],
)
def test_identity_rows(spark, content, options, want):
    assert run(spark, content, **options) == want


def test_titled_cycles(spark):
    rows = [("a", 1, 2, 2), ("a", 2, 1, 2), ("a", 3, 365, 2), ("b", 1, 9, 7), ("b", 2, 8, 7), ("b", 3, 7, 7), ("c", 1, 365, 1), ("c", 2, 1, 1), ("c", 3, 365, 1), ("c", 4, 1, 1)]
    df = spark.createDataFrame(rows, "doc string, start int, period int, title_period int").withColumns({"region": F.lit("top"), "window": F.lit(2)})
    kept, problems = g.titled_cycle_rows(df)
    assert sorted((r.doc, r.period) for r in kept.collect()) == [("a", 1), ("a", 2)]
    assert {(r.doc, r.problem) for r in problems.collect()} == {("b", "the title's period is not in the window"), ("c", "several seams")}


def test_one_value_for_a_period(spark):
    span = lambda p, v: f"<span>{p}期</span><span>{v}</span>"
    html = span(1, "01.02") + span(2, "01,02") + span(2, "01.02") + span(3, "01.02") + span(3, "02.01") + span(4, "1.02") + span(5, "01.50")
    got = {(r.period, r.value, r.problem) for r in g.span_values(spark.createDataFrame([("u", html)], "url string, html string"), 9, 2).collect()}
    assert got == {(1, "01,02", None), (2, "01,02", None), (3, None, "ambiguous")}


def test_what_other_contracts_find(spark):
    words = F.array(t.normalize_keyword(F.lit("十码"), folded=False))
    text = "\n".join(f"00{p}期 十码 0{p}.11.12" for p in (3, 2, 1))
    docs = spark.createDataFrame([("a", "d", text), ("b", "d", text), ("c", "d", text)], "site string, doc string, content string")
    registry = spark.createDataFrame([("a", 3, "top", 2), ("b", 3, "top", 2), ("c", 3, "top", 1)], "site string, count int, region string, window int").withColumn("keywords", words)
    overrides = spark.createDataFrame([("a", None, None, 1), ("b", 0, None, None), ("c", None, None, 3), ("z", None, None, None)], "site string, count int, region string, window int").withColumn("keywords", F.lit(None).cast("array<string>"))
    changes, violations = w.what_if_extraction(docs, registry, overrides, [1, 2, 3])
    assert {(r.site, r.period, r.change) for r in changes.collect()} == {("a", 3, "same"), ("a", 2, "lost"), ("c", 3, "same"), ("c", 2, "found"), ("c", 1, "found")}
    assert {(r.site, r.violation) for r in violations.collect()} == {("b", "count is not positive"), ("z", "unknown site")}
    assert {r.site: tuple(r)[2:] for r in w.coverage(changes, [1, 2, 3]).collect()} == {"a": (2, 1, 1, 2), "c": (1, 3, 2, 0)}


def test_contracts_meet_texts_without_sorting_them(spark):
    words = F.array(t.normalize_keyword(F.lit("十码"), folded=False))
    text = "\n".join(f"00{p}期 十码 0{p}.11.12" for p in (3, 2, 1))
    docs = spark.createDataFrame([(s, d, text) for s in range(6) for d in "xy"], "site int, doc string, content string")
    registry = spark.createDataFrame([(s, 3, "top", 2) for s in range(6)], "site int, count int, region string, window int").withColumn("keywords", words)
    rows = [(0, None, None, 1), (1, None, None, 1), (1, None, None, 1), (2, None, "left", 0), (3, 4, None, None), (7, None, None, 1), (7, None, None, 1), (None, None, None, 1)]
    overrides = spark.createDataFrame(rows, "site int, count int, region string, window int").withColumn("keywords", F.lit(None).cast("array<string>"))
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        # However large the registry is taken to be, texts go past a map of contracts.
        for threshold in ("-1", held):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            changes, violations = w.what_if_extraction(docs, registry, overrides, [1, 2, 3])
            plan = changes._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" not in plan and "Broadcast" not in plan
            assert sorted((r.site, r.doc, r.period, r.change) for r in changes.collect()) == [(s, d, p, c) for s, p2, p3 in ((0, "lost", "same"), (3, "lost", "lost")) for d in "xy" for p, c in ((2, p2), (3, p3))]
            assert sorted(((r.site is None, r.site, r.violation) for r in violations.collect()), key=str) == sorted(
                [(False, 1, "two overrides"), (False, 2, "region"), (False, 2, "window is not positive"), (False, 7, "two overrides"), (False, 7, "unknown site"), (True, None, "unknown site")], key=str
            )
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)


def test_markup_in_its_order(spark):
    cases = {"<style><script></style>x</script>y": "y", "<script>a</script>b<style>c</style>d": "b\nd", "&lt;b&gt;x": "x", "a<br/>b</p>c\r\n\n d": "a\nb\nc\nd"}
    rows = spark.createDataFrame(list(cases.items()), "html string, want string")
    assert all(r.got == r.want for r in rows.select("want", t.html_to_text(F.col("html")).alias("got")).collect())


def test_links_patterns_and_anchors_of_sources(spark):
    from tideline.operators import documents as d

    html = "<a href = \"/x\">one &lt;b&gt;</a><A class='c' HREF='y'>z&amp;q <i>w</i></A><a href=''>no</a><a href='/e'> </a>"
    got = [(r.href, r.label) for r in d.anchor_links(spark.createDataFrame([("http://h/p/q", html)], "url string, html string")).orderBy("n").collect()]
    assert got == [("http://h/x", "one"), ("http://h/p/y", "z&q w")]
    docs = spark.createDataFrame([("a", "http://h/Topic/1"), ("a", "http://h/x"), ("b", "http://h/x")], "site string, url string")
    registry = spark.createDataFrame([("a", "/topic/", "old", "new"), ("b", " ", "old", "new")], "site string, source_pattern string, anchor string, source_anchor string")
    kept, bare = d.source_url_filter(docs, registry)
    assert sorted(map(tuple, kept.collect())) == [("a", "http://h/Topic/1", "new"), ("b", "http://h/x", "old")] and bare.count() == 0
