"""Articles of odd documents agree with their SQL: null columns, short, unprintable and plain bodies that read as base64."""

import base64
import random

import duckdb

from tests.oracle import canonical
from tideline.plans import source_queries as q


def test_articles_of_odd_documents(spark, tmp_path):
    rng = random.Random(4)
    coded = [base64.b64encode(x).decode() for x in (b"plain text", b"ten chars!", "é甲乙丙丁".encode(), b"\x00\x01\x02\x03\x04\x05\x06", b"\xff\xfe\xfd\xfc\xfb\xfa", b"eleven char")]
    texts = [None, "", "A", "Abc", "Abcd", "甲", "ctrl\x01 text is here", "odd � mark", "line\r\nend", "Abcdefgh\n", *coded, *[c.rstrip("=") for c in coded], "abcdefghi", "====", "QUJDREVGRw=", "two  words"]
    texts += ["".join(rng.choices("ABCDabcd0123+/", k=rng.randint(8, 14))) for _ in range(60)]
    rows = [(n * 21 + k, text, lang, source) for n, text in enumerate(texts) for k, (lang, source) in enumerate([("en", "a"), (None, "a"), ("en", None), ("aGVsbG8gd29ybGQ=", "b"), ("en", "c"), (None, None), ("de", "d"), ("en", None)])]
    at = f"{tmp_path}/documents.parquet"
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(at)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{at}/*.parquet'")
    found = con.execute(q.ORACLES["article_documents"])
    names = [d[0] for d in found.description]
    df = q.QUERIES["article_documents"](spark, str(tmp_path))
    got, want = canonical(df.columns, [tuple(r) for r in df.collect()]), canonical(names, found.fetchall())
    assert got == want, [(set(got) - set(want), set(want) - set(got))]
