"""Benchmark items of few words and of scripts without blanks."""

from tideline.llm.decontaminate import contaminated, drop_contaminated


def test_short_and_unspaced_items_are_found(spark):
    docs = spark.createDataFrame([(1, "so: Yes or no? yes or no"), (2, "yes or maybe"), (3, "他问人工智能的首都是什么地方，然后走了"), (4, "one word alone"), (5, "คำถาม"), (6, None)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "Yes or no"), (2, "人工智能的首府是什么地方"), (3, "alone"), (4, "!?"), (5, "คำถาม"), (6, "yes or no?")], "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.start, r.length, r.distance) for r in contaminated(docs, items, min_words=1).collect()}
    short = {(1, i, s, 9, 0) for i in (1, 6) for s in (4, 15)} | {(4, 3, 9, 5, 0)}
    assert short <= got and {(x[0], x[1]) for x in got} == {(1, 1), (1, 6), (3, 2), (4, 3), (5, 5)}
    assert {x[2:] for x in got if x[0] == 3} == {(2, 12, 1)}
    assert [r.doc_id for r in drop_contaminated(docs, items, min_words=1).orderBy("doc_id").collect()] == [2, 6]
