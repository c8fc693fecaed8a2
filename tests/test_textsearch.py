import random

import pytest

from statuta.operators import textsearch as T


@pytest.mark.parametrize("queries, texts", [(50_000, 50_000), (4, 7)])
def test_search_in_blocks_equals_the_join_by_term(spark, monkeypatch, queries, texts):
    rng = random.Random(3)
    words = ["가", "나다", "Law", "law", "제3조", "10", "x", "y"]
    rows = [(i, None if i % 11 == 0 else " ".join(rng.choices(words, k=rng.randint(0, 6)))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    asked = spark.createDataFrame([(i, t) for i, t in rows[:10]] + [(99, "only unknown words")], "qid int, query string")
    monkeypatch.setattr(T, "QUERY_BLOCK", queries)
    monkeypatch.setattr(T, "TEXT_BLOCK", texts)
    want = sorted(map(tuple, T.joined_by_term(docs, asked, 5).collect()))
    assert sorted(map(tuple, T.tfidf_search(docs, asked, 5).collect())) == want and want
    monkeypatch.setattr(T, "VOCABULARY", 3)
    assert sorted(map(tuple, T.tfidf_search(docs, asked, 5).collect())) == want


def test_no_texts_give_no_answers(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert T.tfidf_search(none, spark.createDataFrame([(1, "law")], "qid int, query string"), 5).count() == 0
