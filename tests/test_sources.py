import json

import pytest

from statuta.operators import export, lookup
from statuta.plans import building
from statuta.sources import files, service


def test_recorded_responses(spark, tmp_path):
    (tmp_path / "1.json").write_text('{"법령": {}}', encoding="utf-8")
    (tmp_path / "2.json").write_text("<html>", encoding="utf-8")
    spark.dataSource.register(service.LawService)
    rows = {r["key"]: r for r in spark.read.format("law_service").option("captured", str(tmp_path)).option("partitions", "2").option("rps", "1000").load().collect()}
    assert json.loads(rows["1"]["payload"]) == {"법령": {}} and rows["2"]["payload"] is None and rows["2"]["error"]


def test_retries():
    answers, pauses = [(503, "", ""), (200, "text/html", "<p>"), (200, "application/json", '{"a": 1}')], []
    assert service.with_retries(lambda: answers.pop(0), pauses.append) == {"a": 1}
    assert pauses == [1.0, 2.0]
    with pytest.raises(service.BadResponse):
        service.with_retries(lambda: (200, "application/json", "{"), pauses.append)


def test_rate_limit():
    now, slept = [0.0], []

    def sleep(seconds):
        slept.append(seconds)
        now[0] += seconds

    limiter = service.RateLimiter(2, lambda: now[0], sleep)
    for _ in range(5):
        limiter.acquire()
    assert sum(slept) == pytest.approx(1.5)


def test_kinds_of_responses():
    kinds = [("application/json", "{}"), ("application/json", "{"), ("text/html", " "), ("text/html", " <p>"), (None, "x"), (None, None)]
    assert [service.classify(*k) for k in kinds] == ["json", "bad_json", "empty", "markup", "unexpected", "empty"]


def test_unit_files(spark, tmp_path):
    (tmp_path / "가 법_12_units.json").write_text(json.dumps([{"level": "조", "jo": "1"}, {"level": "별표", "links": {"pdf": "/x"}}], ensure_ascii=False), encoding="utf-8")
    (tmp_path / "나_13_units.json").write_text("{", encoding="utf-8")
    rows = files.read_units(spark, str(tmp_path)).orderBy("level").collect()
    assert [(r["level"], r["base"], r["mst"]) for r in rows] == [("별표", "가 법_12", "12"), ("조", "가 법_12", "12")]
    files.write_units(files.read_units(spark, str(tmp_path)), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_greedy_shards(spark):
    sizes = spark.createDataFrame([("a", i, n) for i, n in enumerate([5, 5, 20, 1, 9, 2])] + [("b", 0, 3)], "k string, i int, n int")
    got = sorted((r["k"], r["i"], r["shard"]) for r in export.greedy_shards(sizes, "k", "i", "n", 10).collect())
    assert got == [("a", 0, 1), ("a", 1, 1), ("a", 2, 2), ("a", 3, 3), ("a", 4, 3), ("a", 5, 4), ("b", 0, 1)]


def test_new_line_is_appended(spark):
    lines = spark.createDataFrame([(0, "A=1")], "pos int, value string")
    assert sorted((r["pos"], r["value"]) for r in files.upsert_line(lines, "B", "2").collect()) == [(0, "A=1"), (1, "B=2")]


def test_first_nonempty_with_null_keys(spark):
    a = spark.createDataFrame([("x", 1)], "k string, v int")
    b = spark.createDataFrame([("x", 2), (None, 3)], "k string, v int")
    assert sorted(r["v"] for r in lookup.first_nonempty([a, b], "k").collect()) == [1, 3]


def test_containment(spark):
    texts = spark.createDataFrame([("가나다 시행령",), ("가나",), ("",), (None,), ("가나다 시행령",)], "listed_name string")
    names = spark.createDataFrame([("가나",), ("나다",), ("없다",), (None,)], "law_name string")
    got = {(r["listed_name"], r["law_name"]) for r in lookup.containing(texts, names).collect()}
    assert got == {("가나다 시행령", "가나"), ("가나다 시행령", "나다"), ("가나", "가나")}


def test_queries_and_sql_agree_on_names():
    assert set(building.SQL) <= set(building.QUERIES)


def test_only_what_may_change_is_asked_again():
    for status, tries in ((401, 1), (404, 1), (429, 3), (503, 3)):
        asked = []

        def request(status=status, asked=asked):
            asked.append(status)
            return status, "text/html", "no"

        try:
            service.with_retries(request, sleep=lambda s: None)
        except RuntimeError:
            pass
        assert len(asked) == tries


def test_failed_pages_neither_end_nor_lengthen_a_run(spark):
    rows = [("a", i, n, bad) for i, (n, bad) in enumerate([(1, False), (0, False), (0, True), (0, False), (9, True), (0, False), (5, False)])]
    pages = spark.createDataFrame(rows, "k string, i int, n int, bad boolean")
    got = lookup.cut_at_empty_run(pages, "k", "i", pages["n"] == 0, run=3, failed=pages["bad"])
    assert sorted(r["i"] for r in got.collect()) == [0, 1, 3, 5]


def test_unit_files_are_found_by_name_or_folder(spark, tmp_path):
    (tmp_path / "12").mkdir()
    for name in ("12/units.json", "나 법_13_units.json", "other.json"):
        (tmp_path / name).write_text("[]", encoding="utf-8")
    got = {(r["base"], r["mst"]) for r in files.find_unit_files(spark, str(tmp_path)).collect()}
    assert got == {("12", "12"), ("나 법_13", "13")}


def test_names_are_composed(spark):
    import unicodedata

    from pyspark.sql import functions as F

    from statuta.functions import text as X

    frame = spark.createDataFrame([(unicodedata.normalize("NFD", "가나 법"),), ("가나 법",), (None,)], "s string")
    assert [r[0] for r in frame.select(X.slug(F.col("s"))).collect()][:2] == ["가나 법", "가나 법"]
