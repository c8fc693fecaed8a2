import datetime

import pytest

from statuta.llm import survivors as S

UNITS = (
    "unit_id long, mst string, level string, annex_no string, title string, links struct<html:string,pdf:string,detail:string>, "
    "source_name string, collected_at timestamp, annex string, trust int, field string"
)
TRUST = [("good", 90), ("fair", 50), ("bad", 10)]


def day(n):
    return None if n is None else datetime.datetime(2024, 1, 1) + datetime.timedelta(days=n)


def run(spark, rows, what=S.best_representatives):
    units = spark.createDataFrame([(i, m, lv, n, t, ln, s, day(c), "clash", 1, "clash") for i, m, lv, n, t, ln, s, c in rows], UNITS)
    return what(units, spark.createDataFrame(TRUST, "source_name string, trust int")).collect()


def survivors(spark, rows):
    return {(r["group_id"], r["field"]): r["unit_id"] for r in run(spark, rows)}


def test_numbers_however_written_are_one_annex(spark):
    written = ["4의2", "4-2", "4_2", "4/2", " 4 의 2", "[별표 4의2]", "별지 제4호의2서식", "000402", "0004의02", "４의２", "4의2."]
    rows = [(i + 1, "1", "별표", n, f"t{i}", None, "good", 0) for i, n in enumerate(written)]
    rows += [(50, "1", "별표", "4", "x", None, "good", 0), (51, "1", "서식", "4의2", "y", None, "good", 0), (52, "2", "별표", "4의2", "z", None, "good", 0)]
    assert {g for g, _ in survivors(spark, rows)} == {1}


@pytest.mark.parametrize("missing", [None, "", " ", "-", "0", "000000", "별표"])
def test_a_unit_without_number_goes_by_its_title(spark, missing):
    rows = [(1, "1", "별표", "3", "[별표 3] 설치 기준(제2조 관련)", None, "bad", 0), (2, "1", "별표", missing, "설치기준", None, "good", 0), (3, "1", "별표", missing, "다른 기준", None, "good", 0)]
    assert survivors(spark, rows) == {(1, "annex_no"): 1, (1, "title"): 2}


def test_trust_then_time_then_id(spark):
    def one(*claims):
        rows = [(i, "1", "별표", "1", None, {"html": "/a", "pdf": None, "detail": None}, s, c) for i, s, c in claims]
        return survivors(spark, rows)[min(c[0] for c in claims), "html"]

    assert one((1, "bad", 9), (2, "good", None), (3, "unheard", 99), (4, None, 99)) == 2
    assert one((1, "fair", None), (2, "fair", 1), (3, "fair", 0)) == 2
    assert one((7, "fair", 1), (5, "fair", 1)) == 5
    assert one((1, None, 1), (2, "unheard", 2)) == 2


def test_stand_ins_are_not_usable(spark):
    links = [{"html": h, "pdf": "#", "detail": "javascript:void(0)"} for h in ("/", "http://", "about:blank", "-", " ")] + [{"html": "/x", "pdf": "", "detail": None}]
    rows = [(i + 1, "1", "서식", "1", "별표/서식" if i else "-", link, "good", 0) for i, link in enumerate(links)]
    assert survivors(spark, rows) == {(1, "annex_no"): 1, (1, "html"): 6}


def test_single_units_have_no_rows_and_repeated_ones_do(spark):
    row = (1, None, "별표", "1", "t", None, None, None)
    assert survivors(spark, [row]) == {}
    assert survivors(spark, [row, row]) == {(1, "annex_no"): 1, (1, "title"): 1}


def test_the_model_learns_which_source_errs(spark):
    rows, n = [], 0
    for a in range(60):
        for source, wrong in (("good", False), ("fair", a % 10 == 0), ("bad", a % 3 != 0)):
            n += 1
            link = {"html": f"/{a}/{'x' + str(n) if wrong else 'right'}", "pdf": None, "detail": None}
            rows.append((n, str(a), "별표", "1", f"기준 {a}", link, source, 0))
    quality = {(r["field"], r["source"]): (r["sensitivity"], r["specificity"]) for r in run(spark, rows, S.source_quality)}
    for k in (0, 1):
        assert min(quality["html", "good"][k], quality["html", "fair"][k]) > 0.8 > 0.5 > quality["html", "bad"][k]
    kept = [r["value"] for r in run(spark, rows, S.true_values)]
    assert sum(v.endswith("right") for v in kept) == 60 and len(kept) <= 66
    best = {r["group_id"]: r for r in run(spark, rows) if r["field"] == "html"}
    assert all(0 < r["posterior"] <= 1 for r in best.values()) and len(best) == 60


def test_empty_table(spark):
    assert run(spark, []) == [] and run(spark, [], S.true_values) == []
