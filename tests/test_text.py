import pytest
from pyspark.sql import functions as F

from statuta.functions import text as X


def value(spark, function, *inputs):
    names = [f"c{i}" for i in range(len(inputs))]
    frame = spark.createDataFrame([tuple(inputs)], ", ".join(f"{n} {'int' if isinstance(i, int) else 'string'}" for n, i in zip(names, inputs)))
    got = frame.select(function(*(F.col(n) for n in names)).alias("v")).first()["v"]
    return got.asDict() if hasattr(got, "asDict") else got


@pytest.mark.parametrize("text,norm", [("제4조의2", "4의2"), ("제4조 의2", "4의2"), ("4조의2", "4의2"), ("제4의2조", "2"), ("제3조 > 제①항", "3"), ("별표 3 (제12조 관련)", "12"), ("제 12 조", "12"), ("제10조의3에 따라 제3조", "10의3"), ("4", None), (None, None)])
def test_article(spark, text, norm):
    assert value(spark, lambda c: X.article(c)["norm"], text) == norm


@pytest.mark.parametrize("text,want", [("제4조의2 제③항 제2호", ("4의2", 3, 2)), ("산업안전보건법 제38조 제1항 2호", ("38", 1, 2)), ("제4조의 3가지", ("4의3", None, None)), ("③항", (None, 3, None)), ("①②항", (None, None, None)), ("별표 2호", (None, None, 2))])
def test_citation(spark, text, want):
    got = value(spark, X.citation, text)
    assert (got["jo"], got["hang"], got["mok"]) == want


@pytest.mark.parametrize("text,want", [("①", 1), ("제3항", 3), ("3.", 3), ("①항", None), ("㉑", None), ("가", None), (" ⑳ ", 20), (None, None)])
def test_paragraph_number(spark, text, want):
    assert value(spark, X.paragraph_number, text) == want


@pytest.mark.parametrize("text,want", [("2.", 2), ("2", 2), ("가.", None), ("1의2.", None), ("", None), (None, None)])
def test_item_number(spark, text, want):
    assert value(spark, X.item_number, text) == want


@pytest.mark.parametrize("text,want", [("본문 <개정 2012.3.5, 2019.12.26> 끝 <신설 2020.1.1>", ["2012-03-05", "2019-12-26"]), ("<개정 2012. 3. 5.>", []), ("< 개정 2021.1.1><개정 2021.1.1, 2022.13.40>", ["2021-01-01", "2022-13-40"]), (None, [])])
def test_amendment_dates(spark, text, want):
    assert value(spark, X.amendment_dates, text) == want


@pytest.mark.parametrize("text,want", [("4-2", "4의2"), ("4/2", "4의2"), ("4 의 2", "4의2"), ("0003", "0003"), ("000300", "000300"), ("", None)])
def test_annex_number(spark, text, want):
    assert value(spark, X.annex_number, text) == want


@pytest.mark.parametrize("text,want", [("000300", "3"), ("000402", "4의2"), ("3", "0의3"), ("12", "0의12"), ("1234567", "1234의567"), ("4의2", None), ("", ""), (None, "")])
def test_annex_number_human(spark, text, want):
    assert value(spark, X.annex_number_human, text) == want


@pytest.mark.parametrize("text,want", [("10", "001000"), ("10의2", "001002"), ("제3조", "000300"), ("제3조의12", "000312"), ("서문", None)])
def test_article_code(spark, text, want):
    assert value(spark, X.article_code, text) == want


@pytest.mark.parametrize("text,want", [("2024-01-05", "2024-01-05"), ("2024-1-5", "2024-01-05"), ("2024-01-05T10:00", "2024-01-05"), ("20240105", None), ("2024-1-5T00", None), ("2024-13-01", None), (None, None)])
def test_as_of_date(spark, text, want):
    assert value(spark, lambda c: X.as_of_date(c).cast("string"), text) == want


def test_intent(spark):
    assert value(spark, X.annex_intent, '"산업안전보건기준에 관한 규칙"의 별표 3') == {"law_name": "산업안전보건기준에 관한 규칙", "number": 3}
    assert value(spark, X.annex_intent, "그 규칙 별표 3 링크 보여줘") == {"law_name": None, "number": 3}


def test_references_are_sorted_by_size(spark):
    assert value(spark, X.annex_references, "별표 10, 별표 2, 별표 4의2, 별표3, 별표 2") == ["2", "3", "10", "4의2"]


def test_paths(spark):
    assert value(spark, X.display_path, "4의2", 1, 2) == "제4조의2 제1항 제2호"
    assert value(spark, X.unit_path, "14", "③", "2.") == "제14조 > 제③항 > 2.호"
    assert value(spark, X.unit_path, "14", "③", "가") == "제14조 > 제③항 > 가.호"


def test_plain_number(spark):
    assert [value(spark, X.plain_number, t) for t in ("007", "0", "x", None)] == [7, 0, None, None]


def test_tables(spark):
    assert value(spark, X.table_runs, "| a |\n| b |\n| c |\nx\n | d | \n") == ["| a | | b |", "| d |"]
