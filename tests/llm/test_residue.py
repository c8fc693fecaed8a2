import os

import pytest
from pyspark.sql import functions as F

from statuta.llm import residue as R

DATA = os.environ.get("TESTDATA_DIR", "/root/testdata")
LAW = "관할 행정청은 해마다 3월까지 설치 현황을 종합하여 대장으로 펴낸다."


def found(spark, rows):
    frame = spark.createDataFrame([(i, t, x, "clash") for i, (t, x) in enumerate(rows)], "unit_id long, title string, text string, name string")
    return {r["unit_id"] for r in R.residue_units(frame).collect()}


RESIDUE = [
        "{{별표명}}", "{{ law_name }}", "${본문}", "#{page_no}", "<%= 항내용 %>", "{% title %}", "%(법령명)s", "__조문제목__", "@@content@@", "[[본문]]", "«시행일자»", "$body$",
        "&lt;별표명&gt;", "[TODO: 항내용]", "(여기에 담당부서 기재)", "<법령명을(를) 입력하세요>", "{{#if 본문}}{{/if}}", "제 {{본문}} 조 (${제목})", "{본문}",
        f"{LAW} ${{본문}} 끝", "undefined undefined", "[object Object]", "#REF!", "None\nNone", "null",
        "Lorem ipsum dolor sit amet", "xxxx xxxx xxxx", "ㅁㄴㅇㄹ ㅁㄴㅇㄹ", "본문본문본문본문", "가나다라마바사아자차카타파하 가나다라마바사", "□□□□ □□□□ □□□□", "test test 123", "테스트 데이터",
        "(견본) 이곳을 눌러 내용을 편집하십시오", "추후 등록 예정", "더미 텍스트 자리 실제 내용으로 교체하세요.",
        "404 Not Found", "Error 500: internal server error", "<html><head><title>403 Forbidden</title></head></html>", '{"error":{"code":504,"message":"gateway time-out"}}',
        "Traceback (most recent call last):\n  File \"a.py\", line 3, in b\nKeyError", "HTTP/1.1 502 Bad Gateway\r\nContent-Length: 0", "SQLSTATE[08006]: connection refused",
        "요청하신  페이지를  찾을  수  없습니다.", "시스템 점검 중입니다.", "이 화면은 자바스크립트를 켜야 보입니다", "<noscript>x</noscript>",
        "Your browser does not support scripts; update it to continue", "JAVASCRIPT IS REQUIRED TO VIEW THIS PAGE", f"{LAW}\n세션이 만료되었습니다. 다시 로그인하세요.",
]


def test_residue_is_found_in_text_and_title(spark):
    rows = [row for value in RESIDUE for row in ((None, value), (value, LAW), ("목적", LAW))]
    assert found(spark, rows) == {k for k in range(len(rows)) if k % 3 < 2}


@pytest.mark.parametrize(
    "value",
    [
        None, "", "  ", "-", "별표/서식", LAW, f"{LAW} <개정 2012.3.5>", "삭제 <2006.2.18>", "[본조신설 2024.8.8]", "<별표 4> 이중 덮개의 설치기준", "[별지 제1호서식] 신청서",
        "소요량 Q = { (A + B) × 0.26 } ÷ 9 으로 계산한다.", "접수번호 (      )  접수일 (    년  월  일)", "[  ] 신규  [  ] 변경", "○○시장은 (성명)란에 신청인을 적게 한다.",
        "소관 부처의 장은 자바스크립트 등 특정 프로그램의 설치를 요구하여서는 아니 된다.", "전자시스템에 오류가 발생한 경우 복구한다.", "견본의 제출", "임시 문구의 표지", "시험(테스트) 방법",
        "사업자는 표의 [유속] 칸과 (비고)난을 비워 둘 수 있다.", "| 이동온실 | 조도 | 46 |\n| 이동온실 | 농도 | 4 |", "----------", "Q281-표면온도W035-소음수준",
    ],
)
def test_wording_of_laws_is_kept(value):
    assert [s for s in R.suspects(value) if s[2] >= 2] == []


def test_weak_slots_need_a_known_name(spark):
    rows = [(None, "<본문> 및 그 밖의 사항을 정한다."), (None, "<갑을> 및 그 밖의 사항을 정한다."), (None, "{{본문}}")]
    assert found(spark, rows) == {0, 2}


def test_templates_count_records(spark):
    frame = spark.createDataFrame([(i, None, f"요청번호 {i} 다시 시도하세요") for i in range(5)], "unit_id long, title string, text string")
    rows = R.templates(R.judged_segments(frame)).collect()
    assert [(r["template"], r["records"], r["residue"]) for r in rows] == [("요청번호 0 다시 시도하세요", 5, True)]


def test_clean_units_keep_columns_and_rows(spark):
    frame = spark.createDataFrame([(1, "a", LAW, "x"), (1, "a", LAW, "x"), (2, "{{t}}", LAW, "y"), (3, None, None, "z")], "unit_id long, title string, text string, kinds string")
    assert sorted((r["unit_id"], r["kinds"]) for r in R.clean_units(frame).collect()) == [(1, "x"), (1, "x"), (3, "z")]


def test_empty_table_and_long_text(spark):
    assert found(spark, []) == set()
    assert found(spark, [(None, LAW * 5000), (None, LAW * 5000 + " {{본문}}")]) == {1}


MISSED_BY_SIGNS = [
    f"{LAW} 본문 본문 본문 본문 본문 본문", "[내용 작성]", "[사업자명을 작성]", "(여기에 담당부서 작성)", "가짜 문구", "나중에 바꿀 제목", "실제 내용으로 교체", "추후 등록할 내용",
    "기본문구", "화면 확인용", "배치 확인", "내용 없음 내용 없음", "가나 다라 가나 다라", "라마바사아자차", "아자차카타파하", "<개정문>", "< 본문>", "<별표명>",
    "<h1>", "l o r e m i p s u m", "t e s t t e s t", f"{LAW} undefıned", "하나 둘 셋 하나 둘 셋 하나 둘",
]


class Everything:
    """A sign that every text shows."""

    def search(self, text):
        return True

    def __iter__(self):
        return iter([""])


@pytest.mark.parametrize("value", MISSED_BY_SIGNS[:12])
def test_residue_without_a_former_sign_is_suspected(value):
    assert R.suspects(value)


def test_signs_lose_nothing(monkeypatch):
    import random

    rng = random.Random(5)
    parts = [*MISSED_BY_SIGNS, LAW, "{{본문}}", "$a$", "%(본문)s", "@@본문@@", "«본문»", "__본문__", "[[본문]]", "{본문}", "#REF!", "nil", "&LT;본문&gt;", "\n", "h1", "404 not found", "견본", "샘플 글", "입력", "시오", "해요"]
    values = parts + ["".join(rng.choice((rng.choice(parts), rng.choice("가나다 <>[](){}$#@_%ab1.\n"))) for _ in range(rng.randint(1, 6))) for _ in range(3000)]
    want = [R.suspects(v) for v in values]
    for name in ("_LETTERS", "_SLOT_SIGNS", "_DUMMY_SIGNS", "_POLITE_SIGNS"):
        monkeypatch.setattr(R, name, Everything())
    assert [R.suspects(v) for v in values] == want


def test_repeats_with_a_cut_end_equal_the_plain_search():
    import random

    rng = random.Random(2)
    for _ in range(3000):
        unit = " ".join("".join(rng.choice("가나") for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(1, 3)))
        value = (" ".join([unit] * rng.randint(1, 4)) + rng.choice(["", " 가", " 나가"])).strip()
        text, words = "".join(value.split()), value.split()
        first = len(words[0])
        plain = any(text.startswith(text[p:]) for p in range(first, len(text) // 2 + 1)) and len(words) > 2 and len(text) >= 6
        doubled = (text + text).find(text, 1)
        if plain and doubled == len(text):
            assert R.is_filler(value), value


def test_a_repeated_page_that_is_a_note_is_a_message(spark):
    rows = [(None, "페이지를 찾을 수 없음"), ("목적", "페이지를 찾을 수 없음"), ("점검 중의 조치", LAW), ("점검 중의 조치", LAW), (None, "시스템 점검 중")]
    assert found(spark, rows) == {0, 1}


#: Residue in no list's words; planted in five units each it has to be found by its repetition.
UNLISTED = [
    "%%TITLE%%", "<<본문>>", "${law.title:-}", "{{ user.name | default('x') }}", "ERR_CONNECTION_RESET", "DNS_PROBE_FINISHED", "Just a moment...",
    "TBD", "TODO", "로딩중", "준비중", "페이지 오류", "웹 페이지를 열지 못함", "접속자가 많아 대기중",
]
INVENTED = [
    "우주항공청장은 발사체의 회수 계획을 해마다 수립하여 알려야 한다.", "이 법은 입력하신 자료를 처리하는 중 오류가 발생하면 문의하여야 합니다.", "해양생물의 표본을 수집하려는 자는 허가를 받아야 한다.",
    "견본을 제출한 자에게는 접수증을 내주어야 한다.", "전산망의 장애로 접속할 수 없는 경우에는 서면으로 신고할 수 있다.", "양식의 빈칸은 신청인이 채운다.", "누리집에는 자바스크립트를 쓰지 아니한다.",
    "비밀번호를 잊은 이용자는 본인임을 확인받아야 한다.", "점검 중인 시설에는 출입하여서는 아니 된다.", "서버의 점검 주기는 6개월로 한다.",
]


def test_repeated_pages_are_found_without_a_list_and_provisions_kept(spark):
    units = spark.read.parquet(os.path.join(DATA, "sf0.001", "units.parquet")).select((-F.col("unit_id")).alias("unit_id"), "mst", "title", "text")
    texts = [x for x in (*UNLISTED, *INVENTED) for _ in range(5)]
    planted = spark.createDataFrame([(i, f"m{i % 7}", None, x) for i, x in enumerate(texts)], units.schema)
    frame = units.unionByName(planted)
    got = {texts[r["unit_id"]] for r in R.residue_units(frame, law="mst").where("unit_id >= 0").collect()}
    assert got == set(UNLISTED)


def test_a_slot_that_other_records_fill_keeps_no_placeholder(spark):
    rest = "에 관하여는 대통령령으로 정하는 바에 따라 신고하여야 한다."
    rows = [(None, f"{chr(0xAC00 + k)}료 {rest}") for k in range(120)] + [(None, f"<수료명> {rest}"), (None, "<갑을명> 및 그 밖의 사항을 정한다.")]
    assert found(spark, rows) == {120}
