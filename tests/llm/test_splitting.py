import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from statuta.llm import splitting as S


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="가나 .\n①제1조(,", max_size=400), st.integers(20, 80), st.integers(0, 9))
def test_pieces_fit_overlap_and_restore_the_text(text, limit, overlap):
    pieces = S.split_text(text, limit, overlap)
    assert "".join(text[s:e] for s, e, _ in pieces) == text
    for k, (s, e, piece) in enumerate(pieces):
        assert len(piece) <= limit and piece.endswith(text[s:e])
        if k and overlap:
            before = pieces[k - 1][2]
            assert piece.startswith(before[-overlap:]) and len(piece) == len(before[-overlap:]) + e - s


def test_the_strongest_boundary_near_the_middle_is_cut():
    text = "가" * 40 + ". " + "나" * 8 + "\n제2조(목적) " + "다" * 40
    (first, second) = S.bisect_spans(text, 80, 10)
    assert text[second[0] :].startswith("제2조")
    text = "가" * 40 + ". " + "나" * 8 + ", " + "다" * 40
    assert text[S.bisect_spans(text, 80, 10)[1][0] :].startswith("나")


def test_a_boundary_far_from_the_middle_is_better_than_none():
    text = "가" * 10 + ". " + "나" * 90
    assert S.bisect_spans(text, 95, 5)[0] == (0, 12)


def test_a_text_without_boundaries_is_halved():
    assert S.bisect_spans("가" * 100, 60, 0) == [(0, 50), (50, 100)]


def test_parameters_are_checked():
    with pytest.raises(ValueError):
        S.split_text("x" * 100, 50, 25)


def test_tables(spark):
    rows = [(1, None), (2, ""), (3, " \n "), (4, "가" * 2000), (5, "나" * 2001), (5, "나" * 2001), (6, "😀" * 2001), (7, "가. " * 100_000)]
    frame = spark.createDataFrame([(*r, "clash") for r in rows], "unit_id long, text string, piece string")
    pieces = S.split_oversized(frame).collect()
    counts = {}
    for r in pieces:
        counts[r["unit_id"]] = counts.get(r["unit_id"], 0) + 1
        assert len(r["piece"]) <= 2000
    assert 1 not in counts and [counts[k] for k in (2, 3, 4, 5, 6)] == [1, 1, 1, 4, 2]
    assert sorted(r["unit_id"] for r in S.oversized(frame).collect()) == [5, 5, 6, 7]


def test_empty_table(spark):
    assert S.split_oversized(spark.createDataFrame([], "unit_id long, text string")).count() == 0


def test_no_slivers():
    for text in ("가. " + "나" * 5000, "나" * 1849 + " 가" + "나" * 951, "가 " * 5 + "나" * 3000 + " 가"):
        sizes = [e - s for s, e in S.bisect_spans(text)]
        assert sum(sizes) == len(text) and min(sizes) >= (S.LIMIT - S.OVERLAP) // 8
