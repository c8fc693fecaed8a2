import json

from statuta.operators import drift as D

FEED = "feed_row_id long, provider_id long, file_id long, file_date string, received_at timestamp, line_no int, payload string"


def feed(spark, files):
    rows, n = [], 0
    for provider, file, date, records in files:
        for line, record in enumerate(records, 1):
            n += 1
            rows.append((n, provider, file, date, None, line, record if isinstance(record, (str, type(None))) else json.dumps(record)))
    return spark.createDataFrame(rows, FEED)


def changes(spark, files):
    return {(r["file_id"], r["field"], r["change"]) for r in D.drift_report(feed(spark, files)).collect()}


def test_every_kind_of_change(spark):
    first = [{"이름": f"n{i}", "번호": str(i), "수": i, "옛": "x"} for i in range(5)]
    second = [{"title": [f"n{i}"], "번호": i, "수": i, "새": None} for i in range(4)]
    got = changes(spark, [(1, 10, "2020-01-01", first), (1, 11, "2020-02-01", second + second[:1])])
    assert got == {
        (11, "title", "renamed"), (11, "title", "retyped"), (11, "번호", "retyped"), (11, "새", "added"), (11, "옛", "removed"),
    }


def test_order_is_by_file_date_and_late_files_fit_in(spark):
    files = [(1, 2, "2020-03-01", [{"a": 1}]), (1, 1, "2020-01-01", [{"a": 1}]), (1, 9, "2020-02-01", [{"a": 1, "b": 2}]), (2, 5, "2019-01-01", [{"z": 1}])]
    assert changes(spark, files) == {(9, "b", "added"), (2, "b", "removed")}


def test_null_values_make_a_field_but_no_type(spark):
    files = [(1, 1, "2020-01-01", [{"a": None}]), (1, 2, "2020-02-01", [{"a": 1}]), (1, 3, "2020-03-01", [{"a": "1"}])]
    assert changes(spark, files) == {(3, "a", "retyped")}


def test_bad_lines_leave_a_file_without_fields(spark):
    files = [(1, 1, "2020-01-01", [{"a": 1}]), (1, 2, "2020-02-01", [None, "{", "[1]"]), (1, 3, "2020-03-01", [{"a": 1}])]
    assert changes(spark, files) == {(2, "a", "removed"), (3, "a", "added")}


def test_each_field_is_renamed_once_and_to_the_best(spark):
    old = [{"x": f"v{i}", "y": f"w{i}"} for i in range(6)]
    new = [{"p": f"v{i}", "q": f"w{i}", "r": f"v{i}" if i < 2 else "other"} for i in range(6)]
    got = changes(spark, [(1, 1, "2020-01-01", old), (1, 2, "2020-02-01", new)])
    assert got == {(2, "p", "renamed"), (2, "q", "renamed"), (2, "r", "added")}


def test_unified_table_keeps_every_record(spark):
    a = [{"별표명": f"이름{i}", "별표번호": str(i), "비고": "x"} for i in range(4)]
    b = [{"명칭": [f"이름{i}"], "별표번호": str(i)} for i in range(4)]
    table = feed(spark, [(1, 1, "2020-01-01", a), (1, 2, "2020-02-01", b), (1, 3, "2020-03-01", [None])])
    _, renames = D.matched(table)
    rows = D.unified_table(table, D.canonical_names(renames)).orderBy("feed_row_id").collect()
    assert [r["별표명"] for r in rows] == [f"이름{i}" for i in range(4)] * 2 + [None]
    assert rows[0]["other"] == {"비고": "x"}


def test_empty_table(spark):
    assert changes(spark, []) == set()


def test_scores_converge_and_prefer_shared_values():
    pair = {"types_a": ["string"], "types_b": ["string"], "n_old": 4, "n_new": 4}
    scores = D.flood([pair | {"old_field": "a", "new_field": "b", "n_both": 4}, pair | {"old_field": "a", "new_field": "c", "n_both": 0}])
    assert scores[0] > scores[1]


def test_unified_table_applies_renames_of_further_fields_and_keeps_every_value(spark):
    rows = [{"담당부서": "가", "비고": None}, {"소관부서": "나"}, {"담당부서": "다", "소관부서": "라"}, {"별표명": "마", "명칭": "바", "담당부서": None, "소관부서": "사"}]
    names = spark.createDataFrame([("소관부서", "담당부서"), ("담당부서", "담당부서"), ("명칭", "별표명")], "field string, canonical string")
    got = D.unified_table(feed(spark, [(1, 1, "2020-01-01", rows)]), names).orderBy("feed_row_id").collect()
    assert [r["other"] for r in got] == [{"담당부서": "가", "비고": None}, {"담당부서": "나"}, {"담당부서": "다"}, {"담당부서": "사"}]
    assert [r["more"] for r in got] == [{}, {}, {"담당부서": ["라"]}, {"별표명": ["마"]}]
    assert sorted(x for x in (got[3]["별표명"], *got[3]["more"]["별표명"])) == ["마", "바"]


def test_wide_files_are_flooded_in_little_memory():
    import tracemalloc

    pairs = [
        {"old_field": f"가{a}", "new_field": f"나{b}", "types_a": ["string"], "types_b": ["string"], "inner_a": [], "inner_b": [], "n_old": 5, "n_new": 5, "n_both": 5 * (a == b)}
        for a in range(100) for b in range(100)
    ]
    tracemalloc.start()
    found = D._consistent(pairs)
    peak = tracemalloc.get_traced_memory()[1]
    assert {(a[1:], b[1:]) for a, b, _ in found} == {(str(k), str(k)) for k in range(100)}
    assert peak < 9 * 2**30 * len(pairs) / 90_000 / 9  # 300 x 300 fields stay within 1 GB


def test_nested_slots_tell_fields_apart():
    assert D.nested_slots({"a": [{"b": 1}], "c": None}) == {".a", ".a[]", ".a[].b", ".c"}
    pair = {"old_field": "x", "types_a": ["object"], "types_b": ["object"], "inner_a": [".url"], "n_old": 4, "n_new": 4, "n_both": 2}
    same, other = D.flood([{**pair, "new_field": "p", "inner_b": [".url"]}, {**pair, "new_field": "q", "inner_b": [".name"]}])
    assert same > other


def test_names_mean_what_their_provider_means_by_them(spark):
    a = [{"별표명": f"이름{i}", "k": i} for i in range(4)]
    b = [{"명칭": f"이름{i}", "k": i} for i in range(4)]
    c = [{"서식명": f"서식{i}", "k": i} for i in range(4)]
    d = [{"명칭": f"서식{i}", "k": i} for i in range(4)]
    table = feed(spark, [(1, 1, "2020-01-01", a), (1, 2, "2020-02-01", b), (2, 3, "2020-01-01", c), (2, 4, "2020-02-01", d), (3, 5, "2020-01-01", b)])
    _, renames = D.matched(table)
    rows = D.unified_table(table, D.canonical_names(renames)).orderBy("feed_row_id").collect()
    assert [(r["별표명"], r["서식명"]) for r in rows if r["line_no"] == 1] == [("이름0", None)] * 2 + [(None, "서식0")] * 2 + [(None, None)]
    assert rows[-1]["other"]["명칭"] == "이름3"
