"""Search and filters without the pairs of a law's units and questions."""

import random

import pytest
from pyspark.sql import functions as F

from statuta.operators import search as S
from statuta.operators import units as U
from statuta.plans import catalog, statutes
from tests.support import DATA, needs_data
from tests.test_search import COLUMNS


def small(spark):
    """Numbered units of three laws with many equal texts, and questions of every pattern."""
    rng = random.Random(5)
    rows = []
    for i in range(150):
        level = rng.choice(["조", "항", "목", "별표", "부칙"])
        jo = f"{rng.randint(1, 4)}" + rng.choice(["", "의2"])
        body = level in ("조", "항", "목")
        rows.append(
            (i, rng.choice(["7", "7", "8", "9"]), level, rng.choice([jo, f" {jo} ", f"제{jo}조"]) if body else None, rng.choice("①②③") if level in ("항", "목") else None,
             f"{rng.randint(1, 3)}." if level == "목" else None, None, f"글 {i % 17}", f"제{jo}조 제{rng.randint(1, 3)}항" if rng.random() < 0.8 else None, None,
             rng.choice([None, "2020-01-01", "2025-01-01", "20250101"]))
        )
    units = U.with_dense_ids(U.normalised(spark.createDataFrame(rows, COLUMNS)))
    asks = ["제2조", "제4조의2 제1항", "제1조 ②항 1호", "②항 1호", "제3항", "2호", "부칙", "제0항", "제3조 제0항", ""]
    questions = [(100 + k, m, q, a) for k, (q, m, a) in enumerate((q, m, a) for q in asks for m in ("7", "8", "0") for a in (None, "2021-01-01"))]
    return units, spark.createDataFrame(questions, "qid int, mst string, query string, as_of string")


def pairs(rows):
    got = [(r["qid"], r["mst"], r["faiss_id"]) for r in rows.select("qid", "mst", "faiss_id").collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_neighbours_in_blocks_equal_all_pairs(spark, monkeypatch):
    units, questions = small(spark)
    index = S.indexed(units)
    rows = S.considered(index, questions).collect()
    want = {}
    for r in sorted(rows, key=lambda r: (r["qid"], r["dist"], r["faiss_id"])):
        want.setdefault(r["qid"], []).append((r["faiss_id"], r["dist"], r["active"], r["matches"], r["exact"]))
    for corpus, asked in ((50_000, 2_048), (11, 3)):
        monkeypatch.setattr(S, "CORPUS_BLOCK", corpus)
        monkeypatch.setattr(S, "QUERY_BLOCK", asked)
        got = {}
        for r in sorted(S.near_units(index, S.asked_about(questions), 6).collect(), key=lambda r: (r["qid"], r["dist"], r["faiss_id"])):
            bits = r["bits"]
            got.setdefault(r["qid"], []).append((r["faiss_id"], r["dist"], bool(bits & S.ACTIVE), (bits & 7).bit_count(), bool(bits & S.EXACT)))
        assert {q: g[:6] for q, g in got.items()} == {q: w[:6] for q, w in want.items()}


def test_pairs_by_key_equal_all_pairs(spark):
    units, questions = small(spark)
    index, asked = S.indexed(units, *S._SHOWN), S.asked_about(questions)
    every = S.considered(index, questions)
    cite = [F.col("c.jo"), F.col("c.hang"), F.col("c.mok")]
    assert pairs(S.exact_pairs(index, asked)) == pairs(every.where("exact"))
    assert pairs(S.strict_pairs(index, asked)) == pairs(every.where("active and matches >= 2"))
    assert pairs(S.lenient_pairs(index, asked, uncited=True)) == pairs(every.where(U.matches_leniently(*cite)))
    given = F.coalesce("c.jo", F.col("c.hang").cast("string"), F.col("c.mok").cast("string")).isNotNull()
    assert pairs(S.lenient_pairs(index, asked)) == pairs(every.where(U.matches_leniently(*cite) & given))


@pytest.mark.parametrize("require_jo", [False, True])
def test_strict_candidates_are_the_neighbours_and_all_strict_matches(spark, require_jo):
    units, questions = small(spark)
    index = S.indexed(units)
    got = {(r["qid"], r["faiss_id"]): r["is_promoted"] for r in S.candidates(index, questions, 1, True, require_jo).where("stage < 2").collect()}
    want, near = {}, {}
    for r in sorted(S.considered(index, questions).collect(), key=lambda r: (r["qid"], r["dist"], r["faiss_id"])):
        near[r["qid"]] = near.get(r["qid"], 0) + 1
        own = (r["jo_norm"] or r["jo"] or "").strip()
        good = r["active"] and r["matches"] >= 2 and not (require_jo and r["c"]["jo"] and own != r["c"]["jo"])
        if good or r["active"] and near[r["qid"]] <= S.OVERFETCH:
            want[r["qid"], r["faiss_id"]] = good
    assert got == want


def no_pairs(*_):
    raise AssertionError("pairs of units and questions were formed")


def forms_no_pairs(spark, name, monkeypatch):
    monkeypatch.setattr(S, "considered", no_pairs)
    return "qid" in catalog.QUERIES[f"{name}_every20"](spark, DATA).columns


@needs_data
def test_hybrid_search_forms_no_pairs(spark, monkeypatch):
    assert forms_no_pairs(spark, "hybrid_search", monkeypatch)


def numbers_no_units(spark, name, monkeypatch):
    def fail(*_):
        raise AssertionError("whole units were laid out and written for ids that the filter doesn't need")

    monkeypatch.setattr(U, "with_dense_ids", fail)
    return "qid" in catalog.QUERIES[f"{name}_every20"](spark, DATA).columns


@needs_data
def test_meta_match_lenient_needs_no_ids(spark, monkeypatch):
    assert numbers_no_units(spark, "meta_match_lenient", monkeypatch)


@needs_data
def test_as_of_filter_needs_no_ids(spark, monkeypatch):
    assert numbers_no_units(spark, "as_of_filter", monkeypatch)


@pytest.mark.parametrize("listed", [50, 400, 2_000_000])
def test_valid_pairs_in_lists_equal_all_pairs(spark, monkeypatch, listed):
    units, questions = small(spark)
    units = S.entries(units, "unit_id", vectors=False).select("unit_id", "mst", "since")
    units = units.unionByName(spark.createDataFrame([(None, "7", 0), (1_000, None, 0), (1_001, "6", 0)], units.schema)).localCheckpoint()
    asked = S.asked_about(questions, vectors=False)
    asks = asked.collect()
    want = [(q["qid"], u["unit_id"]) for u in units.collect() for q in asks if u["mst"] == q["mst"] and u["since"] <= q["until"]]
    for name, value in (("LISTED", listed), ("LISTS", 2), ("ASKED_BLOCK", 3)):
        monkeypatch.setattr(S, name, value)
    got = [(r["qid"], r["unit_id"]) for r in S.valid_pairs(units, asked).collect()]
    assert None in {u for _, u in got} and len(want) < sum(q["mst"] in ("7", "8") for q in asks) * 153
    assert sorted(got, key=str) == sorted(want, key=str)


@needs_data
def test_as_of_filter_of_a_large_law_takes_little_space(spark, tmp_path):
    units = spark.read.parquet(f"{DATA}/units.parquet").crossJoin(spark.range(4).withColumnRenamed("id", "copy"))
    own = {"unit_id": F.col("unit_id") * 4 + F.col("copy"), "mst": F.lit("7"), "title": F.concat(F.lit("글 "), F.col("unit_id"), F.lit("-"), F.col("copy"))}
    units.withColumns(own).drop("copy").write.parquet(f"{tmp_path}/units.parquet")
    date = F.when(F.col("id") % 2 == 0, "2021-01-01")
    asked = spark.range(1_777).select(F.col("id").alias("qid"), F.lit("7").alias("mst"), F.lit("부칙").alias("query"), date.alias("as_of"))
    statutes.as_of_filter(spark, str(tmp_path), asked).write.parquet(f"{tmp_path}/out")
    since = [r[0] for r in spark.read.parquet(f"{tmp_path}/units.parquet").select(U.active_as_of(F.lit("2021-01-01"))).collect()]
    got = spark.read.parquet(f"{tmp_path}/out")
    assert got.count() == got.distinct().count() == 888 * len(since) + 889 * sum(since) > 2_000_000
    assert sum(p.stat().st_size for p in tmp_path.glob("out/*.parquet")) < 0.5 * got.count()


@needs_data
def test_meta_match_all_needs_no_ids(spark, monkeypatch):
    assert numbers_no_units(spark, "meta_match_all", monkeypatch)


@needs_data
def test_meta_match_strict_needs_no_ids(spark, monkeypatch):
    assert numbers_no_units(spark, "meta_match_strict", monkeypatch)


@needs_data
def test_anti_inject_forms_no_pairs(spark, monkeypatch):
    assert forms_no_pairs(spark, "anti_inject", monkeypatch)


@needs_data
def test_rerank_v2_forms_no_pairs(spark, monkeypatch):
    assert forms_no_pairs(spark, "rerank_v2", monkeypatch)


@needs_data
def test_candidate_union_forms_no_pairs(spark, monkeypatch):
    assert forms_no_pairs(spark, "candidate_union", monkeypatch)


@needs_data
def test_seed_select_forms_no_pairs(spark, monkeypatch):
    assert forms_no_pairs(spark, "seed_select", monkeypatch)


@needs_data
def test_ref_semi_join_forms_no_pairs(spark, monkeypatch):
    assert forms_no_pairs(spark, "ref_semi_join", monkeypatch)


@needs_data
def test_priority_rerank_forms_no_pairs(spark, monkeypatch):
    assert forms_no_pairs(spark, "priority_rerank", monkeypatch)


@needs_data
def test_topk_guarantee_forms_no_pairs(spark, monkeypatch):
    assert forms_no_pairs(spark, "topk_guarantee", monkeypatch)
