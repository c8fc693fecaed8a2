import json

from pyspark.sql import functions as F

from statuta.operators import nested as N

NODES = "raw_id long, payload string"


def paths(payload):
    return [r[0] for r in N.nodes_of(payload if isinstance(payload, (str, type(None))) else json.dumps(payload))]


def test_all_article_wrappings_give_the_same_nodes():
    arts = [{"조문번호": "1", "항": [{"항번호": "①"}, "text"]}, {"조문번호": "2"}]
    shapes = [arts, [{"조문단위": arts}], {"조문단위": arts}, {"조문": arts}, [[arts[0]], {"조문단위": arts[1]}]]
    results = [paths({"법령": {"조문": s}}) for s in shapes]
    assert all(r == results[0] for r in results)
    assert set(results[0]) == {"법령/조:1", "법령/조:2", "법령/조:1/항:1", "법령/조:1/항:2"}


def test_nothing_takes_no_position():
    law = {"법령": {"조문": [None, "", {}, [], " ", {"조문번호": "1"}, "bare"], "부칙": {"부칙단위": {"부칙내용": "x"}}}}
    assert set(paths(law)) == {"법령/조:1", "법령/조:2", "법령/부칙:1"}


def test_links_items_and_both_kinds_under_a_paragraph():
    law = {
        "법령": {
            "조문": {"항": {"호": [{"목": "가"}, "나"], "목": {"목내용": "x"}}, "별표": {"별표서식PDF파일링크": ["/a", None, {"링크": "/b"}]}},
            "별표목록": [{"별표서식PDF파일링크": "/c"}],
        }
    }
    assert set(paths(law)) == {
        "법령/조:1", "법령/조:1/항:1", "법령/조:1/항:1/호:1", "법령/조:1/항:1/호:2", "법령/조:1/항:1/호:1/목:1", "법령/조:1/항:1/목:1",
        "법령/조:1/별표:1", "법령/조:1/별표:1/링크:1", "법령/조:1/별표:1/링크:2", "법령/별표:1", "법령/별표:1/링크:1",
    }


def test_laws_as_list_as_text_and_without_wrapper():
    law = {"조문": [{"조문번호": "1"}]}
    assert paths({"법령": [law, {"조문": []}]}) == paths({"법령": json.dumps(law)}) == paths(law) == ["법령/조:1"]


def test_payloads_without_a_law():
    for payload in (None, "", "{", "[]", "3", '"x"', '{"결과": "없음"}', '{"법령": null}', '{"법령": {}}', '{"법령": []}', '{"법령": "{"}', "[" * 100_000):
        assert paths(payload) == []


def test_states_are_built_bottom_up():
    assert N.state_of({"b": [1, "x", None], "a": {"c": " "}}) == "{b:[number|text]}"
    assert N.state_of([[], {}]) is None
    assert N.state_of(True) == "flag"


def test_tables_subtypes_and_links_to_parents(spark):
    law = {"법령": {"조문": [{"조문번호": 3, "조문제목": "정의", "조문내용": ["가", "나"]}], "별표": {"별표번호": 4, "별표명": "기준", "별표서식PDF파일링크": {"링크": "/x", "쪽수": 2}}}}
    raw = spark.createDataFrame([(1, json.dumps(law)), (1, json.dumps(law)), (2, None)], NODES).withColumn("kind", F.lit("clash"))
    nodes = N.flatten_documents(raw).cache()
    assert nodes.count() == 6
    arts = N.subtype_table(nodes, "조").distinct().collect()
    assert [(r["article_no"], r["title"], r["content"]) for r in arts] == [("3", "정의", "가\n나")]
    links = N.subtype_table(nodes, "링크").join(N.subtype_table(nodes, "별표").select("raw_id", F.col("node_path").alias("parent_path")), ["raw_id", "parent_path"])
    assert {(r["url"], r["pages"]) for r in links.collect()} == {("/x", 2)}
    assert N.variant_counts(nodes).agg(F.sum("records")).first()[0] == 6


def test_empty_table_and_very_long_text(spark):
    assert N.flatten_documents(spark.createDataFrame([], NODES)).count() == 0
    law = json.dumps({"법령": {"조문": [{"조문내용": "가" * 300_000}]}})
    assert N.flatten_documents(spark.createDataFrame([(1, law)], NODES)).count() == 1


def test_kind_and_subtype_tables_hold_every_record_once_and_parents_resolve(spark):
    from statuta.plans.restructuring import QUERIES
    from tests.support import DATA

    raw = spark.read.parquet(f"{DATA}/raw_laws.parquet")
    nodes = N.flatten_documents(raw).cache()
    total = 0
    laws = N.law_table(raw).select("raw_id", "node_path")
    tables = {kind: N.subtype_table(nodes, kind) for kind in N.KINDS}
    parents = laws
    for frame in tables.values():
        parents = parents.unionByName(frame.select("raw_id", "node_path"))
    for kind, frame in tables.items():
        count = frame.count()
        total += count
        assert sum(N.subtype_table(nodes, kind, route=r).count() for r in N.SUBTYPES[kind]) == count
    assert total == nodes.count() == QUERIES["p2_found"](spark, DATA).count()
    keys = parents.withColumnRenamed("node_path", "parent_path")
    assert nodes.join(keys, ["raw_id", "parent_path"], "left_anti").count() == 0


def test_the_root_keeps_the_laws_facts(spark):
    law = {"법령": {"기본정보": {"법령명_한글": "갑법", "시행일자": "20200101", "연락부서": {"전화": 1}}, "공포일자": "x", "조문": []}}
    rows = N.law_table(spark.createDataFrame([(1, json.dumps(law)), (2, None), (3, "{")], NODES)).collect()
    assert [(r["raw_id"], r["law_name"], str(r["effective"]), r["promulgated"], r["attributes"]) for r in rows] == [(1, "갑법", "2020-01-01", None, '{"연락부서": {"전화": 1}}')]


def test_numbers_are_typed(spark):
    law = {"법령": {"조문": [{"조문번호": "제3조의2", "항": [{"항번호": "②", "호": ["가"]}]}]}}
    nodes = N.flatten_documents(spark.createDataFrame([(1, json.dumps(law))], NODES))
    assert N.subtype_table(nodes, "조").first()["article_num"] == 3
    row = N.subtype_table(nodes, "항").first()
    assert (row["paragraph_num"], row["subtype"]) == (2, "paragraph_branch")
    assert N.subtype_table(nodes, "호", route="item_text").first()["content"] == "가"
