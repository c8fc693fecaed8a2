
from statuta.plans import catalog, statutes
from tests.support import DATA, needs_data

SEARCHES = sorted(n.removesuffix("_every20") for n in catalog.QUERIES if n.endswith("_every20"))


def test_every_search_has_a_whole_one_and_its_own_sql():
    assert len(SEARCHES) == 14
    for name in SEARCHES:
        assert catalog.SQL[f"{name}_every20"] != catalog.SQL[name]
        assert "990017" not in catalog.SQL[f"{name}_every20"] and "% 20 = 0" in catalog.SQL[f"{name}_every20"]


@needs_data
def test_every_twentieth_unit_asks_and_more_than_the_stated_laws_are_searched(spark):
    asked = statutes._every_20th(spark, DATA)
    ids = {r["unit_id"] for r in spark.read.parquet(f"{DATA}/units.parquet").select("unit_id", "mst").where("mst is not null").collect()}
    assert {r["qid"] for r in asked.collect()} == {i for i in ids if i % 20 == 0}
    answered = {r["qid"] for r in catalog.QUERIES["hybrid_search_every20"](spark, DATA).select("qid").distinct().collect()}
    laws = {r["mst"] for r in asked.collect() if r["qid"] in answered}
    assert answered == {i for i in ids if i % 20 == 0} and len(laws) > 2
