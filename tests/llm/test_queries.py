import pytest

from statuta.llm import queries
from tests.support import DATA, check, needs_data

FOUND = {
    "p1_found": ["unit_id"], "p4_found": ["unit_id"], "p5_found": ["group_id", "field", "unit_id"], "p6_ids": ["doc_id", "ids"],
    "p7_found": ["doc_id", "item_id"], "p8_found": ["doc_id", "lang"],
}


@needs_data
@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_its_sql(spark, name):
    check(spark, queries.QUERIES[name], queries.SQL[name])


@needs_data
@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_query_without_sql_runs(spark, name):
    frame = queries.QUERIES[name](spark, DATA)
    assert frame.count() > 0 and frame.columns == FOUND.get(name, frame.columns)
