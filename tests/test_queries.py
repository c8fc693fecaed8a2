import pytest

from statuta.plans import catalog
from tests.support import DATA, check, needs_data


@needs_data
@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_equals_its_sql(spark, name):
    check(spark, catalog.QUERIES[name], catalog.SQL[name])


@needs_data
@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.SQL)))
def test_query_without_sql_runs(spark, name):
    assert catalog.QUERIES[name](spark, DATA).count() > 0


@needs_data
def test_flagship(spark):
    assert catalog.flagship(spark, DATA).columns[:3] == ["qid", "rank", "faiss_id"]


def test_every_sql_has_a_query():
    assert set(catalog.SQL) <= set(catalog.QUERIES)
