import pytest
from oracle import same

from barstead.plans import basics, files, pipelines  # noqa: F401
from barstead.plans.book import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, name):
    same(spark, QUERIES[name], ORACLE_SQL[name], SF)


def test_entry_has_every_query(spark):
    import __spark_entry__ as e

    assert set(QUERIES) <= set(e.queries())
    assert e.entry(spark).count() > 0
