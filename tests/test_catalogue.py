import pytest

import __spark_entry__ as entry
from tracewell.plans import catalogue


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_gives_the_rows_of_its_sql(name, spark, sf_dir, oracle, same_rows):
    same_rows(catalogue.QUERIES[name](spark, sf_dir), oracle(catalogue.ORACLES[name]))


def test_entry_has_rows(spark, sf_dir):
    assert entry.entry(spark).limit(1).count() == 1


def test_every_query_of_the_engine_has_sql():
    assert set(catalogue.QUERIES) == set(catalogue.ORACLES) <= set(entry.queries())
