import pytest

from tracewell.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_gives_the_rows_of_its_sql(name, spark, sf_dir, oracle, same_rows):
    df = QUERIES[name](spark, sf_dir)
    names, rows = oracle(ORACLES[name])
    same_rows(df.select(*names), (names, rows))


def test_a_query_for_each_operator():
    assert [n.split("_")[0] for n in sorted(QUERIES, key=lambda n: int(n[2:].split("_")[0]))] == [f"op{i}" for i in range(1, 11)]
