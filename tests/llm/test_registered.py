import pytest

import __spark_entry__ as entry
from tests.compare import compare, duck
from txgraph.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def test_all_are_registered():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in QUERIES if q != "pipeline"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    info = compare(spark, name, QUERIES[name], ORACLE[name], SF, duck(SF))
    assert info["ok"], info
