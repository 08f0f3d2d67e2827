"""Every named query has a SQL twin; those without iteration are run beside it here.

``tests/compare.py`` runs all of them, at any scale.
"""

import pytest

import __spark_entry__ as entry
from tests.compare import compare, duck
from txgraph.oracle import ORACLE
from txgraph.queries import QUERIES as OWN

SF = "/root/testdata/sf0.001"
ITERATIVE = {
    "components_hourly",
    "pagerank_hourly",
    "pagerank_daily_fixed",
    "betweenness_hourly",
    "betweenness_daily",
    "pagerank_daily",
    "graph_features_hourly",
    "online_parity",
    "labels_daily",
    "rings_daily",
    "rings_weekly_top",
    "ring_members",
    "rings_distinct",
    "ring_documents",
    "account_rings",
    "rings_busiest_hour",
    "ring_spike",
    "narratives",
}
QUERIES = {name: fn for name, fn in entry.queries().items() if name in OWN}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_a_twin():
    assert set(ORACLE) == set(OWN)


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 1000


@pytest.mark.parametrize("name", sorted(set(QUERIES) - ITERATIVE))
def test_query_equals_sql(spark, con, name):
    info = compare(spark, name, QUERIES[name], entry.oracle_sql()[name], SF, con)
    assert info["ok"], info


def test_scan_reads_only_needed_columns(spark):
    plan = QUERIES["freq_by_channel"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<props:string>" in plan
