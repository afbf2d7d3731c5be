"""Every registered query against its SQL, and the driver contract."""

import pytest

import __spark_entry__ as contract
from conftest import SF_DIR
from workload.bound import Bound
from workload.catalog import QUERIES
from workload.compare import connect, differences


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.fixture(scope="module")
def bound(spark):
    """One set of tables for all queries, so that stored dimensions are computed once."""
    return Bound(spark, SF_DIR)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(bound, con, name):
    build, oracle = QUERIES[name]
    df = build(bound)
    if oracle is None:
        assert df.count() > 0
    else:
        assert differences(df, con, oracle) == []


@pytest.mark.parametrize("name", ["stg_05_canonical_names", "jn_02_validity_join", "fct_02_waste", "dg_03_mapping_backlog"])
def test_queries_hold_when_no_table_may_be_broadcast(spark, con, name):
    settings = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {setting: spark.conf.get(setting) for setting in settings}
    for setting in settings:
        spark.conf.set(setting, "-1")
    try:
        build, oracle = QUERIES[name]
        df = build(Bound(spark, SF_DIR))
        assert differences(df, con, oracle) == []
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "CartesianProduct" not in plan and "BroadcastHashJoin" not in plan
    finally:
        for setting, value in before.items():
            spark.conf.set(setting, value)


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).columns == [
        "store_location", "ingredient_name", "waste_usd", "avg_waste_rate_pct", "max_waste_rate_pct",
    ]
