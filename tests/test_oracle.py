"""Every registered query against its DuckDB twin on the smallest scale (exact match)."""

import pytest

import __spark_entry__ as E
from sqlcheck.compare import compare, duckdb_views

SF = "/root/testdata/sf0.001"
QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duckdb_views(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    rows = df.collect()
    if name not in ORACLE:
        assert len(df.columns) > 0
        return
    res = con.execute(ORACLE[name])
    diff = compare(df.columns, rows, [d[0] for d in res.description], res.fetchall())
    assert diff is None, diff


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["AgeGroup", "BloodType", "MedicalCondition", "Medication", "InsuranceProvider",
                          "AvgBillingAmount", "MinBillingAmount", "MaxBillingAmount", "ClaimCount",
                          "ProviderRank"]


def test_every_query_has_an_oracle():
    from carelens.plans.registry import REGISTRY
    assert set(REGISTRY) <= set(ORACLE)
