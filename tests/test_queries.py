"""Registered queries against their SQL twins at the smallest scale."""

import pytest

import __spark_entry__ as entry
from oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    ok, message = compare(spark, con, FOLDER, entry.queries()[name], ORACLES[name])
    assert ok, message


def test_no_cross_joins(spark):
    """Representative plans hold no product of two tables."""
    for name in ("vector_topk", "two_stage_retrieve", "rank_techniques", "sample_negatives", "drift_psi", "refute_placebo",
                 "relevant_documents", "context_precision", "context_recall", "vector_index", "sparse_bounded"):
        plan = entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan, name


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["Label", "verdict", "flows", "total_bytes"] and df.count() > 0
