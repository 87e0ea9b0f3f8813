"""Every registered SQL-expressible query agrees with its DuckDB oracle (sf0.001)."""

import pytest

from conftest import SF001
from oracle_check import compare

import __spark_entry__ as entry

SQL = entry.oracle_sql()

_BUILT: dict = {}


def built(spark, name):
    """The query's DataFrame, made once for all tests: what a query runs while it is built
    (fits, written tables) is most of the time."""
    if name not in _BUILT:
        _BUILT[name] = entry.queries()[name](spark, SF001)
    return _BUILT[name]


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, name):
    df = built(spark, name)
    ok, msg = compare(df, SQL[name], SF001)
    assert ok, msg


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "log_age_in_days" in df.columns and "Reproductive_Status" in df.columns


@pytest.mark.parametrize("name", sorted(SQL))
def test_no_cross_join_in_plan(spark, name):
    plan = built(spark, name)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_scans_read_only_needed_columns(spark):
    plan = entry.queries()["clean_age_days"](spark, SF001)._jdf.queryExecution() \
        .executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint>" in plan
    assert "ReadSchema: struct<p_partkey:bigint>" in plan


PYTHON_STAGES = ("ArrowEvalPython", "BatchEvalPython", "FlatMapCoGroupsInPandas",
                 "FlatMapGroupsInPandas", "MapInPandas")
NEIGHBOUR_QUERIES = {"smote_neighbours", "smote_rows", "smote_class_counts",
                     "knn_predict_embeddings"}


@pytest.mark.parametrize("name", sorted(set(SQL) - NEIGHBOUR_QUERIES))
def test_no_python_stage_outside_neighbour_search(spark, name):
    plan = built(spark, name)._jdf.queryExecution().executedPlan().toString()
    assert not any(p in plan for p in PYTHON_STAGES)


def test_top_k_limits_before_shuffle(spark):
    plan = built(spark, "top_values_by_group")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_no_cross_join_in_knn_chain_plan(spark):
    plan = entry.queries()["staged_model_predict"](spark, SF001)._jdf.queryExecution() \
        .executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
