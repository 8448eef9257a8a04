"""Plan shape: no Cartesian products / nested-loop joins, pruned scans, codegen present."""

from __future__ import annotations

import pytest

from __spark_entry__ import queries

CHECKED = ["flagship_knn_top10", "fu02_z_ensemble", "fu08_candidate_z_fusion", "rt02_bm25_search",
           "rt05_hybrid_search", "ev01_at_k_popularity", "w04_zscore_catalogue", "m10_graph_3hop_top10"]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", CHECKED)
def test_no_cartesian_or_nested_loop(spark, small_dir, name):
    plan = _plan(queries()[name](spark, small_dir))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_scan_prunes_columns(spark, small_dir):
    from rankforge.sources.tables import interactions

    plan = interactions(spark, small_dir)._jdf.queryExecution().executedPlan().toString()
    # lineitem has 11 columns; the ratings need 4 of them.
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int,l_quantity:double>" in plan


def test_whole_stage_codegen_in_scalar_pipeline(spark, small_dir):
    plan = _plan(queries()["fn03_tokenize_keyword"](spark, small_dir))
    assert "WholeStageCodegen" in plan or "*(" in plan
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan
