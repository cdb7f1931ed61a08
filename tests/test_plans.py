"""Plan-shape regression: the scale review, as assertions over every registered query."""

import re

import pytest

from __spark_entry__ import queries
from framelake.plans.queries import QUERIES
from conftest import SF_SMALL

FORBIDDEN = ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_quadratic_join_or_row_udf(spark, name):
    df = queries()[name](spark, SF_SMALL)
    df.collect()  # the final adaptive plan
    plan = df._jdf.queryExecution().executedPlan().toString()
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op} in plan"
    if name not in ("scored_boxes", "incremental_scoring", "predict_contract", "scoring_failures", "decoded_ranges"):
        assert "MapInPandas" not in plan and "ArrowEvalPython" not in plan, f"{name}: Python outside scoring and decoding"


def test_scans_read_only_needed_columns(spark):
    """The flagship reads 3 of 6 orders columns and 5 of 11 lineitem columns."""
    df = queries()["detections_metrics"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    widths = sorted(len(s.split(",")) for s in schemas)
    assert widths and max(widths) <= 5, widths


@pytest.mark.parametrize("name", ["promotion_gate", "decision_tags", "alias_moves"])
def test_promotion_reads_each_table_once(spark, name):
    """Runs and versions once, the aliases twice (lookup and rows); what follows is grouping, not a chain of joins."""
    df = queries()[name](spark, SF_SMALL)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") <= 4, plan
    assert sum(plan.count(j) for j in ("SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin")) <= 1
