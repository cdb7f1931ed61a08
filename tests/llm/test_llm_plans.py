"""Plans of the training-data queries: no Python where it is not allowed, no few-task stage on a scan."""

import re

import pytest
from pyspark.sql import DataFrameWriter

from llm_docs import SF_SMALL
from framelake.llm.queries import QUERIES


@pytest.mark.parametrize("name", ["op4_exact_dedup", "op10_url_filter", "op6_quality_classifier"])
def test_plans_of_all_written_tables(spark, monkeypatch, name):
    """Every table that the query writes on its way, and its result: a Coalesce would end the scan below it in a few tasks."""
    plans, write = [], DataFrameWriter.parquet

    def parquet(self, path, *a, **k):
        plans.append(self._df._jdf.queryExecution().executedPlan().toString())
        return write(self, path, *a, **k)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    out = QUERIES[name](spark, SF_SMALL)
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert len(plans) > 1
    for plan in plans:
        assert not re.search(r"\bCoalesce \d", plan), plan
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan
        if name != "op6_quality_classifier":
            assert not re.search("Python|Pandas|Arrow", plan), plan
