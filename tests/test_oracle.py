"""Every registered query equals its DuckDB twin (rows, names, values)."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from framelake.plans.queries import QUERIES
from oracle_compare import digest, duck
from conftest import SF_SMALL

QUERY_NAMES = sorted(QUERIES)  # the training-data operators have their own tests


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERY_NAMES) <= set(oracle_sql()) <= set(queries())


def test_entry_runs(spark):
    df = entry(spark)
    assert df.columns == ["frame_id", "video_id", "inferred_at", "n_detections", "avg_conf"]
    assert df.count() > 0


@pytest.mark.parametrize("name", QUERY_NAMES)
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    rel = con.sql(oracle_sql()[name])
    drows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(srows) == len(drows)
    sh, slines = digest(srows, df.columns)
    dh, dlines = digest(drows, rel.columns)
    assert sh == dh, (sorted(set(slines) - set(dlines))[:5], sorted(set(dlines) - set(slines))[:5])
