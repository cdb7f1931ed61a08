"""Ranks and distances from histograms equal those of the sorted values, and no query sorts all values."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from framelake.operators import histogram as hg
from framelake.operators import monitor
from framelake.operators import sequence

DAY = datetime(2024, 1, 1)
COUNTS = "window_start timestamp_ntz, column_name string, value double, c long, cb long"


def _counts(spark, here, base, days=2):
    """Value counts of ``days`` equal windows of ``here``; the baseline stands in a window of its own."""
    rows = {}
    for d in range(days):
        for x in here:
            rows.setdefault((DAY + timedelta(days=9 + d), x), [0, 0])[0] += 1
    for x in base:
        rows.setdefault((DAY, x), [0, 0])[1] += 1
    return spark.createDataFrame([(w, "v", float(x), *n) for (w, x), n in rows.items()], COUNTS)


def sorted_distance(here, base):
    every = np.concatenate([here, base])
    return max(abs(np.searchsorted(np.sort(here), every, "right") / len(here) - np.searchsorted(np.sort(base), every, "right") / len(base)))


def _shapes():
    r = np.random.default_rng(3)
    return {
        "shifted": (r.normal(0, 1, 900), r.normal(0.1, 1, 700)),
        "all but one equal": (np.append(np.zeros(500), 1e9), np.append(np.zeros(300), [1e9, 0.5])),
        "long tail": (np.exp(r.normal(0, 12, 600)), np.exp(r.normal(0.3, 12, 500))),
        "one bin": (1 + r.random(400) * 1e-9, np.concatenate([1 + r.random(300) * 1e-9, [1e6]])),
        "apart": (r.random(50), r.random(60) + 5),
        "equal": (np.arange(40.0), np.arange(40.0)),
        "infinities": (np.array([-np.inf, 1, 2, np.inf, np.inf, 1e308, -1e308]), np.array([-np.inf, -np.inf, 2, 3, 1e308])),
        "whole numbers": (r.integers(0, 9, 800).astype(float), r.integers(0, 8, 700).astype(float)),
    }


@pytest.mark.parametrize("shape", list(_shapes()))
@pytest.mark.parametrize("small", [True, False])
def test_distance_equals_the_sorted_one(spark, shape, small):
    here, base = _shapes()[shape]
    h = hg.Histogram.of(_counts(spark, here, base))
    got = hg.largest_distances(hg.Histogram(h.binned, h.cell, small)).where("window_start > '2024-01-02'").collect()
    assert len(got) == 2 and all(np.isclose(r["ks"], sorted_distance(here, base), atol=1e-12) for r in got)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(allow_nan=False, width=32), min_size=1, max_size=60), st.lists(st.floats(allow_nan=False, width=32), min_size=1, max_size=60))
def test_any_distance_equals_the_sorted_one(spark, here, base):
    here, base = np.array(here) + 0.0, np.array(base) + 0.0
    h = hg.Histogram.of(_counts(spark, here, base, days=1))
    got = hg.largest_distances(h).where("window_start > '2024-01-02'").first()
    assert np.isclose(got["ks"], sorted_distance(here, base), atol=1e-12)


def test_few_bins_are_opened(spark):
    """Bounds keep most bins closed: only these values are read again."""
    r = np.random.default_rng(5)
    h = hg.Histogram.of(_counts(spark, r.normal(0, 1, 20000), r.normal(0.2, 1, 20000), days=1))
    bounds = hg.bounded_distances(h.cell)
    assert bounds.where("high > best").count() < 0.1 * bounds.count()


def test_positions_of_sorted_values(spark):
    r = np.random.default_rng(6)
    values = np.concatenate([r.normal(0, 1, 3000), np.repeat(0.25, 500), [np.nan, np.inf, -np.inf, 1e300]])
    df = spark.createDataFrame([(DAY, "v", float(x)) for x in values], "window_start timestamp_ntz, column_name string, value double")
    h = hg.Histogram.of(df.groupBy(*hg.BY, "value").agg(F.count("*").alias("c"), F.lit(0).cast("long").alias("cb")))
    at = [0, 1, 2, 1000, 1751, 2000, 3000, len(values) - 3, len(values) - 2, len(values) - 1]
    got = hg.values_at(h, hg.BY, "c", {f"p{i}": F.lit(i) for i in at}).first()
    assert np.array_equal([got[f"p{i}"] for i in at], np.sort(values)[at], equal_nan=True)


def test_all_values_distinct_are_never_sorted_as_a_whole(spark, monkeypatch):
    """No range exchange and no sort of the counts, also where hot bins are looked for."""
    monkeypatch.setattr(hg, "fits_one_task", lambda df: False)
    monkeypatch.setattr(sequence, "fits_one_task", lambda df: False)
    n = 30000
    m = spark.range(n).select(F.format_string("f%d", "id").alias("frame_id"), F.lit("v").alias("video_id"),
                              (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.expr("id % 3"))).alias("inferred_at"),
                              F.lit(1).alias("n_detections"), ((F.col("id") * 7919 % n) / n).alias("avg_conf"))
    p = monitor.profile(m)
    rows = {(r["window_start"].day, r["column_name"]): r for r in p.collect()}
    mine = np.sort([(i * 7919 % n) / n for i in range(0, n, 3)])
    assert np.allclose([rows[1, "avg_conf"][q] for q in ("p25", "p50", "p75")], np.quantile(mine, [0.25, 0.5, 0.75]))
    assert rows[1, "avg_conf"]["n_distinct"] == n // 3 and np.isclose(rows[1, "avg_conf"]["stddev"], mine.std(ddof=1))
    d = monitor.drift(m, monitor.baseline(m, 1))
    assert {r["column_name"]: r["baseline_n"] for r in d.collect()} == {"avg_conf": n // 3, "n_detections": n // 3}
    for df in (p, d):
        assert "rangepartitioning" not in df._jdf.queryExecution().executedPlan().toString()


def test_empty_counts(spark):
    h = hg.Histogram.of(spark.createDataFrame([], COUNTS))
    assert hg.largest_distances(h).count() == 0 and hg.values_at(h, hg.BY, "c", {"a": F.lit(0)}).count() == 0
    none = spark.createDataFrame([(DAY, "v", None, 3, 0), (DAY, "w", 1.0, 2, 0)], COUNTS)
    got = {r["column_name"]: r for r in monitor.profile_counts(none).collect()}
    assert (got["v"]["n"], got["v"]["n_null"], got["v"]["p50"], got["v"]["mean"]) == (3, 3, None, None)
    d = monitor.drift_counts(none).collect()
    assert [(r["column_name"], r["n"], r["baseline_n"], r["psi"], r["ks"]) for r in d] == [("w", 2, 0, None, None)]
