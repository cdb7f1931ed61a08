"""Invariants on random small inputs (hypothesis, few examples: each runs Spark jobs)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from framelake.operators.scoring import unscored
from framelake.operators.sequence import number_within
from framelake.sinks.store import merge_result

SCHEMA = "frame_id string, video_id string, width int"
keys = st.integers(min_value=0, max_value=30).map(lambda i: f"f{i}")
rows = st.lists(st.tuples(keys, st.sampled_from(["a", "b"]), st.integers(0, 5)), max_size=25, unique_by=lambda r: r[0])
SET = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SET
@given(target=rows, source=rows)
def test_upsert_applied_twice_equals_once(spark, target, source):
    t = spark.createDataFrame(target, SCHEMA)
    s = spark.createDataFrame(source, SCHEMA)
    once = merge_result(t, s, ["frame_id"])
    twice = merge_result(once, s, ["frame_id"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    got = {r[0]: tuple(r) for r in once.collect()}
    want = {r[0]: r for r in target}
    want.update({r[0]: r for r in source})
    assert got == want


@SET
@given(frames=rows, scored=st.lists(keys, max_size=20))
def test_unscored_and_scored_partition_the_frames(spark, frames, scored):
    f = spark.createDataFrame(frames, SCHEMA)
    s = spark.createDataFrame([(k,) for k in scored], "frame_id string")
    todo = {r["frame_id"] for r in unscored(f, s).collect()}
    done = {r["frame_id"] for r in f.join(s.distinct(), "frame_id", "left_semi").collect()}
    assert todo.isdisjoint(done) and todo | done == {r[0] for r in frames}


@SET
@given(values=st.lists(st.tuples(st.sampled_from(["hot", "hot", "hot", "x", "y"]), st.integers(0, 1000)), min_size=1, max_size=60))
def test_numbering_is_a_permutation_per_group(spark, values):
    df = spark.createDataFrame([(i, g, v) for i, (g, v) in enumerate(values)], "id long, g string, v long")
    out = number_within(df, ["g"], ["v", "id"], out="rn", partitions=5)
    per = out.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.min("rn").alias("lo"), F.max("rn").alias("hi"),
                               F.count_distinct("rn").alias("d")).collect()
    for r in per:
        assert (r["lo"], r["hi"], r["d"]) == (1, r["n"], r["n"])
