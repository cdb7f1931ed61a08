"""Skew-safe numbering equals row_number(), for hot groups, NULL keys and many batches."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from framelake.operators.sequence import Key, _find_cuts, _slice_of, number_within, running_total, running_totals


def _data(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        g = "hot" if rnd.random() < 0.4 else (None if rnd.random() < 0.05 else f"g{rnd.randint(0, 40)}")
        rows.append((i, g, rnd.randint(0, 50), float(rnd.randint(0, 5))))
    return spark.createDataFrame(rows, "id long, g string, t int, v double")


@pytest.mark.parametrize("partitions", [1, 7, 31])
def test_matches_window_row_number(spark, partitions):
    df = _data(spark)
    got = number_within(df, ["g"], ["t", "id"], out="rn", first=["t"], partitions=partitions)
    w = Window.partitionBy("g").orderBy("t", "id")
    ref = df.select("id", F.row_number().over(w).alias("rn2"), F.first("t").over(w).alias("f2"))
    bad = got.join(ref, "id").filter((F.col("rn") != F.col("rn2")) | (F.col("first_t") != F.col("f2")))
    assert got.count() == df.count()
    assert bad.count() == 0


def test_descending_order(spark):
    df = _data(spark, n=1500, seed=3)
    got = number_within(df, ["g"], [F.col("v").desc(), F.col("id").asc()], out="rn", partitions=5)
    w = Window.partitionBy("g").orderBy(F.col("v").desc(), F.col("id").asc())
    ref = df.select("id", F.row_number().over(w).alias("rn2"))
    assert got.join(ref, "id").filter(F.col("rn") != F.col("rn2")).count() == 0


def test_single_hot_group_spans_all_slices(spark):
    df = spark.range(0, 5000).withColumn("g", F.lit("only"))
    got = number_within(df, ["g"], ["id"], out="rn", partitions=16)
    row = got.agg(F.min("rn"), F.max("rn"), F.count_distinct("rn"), F.sum((F.col("rn") != F.col("id") + 1).cast("int"))).first()
    assert tuple(row) == (1, 5000, 5000, 0)


def test_empty_input_and_global_numbering(spark):
    empty = spark.range(0).withColumn("g", F.lit("x"))
    assert number_within(empty, ["g"], ["id"], out="rn", partitions=4).count() == 0
    df = spark.range(0, 2000).withColumn("v", (F.col("id") * 7919) % 2000)
    got = number_within(df, [], ["v"], out="rn", partitions=9)
    assert got.filter(F.col("rn") != F.col("v") + 1).count() == 0


@pytest.mark.parametrize("k", [7, 50])
def test_cap_within_matches_window_filter(spark, k):
    from framelake.operators.sequence import cap_within

    df = _data(spark, n=2500, seed=9)  # one hot group, ~40 groups of ~30 rows, a NULL group
    got = cap_within(df, ["g"], ["t", "id"], k, partitions=6)
    w = Window.partitionBy("g").orderBy("t", "id")
    ref = df.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= k).drop("r")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, ref.collect()), key=str)


def test_values_keep_type_and_identity(spark):
    """Large BIGINT beside NULL, NaN and a year-9999 timestamp pass through unchanged, and keys stay apart."""
    rows = [(9007199254740993, float("nan"), "9999-12-31 23:59:59"), (9007199254740992, 1.0, None), (None, None, "1969-01-01 00:00:00"),
            (None, float("nan"), None)]
    df = spark.createDataFrame(rows, "g long, v double, t string").withColumn("t", F.col("t").cast("timestamp"))
    got = number_within(df, ["g"], ["v"], out="rn", first=["t"], partitions=3)
    assert got.schema["g"].dataType == df.schema["g"].dataType
    out = {(r["g"], str(r["v"])): r["rn"] for r in got.select("g", "v", "rn").collect()}
    assert out == {(9007199254740993, "nan"): 1, (9007199254740992, "1.0"): 1, (None, "None"): 1, (None, "nan"): 2}
    assert got.select(F.year("t").alias("y")).filter("y = 9999").count() == 1
    by_nan = number_within(df.withColumn("k", F.nanvl("v", F.lit(float("nan")))), ["k"], ["g", "t"], out="rn", partitions=2)
    assert by_nan.filter(F.isnan("k")).agg(F.max("rn")).first()[0] == 2  # NaN equals NaN


def test_running_total_with_a_narrow_selection(spark):
    df = _data(spark, n=4000, seed=13)
    got = running_total(df, ["g"], ["t", "id"], F.col("t"), "s", partitions=9).select("id", "s")
    w = Window.partitionBy("g").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    ref = df.select("id", F.sum("t").over(w).alias("s2"))
    assert got.join(ref, "id").filter(F.col("s") != F.col("s2")).count() == 0


def test_numbering_without_aqe(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = _data(spark, n=1200, seed=21)
        got = number_within(df, ["g"], ["t", "id"], out="rn", partitions=11)
        w = Window.partitionBy("g").orderBy("t", "id")
        ref = df.select("id", F.row_number().over(w).alias("rn2"))
        assert got.join(ref, "id").filter(F.col("rn") != F.col("rn2")).count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_full_rows_are_exchanged_once(spark):
    """One exchange on (group, slice), no range exchange; the rest of the shuffles are of the correction's counts."""
    df = _data(spark, n=20000, seed=4).withColumn("payload", F.concat(F.lit("row"), "id"))
    plan = _final_plan(number_within(df, ["g"], ["t", "id"], out="rn", partitions=16))
    assert "rangepartitioning" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    exchanges = [line for line in plan.splitlines() if " Exchange hashpartitioning" in line]
    assert sum("_fl_slice" in line and "g#" in line and "_fl_n" not in line for line in exchanges) <= 2
    full = [i for i, line in enumerate(plan.splitlines()) if " Exchange hashpartitioning" in line and "_fl_slice" in line]
    below = plan.splitlines()
    assert sum("payload" in "".join(below[i + 1:i + 4]) for i in full) == 1


def test_groups_without_skew_take_a_plain_window(spark):
    df = spark.range(4000).withColumn("g", F.col("id") % 500)
    plan = _final_plan(number_within(df, ["g"], ["id"], out="rn", partitions=8))
    assert plan.count("Exchange") == 1 and "Broadcast" not in plan


@pytest.mark.parametrize("order", [["v desc nulls first", "id"], ["v desc", "t asc nulls last", "id desc"], ["v", "t desc nulls first", "id"]])
def test_every_direction_cuts_right(spark, order):
    """Nulls, NaN, infinities and ties on both sides of the cuts."""
    rnd = random.Random(5)
    odd = [None, float("nan"), float("inf"), float("-inf"), -0.0, 0.0, 1.5]
    rows = [(i, "hot" if i % 5 else f"g{i % 35}", rnd.choice(odd + [rnd.random()] * 3), rnd.choice([None, rnd.randint(0, 3)])) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, g string, v double, t int")
    got = number_within(df, ["g"], order, out="rn", partitions=12)
    sort = [Key.of(o).sort() for o in order]
    ref = df.select("id", F.row_number().over(Window.partitionBy("g").orderBy(*sort)).alias("rn2"))
    assert got.count() == 3000 and got.join(ref, "id").filter(F.col("rn") != F.col("rn2")).count() == 0


def test_slices_of_a_hot_group_are_even(spark):
    """A group of a third of the rows is dealt to slices near a task's fair share."""
    df = spark.range(60000).withColumn("g", F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")))
    cuts = _find_cuts(df, ["g"], [Key.of("id")], 30)
    assert [r["g"] for r in cuts.collect()] == [-1]
    keyed = df.where("g = -1").withColumn("_fl_cuts", cuts.select("_fl_cuts").scalar())
    sizes = [r["count"] for r in keyed.groupBy(_slice_of([Key.of("id")], 64).alias("s")).count().collect()]
    assert len(sizes) >= 9 and max(sizes) <= 2 * 60000 / 30


def test_strings_timestamps_and_sorted_columns(spark):
    df = _data(spark, n=3000, seed=2).withColumn("s", F.concat(F.lit("é"), F.col("t").cast("string"))).withColumn(
        "at", F.timestamp_seconds(F.col("id") * 977 % 3000))
    got = number_within(df, [], [F.col("s").desc_nulls_last(), F.col("at")], out="rn", first=["id"], partitions=7)
    w = Window.orderBy(F.col("s").desc_nulls_last(), "at")
    ref = df.select("id", F.row_number().over(w).alias("rn2"), F.first("id").over(w).alias("f2"))
    assert got.join(ref, "id").filter((F.col("rn") != F.col("rn2"))).count() == 0
    assert got.select("first_id").distinct().count() == 1


def test_small_tables_are_not_sampled(spark, monkeypatch):
    import framelake.operators.sequence as sq

    monkeypatch.setattr(sq, "_find_cuts", lambda *a: pytest.fail("sampled"))
    assert number_within(spark.range(100), [], ["id"]).count() == 100
