"""Derived fixture tables built from the driver's Parquet tables (see FIXTURES.md).

Each function reads whole tables and derives the stand-in for a pipeline table
with DataFrame code; the SQL twins live in ``framelake.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from framelake.operators.sequence import number_within
from framelake.schemas import METRIC_NAME_MAP

# --- fixed values of the fixtures (mirror FIXTURES.md) ------------------------
FILE_SUFFIXES = ["mp4", "MOV", "avi", "txt", "mkv"]
FRAMES_OUT_DIR = "/frames"
FIXTURE_STRIDE = 30
FRAME_BOXES = 8  # lineitems of one frame; a larger order has several frames
MODELS = 50
UNFINISHED_MODEL, UNMEASURED_MODEL, UNREGISTERED_MODEL = 47, 48, 49
# -----------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def files_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file listing with mixed-case and unsupported suffixes (SRC-1)."""
    docs = table(spark, sf_dir, "documents")
    suffix = F.element_at(F.array(*[F.lit(s) for s in FILE_SUFFIXES]), (F.col("doc_id") % 5 + 1).cast("int"))
    return docs.select(F.col("doc_id"), F.format_string("/raw/%s/clip.%d.%s", "source", "doc_id", suffix).alias("path"))


def decoded_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every decoded frame of every 'video' (a user's events, in time order)."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    numbered = number_within(ev, ["user_id"], ["ts", "event_id"], out="rn", first=["ts"])
    return numbered.select(
        F.format_string("user_%d", "user_id").alias("video_id"),
        (F.col("rn") - 1).alias("frame_number"),
        (F.expr("timestampdiff(MICROSECOND, first_ts, ts)") / 1000.0).alias("pos_ms"),
        F.lit(1920).alias("width"),
        F.lit(1080).alias("height"),
    )


def frames_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampled frames at stride 30 (manifest columns)."""
    from framelake.operators.frames import sample_frames

    return sample_frames(decoded_fx(spark, sf_dir), FIXTURE_STRIDE, FRAMES_OUT_DIR)


def scored_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of frames_fx already scored."""
    return frames_fx(spark, sf_dir).filter(F.col("timestamp_ms") % 3 == 0).select("frame_id")


def _box_struct() -> F.Column:
    return F.struct(
        F.col("l_linenumber").cast("float").alias("x1"),
        F.col("l_quantity").cast("float").alias("y1"),
        (F.col("l_linenumber") + 10).cast("float").alias("x2"),
        (F.col("l_quantity") + 20).cast("float").alias("y2"),
        (F.col("l_discount") * 10).cast("float").alias("conf"),
        (F.col("l_suppkey") % 3).cast("int").alias("cls"),
    )


def detections_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested detections of every order: all its lineitems, ``FRAME_BOXES`` to a frame.

    Lineitems are numbered inside their order (skew-safe) and every ``FRAME_BOXES``-th
    starts a new frame, so arrays are bounded and no lineitem is left out. An order without
    lineitems has one frame with NULL boxes.
    """
    from framelake.functions.boxes import sort_boxes

    li = table(spark, sf_dir, "lineitem")
    box = ["x1", "y1", "x2", "y2", "conf", "cls"]
    b = li.select(F.col("l_orderkey").alias("k"), _box_struct().alias("b")).select("k", "b.*")
    numbered = number_within(b, ["k"], [F.col("conf").desc(), *box[:4], "cls"])
    frame = F.floor((F.col("rn") - 1) / FRAME_BOXES).cast("int")
    per_frame = numbered.groupBy("k", frame.alias("f")).agg(F.collect_list(F.struct(*box)).alias("bx"))
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"), F.col("o_custkey"), F.col("o_orderdate").alias("inferred_at")
    )
    j = orders.join(per_frame, "k", "left")
    return j.select(
        F.format_string("order_%d__%06d", "k", F.coalesce("f", F.lit(0))).alias("frame_id"),
        F.format_string("cust_%d", "o_custkey").alias("video_id"),
        F.col("inferred_at"),
        sort_boxes("bx").alias("boxes"),
    )


def _map50_raw() -> F.Column:
    k = F.col("o_orderkey")
    digits = F.lpad(((k * 7919 + F.col("o_custkey")) % 100000).cast("string"), 5, "0")
    return (
        F.when((k % 7 == 0) | (F.col("o_custkey") % MODELS == UNMEASURED_MODEL), F.lit(None).cast("string"))
        .when(k % 11 == 0, F.lit("n/a"))
        .otherwise(F.concat(F.lit("0."), digits))
    )


def raw_results_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training runs with their raw result dictionaries (string values, some missing)."""
    o = table(spark, sf_dir, "orders")
    model = F.col("o_custkey") % MODELS
    status = (
        F.when(model == UNFINISHED_MODEL, "FAILED")
        .when(F.col("o_orderstatus") == "F", "FINISHED").when(F.col("o_orderstatus") == "O", "RUNNING").otherwise("FAILED")
    )
    precision = F.concat(F.lit("0."), F.lpad((F.col("o_custkey") % 1000).cast("string"), 3, "0"))
    # A missing result key is absent from the map (not a NULL value).
    empty = F.create_map().cast("map<string,string>")
    map50 = _map50_raw()
    raw = F.map_concat(
        F.when(map50.isNotNull(), F.create_map(F.lit("metrics/mAP50(B)"), map50)).otherwise(empty),
        F.create_map(F.lit("metrics/precision(B)"), precision, F.lit("fitness"), F.col("o_orderpriority")),
    )
    return o.select(
        F.format_string("det_%d", F.col("o_custkey") % MODELS).alias("name"),
        F.col("o_orderkey").alias("run_id"),
        status.alias("status"),
        F.col("o_orderdate").alias("start_time"),
        raw.alias("results"),
    )


def runs_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs table: clean metrics map (SCL-8) and tags."""
    from framelake.operators.registry import clean_metrics

    r = raw_results_fx(spark, sf_dir)
    return r.select(
        "name",
        "run_id",
        "status",
        "start_time",
        F.create_map(F.lit("epochs"), F.lit("50")).alias("params"),
        F.create_map(F.lit("source"), F.lit("fixture")).alias("tags"),
        clean_metrics("results", METRIC_NAME_MAP).alias("metrics"),
    )


def versions_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered versions: one run may have several, some none, one model has none at all; version is text.

    Lineitem keys are de-duplicated before the join (orders is unique on its key),
    so the join and the string building see each version once.
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").filter(F.col("o_custkey") % MODELS != UNREGISTERED_MODEL)
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.select(
        F.format_string("det_%d", F.col("o_custkey") % MODELS).alias("name"),
        F.col("l_orderkey").alias("run_id"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string").alias("version"),
    )


def aliases_fx(spark: SparkSession, sf_dir: str, versions: DataFrame | None = None) -> DataFrame:
    """Present champions: none for m % 5 = 0; a run without the metric for m % 5 = 1;
    else the run ranked 2 + m % 7. ``versions`` may be given as a written table."""
    from framelake.operators.registry import newest_versions

    m, map50 = F.substring("name", 5, 10).cast("int"), F.element_at("metrics", F.lit("mAP50"))
    runs = runs_fx(spark, sf_dir).filter(F.col("status") == "FINISHED").select("name", "run_id", map50.alias("map50"), m.alias("m"))
    runs = runs.filter((F.col("m") % 5 > 1) | ((F.col("m") % 5 == 1) & F.col("map50").isNull()))
    r = runs.join(newest_versions(versions or versions_fx(spark, sf_dir)), ["name", "run_id"])
    # A group limit: a task passes on no more than the first 8 runs of a model, so no model is gathered whole.
    w = Window.partitionBy("name").orderBy(F.col("map50").desc_nulls_last(), F.col("run_id").asc())
    ranked = r.withColumn("rk", F.row_number().over(w)).filter(F.col("rk") <= 8)
    wanted = F.when(F.col("m") % 5 == 1, 1).otherwise(F.col("m") % 7 + 2)
    return ranked.filter(F.col("rk") == wanted).select(
        "name", F.lit("champion").alias("alias"), F.col("version").cast("string").alias("version")
    )


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings")


__all__ = [
    "table", "files_fx", "decoded_fx", "frames_fx", "scored_fx", "detections_fx",
    "raw_results_fx", "runs_fx", "versions_fx", "aliases_fx", "embeddings",
]
