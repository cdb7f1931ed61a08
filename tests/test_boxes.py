"""Nested box expressions and their traps (ARR-1..ARR-9)."""

import itertools
import random

from pyspark.sql import functions as F

from framelake.functions import boxes as bx
from framelake.schemas import BOXES_DDL


def _frames(spark, frames):
    return spark.createDataFrame(frames, f"frame_id string, boxes {BOXES_DDL}")


def test_counts_and_means_null_and_empty(spark):
    df = _frames(spark, [("a", None), ("b", []), ("c", [(0.0, 0.0, 1.0, 1.0, 0.9, 0), (0.0, 0.0, 1.0, 1.0, 0.7, 1)])])
    out = {r["frame_id"]: r for r in df.select(
        "frame_id", bx.n_detections("boxes").alias("n"), bx.avg_conf("boxes").alias("m"),
        bx.avg_conf_or_null("boxes", 3).alias("s")).collect()}
    assert (out["a"]["n"], out["a"]["m"], out["a"]["s"]) == (0, 0.0, None)
    assert (out["b"]["n"], out["b"]["m"], out["b"]["s"]) == (0, 0.0, None)
    # FLOAT stored, DOUBLE summed: 0.9f and 0.7f average to 0.7999999821186066
    assert out["c"]["n"] == 2 and out["c"]["m"] == 0.7999999821186066 and out["c"]["s"] == 0.8


def test_n_detections_same_with_ansi_off(spark):
    df = _frames(spark, [("a", None)])
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert df.select(bx.n_detections("boxes")).first()[0] == 0
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def _iou(a, b):
    w = max(0.0, min(a[2], b[2]) - max(a[0], b[0]))
    h = max(0.0, min(a[3], b[3]) - max(a[1], b[1]))
    inter = w * h
    union = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - inter
    return inter, union


def _greedy(boxes, t):
    order = sorted(boxes, key=lambda b: (-b[4], b[0], b[1], b[2], b[3], b[5]))
    kept = []
    for b in order:
        if not any(k[5] == b[5] and _iou(k, b)[0] > t * _iou(k, b)[1] for k in kept):
            kept.append(b)
    return kept


def test_nms_equals_greedy_reference_and_invariants(spark):
    rnd = random.Random(11)
    frames = []
    for f in range(40):
        bs = []
        for _ in range(rnd.randint(0, 12)):
            x, y = float(rnd.randint(0, 20)), float(rnd.randint(0, 20))
            bs.append((x, y, x + rnd.randint(1, 10), y + rnd.randint(1, 10), rnd.randint(0, 10) / 8, rnd.randint(0, 2)))
        frames.append((f"f{f}", bs))
    df = _frames(spark, frames)
    got = {r["frame_id"]: [tuple(b) for b in r["k"]] for r in df.select("frame_id", bx.nms("boxes", 0.45).alias("k")).collect()}
    for fid, bs in frames:
        want = _greedy(bs, 0.45)
        assert got[fid] == [tuple(b) for b in want]
        assert set(got[fid]) <= set(bs)
        for a, b in itertools.combinations(got[fid], 2):
            if a[5] == b[5]:
                inter, union = _iou(a, b)
                assert not inter > 0.45 * union


def test_threshold_top_and_parallel_arrays(spark):
    df = _frames(spark, [("a", [(0.0, 0.0, 1.0, 1.0, 0.2, 0), (0.0, 0.0, 1.0, 1.0, 0.5, 1), (2.0, 2.0, 3.0, 3.0, 0.25, 2)])])
    r = df.select(bx.keep_conf("boxes", 0.25).alias("k"), bx.top("boxes", 2).alias("t"),
                  bx.confs("boxes").alias("c"), bx.classes("boxes").alias("k2")).first()
    assert [b["cls"] for b in r["k"]] == [1, 2]
    assert [b["cls"] for b in r["t"]] == [1, 2]
    assert r["k2"] == [0, 1, 2] and len(r["c"]) == 3


def test_contract_counts_invalid_boxes(spark):
    from framelake.operators.contracts import box_contract

    df = _frames(spark, [("a", [(0.0, 0.0, 1.0, 1.0, 1.5, 0), (2.0, 0.0, 1.0, 1.0, 0.5, 1), (0.0, 0.0, 1.0, 1.0, 0.5, None)]),
                         ("b", None)])
    r = box_contract(df).first()
    assert (r["n_frames"], r["n_null_frames"], r["n_boxes"], r["n_invalid_boxes"], r["schema_ok"]) == (2, 1, 3, 3, True)
    wrong = df.select("frame_id", F.transform("boxes", lambda b: F.struct(b["x1"].alias("x1"))).alias("boxes"))
    assert box_contract(wrong).first()["schema_ok"] is False


def test_an_order_of_1000_boxes_loses_none_before_the_cap(spark):
    """Suppression sees every box; only the last step caps."""
    from pyspark.sql import functions as F

    from framelake.functions import boxes as bx
    from framelake.schemas import BOXES_DDL

    rows = [("f", [(float(3 * i), 0.0, float(3 * i + 1), 1.0, 0.3 + (i % 7) / 10, 0) for i in range(1000)]), ("empty", []), ("none", None)]
    df = spark.createDataFrame(rows, f"frame_id string, boxes {BOXES_DDL}")
    out = df.select("frame_id", F.size(bx.nms(bx.keep_conf("boxes", 0.25), 0.45)).alias("kept"),
                    F.size(bx.detector_postprocess("boxes", 0.25, 0.45, 300)).alias("capped"))
    got = {r["frame_id"]: (r["kept"], r["capped"]) for r in out.collect()}
    assert got["f"] == (1000, 300) and got["empty"] == (0, 0)
    flat = bx.flatten(df, "boxes", ["frame_id"])
    assert flat.count() == 1002 and flat.filter("pos is null").count() == 2
