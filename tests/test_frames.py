"""Listing, decoding, sampling, capping, features (SRC-*, FLT-1/5, AGG-3/5, PRJ-1, JOI-6)."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from framelake.operators import features, frames
from framelake.sources import files


def test_list_videos_filters_and_sorts(spark, tmp_dir):
    for n in ["b.MP4", "a.mov", "c.avi", "d.mkv", "e.txt", ".hidden.mp4", "_tmp.mp4"]:
        with open(os.path.join(tmp_dir, n), "wb") as fh:
            fh.write(b"x")
    os.makedirs(os.path.join(tmp_dir, "sub"))
    with open(os.path.join(tmp_dir, "sub", "z.mp4"), "wb") as fh:
        fh.write(b"x")
    got = [(r["file_name"], r["video_id"]) for r in files.list_videos(spark, tmp_dir).collect()]
    assert got == [("a.mov", "a"), ("b.MP4", "b"), ("c.avi", "c")]
    with pytest.raises(FileNotFoundError):
        files.list_videos(spark, os.path.join(tmp_dir, "missing"))


def _fake_decode(path):
    n = 95 if "long" in path else 31
    for k in range(n):
        yield k, k * 1000.0 / 60.0, 1920, 1080


def test_decode_sample_cap_count(spark, tmp_dir):
    listing = spark.createDataFrame([(f"{tmp_dir}/long.mp4",), (f"{tmp_dir}/short.MOV",)], "path string")
    decoded = files.decode_videos(listing, _fake_decode)
    assert decoded.count() == 126
    sampled = frames.sample_frames(decoded, 30, "/out")
    got = sorted((r["frame_id"], r["timestamp_ms"], r["frame_path"]) for r in sampled.collect())
    assert got[0] == ("long__000000", 0, "/out/long/long__000000.jpg")
    assert [g[0] for g in got] == ["long__000000", "long__000030", "long__000060", "long__000090", "short__000000", "short__000030"]
    assert [g[1] for g in got][:4] == [0, 500, 1000, 1500]
    capped = frames.sample_frames(decoded, 30, "/out", max_frames=2)
    assert sorted(r["frame_id"] for r in capped.collect()) == ["long__000000", "long__000030", "short__000000", "short__000030"]
    counts = {r["video_id"]: r["n_frames"] for r in frames.frames_per_video(sampled).collect()}
    assert counts == {"long": 4, "short": 2, None: 6}
    with pytest.raises(ValueError):
        frames.sample_frames(decoded, 0, "/out")
    # ranked cap on a manifest with gaps
    gappy = sampled.withColumn("frame_number", F.regexp_extract("frame_id", r"__(\d+)$", 1).cast("long"))
    gappy = gappy.filter(F.col("frame_number") != 30)
    kept = sorted(r["frame_id"] for r in frames.cap_per_video(gappy, 2).collect())
    assert kept == ["long__000000", "long__000060", "short__000000"]


def _count(path):
    return 95 if "long" in path else 31


def _decode_range(path, start, end):
    for k in range(start, end):
        yield k, k * 1000.0 / 60.0, 1920, 1080


def test_long_video_split_into_frame_ranges(spark, tmp_dir):
    listing = spark.createDataFrame([(f"{tmp_dir}/long.mp4",), (f"{tmp_dir}/short.MOV",)], "path string")
    whole = files.decode_videos(listing, _fake_decode)
    split = files.decode_videos(listing, _decode_range, frames_per_task=10, count_fn=_count)
    assert sorted(tuple(r) for r in split.collect()) == sorted(tuple(r) for r in whole.collect())


@pytest.mark.parametrize("ranged", [True, False])
def test_many_short_clips_share_tasks_and_tables(spark, ranged):
    """Tasks do not grow with the clips, nor tables of frames with the ranges; every frame is there."""
    n = 700
    clips = spark.range(n).select(F.format_string("/raw/c%d.mp4", "id").alias("path"))
    given = {"frames_per_task": 2, "count_fn": lambda path: 3} if ranged else {}
    decoded = files.decode_videos(clips, lambda path, start=0, end=3: ((k, 1.0, 1, 1) for k in range(start, end)), **given)
    assert decoded.rdd.getNumPartitions() <= max(files.TASKS_PER_CORE * spark.sparkContext.defaultParallelism, 8) < n
    assert sorted((r["video_id"], r["frame_number"]) for r in decoded.collect()) == sorted((f"c{i}", k) for i in range(n) for k in range(3))
    tables = list(files._chunks((f"c{i}", ((k, 1.0, 1, 1) for k in range(30))) for i in range(n)))
    assert [len(t) for t in tables] == [files.CHUNK_FRAMES] * 2 + [1000] and tables[-1]["video_id"].iloc[-1] == f"c{n - 1}"


def test_frames_with_ingest_time_and_empty_short_circuit(spark):
    from framelake.sources.files import build_frames, is_empty

    m = spark.createDataFrame([("v", "v__000000", "/p", 0, 1, 1)], "video_id string, frame_id string, frame_path string, timestamp_ms int, width long, height long")
    f = build_frames(spark, m)
    assert [t.simpleString() for _, t in [(x.name, x.dataType) for x in f.schema.fields]] == [
        "string", "string", "string", "bigint", "int", "int", "timestamp"]
    assert is_empty(f.limit(0)) and not is_empty(f)


def test_raw_features_dedup_newest_and_model_features(spark):
    rows = [("v", "a", "/old", 1, 1, 1, datetime(2024, 1, 1)), ("v", "a", "/new", 1, 1, 1, datetime(2024, 1, 2)),
            ("v", "b", "/b", 2, 1, 1, datetime(2024, 1, 1))]
    fr = spark.createDataFrame(rows, "video_id string, frame_id string, frame_path string, timestamp_ms long, width int, height int, extracted_at timestamp")
    feats = features.raw_features(fr)
    assert sorted(tuple(r) for r in feats.collect()) == [("a", "/new", "v", 1), ("b", "/b", "v", 2)]
    metrics = spark.createDataFrame([("a", 3, 0.5)], "frame_id string, n_detections int, avg_conf double")
    mf = {r["frame_id"]: (r["detection_count"], r["mean_confidence"]) for r in features.with_model_features(feats, metrics).collect()}
    assert mf == {"a": (3, 0.5), "b": (None, None)}


def test_preview_pending_and_table_reads(spark, tmp_dir):
    from framelake.operators.scoring import pending_count
    from framelake.sources.files import read_table

    f = spark.createDataFrame([(f"v__{i:06d}", "v", f"/p/{i}") for i in range(30)], "frame_id string, video_id string, frame_path string")
    assert frames.preview(f).count() == 10
    scored = f.limit(12).select("frame_id")
    assert pending_count(f) == 30 and pending_count(f, scored) == 18
    f.write.parquet(f"{tmp_dir}/m")
    assert read_table(spark, f"{tmp_dir}/m").count() == 30
    f.createOrReplaceTempView("fl_frames_view")
    assert read_table(spark, "fl_frames_view").count() == 30
