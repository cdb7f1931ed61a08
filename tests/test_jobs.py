"""Stage flows end to end on scratch paths: two passes, asserted not printed."""

import os
from datetime import datetime

import pandas as pd

from framelake import jobs
from framelake.operators.scoring import Predictor


def _decode(path):
    n = 75 if "long" in path else 40
    for k in range(n):
        yield k, k * 1000.0 / 30.0, 640, 480


class FramePredictor(Predictor):
    key = "jobs-test"

    def predict(self, model, inputs: pd.Series):
        return [[{"x1": 0.0, "y1": 0.0, "x2": 2.0, "y2": 2.0, "conf": 0.5 + 0.1 * (len(p) % 3), "cls": len(p) % 2}]
                for p in inputs]


def test_stage_flows(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "raw")
    os.makedirs(raw)
    for n in ["long.mp4", "short.MOV", "notes.txt"]:
        with open(os.path.join(raw, n), "wb") as fh:
            fh.write(b"x")
    lake = os.path.join(tmp_dir, "lake")

    counts = jobs.ingest_frames(spark, raw, _decode, f"{lake}/frames", f"{lake}/jpg", frame_interval=30)
    assert {r["video_id"]: r["n_frames"] for r in counts.collect()} == {"long": 3, "short": 2, None: 5}
    jobs.ingest_frames(spark, raw, _decode, f"{lake}/frames", f"{lake}/jpg", frame_interval=30)
    assert jobs.read(spark, f"{lake}/frames").count() == 5          # re-ingest converges

    assert jobs.register_features(spark, f"{lake}/frames", f"{lake}/features") == "created"
    assert jobs.register_features(spark, f"{lake}/frames", f"{lake}/features") == "merged"
    assert jobs.read(spark, f"{lake}/features").columns == ["frame_id", "frame_path", "video_id", "timestamp_ms"]

    aliases = spark.createDataFrame([("det", "champion", "3")], "name string, alias string, version string")
    first = jobs.batch_inference(spark, f"{lake}/frames", f"{lake}/detections", aliases, "det", "champion",
                                 FramePredictor(), rows_per_task=2)
    second = jobs.batch_inference(spark, f"{lake}/frames", f"{lake}/detections", aliases, "det", "champion",
                                  FramePredictor())
    det = jobs.read(spark, f"{lake}/detections")
    assert (first, second, det.count()) == (5, 0, 5)
    assert {r["model_version"] for r in det.collect()} == {"3"}

    cutoff = jobs.setup_monitoring(spark, f"{lake}/detections", f"{lake}/metrics", f"{lake}/baseline", f"{lake}/monitor")
    assert cutoff is not None
    assert jobs.read(spark, f"{lake}/metrics").count() == 5
    assert jobs.read(spark, f"{lake}/monitor/profile").count() == 2

    jobs.merge_model_features(spark, f"{lake}/metrics", f"{lake}/features")
    wide = jobs.read(spark, f"{lake}/features")
    assert wide.columns[-2:] == ["detection_count", "mean_confidence"] and wide.filter("detection_count is null").count() == 0
    jobs.register_features(spark, f"{lake}/frames", f"{lake}/features")  # re-run on the wider table keeps the model features
    assert jobs.read(spark, f"{lake}/features").filter("detection_count is not null").count() == 5
    review = (aliases, "det", "champion")
    jobs.setup_monitoring(spark, f"{lake}/detections", f"{lake}/metrics", f"{lake}/baseline", f"{lake}/monitor", review=review)
    assert jobs.read(spark, f"{lake}/monitor/flags").columns[-1] == "flagged_version"


def test_promotion_flow_is_idempotent(spark, tmp_dir):
    t = datetime(2024, 1, 1)
    runs = spark.createDataFrame(
        [("m", 1, "FINISHED", t, {}, {}, {"mAP50": 0.5}), ("m", 2, "FINISHED", t, {}, {}, {"mAP50": 0.7}),
         ("n", 3, "FINISHED", t, {}, {}, {"mAP50": 0.2})],
        "name string, run_id long, status string, start_time timestamp, params map<string,string>, "
        "tags map<string,string>, metrics map<string,double>")
    versions = spark.createDataFrame([("m", 1, "1"), ("m", 2, "2"), ("n", 3, "1")], "name string, run_id long, version string")
    aliases = spark.createDataFrame([("m", "champion", "1")], "name string, alias string, version string")
    paths = {k: f"{tmp_dir}/{k}" for k in ("runs", "versions", "aliases")}
    for df, k in ((runs, "runs"), (versions, "versions"), (aliases, "aliases")):
        df.write.parquet(paths[k])
    d = {r["name"]: r for r in jobs.promote_models(spark, paths["runs"], paths["versions"], paths["aliases"]).collect()}
    assert d["m"]["decision"] == "promoted" and d["n"]["reason"] == "first_deploy_no_champion"
    got = sorted(tuple(r) for r in jobs.read(spark, paths["aliases"]).collect())
    assert got == [("m", "challenger", "1"), ("m", "champion", "2"), ("n", "champion", "1")]
    jobs.promote_models(spark, paths["runs"], paths["versions"], paths["aliases"])
    again = sorted(tuple(r) for r in jobs.read(spark, paths["aliases"]).collect())
    assert again == [("m", "challenger", "1"), ("m", "champion", "2"), ("n", "champion", "1")]
    tags = {r["run_id"]: r["tags"].get("promotion_decision") for r in jobs.read(spark, paths["runs"]).collect()}
    assert tags == {1: None, 2: "kept_champion", 3: "kept_champion"}


def test_log_and_register_versions(spark, tmp_dir):
    t = datetime(2024, 1, 1)
    runs = spark.createDataFrame([("m", 1, "FINISHED", t, {}, {}, {"mAP50": 0.5})],
                                 "name string, run_id long, status string, start_time timestamp, "
                                 "params map<string,string>, tags map<string,string>, metrics map<string,double>")
    assert jobs.log_runs(spark, f"{tmp_dir}/runs", runs).startswith("created")
    new = spark.createDataFrame([("m", 1), ("m", 2), ("n", 5)], "name string, run_id long")
    reg = jobs.register_model_versions(spark, f"{tmp_dir}/versions", f"{tmp_dir}/aliases", new, alias="champion")
    assert sorted(tuple(r) for r in reg.collect()) == [("m", 1, "1"), ("m", 2, "2"), ("n", 5, "1")]
    more = spark.createDataFrame([("m", 9)], "name string, run_id long")
    jobs.register_model_versions(spark, f"{tmp_dir}/versions", f"{tmp_dir}/aliases", more, alias="champion")
    assert sorted(tuple(r) for r in jobs.read(spark, f"{tmp_dir}/aliases").collect()) == [("m", "champion", "3"), ("n", "champion", "1")]
    assert jobs.read(spark, f"{tmp_dir}/versions").count() == 4


def test_ingest_refuses_two_files_with_one_video_id(spark, tmp_dir):
    import pytest

    raw = os.path.join(tmp_dir, "raw")
    os.makedirs(raw)
    for n in ["a.mp4", "a.MOV"]:
        with open(os.path.join(raw, n), "wb") as fh:
            fh.write(b"x")
    with pytest.raises(ValueError, match="unique"):
        jobs.ingest_frames(spark, raw, _decode, f"{tmp_dir}/frames", f"{tmp_dir}/jpg")
    assert jobs.read(spark, f"{tmp_dir}/frames") is None  # nothing committed


class _Fails(FramePredictor):
    key = "jobs-fails"

    def predict(self, model, inputs: pd.Series):
        if inputs.str.contains("short").any():
            raise ValueError("cannot read " + "x" * 600)
        return super().predict(model, inputs)


def test_failed_frames_are_counted(spark, tmp_dir):
    rows = [(f"{v}__{i:06d}", v, f"/{v}/{i}.jpg") for v in ("long", "short") for i in range(3)]
    spark.createDataFrame(rows, "frame_id string, video_id string, frame_path string").write.parquet(f"{tmp_dir}/frames")
    aliases = spark.createDataFrame([("det", "champion", "3")], "name string, alias string, version string")
    assert jobs.batch_inference(spark, f"{tmp_dir}/frames", f"{tmp_dir}/det", aliases, "det", "champion", _Fails(),
                                failures_target=f"{tmp_dir}/failures") == 6
    failed = jobs.read(spark, f"{tmp_dir}/failures").collect()
    assert sorted(r["frame_id"][:5] for r in failed) == ["short"] * 3 and all(len(r["error"]) > 600 for r in failed)
    assert jobs.read(spark, f"{tmp_dir}/det").count() == 6


def test_empty_and_long_videos(spark, tmp_dir):
    from framelake.sources import files

    videos = spark.createDataFrame([("/a/empty.mp4",), ("/a/long.mp4",)], "path string")
    n = {"/a/empty.mp4": 0, "/a/long.mp4": 25_001}

    def decode(path, start=0, end=None):
        for k in range(start, n[path] if end is None else end):
            yield k, k * 33.0, 640, 480

    assert files.decode_videos(videos, decode).count() == 25_001
    ranged = files.decode_videos(videos, decode, frames_per_task=4_000, count_fn=lambda p: n[p])
    assert ranged.count() == 25_001 and ranged.select("frame_number").distinct().count() == 25_001
