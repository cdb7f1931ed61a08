"""Stream form of incremental scoring: new files scored once, re-runs score nothing."""

from framelake.operators.scoring import Predictor
from framelake.sinks.store import read_path
from framelake.streaming.incremental import score_new_frames


class LenPredictor(Predictor):
    key = "len-stream"

    def predict(self, model, inputs):
        return [[{"x1": 0.0, "y1": 0.0, "x2": 1.0, "y2": 1.0, "conf": 0.9, "cls": len(p) % 2}] for p in inputs]


SCHEMA = "frame_id string, video_id string, frame_path string"


def test_stream_scores_new_frames_once(spark, tmp_dir):
    src, out = f"{tmp_dir}/frames", f"{tmp_dir}/detections"
    spark.createDataFrame([(f"a__{i:06d}", "a", f"/a/{i}.jpg") for i in range(5)], SCHEMA).write.parquet(f"{src}/b1")
    from pyspark.sql.types import _parse_datatype_string

    schema = _parse_datatype_string(SCHEMA)
    q = score_new_frames(spark, f"{src}/*", schema, out, "frame_path", LenPredictor(), "1", "champion", name="t-stream")
    q.awaitTermination(120)
    assert read_path(spark, out).count() == 5
    spark.createDataFrame([(f"b__{i:06d}", "b", f"/b/{i}.jpg") for i in range(3)] + [("a__000000", "a", "/a/0.jpg")], SCHEMA).write.parquet(f"{src}/b2")
    spark.createDataFrame([("b__000001", "b", "/b/1.jpg")], SCHEMA).write.parquet(f"{src}/b3")  # listed twice
    q = score_new_frames(spark, f"{src}/*", schema, out, "frame_path", LenPredictor(), "2", "champion", name="t-stream")
    q.awaitTermination(120)
    det = read_path(spark, out)
    assert det.count() == 8
    assert sorted(r["model_version"] for r in det.collect()).count("2") == 3


class _Never(LenPredictor):
    key = "never-stream"

    def predict(self, model, inputs):
        raise AssertionError("nothing is left to score")


def test_restart_in_another_session_scores_nothing(spark, tmp_dir):
    from pyspark.sql.types import _parse_datatype_string

    src, out, state = f"{tmp_dir}/frames", f"{tmp_dir}/detections", f"{tmp_dir}/state"
    spark.createDataFrame([(f"a__{i:06d}", "a", f"/a/{i}.jpg") for i in range(5)], SCHEMA).write.parquet(f"{src}/b1")
    schema = _parse_datatype_string(SCHEMA)
    q = score_new_frames(spark, f"{src}/*", schema, out, "frame_path", LenPredictor(), "1", "champion", name="t-one", checkpoint=state)
    q.awaitTermination(120)
    files = set(spark.read.parquet(out).inputFiles())
    other = spark.newSession()
    q = score_new_frames(other, f"{src}/*", schema, out, "frame_path", _Never(), "2", "champion", name="t-two", checkpoint=state)
    q.awaitTermination(120)
    assert q.exception() is None and sum(p["numInputRows"] for p in q.recentProgress) == 0
    assert set(spark.read.parquet(out).inputFiles()) == files and read_path(other, out).count() == 5
