"""Table schemas, the nested box type, keys and fixed pipeline constants."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values (must equal the pipeline contract) -------------------------
# Nested detections column type, as declared by the scoring contract.
BOXES_DDL = "array<struct<x1:float,y1:float,x2:float,y2:float,conf:float,cls:int>>"
BOX_FIELDS = ("x1", "y1", "x2", "y2", "conf", "cls")
# Video suffixes accepted by the listing (compared case-insensitively).
VIDEO_SUFFIXES = (".mp4", ".mov", ".avi")
# Default sampling stride and the detector's thresholds.
DEFAULT_FRAME_INTERVAL = 30
DETECT_CONF_THRESHOLD = 0.25
DETECT_IOU_THRESHOLD = 0.45
DETECT_MAX_BOXES = 300
# Promotion gate defaults.
DEFAULT_METRIC = "mAP50"
DEFAULT_MIN_GAIN = 1.02
CHAMPION = "champion"
CHALLENGER = "challenger"
DECISION_TAG = "promotion_decision"
# Training-result keys and the clean metric names they are logged under.
METRIC_NAME_MAP = {
    "metrics/mAP50(B)": "mAP50",
    "metrics/mAP50-95(B)": "mAP50-95",
    "metrics/precision(B)": "precision",
    "metrics/recall(B)": "recall",
}
# Monitoring defaults: baseline width and profile granularity.
BASELINE_DAYS = 7
MONITOR_GRANULARITY = "1 day"
# Key of the feature table.
FEATURE_PRIMARY_KEY = "frame_id"
# -----------------------------------------------------------------------------

BOX_TYPE = T.StructType(
    [
        T.StructField("x1", T.FloatType()),
        T.StructField("y1", T.FloatType()),
        T.StructField("x2", T.FloatType()),
        T.StructField("y2", T.FloatType()),
        T.StructField("conf", T.FloatType()),
        T.StructField("cls", T.IntegerType()),
    ]
)
BOXES_TYPE = T.ArrayType(BOX_TYPE)

FRAME_KEY = "frame_id"

MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("video_id", T.StringType(), False),
        T.StructField("frame_id", T.StringType(), False),
        T.StructField("frame_path", T.StringType(), False),
        T.StructField("timestamp_ms", T.LongType()),
        T.StructField("width", T.IntegerType()),
        T.StructField("height", T.IntegerType()),
    ]
)
FRAMES_SCHEMA = T.StructType(MANIFEST_SCHEMA.fields + [T.StructField("extracted_at", T.TimestampType())])

FEATURE_COLUMNS = ("frame_id", "frame_path", "video_id", "timestamp_ms")
SCORING_INPUT_COLUMNS = ("frame_id", "video_id", "frame_path")
DETECTIONS_COLUMNS = ("frame_id", "video_id", "boxes", "model_version", "inferred_at", "alias_used")
METRICS_COLUMNS = ("frame_id", "video_id", "inferred_at", "n_detections", "avg_conf")
PREDICT_OUTPUT_COLUMNS = ("frame_id", "boxes", "confs", "classes")

# Registry tables (runs / versions / aliases held as ordinary tables).
RUNS_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType(), False),
        T.StructField("run_id", T.LongType(), False),
        T.StructField("status", T.StringType()),
        T.StructField("start_time", T.TimestampType()),
        T.StructField("params", T.MapType(T.StringType(), T.StringType())),
        T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("experiment", T.StringType()),
    ]
)
VERSIONS_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType(), False),
        T.StructField("run_id", T.LongType()),
        T.StructField("version", T.StringType(), False),
    ]
)
ALIASES_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType(), False),
        T.StructField("alias", T.StringType(), False),
        T.StructField("version", T.StringType(), False),
    ]
)
