"""Frame sampling, ids and counts (FLT-1, FLT-5, SCL-1..5, SET-1, AGG-5, ORD-6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.functions import ids
from framelake.operators.contracts import require_positive_int
from framelake.operators.sequence import cap_within


def listing(files: DataFrame, path_col: str = "path", keep: tuple[str, ...] = ()) -> DataFrame:
    """SRC-1 / SCL-2 / SCL-6 / ORD-6 on a file table: supported videos, sorted by name."""
    name = ids.base_name(path_col)
    return (
        files.select(F.col(path_col).alias("path"), name.alias("file_name"), *keep)
        .filter(ids.has_video_suffix("file_name"))
        .withColumn("video_id", ids.stem("file_name"))
        .select("path", "file_name", "video_id", *keep)
        .orderBy("file_name", "path")
    )


def sample_frames(
    decoded: DataFrame, frame_interval: int, out_dir: str, max_frames: int | None = None
) -> DataFrame:
    """FLT-1 + SCL-1/4/5: keep frame k when k % interval == 0; manifest columns.

    ``decoded`` has (video_id, frame_number, pos_ms, width, height), one row per
    decoded frame. The stride filter is a plain predicate, so it runs before any
    per-frame work and reaches the scan as a data filter.
    """
    require_positive_int("frame_interval", frame_interval)
    kept = decoded.filter(F.col("frame_number") % frame_interval == 0)
    if max_frames is not None:
        kept = cap_per_video(kept, max_frames)
    fid = ids.frame_id("video_id", "frame_number")
    return kept.select(
        F.col("video_id"),
        fid.alias("frame_id"),
        ids.frame_path(out_dir, "video_id", fid).alias("frame_path"),
        ids.truncate_ms("pos_ms").alias("timestamp_ms"),
        F.col("width").cast("int").alias("width"),
        F.col("height").cast("int").alias("height"),
    )


def cap_per_video(frames: DataFrame, max_frames: int) -> DataFrame:
    """FLT-5: the first ``max_frames`` frames of each video by frame number (numbers may have gaps).

    Frames are numbered with the skew-safe sequence operator, so a long video is split over
    many tasks instead of landing in one window partition.
    """
    require_positive_int("max_frames", max_frames)
    return cap_within(frames, ["video_id"], ["frame_number"], max_frames)


def with_extracted_at(manifest: DataFrame) -> DataFrame:
    """SRC-3: frames with the canonical column types plus the ingest timestamp."""
    return manifest.select(
        F.col("video_id").cast("string"),
        F.col("frame_id").cast("string"),
        F.col("frame_path").cast("string"),
        F.col("timestamp_ms").cast("long"),
        F.col("width").cast("int"),
        F.col("height").cast("int"),
        ids.now().alias("extracted_at"),
    )


def frames_per_video(frames: DataFrame) -> DataFrame:
    """AGG-5: sampled frames per video plus a total row (video_id NULL)."""
    return frames.rollup("video_id").agg(F.count(F.lit(1)).alias("n_frames"))


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    """ORD-5: the first ``n`` rows (a limit, not a sort)."""
    return df.limit(n)
