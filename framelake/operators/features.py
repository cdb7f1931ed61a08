"""Feature table operators (PRJ-1, AGG-3, JOI-6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.schemas import FEATURE_COLUMNS, FEATURE_PRIMARY_KEY


def latest_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """AGG-3, deterministic: one whole row per key, the greatest by ``order`` (then by
    the remaining columns, so ties are fully broken).

    A ``max_by`` aggregate: partial aggregation collapses the copies of a key on
    the map side, so a key with a third of all rows never reaches one task whole.
    """
    others = [c for c in df.columns if c != key]
    tie = [c for c in others if c not in order]
    row = F.struct(*[F.col(c) for c in others])
    rank = F.struct(*[F.col(c) for c in list(order) + tie])
    return df.groupBy(key).agg(F.max_by(row, rank).alias("_row")).select(key, *[F.col(f"_row.{c}").alias(c) for c in others])


def raw_features(frames: DataFrame) -> DataFrame:
    """PRJ-1 + AGG-3: model-independent features, unique per frame_id.

    Among copies of a frame the newest ``extracted_at`` wins when present.
    """
    order = ["extracted_at"] if "extracted_at" in frames.columns else []
    proj = frames.select(*FEATURE_COLUMNS, *order)
    return latest_per_key(proj, FEATURE_PRIMARY_KEY, order).select(*FEATURE_COLUMNS)


def with_model_features(features: DataFrame, metrics: DataFrame) -> DataFrame:
    """JOI-6: model-derived features merged in (NULL until the frame is scored); earlier ones are replaced."""
    m = metrics.select(
        "frame_id",
        F.col("n_detections").alias("detection_count"),
        F.col("avg_conf").alias("mean_confidence"),
    )
    return features.drop("detection_count", "mean_confidence").join(m, "frame_id", "left")
