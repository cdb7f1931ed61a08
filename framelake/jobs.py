"""End-to-end stage flows built from the operators and sinks.

Each flow is what one stage of the reference does, as a plain function of its
inputs: ingest frames, register features, score new frames, promote models, set
up monitoring. Targets are catalog table names or storage paths (see
``sinks.store.upsert``). Nothing is collected except single scalars (a count, a
resolved version, a cutoff).
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.operators import features, frames, monitor, registry, scoring
from framelake.operators.contracts import require_names, require_positive_int
from framelake.schemas import (
    BASELINE_DAYS,
    DEFAULT_FRAME_INTERVAL,
    DEFAULT_METRIC,
    DEFAULT_MIN_GAIN,
    FEATURE_PRIMARY_KEY,
    FRAME_KEY,
)
from framelake.session import materialize, staged
from framelake.sinks import store
from framelake.sources import files

def read(spark: SparkSession, target: str) -> DataFrame | None:
    """A target's current content: catalog table or path; None if absent."""
    if "/" not in target:
        store.recover_table(spark, target)
        return store.read_table(spark, target) if store.table_exists(spark, target) else None
    return store.read_path(spark, target)


def ingest_frames(
    spark: SparkSession,
    raw_videos_dir: str,
    decode_fn,
    frames_target: str,
    frames_out_dir: str,
    frame_interval: int = DEFAULT_FRAME_INTERVAL,
    max_frames: int | None = None,
    frames_per_task: int | None = None,
    count_fn=None,
) -> DataFrame | None:
    """Stage 01: list videos, decode on the executors, sample, stamp, upsert by frame_id.

    Returns per-video counts (AGG-5) as a DataFrame, or None when there was nothing
    to write (no videos / no sampled frames: SRC-7).
    """
    require_positive_int("frame_interval", frame_interval)
    videos = files.list_videos(spark, raw_videos_dir)
    if videos.isEmpty():
        return None
    decoded = files.decode_videos(videos, decode_fn, frames_per_task=frames_per_task, count_fn=count_fn)
    manifest = frames.sample_frames(decoded, frame_interval, frames_out_dir, max_frames)
    stamped = staged(frames.with_extracted_at(manifest), "manifest")  # decoded once, for the test and the upsert
    if stamped.isEmpty():
        return None
    store.upsert(spark, frames_target, stamped, [FRAME_KEY])
    return frames.frames_per_video(read(spark, frames_target))


def register_features(
    spark: SparkSession,
    frames_source: str,
    feature_target: str,
    tags: dict[str, str] | None = None,
    description: str = "",
) -> str:
    """Stage 02: raw features, created with key + description + tags, else upserted (model features stay as they are)."""
    feats = features.raw_features(read(spark, frames_source))
    if "/" not in feature_target and not store.table_exists(spark, feature_target):
        store.create_feature_table(spark, feature_target, feats, FEATURE_PRIMARY_KEY, description)
        done = "created"
    else:
        done = store.upsert(spark, feature_target, feats, [FEATURE_PRIMARY_KEY], evolve=True)
    if "/" not in feature_target and tags:
        store.set_table_properties(spark, feature_target, tags)
    return done


def merge_model_features(spark: SparkSession, metrics_source: str, feature_target: str) -> str:
    """Stage 02, after scoring: detection_count and mean_confidence of scored frames merged into the feature table."""
    feats = read(spark, feature_target)
    scored = features.with_model_features(feats, read(spark, metrics_source)).filter(F.col("detection_count").isNotNull())
    return store.upsert(spark, feature_target, scored, [FEATURE_PRIMARY_KEY], evolve=True)


def batch_inference(
    spark: SparkSession,
    frames_source: str,
    detections_target: str,
    aliases: DataFrame,
    model_name: str,
    alias: str,
    predictor: scoring.Predictor,
    input_col: str = "frame_path",
    rows_per_task: int | None = None,
    failures_target: str | None = None,
) -> int:
    """Stage 05: resolve name@alias, score only unscored frames, upsert detections.

    Returns the number of frames scored in this run (0 on a re-run). With ``failures_target`` the frames whose
    scoring failed (stored with empty boxes) are upserted there with their error text.
    """
    require_names(model_name=model_name, alias=alias)
    found = registry.resolve_alias(aliases, model_name, alias).limit(2).collect()
    if len(found) != 1:
        raise ValueError(f"alias {model_name}@{alias} " + ("has several versions" if found else "does not exist"))
    version = found[0]["version"]
    todo = scoring.unscored(read(spark, frames_source), read(spark, detections_target))
    pending = todo.count()
    if pending == 0:
        return 0
    if rows_per_task:
        todo = scoring.spread_for_model(todo, rows_per_task, pending)
    scored = scoring.score(todo, input_col, predictor, error_col="error")
    if failures_target:
        scored = materialize(scored)  # read twice; the model runs once
        failed = scored.filter(F.col("error").isNotNull()).select(FRAME_KEY, "error", F.lit(version).cast("string").alias("model_version"))
        store.upsert(spark, failures_target, failed, [FRAME_KEY])
    store.upsert(spark, detections_target, scoring.with_provenance(scored, version, alias), [FRAME_KEY])
    return pending


def promote_models(
    spark: SparkSession,
    runs_target: str,
    versions_target: str,
    aliases_target: str,
    metric: str = DEFAULT_METRIC,
    min_gain: float = DEFAULT_MIN_GAIN,
    scopes: DataFrame | None = None,
) -> DataFrame:
    """Stage 04: decide for every model, move aliases, tag the best runs.

    With ``scopes`` (``name, experiment``) a model's candidates are the runs of an experiment, whatever their own name.

    The decisions (one row per model) are checkpointed once and then drive both
    upserts and the returned record.
    """
    runs, versions, aliases = (read(spark, t) for t in (runs_target, versions_target, aliases_target))
    decisions = materialize(registry.promotion(runs, versions, aliases, metric, min_gain, scopes))
    moves = registry.alias_updates(decisions)
    if not moves.isEmpty():
        store.upsert(spark, aliases_target, moves, ["name", "alias"])
    tagged = registry.decision_tags(runs, decisions)
    if not tagged.isEmpty():
        store.upsert(spark, runs_target, tagged, ["run_id"])
    return decisions


def setup_monitoring(
    spark: SparkSession,
    detections_source: str,
    metrics_target: str,
    baseline_target: str,
    monitor_target: str,
    window_days: int = BASELINE_DAYS,
    review: tuple[DataFrame, str, str] | None = None,
) -> datetime | None:
    """Stage 06: metrics snapshot, baseline of the first days, profile and drift.

    ``review`` (aliases, model name, alias) also writes the windows that flag this alias for review.

    Returns the baseline cutoff, or None when there are no metrics yet (then no
    baseline or monitor output is written).
    """
    metrics = monitor.detections_metrics(read(spark, detections_source))
    store.overwrite(metrics, metrics_target, change_feed=True)
    written = read(spark, metrics_target)
    cutoff = monitor.baseline_cutoff(written, window_days)
    if cutoff is None:
        return None
    base = written.filter(F.col("inferred_at") < F.lit(cutoff))
    store.overwrite(base, baseline_target)
    out = monitor.refresh_monitor(spark, written, read(spark, baseline_target), monitor_target)
    if review:
        store.overwrite(monitor.flags(read(spark, out["drift_path"]), *review), f"{monitor_target.rstrip('/')}/flags")
    return cutoff


def log_runs(spark: SparkSession, runs_target: str, runs: DataFrame) -> str:
    """Stage 03 (REG-1): record runs (status, params, tags, metrics); re-logging a run
    replaces its row."""
    return store.upsert(spark, runs_target, runs, ["run_id"])


def register_model_versions(
    spark: SparkSession,
    versions_target: str,
    aliases_target: str,
    new_runs: DataFrame,
    alias: str | None = None,
) -> DataFrame:
    """Stage 03 (REG-2, REG-3): register a version for each new (name, run_id) and
    optionally point ``alias`` at each model's newest registered version.

    Versions continue each model's integer sequence; the new rows are returned.
    """
    current = read(spark, versions_target)
    if current is None:
        current = spark.createDataFrame([], "name string, run_id long, version string")
    registered = materialize(registry.register_versions(current, new_runs))
    store.upsert(spark, versions_target, registered, ["name", "version"])
    if alias:
        newest = registered.groupBy("name").agg(F.max(F.col("version").cast("long")).cast("string").alias("version"))
        store.upsert(spark, aliases_target, newest.select("name", F.lit(alias).alias("alias"), "version"), ["name", "alias"])
    return registered
