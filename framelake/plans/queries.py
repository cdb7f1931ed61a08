"""

Each query takes (spark, sf_dir), reads whole driver tables, derives the pipeline
table it needs with framelake operators and returns a flat DataFrame: doubles
rounded to 6 digits, no wall-clock columns, so that the SQL twins in
``framelake.plans.oracle`` can be compared value by value.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake import fixtures as fx
from framelake.functions import boxes as bx
from framelake.functions import ids
from framelake.operators import contracts, features, frames, monitor, registry, scoring
from framelake.session import checkpoint_path, staged
from framelake.sinks import store
from framelake.sources import files

Query = Callable[[SparkSession, str], DataFrame]

# --- fixed query parameters ---------------------------------------------------
PROVENANCE_MODEL = "det_2"
PROVENANCE_ALIAS = "champion"
CAP_PER_VIDEO = 2
TOP_K = 3
STANDIN_MIN_CONF = 0.10
# -----------------------------------------------------------------------------


def r6(c: Column | str) -> Column:
    """Double rounded to 6 digits, negative zero folded to zero."""
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col.cast("double"), 6) + F.lit(0.0)


def _flat_boxes(df: DataFrame, col: str) -> DataFrame:
    flat = bx.flatten(df, col, ["frame_id"], pos="pos")
    return flat.select("frame_id", "pos", *[r6(c).alias(c) for c in ("x1", "y1", "x2", "y2", "conf")], "cls")


def video_listing(spark, d):
    return frames.listing(fx.files_fx(spark, d))


def frame_sampling(spark, d):
    return fx.frames_fx(spark, d)


def _clip_frames(path: str) -> int:
    """Frames of the stand-in clips: some have none, and one in 500 is long."""
    clip = int(path.rsplit(".", 2)[1])
    return 4321 if clip % 500 == 0 else clip % 40


def _clip_decode(path: str, start: int, end: int):
    return ((k, k * 1000.0 / 25, 640 + len(path), 360) for k in range(start, end))


def decoded_ranges(spark, d):
    """SRC-2: every clip decoded in ranges of frames, so that a long one is many tasks, then sampled."""
    clips = fx.files_fx(spark, d).filter(ids.has_video_suffix("path"))
    decoded = files.decode_videos(clips, _clip_decode, frames_per_task=1000, count_fn=_clip_frames)
    return frames.sample_frames(decoded, 7, fx.FRAMES_OUT_DIR)


def frame_sampling_capped(spark, d):
    return frames.sample_frames(fx.decoded_fx(spark, d), fx.FIXTURE_STRIDE, fx.FRAMES_OUT_DIR, max_frames=CAP_PER_VIDEO)


def frames_per_video(spark, d):
    return frames.frames_per_video(fx.frames_fx(spark, d))


def frame_id_from_path(spark, d):
    f = fx.files_fx(spark, d)
    given = F.when(F.col("doc_id") % 3 == 0, F.format_string("given_%d", "doc_id"))
    return f.select("path", ids.frame_id_from_path(given, "path").alias("frame_id"))


def _frames_two_copies(spark, d) -> DataFrame:
    f = fx.frames_fx(spark, d)
    a = f.withColumn("extracted_at", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    b = (
        f.filter(F.col("timestamp_ms") % 2 == 0)
        .withColumn("frame_path", F.concat("frame_path", F.lit("?v2")))
        .withColumn("extracted_at", F.lit("2024-01-02 00:00:00").cast("timestamp_ntz"))
    )
    return a.unionByName(b)


def raw_features(spark, d):
    return features.raw_features(_frames_two_copies(spark, d))


def duplicate_keys(spark, d):
    return contracts.duplicate_keys(fx.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def unscored_frames(spark, d):
    return scoring.unscored(fx.frames_fx(spark, d), fx.scored_fx(spark, d)).select("frame_id", "video_id", "frame_path")


def scored_boxes(spark, d):
    emb = fx.embeddings(spark, d)
    s = scoring.score(emb, "embedding", scoring.VectorBoxPredictor(STANDIN_MIN_CONF))
    flat = bx.flatten(s, "boxes", ["vec_id"], pos="box_pos")
    return flat.select("vec_id", "box_pos", *[r6(c).alias(c) for c in ("x1", "y1", "x2", "y2", "conf")], "cls")


def detections_provenance(spark, d):
    det = fx.detections_fx(spark, d)
    stamped = scoring.with_resolved_version(det, fx.aliases_fx(spark, d), PROVENANCE_MODEL, PROVENANCE_ALIAS)
    return stamped.select("frame_id", "video_id", "model_version", "alias_used", bx.n_detections("boxes").alias("n_detections"))


def _upsert_inputs(spark, d):
    f = fx.frames_fx(spark, d)
    target = f.filter(F.col("timestamp_ms") % 4 != 3)
    source = f.filter(F.col("timestamp_ms") % 4 >= 2).withColumn("width", F.lit(1280)).withColumn("height", F.lit(720))
    return target, source


def upsert_frames(spark, d):
    target, source = _upsert_inputs(spark, d)
    return store.merge_result(target, source, ["frame_id"])


def upsert_frames_table(spark, d):
    """The same upsert through a keyed catalog table: created, merged partition by partition, read back."""
    target, source = _upsert_inputs(spark, d)
    name = f"framelake_frames_{uuid.uuid4().hex}"
    store.upsert(spark, name, target, ["frame_id"], parts=4, buckets=8)
    store.upsert(spark, name, source, ["frame_id"])
    out = staged(store.read_table(spark, name), "frames")
    store.drop_keyed(spark, name)
    return out


def snapshot_feed(spark, d):
    """The change feed of two written snapshots: only partitions with differing digests are read."""
    old, new = _snapshots(spark, d)
    paths = [checkpoint_path(spark, f"snapshot-{uuid.uuid4().hex}") for _ in range(2)]
    for df, path in zip((old, new), paths):
        store.write_snapshot(df, path, ["frame_id"], parts=16)
    return _changes(store.changes_between(spark, *paths, ["frame_id"]))


def _snapshots(spark, d) -> tuple[DataFrame, DataFrame]:
    f = fx.frames_fx(spark, d)
    old = f.filter(F.col("timestamp_ms") % 5 != 0)
    new = f.filter(F.col("timestamp_ms") % 7 != 0).withColumn(
        "width", F.when(F.col("timestamp_ms") % 3 == 0, F.lit(1280)).otherwise(F.col("width"))
    )
    return old, new


def snapshot_changes(spark, d):
    return _changes(store.snapshot_changes(*_snapshots(spark, d), ["frame_id"]))


def _changes(ch: DataFrame) -> DataFrame:
    return ch.select("frame_id", "change_type", F.col("_old.width").alias("old_width"), F.col("_new.width").alias("new_width"))


def _metrics(spark, d) -> DataFrame:
    return monitor.detections_metrics(fx.detections_fx(spark, d))


def _counts(spark, d) -> DataFrame:
    """Value counts of the metrics. Every order has a frame stamped with its date, so the
    baseline's end is read from the orders alone."""
    first = fx.table(spark, d, "orders").select(F.col("o_orderdate").alias("inferred_at"))
    return staged(monitor.value_counts(_metrics(spark, d), baseline_until=monitor.baseline_end(first)), "counts")


def detections_metrics(spark, d):
    m = _metrics(spark, d)
    return m.select("frame_id", "video_id", "inferred_at", "n_detections", r6("avg_conf").alias("avg_conf"))


def detections_summary(spark, d):
    s = monitor.detections_summary(fx.detections_fx(spark, d))
    return s.select("frame_id", "n_detections", r6("avg_conf").alias("avg_conf"))


def confs_classes(spark, d):
    det = fx.detections_fx(spark, d)
    z = det.select("frame_id", F.arrays_zip(bx.confs("boxes").alias("conf"), bx.classes("boxes").alias("cls")).alias("z"))
    e = z.select("frame_id", F.posexplode_outer("z").alias("pos", "p"))
    return e.select("frame_id", "pos", r6("p.conf").alias("conf"), F.col("p.cls").alias("cls"))


def boxes_filtered(spark, d):
    det = fx.detections_fx(spark, d)
    return _flat_boxes(det.select("frame_id", bx.keep_conf("boxes", 0.25).alias("b")), "b")


def boxes_nms(spark, d):
    det = fx.detections_fx(spark, d)
    return _flat_boxes(det.select("frame_id", bx.nms("boxes", 0.45).alias("b")), "b")


def boxes_topk(spark, d):
    det = fx.detections_fx(spark, d)
    return _flat_boxes(det.select("frame_id", bx.top("boxes", TOP_K).alias("b")), "b")


def boxes_postprocessed(spark, d):
    """The detector's order: threshold, suppress, then cap."""
    det = fx.detections_fx(spark, d)
    return _flat_boxes(det.select("frame_id", bx.detector_postprocess("boxes", 0.25, 0.45, TOP_K).alias("b")), "b")


def box_totals(spark, d):
    """AGG-6, AGG-7, JOI-7 in one pass: totals and the top frame with its path
    (``min_by`` over a struct carrying the path; ``monitor.top_frame`` is the
    join form for a separate frames table)."""
    det = fx.detections_fx(spark, d)
    m = det.select(
        "frame_id",
        F.format_string("/frames/%s/%s.jpg", "video_id", "frame_id").alias("frame_path"),
        bx.n_detections("boxes").alias("n_detections"),
    )
    top = F.min_by(F.struct("frame_id", "n_detections", "frame_path"), F.struct(-F.col("n_detections"), F.col("frame_id")))
    return m.agg(
        F.count(F.lit(1)).alias("n_frames"), F.sum("n_detections").cast("long").alias("total_boxes"), top.alias("_top")
    ).select(
        "n_frames",
        "total_boxes",
        F.col("_top.frame_id").alias("top_frame_id"),
        F.col("_top.n_detections").alias("top_n"),
        F.col("_top.frame_path").alias("top_frame_path"),
    )


def box_contract(spark, d):
    """Boxes of class 2 lose their class (invalid); some frames lose their metrics row, some get a second, unknown one."""
    det = staged(fx.detections_fx(spark, d), "detections")  # read by the contract and by both sides of the count
    broken = F.transform("boxes", lambda b: b.withField("cls", F.when(b["cls"] != 2, b["cls"])))
    c = contracts.box_contract(det.select("frame_id", broken.alias("boxes")))
    frames_in = det.select("frame_id", F.dayofmonth("inferred_at").alias("day"))
    out = frames_in.filter(F.col("day") % 9 != 0).unionByName(
        frames_in.filter(F.col("day") % 10 == 0).withColumn("frame_id", F.concat(F.lit("unknown_"), "frame_id")))
    rc = contracts.row_count_check(frames_in, out, "frame_id")
    counts = rc.select(F.struct(*rc.columns)).scalar()  # one row, one subquery
    return c.select("*", *[counts[k].alias(k) for k in rc.columns])


def model_features(spark, d):
    det = fx.detections_fx(spark, d)
    fr = det.select(
        "frame_id",
        "video_id",
        F.format_string("/frames/%s/%s.jpg", "video_id", "frame_id").alias("frame_path"),
        F.lit(0).cast("long").alias("timestamp_ms"),
    )
    feats = features.raw_features(fr)
    scored = monitor.detections_metrics(det.filter(F.dayofmonth("inferred_at") % 4 != 0))
    j = features.with_model_features(feats, scored)
    return j.select(*feats.columns, "detection_count", r6("mean_confidence").alias("mean_confidence"))


def model_features_merged(spark, d):
    """The feature table after the model features of the scored frames are merged in."""
    det = fx.detections_fx(spark, d)
    path = F.format_string("/frames/%s/%s.jpg", "video_id", "frame_id")
    feats = features.raw_features(det.select("frame_id", "video_id", path.alias("frame_path"), F.lit(0).cast("long").alias("timestamp_ms")))
    scored = monitor.detections_metrics(det.filter(F.dayofmonth("inferred_at") % 4 != 0))
    merged = features.with_model_features(feats, scored).filter(F.col("detection_count").isNotNull())
    out = store.merge_result(feats, merged, ["frame_id"], evolve=True)
    return out.withColumn("mean_confidence", r6("mean_confidence"))


class PicturePredictor(scoring.Predictor):
    """Stand-in over paths: as many boxes as the path's length leaves by 3; a text file is no picture."""

    key = "picture-path"

    def predict(self, model, inputs):
        if inputs.str.endswith(".txt").any():
            raise ValueError("not a picture")
        box = {"x1": 0.0, "y1": 0.0, "x2": 1.0, "y2": 1.0, "conf": 0.5, "cls": 1}
        return [[box] * (len(p) % 3) for p in inputs]


def predict_contract(spark, d):
    f = fx.files_fx(spark, d)
    given = F.when(F.col("doc_id") % 3 == 0, F.format_string("given_%d", "doc_id"))
    # The frames table names the column frame_path; the contract's input is path.
    out = scoring.predict_frames(f.select(F.col("path").alias("frame_path"), given.alias("frame_id")), PicturePredictor(), path_col="frame_path")
    return out.select("frame_id", F.size("boxes").alias("n_boxes"), F.size("confs").alias("n_confs"), F.size("classes").alias("n_classes"))


def scoring_failures(spark, d):
    s = scoring.score(fx.files_fx(spark, d).select("path"), "path", PicturePredictor(), error_col="error")
    return s.select("path", "error", F.size("boxes").alias("n_boxes"))


def pending_count(spark, d):
    return scoring.unscored(fx.frames_fx(spark, d), fx.scored_fx(spark, d)).agg(F.count(F.lit(1)).alias("n_pending"))


def run_metrics(spark, d):
    r = fx.runs_fx(spark, d)
    return r.select(
        "run_id",
        "name",
        "status",
        r6(registry.get_metric("metrics", "mAP50")).alias("map50"),
        r6(registry.get_metric("metrics", "precision")).alias("precision"),
        F.size("metrics").alias("n_metrics"),
    )


def runs_ranked(spark, d):
    rk = registry.rank_runs(fx.runs_fx(spark, d))
    return rk.select("name", "run_id", r6("metric").alias("metric"), "rank")


def run_versions(spark, d):
    return registry.run_versions(fx.runs_fx(spark, d), fx.versions_fx(spark, d))


def registered_versions(spark, d):
    """Versions given to the runs that have none yet."""
    runs, versions = fx.runs_fx(spark, d), fx.versions_fx(spark, d)
    new = runs.join(versions.select("name", "run_id"), ["name", "run_id"], "left_anti")
    return registry.register_versions(versions, new)


def logged_runs(spark, d):
    """The runs table after some runs are logged again as finished and some for the first time."""
    runs = fx.runs_fx(spark, d)
    again = runs.filter(F.col("run_id") % 4 >= 2).withColumn("status", F.lit(registry.FINISHED))
    out = registry.log_runs(runs.filter(F.col("run_id") % 4 != 3), again)
    return out.select("run_id", "name", "status", F.size("metrics").alias("n_metrics"))


def latest_run(spark, d):
    return registry.latest_run(fx.runs_fx(spark, d)).select("name", "run_id", "status", "start_time")


def champion_metric(spark, d):
    c = registry.champion_metric(fx.runs_fx(spark, d), fx.versions_fx(spark, d), fx.aliases_fx(spark, d))
    return c.select("name", "champion_version", "champion_run_id", r6("champion_metric").alias("champion_metric"))


def _registry(spark, d) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Runs as they are read; versions and aliases written once, as a registry holds them."""
    versions = staged(fx.versions_fx(spark, d), "versions")
    return fx.runs_fx(spark, d), versions, staged(fx.aliases_fx(spark, d, versions), "aliases")


def _decision_columns(p: DataFrame) -> DataFrame:
    return p.select(
        "name", "status", "best_run_id", "best_version", r6("best_metric").alias("best_metric"),
        "champion_version", r6("champion_metric").alias("champion_metric"), r6("gain_gate").alias("gain_gate"),
        "challenger_version", "challenger_is_champion", "promote", "decision", "reason",
    )


def promotion_gate(spark, d):
    return _decision_columns(registry.promotion(*_registry(spark, d)))


def promotion_by_experiment(spark, d):
    """Each model is promoted from one of ten experiments, whose runs were logged under several models; some name none of them."""
    runs, versions, aliases = _registry(spark, d)
    model = F.substring("name", 5, 10).cast("int")
    runs = runs.withColumn("experiment", F.format_string("exp_%d", model % 10))
    scopes = runs.select("name", F.format_string("exp_%d", model * 7 % 12).alias("experiment")).distinct()
    return _decision_columns(registry.promotion(runs, versions, aliases, scopes=scopes))


def alias_moves(spark, d):
    runs, versions, aliases = _registry(spark, d)
    # One row per model, read by both sides of the merge: written once.
    return registry.move_aliases(aliases, staged(registry.promotion(runs, versions, aliases), "decisions"))


def decision_tags(spark, d):
    runs, versions, aliases = _registry(spark, d)
    t = registry.decision_tags(runs, staged(registry.promotion(runs, versions, aliases), "decisions"))
    return t.select(
        "name", "run_id", F.col("tags")["promotion_decision"].alias("promotion_decision"), F.size("tags").alias("n_tags")
    )


def baseline_window(spark, d):
    b = monitor.baseline(_metrics(spark, d))
    return b.select("frame_id", "video_id", "inferred_at", "n_detections", r6("avg_conf").alias("avg_conf"))


def daily_profile(spark, d):
    p = monitor.profile(_metrics(spark, d))
    dbl = ["mean", "stddev", "min", "max", "p25", "p50", "p75"]
    return p.select("window_start", "column_name", "n", "n_null", "n_distinct", *[r6(c).alias(c) for c in dbl])


def _drift(spark, d) -> DataFrame:
    return monitor.drift_counts(_counts(spark, d))


def drift_vs_baseline(spark, d):
    return _drift_columns(_drift(spark, d))


def _drift_columns(dr: DataFrame) -> DataFrame:
    dbl = ["mean", "baseline_mean", "mean_delta", "psi", "ks"]
    return dr.select("window_start", "column_name", "n", "baseline_n", *[r6(c).alias(c) for c in dbl])


def monitor_refresh(spark, d):
    """MON-4: profile and drift are refreshed twice into their tables, which keep one row per window and column."""
    metrics = staged(_metrics(spark, d), "metrics")
    out = checkpoint_path(spark, f"monitor-{uuid.uuid4().hex}")
    for _ in range(2):
        paths = monitor.refresh_monitor(spark, metrics, monitor.baseline(metrics), out)
    return _drift_columns(store.read_path(spark, paths["drift_path"]))


def drift_flags(spark, d):
    fl = monitor.flags(_drift(spark, d), fx.aliases_fx(spark, d), PROVENANCE_MODEL, PROVENANCE_ALIAS)
    return fl.select("window_start", "column_name", r6("psi").alias("psi"), "name", "alias", "flagged_version")


def _emb_frames(spark, d) -> DataFrame:
    e = fx.embeddings(spark, d)
    return e.select(
        F.format_string("vec_%d__%06d", "vec_id", F.lit(0)).alias("frame_id"),
        F.format_string("label_%d", "label").alias("video_id"),
        F.format_string("/frames/vec_%d.jpg", "vec_id").alias("frame_path"),
        "vec_id",
        "embedding",
    )


def incremental_scoring(spark, d):
    f = _emb_frames(spark, d)
    pred = scoring.VectorBoxPredictor(STANDIN_MIN_CONF)
    first = scoring.incremental_pass(f.filter(F.col("vec_id") % 2 == 0), None, "embedding", pred, "1", "champion")
    second = scoring.incremental_pass(f, first, "embedding", pred, "2", "champion")
    final = store.merge_result(first, second, ["frame_id"])
    return final.select("frame_id", "video_id", bx.n_detections("boxes").alias("n_detections"), "model_version", "alias_used")


QUERIES: dict[str, Query] = {
    "video_listing": video_listing,
    "frame_sampling": frame_sampling,
    "frame_sampling_capped": frame_sampling_capped,
    "decoded_ranges": decoded_ranges,
    "frames_per_video": frames_per_video,
    "frame_id_from_path": frame_id_from_path,
    "raw_features": raw_features,
    "duplicate_keys": duplicate_keys,
    "unscored_frames": unscored_frames,
    "scored_boxes": scored_boxes,
    "detections_provenance": detections_provenance,
    "upsert_frames": upsert_frames,
    "upsert_frames_table": upsert_frames_table,
    "snapshot_changes": snapshot_changes,
    "snapshot_feed": snapshot_feed,
    "detections_metrics": detections_metrics,
    "detections_summary": detections_summary,
    "confs_classes": confs_classes,
    "boxes_filtered": boxes_filtered,
    "boxes_nms": boxes_nms,
    "boxes_topk": boxes_topk,
    "boxes_postprocessed": boxes_postprocessed,
    "box_totals": box_totals,
    "box_contract": box_contract,
    "model_features": model_features,
    "model_features_merged": model_features_merged,
    "predict_contract": predict_contract,
    "scoring_failures": scoring_failures,
    "pending_count": pending_count,
    "run_metrics": run_metrics,
    "runs_ranked": runs_ranked,
    "run_versions": run_versions,
    "registered_versions": registered_versions,
    "logged_runs": logged_runs,
    "latest_run": latest_run,
    "champion_metric": champion_metric,
    "promotion_gate": promotion_gate,
    "promotion_by_experiment": promotion_by_experiment,
    "alias_moves": alias_moves,
    "decision_tags": decision_tags,
    "baseline_window": baseline_window,
    "daily_profile": daily_profile,
    "drift_vs_baseline": drift_vs_baseline,
    "drift_flags": drift_flags,
    "monitor_refresh": monitor_refresh,
    "incremental_scoring": incremental_scoring,
}
