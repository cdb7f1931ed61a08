"""Incremental, vectorized scoring (UDF-1..4, JOI-1, JOI-5, PRJ-2..4, STR-1 batch form).

The model runs inside an Arrow-batched iterator pandas UDF: it is loaded once per
Python worker (cached at module level, reused across tasks with worker reuse),
never broadcast. A predictor scores a whole batch at once; only when the batch
fails is it retried row by row, so one bad frame costs one empty result, not the
batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelake.functions import ids
from framelake.schemas import BOX_FIELDS, BOXES_DDL, BOXES_TYPE, DETECTIONS_COLUMNS, FRAME_KEY, SCORING_INPUT_COLUMNS

# Per worker process: model key -> loaded model.
_WORKER_MODELS: dict[str, Any] = {}


class Predictor:
    """Scoring contract: ``load`` once per worker, ``predict`` a batch of inputs.

    ``predict(model, inputs)`` returns one list of box dicts per input, in order.
    """

    key = "predictor"

    def load(self) -> Any:  # pragma: no cover - interface
        return None

    def predict(self, model: Any, inputs: pd.Series) -> list[list[dict]]:  # pragma: no cover - interface
        raise NotImplementedError


class VectorBoxPredictor(Predictor):
    """Stand-in detector over vectors: every 4 values are a box (x1, y1, x2, y2) with
    conf = |y2| and cls = (x2 > 0); boxes below ``min_conf`` are dropped. All values are used."""

    # --- fixed value of the stand-in detector ---
    VALUES_PER_BOX = 4

    def __init__(self, min_conf: float = 0.10):
        self.min_conf = float(min_conf)
        self.key = f"vector-box:{self.min_conf}"

    def load(self) -> Any:
        return {"min_conf": self.min_conf}

    def predict(self, model: Any, inputs: pd.Series) -> list[list[dict]]:
        b = np.concatenate([np.asarray(v, dtype=np.float32).reshape(-1, self.VALUES_PER_BOX) for v in inputs])  # raises on NULL rows
        image = np.repeat(np.arange(len(inputs)), [len(v) // self.VALUES_PER_BOX for v in inputs])
        conf = np.abs(b[:, 3])
        keep = conf.astype(np.float64) >= model["min_conf"]
        cols = [*b[keep].T, conf[keep], (b[keep, 2] > 0).astype(np.int32)]
        found = [dict(zip(BOX_FIELDS, box)) for box in zip(*(c.tolist() for c in cols))]
        ends = np.searchsorted(image[keep], np.arange(len(inputs) + 1))
        return [found[s:e] for s, e in zip(ends[:-1], ends[1:])]


def _model(predictor: Predictor) -> Any:
    if predictor.key not in _WORKER_MODELS:
        _WORKER_MODELS[predictor.key] = predictor.load()
    return _WORKER_MODELS[predictor.key]


def _predict_isolated(predictor: Predictor, model: Any, inputs: pd.Series) -> tuple[list, list]:
    """Batch first; on failure, row by row (UDF-3). Returns (boxes, errors)."""
    try:
        res = predictor.predict(model, inputs)
        if len(res) != len(inputs):
            raise ValueError("predictor changed the row count")
        return list(res), [None] * len(inputs)
    except Exception:
        boxes, errors = [], []
        for i in range(len(inputs)):
            try:
                one = predictor.predict(model, inputs.iloc[i : i + 1])
                boxes.append(one[0])
                errors.append(None)
            except Exception as exc:  # noqa: BLE001 - isolation is the contract
                boxes.append([])
                errors.append(f"{type(exc).__name__}: {exc}")
        return boxes, errors


def detect_udf(predictor: Predictor, with_errors: bool = False):
    """UDF-1 / UDF-2 / UDF-3: Arrow-batched scoring UDF returning ``boxes``.

    With ``with_errors`` the result is ``struct<boxes, error>`` so failed frames
    can be counted, while still scoring as empty boxes.
    """
    if with_errors:
        rtype = T.StructType([T.StructField("boxes", BOXES_TYPE), T.StructField("error", T.StringType())])

        @F.pandas_udf(rtype)
        def detect_err(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            model = _model(predictor)
            for s in batches:
                boxes, errors = _predict_isolated(predictor, model, s)
                yield pd.DataFrame({"boxes": boxes, "error": errors}, index=s.index)

        return detect_err

    @F.pandas_udf(BOXES_DDL)
    def detect(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = _model(predictor)
        for s in batches:
            boxes, _ = _predict_isolated(predictor, model, s)
            yield pd.Series(boxes, index=s.index)

    return detect


def unscored(
    frames: DataFrame, scored: DataFrame | None = None, rescore_on: tuple[str, ...] = (FRAME_KEY,)
) -> DataFrame:
    """JOI-1 / PRJ-2: frames not yet scored; all frames when there is no target yet.

    A left anti join on the key (placed before the UDF, so scored frames never reach
    Python). ``rescore_on=("frame_id", "model_version")`` re-scores frames for a
    new model version (the target must then carry model_version).
    """
    cols = [c for c in SCORING_INPUT_COLUMNS if c in frames.columns] + [
        c for c in frames.columns if c not in SCORING_INPUT_COLUMNS
    ]
    f = frames.select(*cols)
    if scored is None:
        return f
    return f.join(scored.select(*rescore_on), list(rescore_on), "left_anti")


def score(frames: DataFrame, input_col: str, predictor: Predictor, out: str = "boxes", error_col: str | None = None) -> DataFrame:
    """UDF-1: add the nested ``boxes`` column scored from ``input_col``."""
    if error_col:
        s = frames.withColumn("_scored", detect_udf(predictor, with_errors=True)(F.col(input_col)))
        return s.withColumn(out, F.col("_scored.boxes")).withColumn(error_col, F.col("_scored.error")).drop("_scored")
    return frames.withColumn(out, detect_udf(predictor)(F.col(input_col)))


def with_provenance(scored: DataFrame, model_version: Column | str, alias: str) -> DataFrame:
    """PRJ-4: provenance columns and the fixed detections column order."""
    mv = F.lit(model_version) if isinstance(model_version, str) else model_version
    return scored.withColumns(
        {"model_version": mv.cast("string"), "inferred_at": ids.now(), "alias_used": F.lit(alias)}
    ).select(*DETECTIONS_COLUMNS)


def with_resolved_version(scored: DataFrame, aliases: DataFrame, name: str, alias: str) -> DataFrame:
    """JOI-5 + PRJ-4: resolve ``name@alias`` in the plan and stamp every row with it.

    The lookup is one key of the alias table, attached as a scalar subquery (no
    join; Spark fails the query if the key held two rows). An unknown alias fails the query.
    """
    version = aliases.filter((F.col("name") == name) & (F.col("alias") == alias)).select("version").scalar()
    unknown = F.raise_error(F.lit(f"alias {name}@{alias} does not exist")).cast("string")
    return with_provenance(scored, F.coalesce(version, unknown), alias)


def predict_frames(frames: DataFrame, predictor: Predictor, path_col: str = "path") -> DataFrame:
    """UDF-4: the batch predict contract - ``path`` (+ optional ``frame_id``) in,
    exactly ``frame_id, boxes, confs, classes`` out, one row per input row.

    frame_id falls back to the file's base name without extension (SCL-3).
    """
    fid = F.col("frame_id") if "frame_id" in frames.columns else F.lit(None).cast("string")
    inp = frames.select(F.col(path_col).alias("path"), ids.frame_id_from_path(fid, path_col).alias("frame_id"))
    scored = inp.withColumn("boxes", detect_udf(predictor)(F.col("path")))
    from framelake.functions import boxes as bx

    return scored.select("frame_id", "boxes", bx.confs("boxes").alias("confs"), bx.classes("boxes").alias("classes"))


def spread_for_model(todo: DataFrame, rows_per_task: int, pending: int | None = None) -> DataFrame:
    """Give the scoring UDF a bounded number of frames per task.

    AQE sizes partitions by bytes, and a frame row (a path) is tiny while its model
    call is not, so after the anti join a single task could receive hundreds of
    thousands of frames. Here the pending count (computed anyway to skip empty
    runs) fixes the partition count instead.
    """
    n = todo.count() if pending is None else pending
    return todo.repartition(max(1, -(-n // int(rows_per_task))), FRAME_KEY)


def incremental_pass(
    frames: DataFrame,
    detections: DataFrame | None,
    input_col: str,
    predictor: Predictor,
    model_version: str,
    alias: str,
    rows_per_task: int | None = None,
) -> DataFrame:
    """STR-1 (one pass): score only the frames missing from ``detections``.

    With ``rows_per_task`` the pending frames are spread to that many per task
    before the model runs (one count job, as the reference also counts first).
    """
    todo = unscored(frames, detections)
    if rows_per_task:
        todo = spread_for_model(todo, rows_per_task)
    return with_provenance(score(todo, input_col, predictor), model_version, alias)


def pending_count(frames: DataFrame, scored: DataFrame | None = None) -> int:
    """AGG-1: number of frames still to score (partial + final count, no UDF in it)."""
    return unscored(frames, scored).count()
