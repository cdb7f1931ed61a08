"""Expressions over the nested ``boxes`` column (ARR-1..ARR-9).

Everything is a Catalyst higher-order function (transform / aggregate / filter /
exists), so per-frame box work runs inside the JVM with no Python worker and no
shuffle: a frame's boxes live in one row by the data model.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelake.schemas import BOX_FIELDS, BOXES_DDL


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def n_detections(boxes: Column | str) -> Column:
    """ARR-1: number of boxes, NULL or empty -> 0, as INT.

    ``array_size`` is NULL for a NULL array under both ANSI settings (``size`` is
    -1 with ANSI off), so the coalesce always yields 0.
    """
    return F.coalesce(F.array_size(_c(boxes)), F.lit(0)).cast("int")


def conf_sum(boxes: Column | str) -> Column:
    """Sum of ``conf`` in DOUBLE; NULL for a NULL frame."""
    return _fold(boxes, lambda acc: acc["total"])


def _fold(boxes: Column | str, finish) -> Column:
    """One pass over the boxes carrying (total conf, number of boxes)."""
    zero = F.struct(F.lit(0.0).alias("total"), F.lit(0).alias("boxes"))
    return F.aggregate(
        _c(boxes),
        zero,
        lambda acc, b: F.struct((acc["total"] + b["conf"]).alias("total"), (acc["boxes"] + 1).alias("boxes")),
        finish,
    )


def avg_conf(boxes: Column | str) -> Column:
    """ARR-2: mean conf as DOUBLE; 0.0 for a NULL or empty frame."""
    return F.coalesce(_fold(boxes, lambda acc: F.try_divide(acc["total"], acc["boxes"])), F.lit(0.0))


def avg_conf_or_null(boxes: Column | str, digits: int = 3) -> Column:
    """ARR-3: summary mean, rounded; NULL for a NULL or empty frame (no zero guard)."""
    b = _c(boxes)
    total = F.aggregate(b, F.lit(0.0).cast("double"), lambda a, x: a + x["conf"])
    return F.round(F.try_divide(total, F.array_size(b)), digits)


def confs(boxes: Column | str) -> Column:
    """ARR-4: parallel array of conf values."""
    return F.transform(_c(boxes), lambda b: b["conf"])


def classes(boxes: Column | str) -> Column:
    """ARR-4: parallel array of class ids."""
    return F.transform(_c(boxes), lambda b: b["cls"])


def keep_conf(boxes: Column | str, threshold: float) -> Column:
    """ARR-5: keep boxes with conf >= threshold."""
    return F.filter(_c(boxes), lambda b: b["conf"] >= F.lit(threshold))


def sort_boxes(boxes: Column | str) -> Column:
    """Boxes in the total order conf DESC, x1, y1, x2, y2, cls (ties fully broken)."""
    keyed = F.transform(
        _c(boxes),
        lambda b: F.struct(
            (-b["conf"]).alias("k0"),
            b["x1"].alias("k1"),
            b["y1"].alias("k2"),
            b["x2"].alias("k3"),
            b["y2"].alias("k4"),
            b["cls"].alias("k5"),
            b.alias("box"),
        ),
    )
    return F.transform(F.sort_array(keyed, asc=True), lambda k: k["box"])


def _area(b: Column) -> Column:
    return (b["x2"].cast("double") - b["x1"].cast("double")) * (b["y2"].cast("double") - b["y1"].cast("double"))


def _intersection(a: Column, b: Column) -> Column:
    w = F.least(a["x2"].cast("double"), b["x2"].cast("double")) - F.greatest(a["x1"].cast("double"), b["x1"].cast("double"))
    h = F.least(a["y2"].cast("double"), b["y2"].cast("double")) - F.greatest(a["y1"].cast("double"), b["y1"].cast("double"))
    return F.greatest(w, F.lit(0.0)) * F.greatest(h, F.lit(0.0))


def overlaps(a: Column, b: Column, iou: float) -> Column:
    """Same class and IoU strictly above ``iou``, written without a division."""
    inter = _intersection(a, b)
    union = _area(a) + _area(b) - inter
    return (a["cls"] == b["cls"]) & (inter > F.lit(iou) * union)


def nms(boxes: Column | str, iou: float) -> Column:
    """ARR-6: greedy per-class overlap suppression as a fold over the sorted boxes.

    A box is kept unless an already kept box of the same class overlaps it with
    IoU > ``iou``. O(n^2) per frame; frames hold at most a few hundred boxes.
    """
    ordered = sort_boxes(boxes)
    empty = F.filter(ordered, lambda b: F.lit(False))
    return F.aggregate(
        ordered,
        empty,
        lambda acc, b: F.when(F.exists(acc, lambda k: overlaps(k, b, iou)), acc).otherwise(
            F.concat(acc, F.array(b))
        ),
    )


def top(boxes: Column | str, k: int) -> Column:
    """ARR-7: the ``k`` best boxes in the total order."""
    return F.slice(sort_boxes(boxes), 1, k)


def detector_postprocess(boxes: Column | str, conf: float, iou: float, max_boxes: int) -> Column:
    """ARR-5 -> ARR-6 -> ARR-7 in the detector's order: threshold, suppress, cap."""
    return top(nms(keep_conf(boxes, conf), iou), max_boxes)


def invalid_box(b: Column) -> Column:
    """ARR-9 predicate for one box: missing field, conf outside [0, 1], or inverted corners."""
    missing = b["x1"].isNull() | b["y1"].isNull() | b["x2"].isNull() | b["y2"].isNull()
    missing = missing | b["conf"].isNull() | b["cls"].isNull()
    bad = (b["conf"] < 0) | (b["conf"] > 1) | (b["x2"] < b["x1"]) | (b["y2"] < b["y1"])
    return F.coalesce(missing | bad, F.lit(True))


def n_invalid(boxes: Column | str) -> Column:
    """ARR-9: number of boxes breaking the contract in a frame (NULL frame -> 0)."""
    return F.coalesce(F.array_size(F.filter(_c(boxes), invalid_box)), F.lit(0))


def boxes_type_ok(df: DataFrame, col: str = "boxes") -> bool:
    """ARR-9: the column has exactly the contract type (field names, order and types)."""
    return df.schema[col].dataType.simpleString() == BOXES_DDL


def flatten(df: DataFrame, boxes: str, keep: list[str], pos: str = "pos") -> DataFrame:
    """ARR-8: one row per box with its list position; a frame without boxes keeps one row of NULLs."""
    exploded = df.select(*keep, F.posexplode_outer(boxes).alias(pos, "_box"))
    return exploded.select(*keep, pos, *[F.col("_box")[f].alias(f) for f in BOX_FIELDS])
