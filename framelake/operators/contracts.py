"""Contracts and checks (AGG-8, AGG-9, ARR-9, PRJ-6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.functions import boxes as bx


def require_positive_int(name: str, value) -> int:
    """PRJ-6: stride and similar parameters."""
    if isinstance(value, bool) or not isinstance(value, int) or value <= 0:
        raise ValueError(f"{name} must be a positive integer, got {value!r}")
    return value


def require_names(**names: str) -> None:
    """PRJ-6: non-empty names."""
    empty = [k for k, v in names.items() if not isinstance(v, str) or not v.strip()]
    if empty:
        raise ValueError(f"required and must be non-empty: {', '.join(empty)}")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """AGG-9: keys occurring more than once, with their count (partial aggregation)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def check_keys(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise when a key is NULL or not unique (the precondition of a clean upsert)."""
    keys = list(keys)
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    bad = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") > 1) | null_key)
    offending = bad.limit(1).collect()
    if offending:
        raise ValueError(f"source keys {keys} must be unique and non-null; offending key: {offending[0].asDict()}")


def row_count_check(inp: DataFrame, out: DataFrame, key: str) -> DataFrame:
    """AGG-8: counts in / out and rows whose key is missing on the other side, from one full outer join of the key counts."""
    a = inp.groupBy(key).agg(F.count(F.lit(1)).alias("a"))
    b = out.groupBy(key).agg(F.count(F.lit(1)).alias("b"))

    def total(c, when=None):
        return F.coalesce(F.sum(c if when is None else F.when(when, F.col(c))), F.lit(0)).cast("long")

    return a.join(b, key, "full_outer").agg(
        total("a").alias("n_in"), total("b").alias("n_out"), total("a", F.col("b").isNull()).alias("n_lost"),
        total("b", F.col("a").isNull()).alias("n_extra"),
    )


def box_contract(df: DataFrame, boxes: str = "boxes") -> DataFrame:
    """ARR-9: schema check and counts of frames / boxes / invalid boxes."""
    type_ok = bx.boxes_type_ok(df, boxes)
    # Field-level checks need the contract's fields; a wrong type reports NULL there.
    invalid = F.sum(bx.n_invalid(boxes)).cast("long") if type_ok else F.lit(None).cast("long")
    return df.agg(
        F.count(F.lit(1)).alias("n_frames"),
        F.count_if(F.col(boxes).isNull()).alias("n_null_frames"),
        F.sum(bx.n_detections(boxes)).cast("long").alias("n_boxes"),
        invalid.alias("n_invalid_boxes"),
    ).withColumn("schema_ok", F.lit(type_ok))
