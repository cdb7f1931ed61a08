"""Derived tables written once to the shared checkpoint folder.

A staged table is computed once, read by several plans, and survives a lost
executor: the rows are in the folder that ``spark.checkpoint.dir`` names, never on
one machine. Spark's own Parquet writer commits it task by task.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from framelake.session import ensure_checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new shared table and read it back (cuts the lineage)."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(name: str, taken: list[str]) -> str:
    """``name``, with underscores in front until it clashes with no given column."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name = "_" + name
    return name


def partitions_for(spark: SparkSession, size: float, target: int = 16 << 20, most: int = 10_000) -> int:
    """How many partitions a shuffle of ``size`` bytes should have: about ``target`` bytes each, at least
    ``spark.sql.shuffle.partitions``, and ``most`` at most (beyond that, tasks stream more)."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(most, int(size / target) + 1))
