"""File and table sources (SRC-1..SRC-7).

Listing goes through Spark's ``binaryFile`` source with only path metadata
selected, so file contents are never read. Decoding is distributed: one task per
video file via ``mapInPandas`` with a pluggable decoder (the codec itself is not
part of this library).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelake.functions import ids
from framelake.operators.frames import listing
from framelake.session import materialize

DECODED_SCHEMA = T.StructType(
    [
        T.StructField("video_id", T.StringType(), False),
        T.StructField("frame_number", T.LongType(), False),
        T.StructField("pos_ms", T.DoubleType()),
        T.StructField("width", T.IntegerType()),
        T.StructField("height", T.IntegerType()),
    ]
)

CHUNK_FRAMES = 10_000
#: Waves of tasks that even out long items; see :func:`_most_tasks`.
TASKS_PER_CORE = 16

# decode_fn(path) -> iterable of (frame_number, pos_ms, width, height)
DecodeFn = Callable[[str], Iterable[tuple[int, float, int, int]]]


def list_videos(spark: SparkSession, raw_videos_dir: str) -> DataFrame:
    """SRC-1: supported video files directly inside ``raw_videos_dir``, sorted by name.

    Raises FileNotFoundError for a missing folder. Spark's file sources skip names
    starting with '_' or '.', and do not descend into sub-folders.
    """
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(raw_videos_dir)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.isDirectory(p):
        raise FileNotFoundError(f"Raw videos directory does not exist: {raw_videos_dir}")
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "false")
        .load(raw_videos_dir)
        .select("path", "length", "modificationTime")
    )
    return listing(files, keep=("length",))


def _most_tasks(spark: SparkSession) -> int:
    """How many tasks work items are dealt to at most: waves enough to even out long items, and a number that does
    not grow with the items, as starting a Python task takes longer than decoding a short clip."""
    try:
        cores = spark.sparkContext.defaultParallelism
    except Exception:  # Spark Connect: the server knows its cores
        cores = 0
    return max(TASKS_PER_CORE * cores, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _spread_items(items: DataFrame, tasks: int) -> DataFrame:
    """Deal work items (files, frame ranges; a written table) evenly to ``tasks`` tasks, or to :func:`_most_tasks` if that is fewer.

    A path row is a few bytes, so AQE, which sizes partitions by bytes, would put
    thousands of videos in one task; an explicit count (round robin) prevents that.
    """
    return items.repartition(max(1, min(tasks, _most_tasks(items.sparkSession))))


def _chunks(decoded: Iterable[tuple[str, Iterable[tuple[int, float, int, int]]]]) -> Iterator[pd.DataFrame]:
    """Frames of ``(video_id, frames)`` as tables of ``CHUNK_FRAMES`` rows: a long video is never held whole, and short ones share a table."""
    names = [f.name for f in DECODED_SCHEMA.fields]
    it = ((vid, int(k), float(ms), int(w), int(h)) for vid, frames in decoded for k, ms, w, h in frames)
    while rows := list(islice(it, CHUNK_FRAMES)):
        yield pd.DataFrame(rows, columns=names)


def decode_videos(
    files: DataFrame,
    decode_fn,
    path_col: str = "path",
    frames_per_task: int | None = None,
    count_fn=None,
) -> DataFrame:
    """SRC-2: every decoded frame of every file, decoded on the executors.

    Without ``frames_per_task``: ``decode_fn(path)`` yields
    ``(frame_number, pos_ms, width, height)`` for each frame, numbered from 0, and
    each file is decoded by one task (files are spread over partitions first, one to a task up to :func:`_most_tasks`).

    With ``frames_per_task`` and a seeking decoder, a long video is cut into frame
    ranges so it never becomes one giant task: ``count_fn(path)`` returns the
    frame count, each range ``[start, end)`` is its own row (spread by a shuffle),
    and ``decode_fn(path, start, end)`` yields the frames of that range.
    """
    spread = files.select(F.col(path_col).alias("path"), ids.video_id_from_path(path_col).alias("video_id"))
    if frames_per_task is None:
        # Written once (a few bytes each), so that the listing does not run again for the count or the spread.
        spread = materialize(spread)
        spread = _spread_items(spread, spread.count())

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            yield from _chunks((vid, decode_fn(path)) for pdf in batches for path, vid in zip(pdf["path"], pdf["video_id"]))

        return spread.mapInPandas(run, DECODED_SCHEMA)

    if count_fn is None:
        raise ValueError("frames_per_task needs count_fn(path) -> number of frames")
    step = int(frames_per_task)

    @F.pandas_udf("long")
    def n_frames(paths: pd.Series) -> pd.Series:
        return paths.map(lambda p: int(count_fn(p)))

    # Written once, so each video is opened for its count only once; a video without frames has no range.
    counted = materialize(spread.withColumn("_n", n_frames("path"))).filter(F.col("_n") > 0)
    ranges = counted.select(
        "path", "video_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(step).cast("long"))).alias("start"), "_n"
    ).withColumn("end", F.least(F.col("start") + step, F.col("_n")))
    # No more tasks than there are full ranges of frames, so that short videos share one; dealt evenly, not by the rows' few bytes.
    frames = counted.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    ranges = _spread_items(ranges, -(-frames // step))

    def run_ranges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _chunks((vid, decode_fn(path, int(start), int(end))) for pdf in batches
                           for path, vid, start, end in zip(pdf["path"], pdf["video_id"], pdf["start"], pdf["end"]))

    return ranges.mapInPandas(run_ranges, DECODED_SCHEMA)


def build_frames(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """SRC-3: explicit schema plus the ingest time (no driver-side row list)."""
    from framelake.operators.frames import with_extracted_at

    return with_extracted_at(manifest)


def read_table(spark: SparkSession, name_or_path: str, fmt: str = "parquet") -> DataFrame:
    """SRC-4 / SRC-5 / SRC-6: a catalog table by name, or a path in ``fmt``."""
    if "/" in name_or_path:
        return spark.read.format(fmt).load(name_or_path)
    return spark.table(name_or_path)


def is_empty(df: DataFrame) -> bool:
    """SRC-7: empty-input short circuit before a sink (reads at most one row)."""
    return df.isEmpty()
