"""STR-1, stream form: new frame files are scored once and upserted.

A file-source stream over the frames folder feeds ``foreachBatch``; each micro
batch goes through the same batch operators (anti join against what is already
stored, score, upsert). The stream's checkpoint lives under the cluster's shared
``spark.checkpoint.dir``, so a restarted or re-run query resumes where it left
off and a lost executor only replays the current micro batch, whose upsert is
idempotent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from framelake.operators.scoring import Predictor, score, spread_for_model, unscored, with_provenance
from framelake.session import checkpoint_path
from framelake.sinks.store import read_path, upsert


def score_new_frames(
    spark: SparkSession,
    frames_dir: str,
    frames_schema: StructType,
    detections_path: str,
    input_col: str,
    predictor: Predictor,
    model_version: str,
    alias: str,
    name: str = "incremental-scoring",
    available_now: bool = True,
    rows_per_task: int | None = None,
    checkpoint: str | None = None,
):
    """Start the stream; with ``available_now`` it processes what exists and stops.

    ``checkpoint`` is the folder of the stream's own state, which a restart must name again; by
    default ``streams/<name>`` below ``spark.checkpoint.dir``.
    """

    def upsert_batch(batch: DataFrame, epoch_id: int) -> None:
        current = read_path(spark, detections_path)
        # A frame listed twice in one micro batch (two files) is one frame: score it once.
        todo = unscored(batch.dropDuplicates(["frame_id"]), current)
        pending = todo.count()
        if pending == 0:
            return
        if rows_per_task:
            todo = spread_for_model(todo, rows_per_task, pending)
        scored = with_provenance(score(todo, input_col, predictor), model_version, alias)
        upsert(spark, detections_path, scored, ["frame_id"])

    stream = spark.readStream.schema(frames_schema).parquet(frames_dir)
    writer = (
        stream.writeStream.foreachBatch(upsert_batch)
        .option("checkpointLocation", checkpoint or checkpoint_path(spark, "streams", name))
        .queryName(name)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
