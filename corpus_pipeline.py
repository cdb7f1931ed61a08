"""Corpus pipeline: quality, exact dedup, near dedup, decontamination, tokens.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir), works on all rows its
predecessor kept and returns a DataFrame that is written as Parquet and read again as the next
stage's ``docs``. All but the last return the columns of ``documents``.

Null, empty and blank texts pass like others (exact dedup keeps one of them). A decision is for a ``doc_id``: rows that
share one are kept or dropped together, except that exact dedup keeps one row per distinct text; rows with a null
``doc_id`` are never near copies of a kept row's id and stay. Without labels nothing is rejected, without a benchmark
nothing is contaminated; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.llm import decontam, dedup, spm
from framelake.llm.jaccard import jaccard_components
from framelake.llm.quality import keep_good, quality_scores
from framelake.llm.staging import staged


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier (fitted on the labelled ones) does not reject."""
    scores, _ = quality_scores(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return keep_good(docs, scores)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each distinct text."""
    return dedup.deduplicate(docs, keep="max")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest doc_id, of each component of near copies (five words, 0.8)."""
    comps = jaccard_components(docs, k=5, percent=80)
    gone = comps.where("component_id <> doc_id").select(F.col("doc_id").alias("gone_id")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any 10-word window (or shorter whole item) of the benchmark."""
    report = decontam.contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), size=10)
    return decontam.drop_contaminated(docs, report)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of each document, told by digests, with the decoded text's digest."""
    return spm.segmentation_digests(docs)


STAGES = [("quality", quality), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("decontaminate", decontaminate),
          ("tokenize", tokenize)]

#: The quality model and the sampled segmentations have no SQL form; tests check each stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
