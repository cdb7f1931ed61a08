"""Exact deduplication by a tree merge of digest runs (DataFrame operations only).

Each input partition makes one run: a row per distinct digest with its best identifier and its
row count. Runs then meet in binomial rounds: in round ``r`` the runs whose numbers agree after
dropping ``r * log2(fan_in)`` bits are merged, and each digest keeps the best identifier of the
merged runs. A hot digest thus has one row per run after the first level and ``fan_in`` times
fewer after each round. Every merge is dealt by (digest, run group), so a round is spread over
all tasks and no run is ever gathered in one. Answers go back the same way: the winners meet the
first-level runs (one row per digest and run), and these meet the rows of their own run.

Digests are verified at every level: rows merge only if the SHA-256, the byte length and a second,
unrelated 64-bit hash all agree.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelake.llm.staging import free_name, staged

_KEY = ["sha", "n_bytes", "second"]


def _order(keep: str) -> Column:
    """What the best row has most of: null identifiers come last, equal ones go by row number."""
    if keep == "max":
        return F.struct("id", "seq")
    return F.struct(F.col("id").isNotNull().alias("has"), (-F.col("id")).alias("low"), (-F.col("seq")).alias("seq_low"), "id", "seq")


def digests(docs: DataFrame) -> DataFrame:
    """``id, run, seq`` and the verified digest of every row's whole text (null is empty)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("id"), F.spark_partition_id().alias("run"),
                       F.monotonically_increasing_id().alias("seq"), F.unhex(F.sha2(text, 256)).alias("sha"),
                       F.octet_length(text).alias("n_bytes"), F.xxhash64(text).alias("second"))


def merge_rounds(runs: DataFrame, n_runs: int, fan_in: int) -> DataFrame:
    """Merge runs, ``fan_in`` neighbours at a time, until each digest has one row."""
    for _ in range(max(0, math.ceil(math.log(max(n_runs, 1), fan_in) - 1e-9))):
        runs = (runs.withColumn("run", F.floor(F.col("run") / fan_in).cast("int"))
                .groupBy(*_KEY, "run").agg(F.max("best").alias("best"), F.sum("size").alias("size")))
    return runs


def exact_dedup(docs: DataFrame, keep: str = "max", fan_in: int = 16) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    ``docs`` has ``doc_id`` and ``text``; other columns are ignored. Texts are equal when identical; null
    counts as the empty text. Of equal texts the row with the largest (``keep="max"``) or smallest
    ``doc_id`` stays; a null ``doc_id`` loses to any other, and of repeated rows with one ``doc_id`` exactly
    one is kept. An empty table gives an empty result.
    """
    if keep not in ("max", "min") or fan_in < 2:
        raise ValueError("keep is 'max' or 'min', fan_in at least 2")
    rows = staged(digests(docs), "digests")
    n_runs = (rows.agg(F.max("run")).first()[0] or 0) + 1
    first = rows.groupBy(*_KEY, "run").agg(F.max(_order(keep)).alias("best"), F.count("*").alias("size"))
    winners = merge_rounds(first, n_runs, fan_in).select(*_KEY, F.col("best.id").alias("keep_id"), F.col("best.seq").alias("keep_seq"), "size")
    down = first.select(*_KEY, "run").join(winners, _KEY)
    out = rows.join(down, [*_KEY, "run"])
    return out.select(F.col("id").alias("doc_id"), "keep_id", F.col("size").alias("group_size"),
                      (F.col("seq") == F.col("keep_seq")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


def deduplicate(docs: DataFrame, keep: str = "max", fan_in: int = 16) -> DataFrame:
    """The rows of ``docs`` that :func:`exact_dedup` keeps, with all their columns."""
    sha, kid, ksha = (free_name(c, docs.columns) for c in ("sha_", "kept_id_", "kept_sha_"))
    kept = exact_dedup(docs, keep, fan_in).where("kept").select(F.col("doc_id").alias(kid), F.unhex("text_sha256").alias(ksha))
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    tagged = docs.withColumn(sha, F.unhex(F.sha2(text, 256)))
    same = tagged.join(kept, tagged[sha].eqNullSafe(kept[ksha]) & tagged["doc_id"].eqNullSafe(kept[kid]), "left_semi")
    return same.dropDuplicates([sha, "doc_id"]).select(*docs.columns)


ORACLE_EXACT_DEDUP = """
with t as (select doc_id, coalesce(text, '') as body from documents)
select doc_id, max(doc_id) over (partition by body) as keep_id,
       count(*) over (partition by body) as group_size,
       doc_id = max(doc_id) over (partition by body) as kept,
       sha256(body) as text_sha256
from t
"""
