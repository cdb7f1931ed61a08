"""Registered queries of the training-data operators: ``opN_<name>(spark, sf_dir)``.

Each applies its operator, with production parameters, to its whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from framelake.llm import decontam, dedup, lm, merkle, spm, urls, warc
from framelake.llm.html import extract_text
from framelake.llm.jaccard import jaccard_components
from framelake.llm.langid import identify
from framelake.llm.quality import quality_scores
from framelake.llm.rulescore import quality_rules
from framelake.llm.spelling import spelling_groups
from framelake.llm.staging import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sentencepiece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of every document, with inclusion scores and decoded digests."""
    return spm.segmentation_digests(table(spark, sf_dir, "documents"))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 4-word shingle sets have Jaccard 0.85 or more."""
    return jaccard_components(table(spark, sf_dir, "documents"), k=4, percent=85)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by rank-order profiles."""
    docs = table(spark, sf_dir, "documents")
    return identify(docs, docs)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of identical texts; the largest doc_id of each stays."""
    return dedup.exact_dedup(table(spark, sf_dir, "documents"), keep="max")


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside 10-word windows of benchmark items."""
    return decontam.digest_columns(decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), size=10))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document by a sparse rule ensemble."""
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))[0]


def op7_stupid_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stupid-backoff score of every document under the trigram counts of all other documents."""
    return lm.lm_scores(table(spark, sf_dir, "documents"), leave_out=True)


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract_text(table(spark, sf_dir, "pages"))


def op9_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives with revisits, and read back by the salvage reader."""
    path = scratch_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.page_records(warc.read_archives(spark, path, payloads=False))


#: Rules of the registered URL filter: verdict, host and path prefix.
URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule or tree verdict of every page's URL."""
    return urls.classify_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word with the frequent word one edit away that it is a variant of."""
    return spelling_groups(table(spark, sf_dir, "documents"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, limits and the boosted trees' verdict of every document."""
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))[0]


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document, checked after some texts lost their line feeds."""
    return merkle.tamper_report(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_sentencepiece_sampling, op2_ngram_jaccard_join, op3_language_id, op4_exact_dedup, op5_benchmark_decontamination,
    op6_quality_classifier, op7_stupid_backoff, op8_html_extraction, op9_warc_salvage, op10_url_filter,
    op11_spelling_variants, op12_quality_rules, op13_merkle_manifest)}

ORACLE: dict[str, str] = {"op4_exact_dedup": dedup.ORACLE_EXACT_DEDUP, "op9_warc_salvage": warc.ORACLE_WARC,
                          "op13_merkle_manifest": merkle.ORACLE_MERKLE}
