"""The pipeline: each stage's decisions against plain Python over its own input."""

import hashlib

import corpus_pipeline
from llm_docs import SF_SMALL, docs, texts  # noqa: F401 (fixtures)
from test_pairs_and_copies import shingles
from test_text_scoring import brute_hits


def test_stages_on_their_own_inputs(spark, tmp_dir):
    sf = SF_SMALL
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    steps = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        out.write.parquet(f"{tmp_dir}/{name}")
        steps[name] = ([tuple(r) for r in docs.select("doc_id", "text").collect()], spark.read.parquet(f"{tmp_dir}/{name}"))
        docs = steps[name][1]
        if name != "tokenize":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]

    before, after = steps["exact_dedup"]
    best = {}
    for d, t in before:
        best[t] = max(best.get(t, -1), d)
    assert {r["doc_id"] for r in after.collect()} == set(best.values())

    before, after = steps["near_dedup"]
    sets = {d: shingles(t, 5) for d, t in before}
    low = {d: d for d in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if b < a and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                ra, rb = low[a], low[b]
                low = {k: min(ra, rb) if v in (ra, rb) else v for k, v in low.items()}
    assert {r["doc_id"] for r in after.collect()} == {d for d, c in low.items() if d == c}

    before, after = steps["decontaminate"]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    assert {r["doc_id"] for r in after.collect()} == {d for d, _, hit, _ in brute_hits(before, items, 10) if hit == 0}

    before, after = steps["tokenize"]
    sha = {d: hashlib.sha256((t or "").encode()).hexdigest() for d, t in before}
    rows = after.collect()
    assert {r["doc_id"] for r in rows} == set(sha) and all(r["decoded_sha256"] == sha[r["doc_id"]] for r in rows)
    assert all(sum(r["doc_id"] == d for r in rows) <= 2 for d in list(sha)[:20])


def test_run_is_the_stages_in_order(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "decontaminate", "tokenize"]
    assert corpus_pipeline.run(spark, SF_SMALL).count() > 0


def test_pipeline_on_awkward_documents(spark, tmp_dir, docs):
    docs.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_dir}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_dir}/benchmark.parquet")
    d = spark.read.parquet(f"{tmp_dir}/documents.parquet")
    n = d.count()
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        d = stage(spark, d, tmp_dir)
        if i == 0:
            assert d.count() == n  # nothing learned, nothing rejected
    assert d.count() > 0


def test_pipeline_on_an_empty_table(spark, tmp_dir):
    d = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        d = stage(spark, d, SF_SMALL)
        assert d.count() == 0
