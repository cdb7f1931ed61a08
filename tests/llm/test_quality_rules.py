"""Document counts against a plain version; the trees' node arrays, constraints and held-out accuracy."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_docs import SF_SMALL, docs, make_docs, texts  # noqa: F401 (fixtures)
from framelake.llm import boosting, rulescore
from framelake.llm.langid import held_out

BLANK = "\x20\x09\x0a\x0b\x0c\x0d"


def brute_counts(text):
    text = text or ""
    words = re.findall(f"[^{BLANK}]+", text)
    lines = [x for x in text.split("\n") if x.strip(BLANK)]
    triples = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(triples)
    inside = {i + k for i, t in enumerate(triples) if often[t] > 1 for k in range(3)}
    n = [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside)]
    return (*n, n[0] < 50 or 100 * n[4] > 50 * n[0])


ODD = [(1, "a a a a b"), (2, "x\n x\nx\n\n \n x\r\nx\r"), (3, "A b c a b c A b c"), (4, "é#ü *$%&|<>     中文"), (5, "w " * 60),
       (6, " ".join(f"w{i}" for i in range(50))), (7, " ".join(f"w{i}" for i in range(49))), (8, "\x0b\x0c"), (9, "a b\na b\nc"), (9, "a b\na b\nc")]


def test_counts_match_brute_force(spark, docs, texts):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    rows = texts + ODD
    got = rulescore.quality_rules(make_docs(spark, rows).repartition(3), labels)[0]
    assert got.columns[:8] == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    want = sorted(((d, *brute_counts(t)) for d, t in rows), key=str)
    assert sorted((tuple(r)[:7] for r in got.collect()), key=str) == want
    assert got.where("kept = base_failed").isEmpty()  # nothing learned: only the limits reject
    assert rulescore.quality_rules(docs.limit(0), labels)[0].count() == 0


def test_registered_tables_and_held_out_accuracy(spark):
    d, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    out, forest = rulescore.quality_rules(d, labels)
    text = {r["doc_id"]: r["text"] for r in d.collect()}
    rows = {r["doc_id"]: r for r in out.collect()}
    assert set(rows) == set(text)
    assert all(tuple(r)[1:7] == brute_counts(text[i]) for i, r in rows.items())
    held = labels.where(held_out(F.col("doc_id"))).collect()
    right = [rows[r["doc_id"]]["score"] >= rulescore.KEEP_AT for r in held if r["quality"] == 1]
    wrong = [rows[r["doc_id"]]["score"] < rulescore.KEEP_AT for r in held if r["quality"] == 0]
    assert np.mean(right) >= 0.97 and np.mean(wrong) >= 0.8
    x = np.array([[r[c] for c in rulescore.SHARES] for r in rulescore.document_counts(d).collect()])
    base = forest.margin(x)
    for j in np.flatnonzero(rulescore.DIRECTION):  # any growth of a constrained share never raises a score
        for more in (1e-4, 0.01, 0.1, 1.0, 10.0):
            y = x.copy()
            y[:, j] += more
            assert (forest.margin(y) <= base + 1e-12).all()


def walk(forest, row):
    """The same trees, one row and one node at a time."""
    total = forest.base
    for at in forest.roots:
        while forest.feature[at] >= 0:
            at = forest.left[at] if row[forest.feature[at]] <= forest.threshold[at] else forest.right[at]
        total += forest.value[at]
    return total


@pytest.mark.parametrize("direction", [[1, -1, 0], [0, 0, 0]])
def test_node_arrays_and_constraints(direction):
    rnd = np.random.default_rng(4)
    x = np.round(rnd.normal(size=(1500, 3)), 2)
    y = (x[:, 0] - x[:, 1] + np.sin(3 * x[:, 2]) + np.sin(5 * x[:, 0]) + rnd.normal(size=1500) > 0).astype(float)
    forest = boosting.fit(x, y, np.array(direction), n_trees=30)
    assert np.allclose(forest.margin(x[:200]), [walk(forest, r) for r in x[:200]])
    assert ((forest.score(x) > 0.5) == y).mean() > 0.75
    grid = np.sort(x[:, 0])
    for j, way in enumerate(direction):
        curve = x[:300, None, :].repeat(40, axis=1)
        curve[:, :, j] = np.linspace(grid[0], grid[-1], 40)
        step = np.diff(forest.margin(curve.reshape(-1, 3)).reshape(300, 40), axis=1)
        assert way == 0 or (step * way >= -1e-12).all()
        assert way != 0 or j != 0 or (step < 0).any()  # unconstrained, the first feature's wiggle is learned


def test_labels_that_teach_nothing(spark):
    d = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    one = spark.createDataFrame([(i, 0) for i in range(50)] + [(None, 1), (60, None), (1, 0)], "doc_id long, quality int")
    assert rulescore.quality_rules(d, one)[0].where("kept").isEmpty()
