"""Quality classifier: a sparse ensemble of rules over text statistics.

Every whole text is reduced to a row of statistics. From a bounded sample of labelled rows, shallow
randomised trees are grown; each path of a tree is a rule (a conjunction of thresholds). A logistic model
with an L1 penalty weighs the rules, which leaves most at zero, and the remaining ones
are compiled into one Spark column expression that scores all rows inside generated code.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelake.llm.langid import held_out
from framelake.llm.staging import staged
from framelake.llm.tokens import NON_BLANK, U, byte_class, column_bytes, mix, slices, windows, words_of
from framelake.llm.trees import all_of, paths

SAMPLE_ROWS = 20_000
N_TREES, DEPTH, L1 = 12, 3, 0.003
KEEP_AT = 0.7

STATS = ["log_words", "word_len", "longest_word", "upper_share", "digit_share", "symbol_share", "mark_share", "blank_share",
         "distinct_words", "distinct_pairs", "top_word", "repeated_word", "line_words", "repeated_lines"]

_LOWER, _UPPER, _DIGIT, _BLANK, _MARK, _SYMBOL, _HIGH = range(7)
_KIND = np.full(256, _SYMBOL, dtype=np.int64)
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[128:] = _LOWER, _UPPER, _DIGIT, _HIGH
for _b in b" \t\n\r\x0b\x0c":
    _KIND[_b] = _BLANK
for _b in b".,;:?'\"()-":
    _KIND[_b] = _MARK
_LINE = byte_class((0x0A, 0x0D))


def _distinct(doc: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and the largest count of one value, per document."""
    if not len(h):
        return np.zeros(n), np.zeros(n)
    key = np.sort((doc.astype(U) << U(40)) | (h >> U(24)))
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    own, cnt = (key[first] >> U(40)).astype(np.int64), np.diff(np.append(first, len(key)))
    top = np.zeros(n, dtype=np.int64)
    np.maximum.at(top, own, cnt)
    return np.bincount(own, minlength=n), top


def text_statistics(col: pa.Array) -> np.ndarray:
    """A row of ``STATS`` for each text; null and empty texts get zeros."""
    raw, at = column_bytes(col)
    n = len(at) - 1
    doc_of = np.repeat(np.arange(n), np.diff(at))
    kind = np.bincount(doc_of * 7 + _KIND[raw], minlength=7 * n).reshape(n, 7)
    size = np.maximum(np.diff(at), 1)
    letters = np.maximum(kind[:, _LOWER] + kind[:, _UPPER], 1)
    w = words_of(col, NON_BLANK)
    doc, cnt = w.doc_of_word(), w.count()
    some = np.maximum(cnt, 1)
    length = w.end - w.start
    longest = np.zeros(n, dtype=np.int64)
    np.maximum.at(longest, doc, length)
    distinct, top = _distinct(doc, w.hash, n)
    inside = doc[1:] == doc[:-1]
    pairs, _ = _distinct(doc[:-1][inside], windows(w.hash, 2)[inside], n)
    again = np.bincount(doc[1:][inside & (w.hash[1:] == w.hash[:-1])], minlength=n)
    lines = words_of(col, _LINE)
    n_lines = np.maximum(lines.count(), 1)
    one_each, _ = _distinct(lines.doc_of_word(), lines.hash, n)
    return np.stack([np.log1p(cnt), np.bincount(doc, weights=length, minlength=n) / some, longest, kind[:, _UPPER] / letters,
                     kind[:, _DIGIT] / size, kind[:, _SYMBOL] / size, kind[:, _MARK] / size, kind[:, _BLANK] / size,
                     distinct / some, pairs / np.maximum(cnt - 1, 1), top / some, again / some, cnt / n_lines,
                     1 - one_each / n_lines * (lines.count() > 0) - (lines.count() == 0)], axis=1).astype(np.float64)


def _stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "text"):
        x = text_statistics(b.column("text"))
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(x[:, j]) for j in range(len(STATS)))], names=["doc_id", *STATS])


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the statistics of each whole text."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _stats, "doc_id long, " + ", ".join(f"{c} double" for c in STATS))


@dataclass
class RuleModel:
    """An intercept and weighted rules; ``score`` is their logistic sum as a column."""

    intercept: float
    rules: list[tuple[float, tuple]]

    def score(self) -> Column:
        total = F.lit(self.intercept)
        for weight, conds in self.rules:
            total = total + F.when(all_of(conds), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    def describe(self) -> list[str]:
        return [f"{w:+.3f} if " + " and ".join(f"{c.feature} {'<=' if c.below else '>'} {c.threshold:.4g}" for c in conds)
                for w, conds in sorted(self.rules, key=lambda r: -abs(r[0]))]


def fit_rules(sample: DataFrame, n_trees: int = N_TREES, depth: int = DEPTH, l1: float = L1) -> RuleModel:
    """Fit on rows of ``STATS`` and ``label`` (0 or 1). Without both classes the score is constant: the share of 1
    kept inside 0.01 to 0.99, or 0.99 without any row, so that nothing is rejected where nothing was learned."""
    n, ones = sample.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if ones == 0 or ones == n:
        p = 0.99 if n == 0 else min(max(ones / n, 0.01), 0.99)
        return RuleModel(float(np.log(p / (1 - p))), [])
    x = VectorAssembler(inputCols=STATS, outputCol="features").transform(sample)
    forest = RandomForestClassifier(labelCol="label", numTrees=n_trees, maxDepth=depth, seed=11, subsamplingRate=0.7,
                                    featureSubsetStrategy="0.5").fit(x)
    rules = list(dict.fromkeys(p for t in forest.trees for p in paths(t, STATS)))
    names = [f"r{i}" for i in range(len(rules))]
    fired = sample.select("label", *(all_of(r).cast("double").alias(c) for r, c in zip(rules, names)))
    fired = staged(VectorAssembler(inputCols=names, outputCol="features").transform(fired).select("label", "features"), "rules")
    lasso = LogisticRegression(labelCol="label", elasticNetParam=1.0, regParam=l1, standardization=False, maxIter=60).fit(fired)
    kept = [(float(w), r) for w, r in zip(lasso.coefficients, rules) if abs(w) > 1e-6]
    return RuleModel(float(lasso.intercept), kept)


def quality_scores(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> tuple[DataFrame, RuleModel]:
    """One row per document, ``doc_id, held_out, score, predicted``, and the fitted model.

    ``labels`` has ``doc_id`` and ``quality`` (0 or 1). Learning uses labelled rows that are not held out: all, or
    if there are more, about ``sample_rows`` chosen by a hash of the id (a documented bound). The
    score uses the text alone. Null and empty texts are scored as texts without words. Labels that
    repeat count once (by majority); null ones are ignored; a table without both classes gives a
    constant score (see :func:`fit_rules`). Other columns are ignored.
    """
    stats = staged(statistics(docs), "statistics")
    marks = (labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg((F.avg("quality") >= 0.5).cast("double").alias("label")))
    usable = stats.where(~held_out(F.col("doc_id"))).join(marks, "doc_id")
    total = usable.count()
    if total > sample_rows:
        usable = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * sample_rows / total))
    sample = staged(usable.select("label", *STATS).repartition(2), "sample")
    model = fit_rules(sample)
    score = model.score()
    return stats.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"),
                        (score >= KEEP_AT).cast("int").alias("predicted")), model


def keep_good(docs: DataFrame, scores: DataFrame) -> DataFrame:
    """``docs`` without the documents that the scores reject."""
    bad = scores.where("predicted = 0").select(F.col("doc_id").alias("bad_id"))
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["bad_id"]), "left_anti")
