"""Quality rules: fixed limits first, boosted trees over document statistics for the rest.

Every whole text is reduced to counts (words, symbols, repeated lines, words in repeated windows) and shares. Two limits reject
outright. The verdict on the others is that of gradient-boosted trees, fitted on a bounded sample of labelled rows and flattened into node
arrays that score a whole batch at once. More symbols, repeated lines or repeated windows can never raise a
document's score: the trees are constrained in these three shares.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.llm import boosting
from framelake.llm.langid import held_out
from framelake.llm.staging import staged
from framelake.llm.tokens import NON_BLANK, Words, byte_class, slices, windows, words_of

SAMPLE_ROWS = 20_000
KEEP_AT = 0.5
WINDOW = 3
# Fixed values of the limits.
LEAST_WORDS, MOST_REPEAT_PERCENT = 50, 50
SYMBOLS = "#*$%&|<>"

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SHARES = ["symbol_share", "dup_line_share", "repeat_share", "log_words", "word_length", "upper_share", "digit_share", "mark_share",
          "closed_lines", "line_words", "distinct_words", "top_word"]
#: Shares that can only lower the score as they grow.
DIRECTION = np.array([-1, -1, -1] + [0] * (len(SHARES) - 3))

_LINE = byte_class((0x0A, 0x0A))


def _flags(chars: str) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(chars.encode())] = True
    return out


_SYMBOL, _MARK, _CLOSE = _flags(SYMBOLS), _flags(".,;:?!'\"()-"), _flags(".!?\"'")
_UPPER, _DIGIT = _flags("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _flags("0123456789")
_OPENS = (np.arange(256) & 0xC0) != 0x80  # first byte of a code point


def _again(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For values in order of place: whether an equal one of the same document stands earlier, and how often the value occurs there."""
    order = np.lexsort((np.arange(len(h)), h, doc))
    d, v = doc[order], h[order]
    new = np.ones(len(v), dtype=bool)
    new[1:] = (v[1:] != v[:-1]) | (d[1:] != d[:-1])
    first = np.flatnonzero(new)
    times = np.diff(np.append(first, len(v)))
    earlier, count = np.zeros(len(v), dtype=bool), np.zeros(len(v), dtype=np.int64)
    earlier[order] = ~new
    count[order] = np.repeat(times, times)
    return earlier, count


def _per_doc(w: Words, flags: np.ndarray) -> np.ndarray:
    run = np.concatenate([[0], np.cumsum(flags[w.buf])])
    return run[w.doc_start[1:]] - run[w.doc_start[:-1]]


def text_counts(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A row of ``COUNTS`` and a row of ``SHARES`` for each text; null and empty texts get zeros."""
    w = words_of(col, NON_BLANK, lower=False)
    n, doc, n_words = w.docs, w.doc_of_word(), w.count()
    opens = np.concatenate([[0], np.cumsum(_OPENS[w.buf])])
    word_chars = np.bincount(doc, weights=opens[w.end] - opens[w.start], minlength=n).astype(np.int64)

    lines = words_of(col, _LINE, lower=False)
    solid = np.concatenate([[0], np.cumsum(NON_BLANK[lines.buf])])
    real = solid[lines.end] > solid[lines.start]
    line_doc = lines.doc_of_word()[real]
    earlier, _ = _again(line_doc, lines.hash[real])
    n_dup_lines = np.bincount(line_doc[earlier], minlength=n)
    n_lines = np.bincount(line_doc, minlength=n)
    # The last non-blank byte of a line closes it.
    last = np.flatnonzero(NON_BLANK[lines.buf])[solid[lines.end[real]] - 1] if real.any() else np.zeros(0, np.int64)
    closed = np.bincount(line_doc[_CLOSE[lines.buf[last]]], minlength=n)

    covered = np.zeros(len(doc), dtype=bool)
    if len(doc) >= WINDOW:
        inside = np.flatnonzero(doc[WINDOW - 1:] == doc[:1 - WINDOW])
        _, times = _again(doc[inside], windows(w.hash, WINDOW)[inside])
        for k in range(WINDOW):
            covered[inside[times > 1] + k] = True
    n_repeat_words = np.bincount(doc[covered], minlength=n)
    earlier_word, times = _again(doc, w.hash)
    distinct = np.bincount(doc[~earlier_word], minlength=n)
    top = np.zeros(n, dtype=np.int64)
    np.maximum.at(top, doc, times)

    counts = np.stack([n_words, word_chars, _per_doc(w, _SYMBOL), n_dup_lines, n_repeat_words], axis=1).astype(np.int64)
    some_chars, some_words, some_lines = (np.maximum(v, 1) for v in (word_chars, n_words, n_lines))
    shares = np.stack([counts[:, 2] / some_chars, n_dup_lines / some_lines, n_repeat_words / some_words, np.log1p(n_words),
                       word_chars / some_words, _per_doc(w, _UPPER) / some_chars, _per_doc(w, _DIGIT) / some_chars,
                       _per_doc(w, _MARK) / some_chars, closed / some_lines, n_words / some_lines, distinct / some_words,
                       top / some_words], axis=1)
    return counts, shares


def _stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "text"):
        counts, shares = text_counts(b.column("text"))
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(c) for c in counts.T), *(pa.array(c) for c in shares.T)],
                                         names=["doc_id", *COUNTS, *SHARES])


def document_counts(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``COUNTS`` and ``SHARES`` of each whole text."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _stats, ", ".join(["doc_id long", *(f"{c} long" for c in COUNTS), *(f"{c} double" for c in SHARES)]))


def fit_forest(sample: pa.Table) -> boosting.Forest:
    """Trees from a bounded sample of ``SHARES`` and ``label``. Without rows nothing is rejected (score 0.99); with one class
    the score is its share, kept inside 0.01 to 0.99."""
    y = sample.column("label").to_numpy()
    if len(y) == 0 or y.min() == y.max():
        return boosting.constant(0.99 if len(y) == 0 else float(np.clip(y.mean(), 0.01, 0.99)))
    x = np.stack([sample.column(c).to_numpy() for c in SHARES], axis=1)
    return boosting.fit(x, y, DIRECTION)


def _judge(forest: boosting.Forest):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            count = {c: b.column(c).to_numpy() for c in COUNTS}
            failed = (count["n_words"] < LEAST_WORDS) | (100 * count["n_repeat_words"] > MOST_REPEAT_PERCENT * count["n_words"])
            score = forest.score(np.stack([b.column(c).to_numpy() for c in SHARES], axis=1))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(b.column(c) for c in COUNTS), pa.array(failed),
                                              pa.array(~failed & (score >= KEEP_AT)), pa.array(score)],
                                             names=["doc_id", *COUNTS, "base_failed", "kept", "score"])

    return run


def quality_rules(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> tuple[DataFrame, boosting.Forest]:
    """One row per document, ``doc_id``, ``COUNTS``, ``base_failed``, ``kept`` and ``score``, and the fitted trees.

    Words are runs of non-blank characters, case kept. ``word_chars`` counts code points in words, ``n_symbols`` the
    characters ``#*$%&|<>``, ``n_dup_lines`` the lines (cut at line feeds, with a word) equal to an earlier one, ``n_repeat_words``
    the words inside three-word windows that the text has twice or more. ``base_failed``: fewer than 50 words, or
    over half of them in such windows. ``kept``: not failed, and a score of 0.5 or more.

    ``labels`` has ``doc_id`` and ``quality`` (0 or 1). The trees learn from the labelled rows that are not held out; if there are more
    than ``sample_rows``, from about so many, chosen by a hash of the id (a documented bound on what is fitted). Labels that repeat
    count once, by majority; null ones are ignored. Lines and windows are told by 64-bit hashes within their text. Null and
    empty texts have zeros and fail; repeated rows are each judged; other columns are ignored; an empty table gives none.
    """
    stats = staged(document_counts(docs), "counts")
    marks = (labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg((F.avg("quality") >= 0.5).cast("double").alias("label")))
    usable = stats.where(~held_out(F.col("doc_id"))).join(marks, "doc_id")
    total = usable.count()
    if total > sample_rows:
        usable = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * sample_rows / total))
    forest = fit_forest(usable.orderBy("doc_id").select("label", *SHARES).toArrow())  # about sample_rows rows of 13 numbers
    schema = ", ".join(["doc_id long", *(f"{c} long" for c in COUNTS), "base_failed boolean", "kept boolean", "score double"])
    return stats.mapInArrow(_judge(forest), schema), forest
