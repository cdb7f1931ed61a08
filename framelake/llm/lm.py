"""Stupid-backoff language-model scores, computed relationally.

Texts are dealt to blocks of about ``BLOCK_ROWS`` rows, or of ``BLOCK_BYTES`` bytes if that makes more blocks. A block lists its distinct n-grams of every order once, as 47-bit
hashes packed by hash bucket (sorted; the upper 15 bits as differences, counts and answers as deflated byte planes). Each bucket adds up the counts of its n-grams over all blocks (the count table,
partitioned by hash), joins them back to the lists that asked, and returns the counts in list order. A
block then looks up the counts of its own n-grams and sums the log scores per document. An n-gram of a third of all rows
thus reaches its bucket once per block, and a bucket holds one list per block. The partitions of the lists are many buckets each, sized by
the input and sorted by bucket, so a task streams them and holds the lists of one bucket at a time.

``S(w | h) = count(h w) / count(h)``, or ``backoff * S(w | h without its first word)`` if ``h w`` was never seen; a single
word has ``count(w) / N``, an unseen one ``1 / (N + 1)``. Words are runs of non-blank characters, A-Z lower-cased.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.llm.staging import partitions_for, staged
from framelake.llm.tokens import NON_BLANK, U, Words, slices, windows, words_of

ORDER = 3
BACKOFF = 0.4
BLOCK_ROWS, BLOCK_BYTES = 2_000, 12 << 20
BUCKETS_A_TASK, MOST_BUCKETS = 2, 1 << 16
LIST_GROWTH = 1.3  # bytes of lists per byte of text
_BITS = 47  # of a hash beside its bucket's number, which adds its own
_MASK = U((1 << _BITS) - 1)
_JOIN_GRAMS = 1 << 20
_LISTS = "bucket int, block long, asks boolean, size int, grams binary, counts binary"
_SCHEMA = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("asks", pa.bool_()), ("size", pa.int32()), ("grams", pa.binary()), ("counts", pa.binary())])


def _pack(x: np.ndarray) -> bytes:
    """Small integers from 0 as deflated byte planes."""
    return zlib.compress(np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_width(x)].T).tobytes(), 1)


def _width(x: np.ndarray) -> int:
    return max(1, (int(x.max()).bit_length() + 7) // 8) if len(x) else 1


def _unpack(b: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(b), dtype=np.uint8).reshape(-1, n)
    out = np.zeros((n, 8), dtype=np.uint8)
    out[:, :len(planes)] = planes.T
    return out.reshape(-1).view("<u8").astype(np.int64)


def _pack_sorted(x: np.ndarray) -> bytes:
    """Ascending integers of up to 48 bits: their lower 32 bits, then the steps of the upper ones."""
    return x.astype("<u4").tobytes() + _pack(np.diff(x >> U(32), prepend=U(0)))


def _unpack_sorted(b: bytes, n: int) -> np.ndarray:
    return (np.cumsum(_unpack(b[4 * n:], n)).astype(U) << U(32)) | np.frombuffer(b, dtype="<u4", count=n).astype(U)


def _starts(w: Words, n: int) -> np.ndarray:
    """First words of the n-grams that stay inside one document."""
    at = np.arange(max(0, len(w.hash) - n + 1))
    return at[at + n <= np.repeat(w.first[1:], w.count())[:len(at)]]


def block_grams(w: Words, order: int, buckets: int, places: bool = False) -> tuple[np.ndarray, ...]:
    """Distinct n-grams of a block by (bucket, hash): keys ``bucket << 48 | hash``, counts, bucket ends; and with ``places``, for each
    order, which of them stands at each place."""
    key = []
    for n in range(1, order + 1):
        h = windows(w.hash, n)[_starts(w, n)]
        key.append(((h >> U(48)) * U(buckets) >> U(16) << U(48)) | (h & _MASK))
    size = np.cumsum([len(k) for k in key])
    key, *inverse, cnt = np.unique(np.concatenate(key), return_inverse=places, return_counts=True)
    ends = np.searchsorted(key >> U(48), np.arange(buckets + 1, dtype=U))
    return (key, cnt, ends, np.split(inverse[0].astype(np.int32), size[:-1])) if places else (key, cnt, ends)


def _emit(order: int, buckets: int, asks: bool, counts: bool):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        gram, cnt, ends = block_grams(words_of(table.column("text"), NON_BLANK), order, buckets)
        used = np.flatnonzero(np.diff(ends))
        return pa.table({"bucket": pa.array(used, pa.int32()), "block": pa.array([key[0].as_py()] * len(used), pa.int64()),
                         "asks": pa.array([asks] * len(used), pa.bool_()), "size": pa.array(np.diff(ends)[used], pa.int32()),
                         "grams": pa.array([_pack_sorted(gram[ends[b]:ends[b + 1]] & _MASK) for b in used], pa.binary()),
                         "counts": pa.array([_pack(cnt[ends[b]:ends[b + 1]]) if counts else b"" for b in used], pa.binary())}, schema=_SCHEMA)

    return run


def _answer(bucket: int, mine: list[tuple]) -> Iterator[pa.RecordBatch]:
    """Add up one bucket's counts and answer its lists, each by what the other lists count."""
    grams = [_unpack_sorted(r[4], r[3]) for r in mine]
    counts = [_unpack(r[5], r[3]) if r[5] else np.zeros(0, np.int64) for r in mine]
    out = [np.zeros(r[3] if r[2] else 0, np.int64) for r in mine]
    parts = max(1, sum(map(len, grams)) // _JOIN_GRAMS)  # ranges of hashes, one after the other
    cuts = np.array([(p << _BITS) // parts for p in range(parts + 1)], dtype=U)
    at = [np.searchsorted(g, cuts) for g in grams]
    have = [i for i in range(len(mine)) if mine[i][5]]
    for p in range(parts):
        cut = [slice(a[p], a[p + 1]) for a in at]
        gram = np.concatenate([grams[i][cut[i]] for i in have]) if have else np.zeros(0, U)
        if not len(gram):
            continue
        keys, inverse = np.unique(gram, return_inverse=True)
        total = np.bincount(inverse, weights=np.concatenate([counts[i][cut[i]] for i in have]).astype(float)).astype(np.int64)
        for i, r in enumerate(mine):
            if r[2]:
                ask = grams[i][cut[i]]
                place = np.minimum(np.searchsorted(keys, ask), len(keys) - 1)
                out[i][cut[i]] = np.where(keys[place] == ask, total[place], 0) - (counts[i][cut[i]] if r[5] else 0)
    for i, r in enumerate(mine):
        if r[2]:
            yield pa.RecordBatch.from_arrays([pa.array([r[1]], pa.int64()), pa.array([bucket], pa.int32()),
                                              pa.array([_pack(out[i])], pa.binary())], names=["block", "bucket", "counts"])


def _join_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Answer the lists of a partition, which come in order of their buckets, one bucket at a time."""
    now, mine = -1, []
    for b in batches:
        for r in zip(*(b.column(f.name).to_pylist() for f in _SCHEMA)):
            if r[0] != now:
                yield from _answer(now, mine)
                now, mine = r[0], []
            mine.append(r)
    yield from _answer(now, mine)


def _inside(doc: np.ndarray, gram: np.ndarray, held: np.ndarray) -> np.ndarray:
    """For every n-gram, how often its own document has it; ``held`` is how often the block has each."""
    out = np.ones(len(gram), dtype=np.int64)
    some = np.flatnonzero(held[gram] > 1)
    _, inverse, cnt = np.unique(doc[some] * len(held) + gram[some].astype(np.int64), return_inverse=True, return_counts=True)
    out[some] = cnt[inverse]
    return out


def score_words(w: Words, places: list[np.ndarray], count: np.ndarray, held: np.ndarray | None, order: int,
                backoff: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per document: summed log scores without the ``1 / N`` of single words, how many ended there, and unseen words.

    ``places`` has each order's n-grams in the block, ``count`` the counts to score by. With ``held``, the block's own counts, a document's
    own n-grams are taken off the counts it is scored by."""
    n = len(w.hash)
    doc = w.doc_of_word()
    c = np.zeros((order + 1, n))  # count of the n-gram that ends at a word; 0 where the document starts later
    for k, gram in enumerate(places, 1):
        at = _starts(w, k)
        c[k, at + k - 1] = count[gram] if held is None else count[gram] - _inside(doc[at], gram, held)
    log = np.zeros(n)
    open_ = np.ones(n, dtype=bool)
    since = np.arange(n) - np.repeat(w.first[:-1], w.count())
    for k in range(order, 1, -1):
        # The history of an n-gram inside a document is the shorter one that ends a word before.
        seen = np.flatnonzero(open_[1:] & (c[k, 1:] > 0) & (c[k - 1, :-1] > 0)) + 1
        log[seen] += np.log(c[k, seen] / c[k - 1, seen - 1])
        open_[seen] = False
        log[open_ & (since >= k - 1)] += np.log(backoff)
    known = open_ & (c[1] > 0)
    log[known] += np.log(c[1, known])

    def per(x: np.ndarray) -> np.ndarray:
        return np.bincount(doc, weights=x, minlength=w.docs)

    return per(log), per(known), per(open_ & ~known)


def _score(order: int, buckets: int, backoff: float, own: bool, leave_out: bool):
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("log_sum", pa.float64()), ("known", pa.int64()), ("unseen", pa.int64())])

    def run(key: tuple, docs: pa.Table, answers: pa.Table) -> pa.Table:
        w = words_of(docs.column("text"), NON_BLANK)
        gram, cnt, ends, places = block_grams(w, order, buckets, places=True)
        count = cnt.astype(float) if own else np.zeros(len(gram))
        for b, x in zip(answers.column("bucket").to_pylist(), answers.column("counts").to_pylist()):
            count[ends[b]:ends[b + 1]] += _unpack(x, ends[b + 1] - ends[b])
        log, known, unseen = score_words(w, places, count, cnt if leave_out else None, order, backoff)
        return pa.table([docs.column("doc_id"), pa.array(w.count(), pa.int64()), pa.array(log), pa.array(known.astype(np.int64)),
                         pa.array(unseen.astype(np.int64))], schema=schema)

    return run


def _blocks(docs: DataFrame, rows: int) -> tuple[DataFrame, int]:
    """``(block, doc_id, text)``, and the bytes of all texts."""
    count, size = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(F.col("text").cast("string"))), F.lit(0))).first()
    n = max(1, -(-count // rows), -(-size // BLOCK_BYTES))
    return docs.select(F.pmod(F.monotonically_increasing_id() * 7919 + F.spark_partition_id(), F.lit(n)).alias("block"),
                       F.col("doc_id").cast("long"), F.col("text").cast("string")), size


def lm_scores(docs: DataFrame, corpus: DataFrame | None = None, order: int = ORDER, backoff: float = BACKOFF, block_rows: int = BLOCK_ROWS,
              leave_out: bool = False) -> DataFrame:
    """One row per document: ``doc_id, n_words, log_score, mean_log_score``.

    Counts come from every text of ``corpus`` (by default ``docs`` themselves; with ``leave_out``, from all other rows of
    them, so that n-grams found in no other row back off). ``log_score`` is the natural log of the
    product of the words' scores, ``mean_log_score`` its mean per word. Null, empty and blank texts have no words, score 0
    and a null mean. Repeated rows are each scored; other columns are ignored; an empty corpus makes all words unseen.
    """
    own = corpus is None
    if leave_out and not own:
        raise ValueError("leave_out is for documents scored by their own counts")
    blocks, size = _blocks(docs, block_rows)
    others, more = (None, 0) if own else _blocks(corpus, block_rows)
    tasks = partitions_for(docs.sparkSession, LIST_GROWTH * (size + more))
    buckets = min(tasks * BUCKETS_A_TASK, MOST_BUCKETS)
    lists = blocks.groupBy("block").applyInArrow(_emit(order, buckets, True, own), _LISTS)
    if not own:
        lists = lists.union(others.groupBy("block").applyInArrow(_emit(order, buckets, False, True), _LISTS))
    # Neighbouring buckets go to one task; the task's number is given, not hashed, so that no task is left without any.
    dealt = lists.repartitionById(tasks, F.expr(f"cast(bucket * {tasks}L div {buckets} as int)")).sortWithinPartitions("bucket")
    answers = dealt.mapInArrow(_join_counts, "block long, bucket int, counts binary")
    scored = staged(blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _score(order, buckets, backoff, own, leave_out), "doc_id long, n_words long, log_sum double, known long, unseen long"), "scores")
    if own:
        total = scored.agg(F.sum("n_words")).first()[0] or 0
    else:
        total = corpus.select(F.col("text").cast("string").alias("text")).mapInArrow(_count_words, "n long").agg(F.sum("n")).first()[0] or 0
    around = F.lit(total) - F.col("n_words") if leave_out else F.lit(total)
    log = F.col("log_sum") - F.col("known") * F.log(F.greatest(around, F.lit(1))) - F.col("unseen") * F.log(around + 1)
    return scored.select("doc_id", "n_words", log.alias("log_score"), F.when(F.col("n_words") > 0, log / F.col("n_words")).alias("mean_log_score"))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "text"):
        yield pa.RecordBatch.from_arrays([pa.array([len(words_of(b.column("text"), NON_BLANK).hash)], pa.int64())], names=["n"])
