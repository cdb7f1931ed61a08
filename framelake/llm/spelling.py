"""Spelling variants: words one edit apart, found over a reduced alphabet.

Letters are hashed to a few symbols, so a word becomes a *reduced* word. Words one edit apart have reduced words that are equal or
one edit apart, so the one-edit neighbourhoods of the reduced words are generated and joined with the reduced vocabulary; what meets is
verified on the original strings. It is enough that one word of a pair generates the other:

* inserted or deleted letter: the longer word deletes each of its symbols (equal results count once);
* replaced letter, another symbol: the word with the larger symbol puts each smaller one in its place;
* replaced letter, the same symbol: the reduced words are equal, both words generate, and each takes its own direction.

So every pair comes out once. A neighbour is told by a 64-bit hash of its symbols and length, taken for all places of all words at
once with running sums; equal hashes are candidates only, ``levenshtein`` of the words decides.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.llm.staging import staged
from framelake.llm.tokens import LOWER, U, column_bytes, mix, slices

MIN_LENGTH, MIN_COUNT = 5, 3
DROP_EVERY = 97
SLICE_BYTES, WORD_BYTES = 4 << 20, 1 << 17
_LEAD = 0xC3  # the lead byte of U+00C0 to U+00FF in UTF-8, whatever follows it
_LONG = 64

_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, (_CRC >> 1) ^ np.uint32(0xEDB88320), _CRC >> 1).astype(np.uint32)


def _runs(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and byte after the last of every maximal run of letters; runs end with their text."""
    letter = ((raw | 32) >= 97) & ((raw | 32) <= 122) & (raw < 128)
    letter |= raw == _LEAD
    letter[1:] |= raw[:-1] == _LEAD
    begins, ends = letter.copy(), letter.copy()
    if len(raw):
        begins[1:] &= ~letter[:-1]
        ends[:-1] &= ~letter[1:]
        cut = at[(at > 0) & (at < len(raw))]
        begins[cut] |= letter[cut]
        ends[cut - 1] |= letter[cut - 1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def run_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """crc32 of each run, continued from ``seed`` (the crc32 of what stands before it)."""
    out = np.array(seed, dtype=np.uint32)
    length = end - start
    order = np.argsort(-length, kind="stable")
    long = int(np.count_nonzero(length > _LONG))
    for i in order[:long]:
        out[i] = crc32(raw[start[i]:end[i]].tobytes(), int(out[i]))
    order = order[long:]
    state, first, size = ~out[order], start[order], length[order]
    for p in range(int(size[0]) if len(size) else 0):
        live = int(np.searchsorted(-size, -p, side="left"))
        state[:live] = _CRC[(state[:live] ^ raw[first[:live] + p]) & 0xFF] ^ (state[:live] >> np.uint32(8))
    out[order] = ~state
    return out


def words_of_slice(ids: list[int | None], col: pa.Array) -> pa.LargeStringArray:
    """All words of the texts, in order, each already with its code point deleted where 97 divides the hash."""
    raw, at = column_bytes(col)
    raw = LOWER[raw]
    start, end = _runs(raw, at)
    doc = np.searchsorted(at, start, side="right") - 1
    prefix = np.array([crc32(f"{'' if i is None else i}:".encode()) for i in ids], dtype=np.uint32)
    h = run_hashes(raw, start, end, prefix[doc])
    opens = (raw & 0xC0) != 0x80
    before = np.concatenate([[0], np.cumsum(opens)])  # code points that open before each byte
    length = before[end] - before[start]
    keep = np.zeros(len(raw) + 1, dtype=np.int64)
    np.add.at(keep, start, 1)
    np.add.at(keep, end, -1)
    keep = np.cumsum(keep[:-1]).astype(bool)
    hit = np.flatnonzero((h % DROP_EVERY == 0))
    if len(hit):
        place = np.flatnonzero(opens)[before[start[hit]] + h[hit] % length[hit]]
        keep[place] = False
        two = place[raw[place] == _LEAD] + 1
        keep[two] = False
    left = np.concatenate([[0], np.cumsum(keep)])
    offsets = np.append(left[start], left[-1]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(raw[keep])))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "text", SLICE_BYTES):
        known = b.filter(pc.is_valid(b.column("text")))
        words = words_of_slice(known.column("doc_id").to_pylist(), known.column("text"))
        counted = pc.value_counts(words.filter(pc.greater_equal(pc.utf8_length(words), MIN_LENGTH)))
        yield pa.RecordBatch.from_arrays([counted.field(0).cast(pa.string()), counted.field(1).cast(pa.int64())], names=["word", "n"])


def vocabulary(docs: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """``(word, n)`` of every word of at least five code points that occurs ``min_count`` times in all texts.

    Each task adds up its own words, a slice of text at a time, so a word that makes up a third of a corpus is a few rows a task.
    """
    counted = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _symbols(letters: np.ndarray, symbols: int) -> np.ndarray:
    """The symbol that each code point is hashed to."""
    return (mix(letters.astype(U)) >> U(33)).astype(np.int64) % symbols


_BASE = U(0x9E3779B97F4A7C55)
_LENGTH = U(0x51ED270B27B4B1A3)


def _neighbourhoods(words: pa.Array, symbols: int, edits: bool) -> list[np.ndarray]:
    """For each word the hash of its reduced word, then (``edits``) those of the neighbours it generates."""
    value = mix(np.arange(1, symbols + 1, dtype=U)) | U(1)
    length = np.asarray(pc.utf8_length(words)).astype(np.int64)
    first = np.concatenate([[0], np.cumsum(length)])
    letters = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), dtype=np.uint32)
    sign = _symbols(letters, symbols)
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(words)
    for size in np.unique(length):
        own = np.flatnonzero(length == size)
        s = sign[first[own][:, None] + np.arange(size)]
        v = value[s]
        place = np.full(size + 1, _BASE, dtype=U)
        place[0] = U(1)
        place = np.cumprod(place)
        at = v * place[:size]
        whole = at.sum(axis=1, dtype=U) + np.multiply(U(size), _LENGTH)
        if not edits:
            for i, h in zip(own, whole.view(np.int64)):
                out[i] = h
            continue
        none = np.zeros((len(own), 1), dtype=U)
        before = np.hstack([none, np.cumsum(at, axis=1, dtype=U)])[:, :size]
        after = np.hstack([np.cumsum((v[:, 1:] * place[:size - 1])[:, ::-1], axis=1, dtype=U)[:, ::-1], none])
        less = before + after + np.multiply(U(size - 1), _LENGTH)
        less.sort(axis=1)
        fresh = np.ones(less.shape, dtype=bool)
        fresh[:, 1:] = less[:, 1:] != less[:, :-1]
        keys, row = [whole, less[fresh]], [np.arange(len(own)), np.nonzero(fresh)[0]]
        for k in range(symbols - 1):
            larger = s > k
            keys.append((whole[:, None] + (value[k] - v) * place[:size])[larger])
            row.append(np.nonzero(larger)[0])
        row = np.concatenate(row)
        order = np.argsort(row, kind="stable")
        keys = np.concatenate(keys)[order].view(np.int64)
        ends = np.searchsorted(row[order], np.arange(len(own) + 1))
        for j, i in enumerate(own):
            out[i] = keys[ends[j]:ends[j + 1]]
    return out


def _generate(symbols: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "word", WORD_BYTES):
            keys = _neighbourhoods(b.column("word"), symbols, True)
            ends = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(keys)))
            yield pa.RecordBatch.from_arrays([b.column("word"), b.column("n"), lists], names=["word", "n", "keys"])

    return run


def _reduce(symbols: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "word", WORD_BYTES):
            keys = np.array(_neighbourhoods(b.column("word"), symbols, False), dtype=np.int64)
            yield pa.RecordBatch.from_arrays([b.column("word"), b.column("n"), pa.array(keys)], names=["word", "n", "key"])

    return run


def near_pairs(vocab: DataFrame, symbols: int) -> DataFrame:
    """``(word, near, near_n)``, both directions of every pair of words exactly one edit apart; ``vocab`` has ``word, n``.

    A generated neighbour travels with its word, so that the pair is verified where it meets. The neighbours of words of more
    than 64 code points, whose rows would grow with the square of the length, travel with a number for the word and get it back
    after the meeting. Both ways give each pair once.
    """
    size = F.char_length("word")
    reduced = vocab.mapInArrow(_reduce(symbols), "word string, n long, key long").select(
        "key", F.col("word").alias("b"), F.col("n").alias("bn"))

    def keyed(words: DataFrame) -> DataFrame:
        return words.mapInArrow(_generate(symbols), "word string, n long, keys array<long>")

    key = F.posexplode("keys").alias("pos", "key")
    short = keyed(vocab.where(size <= _LONG)).select(F.col("word").alias("a"), F.col("n").alias("an"), key).join(
        reduced.where(F.char_length("b") <= _LONG), "key")
    told = F.xxhash64("word").alias("number")
    long = keyed(vocab.where(size > _LONG)).select(told, key).join(reduced.where(F.char_length("b") >= _LONG), "key").join(
        vocab.where(size > _LONG).select(told, F.col("word").alias("a"), F.col("n").alias("an")), "number")
    one = F.levenshtein("a", "b", 1) == 1
    pairs = short.where(one).select("a", "an", "b", "bn", "pos").union(long.where(one).select("a", "an", "b", "bn", "pos"))
    there = F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("bn").alias("near_n"))
    back = F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("an").alias("near_n"))
    return pairs.select(F.explode(F.when(F.col("pos") == 0, F.array(there)).otherwise(F.array(there, back))).alias("p")).select("p.*")


def _roots(forms: DataFrame) -> DataFrame:
    """``(word, root)``: each word's forms followed to the last, by doubling steps.

    A form occurs at least twice as often as its word, so a chain is no longer than the binary logarithm of the largest count.
    """
    hops = staged(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "forms")
    while not hops.where("moved").isEmpty():
        ahead = hops.select(F.col("word").alias("root"), F.col("root").alias("next"))
        hops = staged(hops.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                             F.col("next").isNotNull().alias("moved")), "forms")
    return hops.select("word", "root")


def spelling_groups(docs: DataFrame, min_count: int = MIN_COUNT, symbols: int | None = None) -> DataFrame:
    """One row per word: ``word, form, root, n, n_near, form_n``.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, with A-Z lower-cased, of five code points or more and ``min_count``
    occurrences (``n``) in all texts; in an occurrence for which 97 divides h, the unsigned crc32 of ``<doc_id>:<run>``, the code point
    h % length is left out first. ``n_near`` counts the words one edit away; ``form`` is the most frequent of them (ties: the smallest),
    if it occurs twice as often as the word, and ``root`` the last form that forms lead to, or the word itself.

    ``symbols`` is the size of the reduced alphabet. By default it is 8, or more where a large vocabulary would bring over 32
    words to each reduced word of five symbols; it changes the work, never the rows. Null and empty texts have no word, a null
    ``doc_id`` counts as empty text in h, repeated rows count each time, and other columns are ignored. No words: an empty table.
    """
    vocab = staged(vocabulary(docs, min_count), "words")
    symbols = symbols or max(8, math.ceil((vocab.count() / 32) ** (1 / MIN_LENGTH)))
    best = F.min(F.struct(-F.col("near_n"), F.col("near"))).alias("best")
    near = near_pairs(vocab, symbols).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    known = staged(vocab.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "best"), "near")
    twice = -F.col("best.col1") >= 2 * F.col("n")
    known = known.select("word", "n", "n_near", F.when(twice, F.col("best.near")).alias("form"), F.when(twice, -F.col("best.col1")).alias("form_n"))
    roots = _roots(known.where("form is not null"))
    return known.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
