"""Language identification by rank-order n-gram profiles.

A profile is the list of the ``depth`` most frequent letter n-grams (one to three letters, words
padded with a blank), by rank. A document takes the language whose profile is nearest by
out-of-place distance: for each of the document's own most frequent n-grams, how many places it
lies away in the profile, or ``depth`` places if it is missing.

Profiles are learned from a sample of about ``sample_rows`` labelled rows, dealt evenly to the languages (chosen by a hash
of the identifier; all rows of a language that has fewer, one hash at least of any), a documented bound. Prediction reads every whole text.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framelake.llm.tokens import U, mix, slices

DEPTH = 300
SAMPLE_ROWS = 40_000
MAX_LANGUAGES = 1_000
_SLICE = 1 << 20
_tables: list[np.ndarray] = []


def _letters() -> tuple[np.ndarray, np.ndarray]:
    """For every code point: whether it is a letter, and its one-character lower case."""
    if not _tables:
        alpha, low = np.zeros(0x110000, dtype=bool), np.arange(0x110000, dtype=np.uint32)
        for c in range(0x110000):
            s = chr(c)
            if s.isalpha():
                alpha[c] = True
                t = s.lower()
                low[c] = ord(t) if len(t) == 1 else c
        _tables.extend([alpha, low])
    return _tables[0], _tables[1]


def gram_keys(col: pa.Array, owner: np.ndarray) -> np.ndarray:
    """``owner << 40 | hash`` of every n-gram of every row; rows without letters have none."""
    alpha, low = _letters()
    col = col.cast(pa.large_string()).fill_null("")
    size = pc.utf8_length(col).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    if not len(col):
        return np.zeros(0, dtype=U)
    # A line feed stands before each text and behind the last, whose words end there.
    cp = np.frombuffer(("\n" + "\n".join(col.to_pylist()) + "\n").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    own = np.append(np.repeat(owner.astype(U), size), U(owner[-1]))
    is_letter = alpha[cp]
    keep = is_letter.copy()
    keep[:-1] |= is_letter[1:]  # the blank before a word
    keep[1:] |= is_letter[:-1]  # and after it
    ch = np.where(is_letter, low[cp], 32).astype(U)[keep]
    own, letter = own[keep], is_letter[keep]
    if not len(ch):
        return np.zeros(0, dtype=U)
    same = own[1:] == own[:-1]
    two = (ch[:-1] << U(21)) | ch[1:]
    ok2 = (letter[:-1] | letter[1:]) & (same | letter[:-1])
    three = (two[:-1] << U(21)) | ch[2:]
    ok3 = letter[1:-1]
    out = [(own[letter], ch[letter]), (np.where(letter[:-1], own[:-1], own[1:])[ok2], two[ok2]), (own[1:-1][ok3], three[ok3])]
    return np.concatenate([(o << U(40)) | (mix(g) >> U(24)) for o, g in out])


def _counts(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys.sort()
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.diff(np.append(first, len(keys)))


def _ranked(keys: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, hash and rank of each owner's ``depth`` most frequent n-grams (ties by hash)."""
    key, cnt = _counts(keys)
    owner = key >> U(40)
    order = np.lexsort((key, -cnt, owner))
    key, owner = key[order], owner[order]
    start = np.searchsorted(owner, owner)
    rank = np.arange(len(key)) - start
    top = rank < depth
    return owner[top].astype(np.int64), key[top] & U((1 << 40) - 1), rank[top]


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "text", _SLICE):
        langs, owner = np.unique(np.array(b.column("lang").to_pylist(), dtype=object), return_inverse=True)
        key, cnt = _counts(gram_keys(b.column("text"), owner))
        yield pa.RecordBatch.from_arrays([pa.array(langs[(key >> U(40)).astype(np.int64)], pa.string()),
                                          pa.array((key & U((1 << 40) - 1)).astype(np.int64)), pa.array(cnt, pa.int64())],
                                         names=["lang", "gram", "cnt"])


def learn_profiles(labelled: DataFrame, depth: int = DEPTH, sample_rows: int = SAMPLE_ROWS) -> dict[str, list[int]]:
    """Language to its n-gram hashes, most frequent first, from rows ``(doc_id, text, lang)``.

    Rows with a null language are not used. Of more than ``MAX_LANGUAGES`` languages (a documented bound on what is learned), those with the
    most rows get a profile, ties by name, and a warning says so.
    """
    rows = labelled.where("lang is not null").select("doc_id", F.col("text").cast("string"), F.col("lang").cast("string"))
    share = F.shiftrightunsigned(F.xxhash64("doc_id"), 11)
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n"), F.min(share).alias("least")).orderBy(F.desc("n"), "lang").limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        warnings.warn(f"more than {MAX_LANGUAGES} languages: those with the most rows are learned", stacklevel=2)
        sizes = sizes[:MAX_LANGUAGES]
        learned = labelled.sparkSession.createDataFrame([(r.lang,) for r in sizes], "lang string")
        rows = rows.join(F.broadcast(learned), "lang").select("doc_id", "text", "lang")
    if sum(r.n for r in sizes) > sample_rows:
        left, bounds = sample_rows, []
        for i, r in enumerate(sorted(sizes, key=lambda r: (r.n, r.lang))):
            take = min(r.n, left / (len(sizes) - i))
            left -= take
            bounds.append((r.lang, max(int(take / r.n * 2**53), r.least + 1)))
        bound = labelled.sparkSession.createDataFrame(bounds, "lang string, bound long")  # MAX_LANGUAGES rows at most
        rows = rows.join(F.broadcast(bound), "lang").where(share < F.col("bound")).select("doc_id", "text", "lang")
    grams = rows.mapInArrow(_learn, "lang string, gram long, cnt long").groupBy("lang", "gram").agg(F.sum("cnt").alias("cnt"))
    best = Window.partitionBy("lang").orderBy(F.desc("cnt"), "gram")
    top = grams.withColumn("r", F.row_number().over(best)).where(F.col("r") <= depth)
    out: dict[str, list[int]] = {}
    for r in top.orderBy("lang", "r").collect():  # depth rows per language
        out.setdefault(r.lang, []).append(r.gram)
    return out


def _predict(profiles: dict[str, list[int]], depth: int):
    langs = sorted(profiles)
    grams = np.unique(np.array([g for p in profiles.values() for g in p], dtype=np.int64)).astype(U)
    places = np.full((len(grams) + 1, len(langs)), -1, dtype=np.int32)
    for j, name in enumerate(langs):
        mine = np.array(profiles[name], dtype=np.int64).astype(U)
        places[np.searchsorted(grams, mine), j] = np.arange(len(mine))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", _SLICE):
            n = b.num_rows
            doc, gram, rank = _ranked(gram_keys(b.column("text"), np.arange(n)), depth)
            used = np.bincount(doc, minlength=n)
            name, score = np.full(n, "und", dtype=object), np.zeros(n)
            if len(langs) and len(doc):
                at = np.searchsorted(grams, gram)
                at[(at < len(grams)) & (grams[np.minimum(at, len(grams) - 1)] != gram)] = len(grams)
                place = places[at]
                far = np.where(place < 0, depth, np.abs(place - rank[:, None]))
                dist = np.stack([np.bincount(doc, weights=far[:, j], minlength=n) for j in range(len(langs))], axis=1)
                some = used > 0
                best = dist.argmin(axis=1)
                name[some] = np.array(langs, dtype=object)[best[some]]
                score[some] = 1 - dist[some, best[some]] / (used[some] * depth)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(name, pa.string()),
                                              pa.array(np.clip(score, 0, 1))], names=["doc_id", "held_out", "lang_pred", "score"])

    return run


def held_out(doc_id: Column) -> Column:
    """Whether the row is kept from learning: crc32 of its id as text leaves 2 by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, labelled: DataFrame, depth: int = DEPTH, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per document: ``doc_id, held_out, lang_pred, score``.

    Learns from the rows of ``labelled`` (``doc_id, text, lang``) that are not held out. The prediction uses
    the text alone: ``und`` with score 0 if it is null or has no letter (or nothing was learned);
    otherwise the nearest language, ties by name, with ``1 - distance / largest possible distance``.
    Extra columns are ignored; repeated rows are each predicted.
    """
    profiles = learn_profiles(labelled.where(~held_out(F.col("doc_id"))), depth, sample_rows)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), held_out(F.col("doc_id")).alias("held_out"))
    return rows.mapInArrow(_predict(profiles, depth), "doc_id long, held_out boolean, lang_pred string, score double")
