"""Benchmark decontamination by word windows.

Benchmark items are cut into windows of ``size`` consecutive words (a shorter item is one window).
Up to ``BROADCAST_WINDOWS`` distinct windows and ``BROADCAST_BYTES`` of words and item names they go to every task as one sorted
hash list with their words; every document's windows are hashed with array operations, looked up, and
each hit is verified word by word. Of a larger benchmark only a Bloom filter goes to the tasks, of two bits a window and at most
``FILTER_BITS`` bits; the few document windows that pass it leave their task with their words and meet the benchmark's in a join on these.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.llm.staging import free_name, staged
from framelake.llm.tokens import ALNUM, PLACE, U, Words, mix, slices, windows, words_of

BROADCAST_WINDOWS, BROADCAST_BYTES = 300_000, 64 << 20
FILTER_BITS, _SLOT = 29, 15  # logarithms: of the largest filter's bits, and of the bits built by one group
_REPORT = "doc_id long, n_words long, n_hit long, items array<string>, spans array<struct<start:long,end:long>>"
_REPORT_SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())),
    ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])


def _item_windows(size: int):
    schema = pa.schema([("item", pa.string()), ("n", pa.int32()), ("h", pa.int64()), ("phrase", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            w = words_of(b.column("text"), ALNUM)
            items, counts, hashes, phrases = [], [], [], []
            for d, item in enumerate(b.column("item").to_pylist()):
                lo, hi = int(w.first[d]), int(w.first[d + 1])
                n = min(size, hi - lo)
                if n == 0:
                    continue
                h = windows(w.hash[lo:hi], n)
                items += [item] * len(h)
                counts += [n] * len(h)
                hashes += h.view(np.int64).tolist()
                phrases += [w.text(i, i + n) for i in range(lo, hi - n + 1)]
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip((items, counts, hashes, phrases), schema)],
                                             schema=schema)

    return run


def benchmark_windows(benchmark: DataFrame, size: int) -> DataFrame:
    """``(n, h, phrase, items)``: each distinct window with the items that hold it (a null id holds it without a name)."""
    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string")).mapInArrow(
        _item_windows(size), "item string, n int, h long, phrase binary")
    return rows.groupBy("n", "h", "phrase").agg(F.sort_array(F.collect_set("item")).alias("items"))


def _valid(w: Words, n: int) -> np.ndarray:
    """First words of the windows of ``n`` words that stay inside one document."""
    at = np.arange(max(0, len(w.hash) - n + 1))
    return at[at + n <= np.repeat(w.first[1:], w.count())[:len(at)]]


def _runs(hit: np.ndarray, lo: int, hi: int, w: Words, base: int) -> list[dict]:
    """Byte ranges of the document's runs of hit words."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit[lo:hi].view(np.int8), [0]])))
    return [{"start": int(w.start[lo + s]) - base, "end": int(w.end[lo + e - 1]) - base} for s, e in zip(edge[::2], edge[1::2])]


def _scan(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for b in slices(batches, "text"):
            w = words_of(b.column("text"), ALNUM)
            doc = w.doc_of_word()
            hit = np.zeros(len(w.hash), dtype=bool)
            found: dict[int, set[str]] = {}
            for n, (keys, phrases, items) in table.items():
                at = _valid(w, n)
                h = windows(w.hash, n)[at]
                i = np.searchsorted(keys, h)
                i[i == len(keys)] = 0
                for p, first in zip(at[keys[i] == h].tolist(), i[keys[i] == h].tolist()):
                    words, j = w.text(p, p + n), first
                    while j < len(keys) and keys[j] == keys[first]:
                        if phrases[j] == words:
                            hit[p:p + n] = True
                            found.setdefault(int(doc[p]), set()).update(items[j])
                        j += 1
            n_hit = np.bincount(doc[hit], minlength=w.docs)
            spans = [_runs(hit, int(w.first[d]), int(w.first[d + 1]), w, int(w.doc_start[d])) if n_hit[d] else [] for d in range(w.docs)]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(w.count(), pa.int64()), pa.array(n_hit, pa.int64()),
                 pa.array([sorted(found.get(d, ())) for d in range(w.docs)], _REPORT_SCHEMA.field("items").type),
                 pa.array(spans, _REPORT_SCHEMA.field("spans").type)], schema=_REPORT_SCHEMA)

    return run


def _bits(h: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """A window hash's two places in a filter of ``2**size`` bits."""
    return (h >> U(64 - size)).astype(np.int64), (mix(h ^ PLACE[5]) >> U(64 - size)).astype(np.int64)


def _places(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = np.concatenate(_bits(b.column("h").to_numpy().view(U), size))
            yield pa.RecordBatch.from_arrays([pa.array(at >> _SLOT), pa.array(at & ((1 << _SLOT) - 1), pa.int32())], names=["slot", "at"])

    return run


def _slot_bits(rows: pa.Table) -> pa.Table:
    one = np.zeros(1 << _SLOT, dtype=bool)
    one[rows.column("at").to_numpy()] = True
    return pa.table({"slot": rows.column("slot").slice(0, 1), "bits": pa.array([np.packbits(one).tobytes()], pa.binary())})


def bloom_filter(wins: DataFrame, count: int) -> tuple[int, np.ndarray]:
    """The filter of the windows' hashes: the logarithm of its bits, sixteen a window where the bound allows, and its bytes.

    Each group builds the bits of one slot, so what comes to the driver is the filter's size, 64 MB at most.
    """
    size = min(max((16 * count).bit_length(), _SLOT + 1), FILTER_BITS)
    slots = wins.select("h").mapInArrow(_places(size), "slot long, at int").distinct().groupBy("slot").applyInArrow(
        _slot_bits, "slot long, bits binary")
    out = np.zeros((1 << (size - _SLOT), 1 << (_SLOT - 3)), dtype=np.uint8)
    for r in slots.collect():
        out[r.slot] = np.frombuffer(r.bits, dtype=np.uint8)
    return size, out.ravel()


def _candidates(sizes: list[int], shared):
    """A row per document, and one for each of its windows that passes the filter."""
    schema = pa.schema([("rid", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n", pa.int32()), ("h", pa.int64()),
                        ("phrase", pa.binary()), ("pos", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, flags = shared.value
        for b in slices(batches, "text"):
            w = words_of(b.column("text"), ALNUM)
            doc, base, rid = w.doc_of_word(), w.doc_start[:-1], b.column("rid").to_numpy()
            yield pa.RecordBatch.from_arrays([b.column("rid"), b.column("doc_id"), pa.array(w.count(), pa.int64())]
                                             + [pa.nulls(w.docs, f.type) for f in schema][3:], schema=schema)
            for n in sizes:
                at = _valid(w, n)
                h = windows(w.hash, n)[at]
                one, two = _bits(h, size)
                may = np.flatnonzero((flags[one >> 3] >> (7 - (one & 7))) & (flags[two >> 3] >> (7 - (two & 7))) & 1)
                at, h = at[may], h[may]
                cols = [rid[doc[at]], h.view(np.int64), at - w.first[doc[at]], w.start[at] - base[doc[at]], w.end[at + n - 1] - base[doc[at]]]
                own, hashes, pos, start, end = (pa.array(c, pa.int64()) for c in cols)
                none = pa.nulls(len(at), pa.int64())
                phrases = pa.array([w.text(i, i + n) for i in at.tolist()], pa.binary())
                yield pa.RecordBatch.from_arrays([own, none, none, pa.array(np.full(len(at), n), pa.int32()), hashes, phrases, pos, start, end], schema=schema)

    return run


def _joined(docs: DataFrame, wins: DataFrame, count: int) -> DataFrame:
    """The report for a benchmark too large to broadcast: windows that pass its filter meet it by their words."""
    sizes = [r.n for r in wins.select("n").distinct().collect()]  # at most the window size
    shared = docs.sparkSession.sparkContext.broadcast(bloom_filter(wins, count))
    rows = staged(docs.withColumn("rid", F.monotonically_increasing_id()).mapInArrow(
        _candidates(sizes, shared), "rid long, doc_id long, n_words long, n int, h long, phrase binary, pos long, start long, end long"), "windows")
    hits = rows.where("pos is not null").join(wins, ["n", "h", "phrase"])
    per = hits.groupBy("rid").agg(
        F.array_sort(F.collect_set(F.struct("pos", "n", "start", "end"))).alias("w"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    words = F.size(F.array_distinct(F.flatten(F.transform("w", lambda x: F.sequence(x["pos"], x["pos"] + x["n"] - 1)))))
    spans = F.aggregate("w", F.array().cast("array<struct<pos:bigint,last:bigint,start:bigint,end:bigint>>"), lambda acc, x: F.when(
        (F.size(acc) > 0) & (F.element_at(acc, -1)["last"] >= x["pos"]),
        F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
            F.element_at(acc, -1)["pos"].alias("pos"), F.greatest(F.element_at(acc, -1)["last"], x["pos"] + x["n"]).alias("last"),
            F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["end"], x["end"]).alias("end"))))
    ).otherwise(F.concat(acc, F.array(F.struct(x["pos"].alias("pos"), (x["pos"] + x["n"]).alias("last"), x["start"].alias("start"),
                                               x["end"].alias("end"))))))
    per = per.select("rid", words.cast("long").alias("n_hit"), "items",
                     F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias("spans"))
    heads = rows.where("pos is null").select("rid", "doc_id", "n_words")
    return heads.join(per, "rid", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("spans", F.array().cast("array<struct<start:bigint,end:bigint>>")).alias("spans"))


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = 10, broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, items, spans``.

    Words are runs of letters and digits (all bytes above 0x7F count as letters), A-Z lower-cased.
    ``n_hit`` counts the document's words inside any occurrence of a benchmark window, ``items`` lists the
    items with an occurring window (as strings, sorted), ``spans`` the UTF-8 byte ranges of the hit words.
    Null, empty or wordless texts have no words; such items have no window. Items with a null id are hit like others and not listed.
    Repeated rows are each reported; other columns are ignored; an empty benchmark hits nothing.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    wins = staged(benchmark_windows(benchmark, size), "benchmark")
    size_of = F.length("phrase") + F.aggregate("items", F.lit(0), lambda acc, x: acc + F.length(x) + 60) + 120
    count, held = wins.agg(F.count(F.lit(1)), F.coalesce(F.sum(size_of), F.lit(0))).first()
    if count > broadcast_windows or held > BROADCAST_BYTES:
        return _joined(texts, wins, count)
    table: dict[int, list] = {}
    for r in wins.collect():  # at most broadcast_windows rows and BROADCAST_BYTES bytes
        table.setdefault(r.n, []).append((r.h % 2**64, bytes(r.phrase), r.items))
    packed = {}
    for n, rows in table.items():
        rows.sort(key=lambda x: x[0])
        packed[n] = (np.array([x[0] for x in rows], dtype=U), [x[1] for x in rows], [x[2] for x in rows])
    return texts.mapInArrow(_scan(spark.sparkContext.broadcast(packed)), _REPORT)


def _cut(names: list[str], spans_name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text, spans in zip(b.column("text").to_pylist(), b.column(spans_name).to_pylist()):
                raw, parts, at = (text or "").encode(), [], 0
                for s in spans or ():
                    parts.append(raw[at:s["start"]])
                    at = s["end"]
                out.append(None if text is None else b"".join([*parts, raw[at:]]).decode())
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()) if n == "text" else b.column(n) for n in names], names=names)

    return run


def cut_spans(docs: DataFrame, report: DataFrame) -> DataFrame:
    """``docs`` with each reported span cut from its text. ``doc_id`` has to be unique in both, a null one included.

    Other columns stay as they are, whatever their names.
    """
    own, spans = free_name("cut_id", docs.columns), free_name("spans", docs.columns)
    cuts = report.where("n_hit > 0").select(F.col("doc_id").alias(own), F.col("spans").alias(spans))
    joined = docs.join(cuts, docs["doc_id"].eqNullSafe(cuts[own]), "left").select(*[docs[c] for c in docs.columns], cuts[spans])
    return joined.mapInArrow(_cut(docs.columns, spans), docs.schema)


def drop_contaminated(docs: DataFrame, report: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold any benchmark window."""
    bad = report.where("n_hit > 0").select(F.col("doc_id").alias("bad_id"))
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["bad_id"]), "left_anti")


def digest_columns(report: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` of a report."""
    return report.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                         F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
