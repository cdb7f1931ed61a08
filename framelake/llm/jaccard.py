"""Exact Jaccard join of documents' word n-gram sets, told by components.

Equal sets are one class. Classes that can link are found, and then compared, with
set relations, so that work follows links rather than pairs:

1. ``shingle_classes``: one pass over the texts hashes each document's shingles. Shingles
   with a hash in the lowest quarter (all of a small set's) are dealt to buckets by hash, and
   a class is credited for each one that another class has too. A class linked with any other
   shares all but ``n - ceil(t n)`` of its shingles, thus of any part; with fewer credits it has
   no link and is done. Before the shuffle each task keeps one row per shingle, so a passage
   found in a third of all documents arrives once per task.
2. ``prefix_postings``: the remaining sets order their shingles by frequency, then hash. A link
   needs a common shingle among the first ``n - ceil(t n) + 1`` of both. Shingles of one class
   only come first and are never written; positions and sizes go with each entry.
3. Index lists are skipped by block and position: a list is cut by size class, only neighbouring
   classes meet, and an entry is passed over when the places after its position cannot
   give the needed overlap.
4. Answers come from a similar set's answers. In each list every set is compared with one pivot. What
   links to one pivot is one component and is never compared again inside it. For two sets of
   different components measured against the same pivot, the overlap lies between ``oa + ob - |p|``
   and ``min(oa, ob) + min(na - oa, nb - ob)``: the pair is accepted or skipped by these
   bounds where they decide, and intersected only otherwise.

Hashes have 64 bits; a class is a 64-bit sum hash together with its size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framelake.llm.components import components
from framelake.llm.staging import partitions_for, staged
from framelake.llm.tokens import NON_BLANK, PLACE, U, mix, slices, windows, words_of

REGION = 0.25
SMALL = 64
MARK = np.uint64(0xFFFFFFFFFFFFFFFF)
FLUSH = 1_000_000
BUCKETS_A_TASK, MOST_BUCKETS = 8, 1 << 14
DEALT_GROWTH = 0.5  # bytes of dealt shingles per byte of text
BROADCAST_CLASSES = 1_000_000

_DEALT = pa.schema([("bucket", pa.int32()), ("kind", pa.string()), ("doc_id", pa.int64()), ("fp", pa.int64()),
                    ("n", pa.int64()), ("m", pa.int64()), ("tokens", pa.binary()), ("owners", pa.binary())])
_DEALT_DDL = "bucket int, kind string, doc_id long, fp long, n long, m long, tokens binary, owners binary"
_CLASS_DDL = "kind string, doc_id long, fp long, n long, m long"


def shingle_sets(col: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each row: all hashes, n + 1 offsets, set hashes."""
    w = words_of(col, NON_BLANK)
    count = w.count()
    per = np.where(count >= k, count - k + 1, np.minimum(count, 1))
    at = np.concatenate([[0], np.cumsum(per)])
    out = np.zeros(at[-1], dtype=U)
    whole = windows(w.hash, k)
    for d in np.flatnonzero(per):
        lo, hi, f = at[d], at[d + 1], w.first[d]
        out[lo:hi] = whole[f:f + hi - lo] if count[d] >= k else windows(w.hash[f:f + count[d]], int(count[d]))
        out[lo:hi].sort()
    doc = np.repeat(np.arange(len(per)), per)
    new = np.ones(len(out), dtype=bool)
    new[1:] = (out[1:] != out[:-1]) | (doc[1:] != doc[:-1])
    out, doc = out[new], doc[new]
    n = np.bincount(doc, minlength=len(per))
    at = np.concatenate([[0], np.cumsum(n)])
    run = np.concatenate([np.zeros(1, U), np.cumsum(mix(out + PLACE[0]), dtype=U)])
    return out, at, mix(run[at[1:]] - run[at[:-1]] + n.astype(U))


def _once(token: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (token, owner) pairs in token order, and whether the token has several owners."""
    order = np.lexsort((owner, token))
    token, owner = token[order], owner[order]
    keep = np.ones(len(token), dtype=bool)
    keep[1:] = (token[1:] != token[:-1]) | (owner[1:] != owner[:-1])
    token, owner = token[keep], owner[keep]
    same = token[1:] == token[:-1]
    many = np.zeros(len(token), dtype=bool)
    many[1:] |= same
    many[:-1] |= same
    return token, owner, many


def _rows(schema: pa.Schema, rows: int, **cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(cols[f.name], f.type) if f.name in cols else pa.nulls(rows, f.type)
                                       for f in schema], schema=schema)


def _credits(owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ids, cnt = np.unique(owner, return_counts=True)
    return ids.view(np.int64), cnt


def _deal(k: int, buckets: int, region: float):
    """Map side: a row per document, a packed row of shingles per bucket."""
    limit = U(int(region * 2**64)) if region < 1 else MARK

    def flush(held: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        token, owner, many = _once(np.concatenate([t for t, _ in held]), np.concatenate([o for _, o in held]))
        if many.any():
            ids, cnt = _credits(owner[many])
            yield _rows(_DEALT, len(ids), bucket=(ids.view(U) % U(buckets)).astype(np.int32), kind=["c"] * len(ids), fp=ids, m=cnt)
        first = many.copy()
        first[1:] &= token[1:] != token[:-1]
        token = np.concatenate([token[~many], token[first]])
        owner = np.concatenate([owner[~many], np.full(first.sum(), MARK)])
        to = mix(token) % U(buckets)
        order = np.argsort(to, kind="stable")
        token, owner, to = token[order], owner[order], to[order]
        ends = np.searchsorted(to, np.arange(buckets + 1, dtype=U))
        used = np.flatnonzero(np.diff(ends))
        yield _rows(_DEALT, len(used), bucket=used.astype(np.int32), kind=["p"] * len(used),
                    tokens=[token[ends[b]:ends[b + 1]].tobytes() for b in used],
                    owners=[owner[ends[b]:ends[b + 1]].tobytes() for b in used])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in slices(batches, "text"):
            token, at, fp = shingle_sets(b.column("text"), k)
            n = np.diff(at)
            doc = np.repeat(np.arange(len(n)), n)
            low = token < limit
            m = np.where(n <= SMALL, n, np.bincount(doc[low], minlength=len(n)))
            yield _rows(_DEALT, len(n), bucket=(fp % U(buckets)).astype(np.int32), kind=["d"] * len(n), doc_id=b.column("doc_id"),
                        fp=fp.view(np.int64), n=n, m=m)
            sent = low | (n[doc] <= SMALL)
            held.append((token[sent], fp[doc[sent]]))
            size += int(sent.sum())
            if size >= FLUSH:
                yield from flush(held)
                held, size = [], 0
        if size:
            yield from flush(held)

    return run


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reduce side: count, for each class, its shingles that other classes have. Rows come in order of their buckets, and one
    bucket's shingles are held at a time."""
    schema = pa.schema([f for f in _DEALT if f.name in ("kind", "doc_id", "fp", "n", "m")])
    now, tokens, owners = -1, [], []

    def counted() -> Iterator[pa.RecordBatch]:
        if tokens:
            _, owner, many = _once(np.concatenate(tokens), np.concatenate(owners))
            owner = owner[many]
            ids, cnt = _credits(owner[owner != MARK])
            yield _rows(schema, len(ids), kind=["c"] * len(ids), fp=ids, m=cnt)
            tokens.clear()
            owners.clear()

    for b in batches:
        kind, bucket = np.array(b.column("kind").to_pylist(), dtype=object), b.column("bucket").to_numpy()
        packed = np.flatnonzero(kind == "p")
        for i in packed.tolist():
            if bucket[i] != now:
                yield from counted()
                now = bucket[i]
            # Copies: a view would keep its whole batch.
            tokens.append(np.frombuffer(b.column("tokens")[i].as_buffer(), dtype=U).copy())
            owners.append(np.frombuffer(b.column("owners")[i].as_buffer(), dtype=U).copy())
        if len(packed) < len(kind):
            rest = b.filter(pa.array(kind != "p"))
            yield pa.RecordBatch.from_arrays([rest.column(f.name) for f in schema], schema=schema)
    yield from counted()


def _need(n: Column, percent: int) -> Column:
    """ceil(percent/100 * n) in whole numbers."""
    return ((n * percent + 99) / 100).cast("long")


def shingle_classes(docs: DataFrame, k: int, percent: int, region: float = REGION) -> tuple[DataFrame, DataFrame]:
    """Documents ``(doc_id, fp, n)`` and the classes ``(fp, n, rep)`` that may link with another."""
    size = docs.agg(F.coalesce(F.sum(F.octet_length(F.col("text").cast("string"))), F.lit(0))).first()[0]
    tasks = partitions_for(docs.sparkSession, DEALT_GROWTH * size)
    buckets = tasks * max(1, min(BUCKETS_A_TASK, MOST_BUCKETS // tasks))
    dealt = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_deal(k, buckets, region), _DEALT_DDL)
    # Neighbouring buckets go to one task; the task's number is given, not hashed, so that no task is left without any.
    dealt = dealt.repartitionById(tasks, F.expr(f"cast(bucket * {tasks}L div {buckets} as int)")).sortWithinPartitions("bucket")
    both = staged(dealt.mapInArrow(_meet, _CLASS_DDL), "shingles")
    rows = both.where("kind = 'd'").select("doc_id", "fp", "n", "m")
    credit = both.where("kind = 'c'").groupBy("fp").agg(F.sum("m").alias("credit"))
    n, m = F.col("n"), F.col("m")
    classes = rows.where("n > 0").groupBy("fp", "n").agg(F.min("doc_id").alias("rep"), F.first("m").alias("m"))
    missing = n - _need(n, percent)
    sure = (n <= SMALL) & (n * 100 > SMALL * percent)
    live = (classes.join(credit, "fp", "left")
            .where(sure | (F.coalesce(F.col("credit"), F.lit(0)) >= m - missing)).select("fp", "n", "rep"))
    return rows.select("doc_id", "fp", "n"), live


def _arrays(k: int):
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64()), ("n", pa.int64()), ("tokens", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            token, at, fp = shingle_sets(b.column("text"), k)
            lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(token.view(np.int64)))
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), pa.array(fp.view(np.int64)),
                                              pa.array(np.diff(at)), lists], schema=schema)

    return run


def _sets(docs: DataFrame, live: DataFrame, k: int) -> DataFrame:
    """``(fp, n, tokens)`` of each live class, from its representative's text."""
    all_sets = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _arrays(k), "doc_id long, fp long, n long, tokens array<long>")
    if live.count() <= BROADCAST_CLASSES:
        live = F.broadcast(live)
    same = all_sets.alias("s").join(live.alias("l"), F.expr("s.fp = l.fp and s.n = l.n and s.doc_id <=> l.rep"))
    return same.select("s.fp", "s.n", "tokens").dropDuplicates(["fp", "n"])


def prefix_postings(sets: DataFrame, percent: int) -> DataFrame:
    """``(t, fp, n, u, pos, sc)``: the non-unique shingles in each set's prefix, rarest first."""
    tokens = sets.select("fp", "n", F.explode("tokens").alias("t"))
    common = tokens.groupBy("t").agg(F.count("*").alias("df")).where("df > 1")
    shared = tokens.join(common, "t")
    mine = Window.partitionBy("fp")
    n = F.col("n")
    return (shared.withColumn("r", F.row_number().over(mine.orderBy("df", "t")))
            .withColumn("u", n - F.count("*").over(mine))
            .withColumn("pos", F.col("u") + F.col("r") - 1)
            .where(F.col("pos") <= n - _need(n, percent))
            .select("t", "fp", "n", "u", "pos", _size_class(n, percent).alias("sc")))


def _size_class(n: Column, percent: int) -> Column:
    """Sizes that can link differ by one class at most."""
    return F.floor(F.log(n.cast("double")) / F.log(F.lit(100.0 / percent)) + F.lit(1e-9)).cast("int")


def _may_link(percent: int) -> Column:
    """Length and position filters for entries ``a`` and ``b`` of one list.

    A linked pair passes at its first common shingle, before which it has none in common.
    """
    rest = F.least(F.col("a.n") - F.col("a.pos"), F.col("b.n") - F.col("b.pos"))
    return F.expr(f"least(a.n, b.n) * 100 >= greatest(a.n, b.n) * {percent}") & (
        rest * (100 + percent) >= (F.col("a.n") + F.col("b.n")) * percent)


def _overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``(x, nx, y, ny, o)``: exact overlap of each pair."""
    one = sets.select(F.col("fp").alias("x"), F.col("n").alias("nx"), F.col("tokens").alias("tx"))
    two = sets.select(F.col("fp").alias("y"), F.col("n").alias("ny"), F.col("tokens").alias("ty"))
    return pairs.join(one, "x").join(two, "y").select("x", "nx", "y", "ny", F.size(F.array_intersect("tx", "ty")).cast("long").alias("o"))


def _linked(percent: int) -> Column:
    return F.col("o") * (100 + percent) >= (F.col("nx") + F.col("ny")) * percent


def class_links(sets: DataFrame, percent: int) -> DataFrame:
    """``(node, component)`` over linked classes (classes without a link are left out)."""
    posts = staged(prefix_postings(sets, percent), "postings")
    pivots = posts.groupBy("t", "sc").agg(F.min(F.struct("u", "fp", "n", "pos")).alias("p"), F.count("*").alias("c")).where("c > 1")
    star = (posts.alias("a").join(pivots.select("t", "sc", "p.*").alias("b"), ["t", "sc"])
            .where("a.fp <> b.fp").where(_may_link(percent))
            .select(F.col("a.fp").alias("x"), F.col("b.fp").alias("y")).distinct())
    measured = staged(_overlaps(star, sets), "pivots")
    links = measured.where(_linked(percent)).select(F.col("x").alias("a"), F.col("y").alias("b"))
    first = components(links)
    anchors = measured.groupBy("x").agg(F.min(F.struct("y", "ny", "o")).alias("k")).select("x", "k.*")
    entry = (posts.join(first.withColumnRenamed("node", "fp"), "fp", "left")
             .withColumn("label", F.coalesce("component", "fp"))
             .join(anchors.select(F.col("x").alias("fp"), F.col("y").alias("p"), F.col("ny").alias("np"), "o"), "fp", "left")
             .select("t", "fp", "n", "u", "pos", "sc", "label", F.coalesce("p", "fp").alias("p"), F.coalesce("np", "n").alias("np"),
                     F.coalesce("o", "n").alias("o")))
    entry = staged(entry, "entries")
    main = (entry.groupBy("t", "label").agg(F.count("*").alias("c"))
            .groupBy("t").agg(F.max(F.struct("c", "label")).alias("m"), F.count("*").alias("labels"))
            .where("labels > 1").select("t", F.col("m.label").alias("main")))
    left = entry.join(main, "t").where("label <> main")
    right = entry.withColumn("near", F.explode(F.array(F.col("sc") - 1, F.col("sc"), F.col("sc") + 1)))
    high = F.least("a.o", "b.o") + F.least(F.col("a.n") - F.col("a.o"), F.col("b.n") - F.col("b.o"))
    low = F.col("a.o") + F.col("b.o") - F.col("a.np")
    need = (F.col("a.n") + F.col("b.n")) * percent
    same = F.col("a.p") == F.col("b.p")
    pairs = (left.alias("a").join(right.alias("b"), F.expr("a.t = b.t and a.sc = b.near and a.label <> b.label"
                                                          " and (b.label = a.main or a.fp < b.fp)") & _may_link(percent)
                                  & (~same | (high * (100 + percent) >= need)))
             .select(F.least("a.fp", "b.fp").alias("x"), F.greatest("a.fp", "b.fp").alias("y"),
                     (same & (low * (100 + percent) >= need)).alias("sure")).distinct())
    pairs = staged(pairs, "pairs")
    rest = _overlaps(pairs.where("not sure"), sets).where(_linked(percent)).select("x", "y")
    more = pairs.where("sure").select("x", "y").union(rest)
    return components(links.union(more))


def jaccard_components(docs: DataFrame, k: int = 4, percent: int = 85, region: float = REGION) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id``.

    Words are runs of non-blank characters with A-Z lower-cased; a document's set holds its
    distinct ``k``-word shingles, or its whole word sequence when shorter. Two documents link
    when ``100 * |x & y| >= percent * |x | y|``; ``component_id`` is the smallest ``doc_id`` reachable by
    links. Null, empty or blank text has an empty set and no link. Rows with a null ``doc_id`` are
    returned and can link, but never name a component unless nothing else is in it. Repeated
    rows are returned each. Other columns of ``docs`` are ignored.
    """
    rows, live = shingle_classes(docs, k, percent, region)
    live = staged(live, "live")
    sets = staged(_sets(docs, live, k), "sets")
    comps = class_links(sets, percent)
    linked = comps.join(live.select(F.col("fp").alias("node"), "rep"), "node")
    low = linked.groupBy("component").agg(F.min("rep").alias("low"))
    reach = linked.join(low, "component").select(F.col("node").alias("fp"), "low")
    copies = rows.where("n > 0").groupBy("fp", "n").agg(F.min("doc_id").alias("rep"), F.count("*").alias("c"))
    tops = copies.join(reach, "fp", "left").where("c > 1 or low is not null").select("fp", "n", F.coalesce("low", "rep").alias("top"))
    out = rows.join(tops, ["fp", "n"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("top", "doc_id").alias("component_id"))
