"""Sampled SentencePiece segmentations without replacement, and decoding.

The lattice of a text has a node per character and an edge per vocabulary piece; its paths are
weighed by the pieces' log-probabilities. Perturbing every path with Gumbel noise and taking
the ``k`` largest samples ``k`` distinct segmentations without replacement. The search is
best-first: a node's perturbed maximum is drawn before its children's, which are then drawn under
that maximum, so the frontier holds exact maxima of sets of unseen paths and the best entry is
always the next sample. An entry stands for "same path up to here, then any other edge"; taking
it gives the next segmentation and the entries of its new part. The ``k + 1``-th maximum, still in the
frontier at the end, gives each sample's inclusion score ``1 - exp(-exp(log_prob - threshold))``.

No vocabulary piece crosses the start of a word, so each distinct word of a slice has its lattice built
once (piece lookups and backward sums as array operations over all words together), and documents
are walked word by word in parallel. All noise is a hash of the row key, the round and the place, so a
row's samples do not depend on partitions or retries. Words of more than ``UNIT`` characters without a
blank are cut wherever no vocabulary piece that matches there crosses, which leaves every path; else they stay whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.llm.staging import free_name
from framelake.llm.tokens import BASE, U, _pow, mix, slices

BLANK = 0x2581
UNIT = 64
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
K = 2
ALPHA = 1.0
SEED = 20240229
SLOT_BITS = 20
_SLICE = 1 << 18
_PART = 1 << 18
_UNUSED = -1e8
_SAMPLES = pa.schema([("doc_id", pa.int64()), ("sample", pa.int32()), ("ids", pa.list_(pa.int32())), ("log_prob", pa.float64()),
                      ("perturbed", pa.float64()), ("inclusion", pa.float64())])
_SAMPLES_DDL = "doc_id long, sample int, ids array<int>, log_prob double, perturbed double, inclusion double"


def _letter(cp: np.ndarray) -> np.ndarray:
    return mix(cp.astype(U) + U(0x51ED27)) | U(1)


@dataclass
class Vocab:
    """Hashes of all prefixes of pieces (sorted), the ids (-1 for a mere prefix) and log-probabilities of pieces,
    byte pieces, and every id's surface."""

    keys: np.ndarray
    slot: np.ndarray
    ids: np.ndarray
    logp: np.ndarray
    longest: int
    byte_ids: np.ndarray
    byte_logp: float
    surface: np.ndarray
    surface_at: np.ndarray


@lru_cache(maxsize=2)
def load_vocab(model_file: str = MODEL, alpha: float = ALPHA) -> Vocab:
    """Read a model. Unigram scores are log-probabilities; BPE scores are merge ranks and are taken by
    Zipf's law, ``-log(rank + 10)`` less their log-sum. ``alpha`` flattens (below 1) or sharpens."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
    n = sp.get_piece_size()
    text = [sp.id_to_piece(i) for i in range(n)]
    score = np.array([sp.get_score(i) for i in range(n)])
    plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))
             and (score[i] > _UNUSED or len(text[i]) == 1) and chr(BLANK) not in text[i][1:]]
    s = score[plain]
    s = np.maximum(s, s[s > _UNUSED].min())
    logp = -np.log(10 - s) if (s == np.round(s)).all() else s
    logp = alpha * (logp - np.log(np.exp(logp).sum()))
    cps = [np.array([ord(c) for c in text[i]], dtype=np.uint32) for i in plain]
    size = np.array([len(c) for c in cps])
    letter, first = _letter(np.concatenate(cps)), np.cumsum(size) - size
    every, h, whole = [], np.zeros(len(cps), dtype=U), np.zeros(len(cps), dtype=U)
    for i in range(int(size.max())):
        go = np.flatnonzero(size > i)
        h[go] = h[go] * BASE + letter[first[go] + i]
        every.append(mix(h[go]))
        whole[go] = every[-1]
    keys = np.unique(np.concatenate(every))
    at = np.searchsorted(keys, whole)
    ids, logps = np.full(len(keys), -1, dtype=np.int32), np.full(len(keys), -np.inf)
    ids[at], logps[at] = plain, logp
    byte_ids = np.full(256, sp.unk_id(), dtype=np.int32)
    raw = [t.replace(chr(BLANK), " ").encode() for t in text]
    for i in range(n):
        if sp.is_byte(i):
            byte_ids[int(text[i][3:5], 16)] = i
            raw[i] = bytes([int(text[i][3:5], 16)])
        elif sp.is_control(i) or sp.is_unknown(i):
            raw[i] = b""
    slot = np.searchsorted(keys >> U(64 - SLOT_BITS), np.arange((1 << SLOT_BITS) + 1, dtype=U)).astype(np.int32)
    return Vocab(keys, slot, ids, logps, int(size.max()), byte_ids,
                 float(logp.min()), np.frombuffer(b"".join(raw), dtype=np.uint8),
                 np.concatenate([[0], np.cumsum([len(r) for r in raw])]))


def _find(v: Vocab, h: np.ndarray) -> np.ndarray:
    """Place of each hash among the vocabulary's prefixes, or -1: a table by the top bits, most of whose slots hold one key or none."""
    top = (h >> U(64 - SLOT_BITS)).astype(np.int64)
    at = v.slot[top]
    some = at < v.slot[top + 1]
    hit = some & (v.keys[np.minimum(at, len(v.keys) - 1)] == h)
    out = np.where(hit, at, np.int32(-1))
    todo = np.flatnonzero(some & ~hit)
    at, end, h = at[todo] + 1, v.slot[top[todo] + 1], h[todo]
    go = at < end
    todo, at, end, h = todo[go], at[go], end[go], h[go]
    while len(todo):
        hit = v.keys[at] == h
        out[todo[hit]] = at[hit]
        at = at + 1
        go = ~hit & (at < end)
        todo, at, end, h = todo[go], at[go], end[go], h[go]
    return out


def _matches(v: Vocab, letter: np.ndarray, src: np.ndarray, left: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """By length: entries of ``src`` at whose characters a prefix of a piece starts, and its place in the vocabulary."""
    pos, h = np.arange(len(src)), np.zeros(len(src), dtype=U)
    for n in range(1, longest + 1):
        if n > 1:
            go = left[pos] >= n
            pos, h = pos[go], h[go]
        h = h * BASE + letter[src[pos] + (n - 1)]
        found = _find(v, mix(h))
        go = found >= 0  # only prefixes of pieces go on
        pos, h, found = pos[go], h[go], found[go]
        if not len(pos):
            break
        yield n, pos, found


def _cut_long(v: Vocab, cp: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Starts of units when those of more than ``UNIT`` characters are cut where no matching piece crosses."""
    long = size > UNIT
    first = np.concatenate([[0], np.cumsum(size[long])])
    src = np.repeat(start[long] - first[:-1], size[long]) + np.arange(first[-1])
    at = np.arange(len(src))
    left = np.repeat(first[1:], size[long]) - at
    reach = at + 1
    for n, pos, found in _matches(v, _letter(cp[src]), at, left, v.longest):
        pos = pos[v.ids[found] >= 0]
        reach[pos] = pos + n
    free = np.maximum.accumulate(reach)[:-1] <= at[1:]
    return np.union1d(start, src[1:][free])


class Lattice:
    """Distinct words of a slice: per character, the conditional probability of each piece length.

    Words are ranked by length, longest first, and a node is a word's character at some distance from its end. The nodes of one distance
    stand together in order of rank, so the nodes that edges of one length lead to are the head of another such block, and
    the backward sums run over whole blocks without looking anything up.
    """

    def __init__(self, v: Vocab, cp: np.ndarray, start: np.ndarray, size: np.ndarray):
        letter = _letter(cp)
        run = np.zeros(len(cp) + 1, dtype=U)
        np.cumsum(letter * _pow("b", len(cp)), out=run[1:])
        h = mix((run[start + size] - run[start]) * _pow("i", len(cp) + 1)[start] + size.astype(U))
        _, one, word = np.unique(h, return_index=True, return_inverse=True)
        one_size = size[one]
        most = int(one_size.max()) if len(one) else 0
        order = np.argsort(-one_size, kind="stable")
        rank = np.empty(len(one), dtype=np.int64)
        rank[order] = np.arange(len(one))
        self.rank = rank[word]
        last = (start[one] + one_size)[order]
        # Block d - 1 holds the nodes at distance d from the end, those of the words of at least d characters.
        held = np.searchsorted(-one_size[order], -np.arange(1, most + 1), side="right")
        self.base = np.concatenate([[0], np.cumsum(held)])
        total = int(self.base[-1])
        left = np.repeat(np.arange(1, most + 1), held)
        src = last[np.arange(total) - np.repeat(self.base[:-1], held)] - left
        self.cp = cp[src]
        longest = min(v.longest, max(most, 1))
        ids = np.full((longest, total), -1, dtype=np.int32)
        logp = np.full((longest, total), -np.inf, dtype=np.float32)
        used = 1
        for n, pos, found in _matches(v, letter, src, left, longest):
            ids[n - 1, pos] = v.ids[found]
            logp[n - 1, pos] = v.logp[found]
            used = n
        longest, ids, logp = used, ids[:used], logp[:used]
        none = np.flatnonzero(ids[0] < 0)
        c = self.cp[none]
        ids[0, none] = -2
        logp[0, none] = v.byte_logp * (1 + (c > 0x7F) + (c > 0x7FF) + (c > 0xFFFF))
        prob = np.zeros_like(logp)
        some = [np.logical_or.reduceat(logp[j] > -np.inf, self.base[:-1]).tolist() if most else [] for j in range(longest)]
        ahead: list[np.ndarray] = []  # log of the sum over all ways to the end, for the blocks done
        for d in range(1, most + 1):
            here, n = slice(self.base[d - 1], self.base[d]), int(held[d - 1])
            used = [j for j in range(min(d, longest)) if some[j][d - 1]]
            ways = [logp[j, here] + (ahead[d - j - 2][:n] if j + 1 < d else 0.0) for j in used]
            top = np.maximum.reduce(ways)
            share = [np.exp((w - top).astype(np.float32)) for w in ways]
            whole = sum(share[1:], share[0])
            ahead.append(top + np.log(whole, dtype=np.float64))
            for j, x in zip(used, share):
                np.divide(x, whole, out=prob[j, here])
        upto, behind = prob.copy(), np.zeros_like(prob)
        for j in range(1, longest):
            upto[j] += upto[j - 1]
            np.add(behind[-j], prob[-j], out=behind[-j - 1])
        # A row per node: the piece ids, their probabilities, the sums up to each edge, and of those behind it.
        self.ids, self.prob, self.upto, self.behind = (np.ascontiguousarray(x.T) for x in (ids, prob, upto, behind))


def _noise(key: np.ndarray, a: np.ndarray, what: int) -> np.ndarray:
    """Uniform numbers in (0, 1) from row key, place and purpose."""
    h = mix(mix(key + U(what * int(BASE) % 2**64)) ^ (a.astype(U) * U(0xD6E8FEB86659FD93)))
    return ((h >> U(11)).astype(np.float64) + 0.5) * 2.0**-53


class _Walk:
    """Units (words in documents) of a slice, and the steps of sampled paths through them."""

    def __init__(self, v: Vocab, cp: np.ndarray, doc_start: np.ndarray, key: np.ndarray):
        n = len(cp)
        begin = cp == BLANK
        begin[doc_start[:-1][np.diff(doc_start) > 0]] = True
        start = np.flatnonzero(begin)
        size = np.diff(np.append(start, n))
        if (size > UNIT).any():
            start = _cut_long(v, cp, start, size)
            size = np.diff(np.append(start, n))
        self.size, self.key = size, key
        self.unit = np.searchsorted(start, doc_start)
        self.doc = np.repeat(np.arange(len(key)), np.diff(self.unit))
        self.place = start - doc_start[self.doc]
        self.lat = Lattice(v, cp, start, size)
        self.rank = self.lat.rank

    def part(self, lo: int, hi: int) -> _Walk:
        """The units of documents ``lo`` to ``hi``, on the same lattice."""
        one = object.__new__(_Walk)
        a, b = self.unit[lo], self.unit[hi]
        one.size, one.key, one.unit = self.size[a:b], self.key[lo:hi], self.unit[lo:hi + 1] - a
        one.doc, one.place, one.rank, one.lat = self.doc[a:b] - lo, self.place[a:b], self.rank[a:b], self.lat
        return one

    def node(self, unit: np.ndarray, off: np.ndarray) -> np.ndarray:
        """The lattice's node of each unit's character ``off``."""
        return self.lat.base[self.size[unit] - off - 1] + self.rank[unit]

    def go(self, unit: np.ndarray, off: np.ndarray, rnd: int) -> tuple[np.ndarray, ...]:
        """Draw a path from each unit's character ``off`` to its end: unit, offset, edge, p, rest, in order of the units given."""
        steps, taken, own = [], np.zeros(len(unit), dtype=np.int64), np.arange(len(unit))
        while True:
            live = off < self.size[unit]
            unit, off, own = unit[live], off[live], own[live]
            if not len(unit):
                break
            taken[own] += 1
            edge, p, rest = self.pick(unit, off, None, rnd)
            steps.append((own, (unit, off, edge, p, rest)))
            off = off + edge + 1
        first = np.cumsum(taken) - taken
        out = tuple(np.zeros(int(taken.sum()), t) for t in (np.int64, np.int64, np.int64, np.float64, np.float64))
        for i, (own, cols) in enumerate(steps):  # every unit takes its i-th step in round i
            at = first[own] + i
            for whole, part in zip(out, cols):
                whole[at] = part
        return out

    def pick(self, unit: np.ndarray, off: np.ndarray, banned: np.ndarray | None, rnd: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Draw an edge not banned, by probability; its probability and that of the edges left."""
        node = self.node(unit, off)
        u = _noise(self.key[self.doc[unit]], self.place[unit] + off, 2 * rnd + 1).astype(np.float32)
        lat, row = self.lat, np.arange(len(node))
        if banned is None:
            cum = lat.upto[node]
        else:
            p = lat.prob[node]
            p[(banned[:, None] >> np.arange(p.shape[1])) & 1 == 1] = 0
            cum = np.cumsum(p, axis=1)
        last = cum[:, -1]
        u = np.minimum(u * last, np.nextafter(last, np.float32(0)))
        edge = (cum > u[:, None]).argmax(axis=1)
        mine = lat.prob[node, edge].astype(np.float64)
        if banned is None:
            rest = np.where(edge > 0, cum[row, edge - 1], np.float32(0)).astype(np.float64) + lat.behind[node, edge]
        else:
            p[row, edge] = 0
            rest = p.sum(axis=1, dtype=np.float64)
        return edge, mine, rest


def _below(phi: np.ndarray, top: np.ndarray, u: np.ndarray) -> np.ndarray:
    """A Gumbel of location ``phi``, given that it is below ``top``."""
    with np.errstate(over="ignore", divide="ignore", invalid="ignore"):
        g = phi - np.logaddexp(phi - top, np.log(-np.log(u)))
    return np.where(np.isneginf(phi), -np.inf, g)


def _prefix(logp: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Log-probability before each step, and of each whole document."""
    run = np.concatenate([[0.0], np.cumsum(logp)])
    at = np.searchsorted(doc, np.arange(n + 1))
    return run[:-1] - run[at[:-1]][doc], run[at[1:]] - run[at[:-1]]


def _best(doc: np.ndarray, g: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest entry of each document and its place (entries in document order)."""
    top, at = np.full(n, -np.inf), np.zeros(n, dtype=np.int64)
    if len(doc):
        first = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
        top[doc[first]] = np.maximum.reduceat(g, first)
        hit = np.flatnonzero(g == top[doc])[::-1]
        at[doc[hit]] = hit
    return top, at


def sample_part(w: _Walk, k: int) -> tuple[list[tuple], np.ndarray]:
    """For rounds 0 to k - 1: documents that have such a sample, their steps (unit, offset, edge), log-probabilities and
    perturbed values; and the threshold of every document."""
    n = len(w.key)
    docs = np.arange(n)
    unit, off, edge, p, rest = w.go(np.arange(len(w.size)), np.zeros(len(w.size), dtype=np.int64), 0)
    top = -np.log(-np.log(_noise(w.key, np.zeros(n), 0)))
    paths, front, found = [], [], []
    new, banned = np.arange(len(unit)), np.left_shift(1, edge)
    for r in range(k):
        doc = w.doc[unit]
        before, total = _prefix(np.log(p), doc, n)
        paths.append((unit, off, edge, p))
        found.append((docs, unit, off, edge, total, top))
        with np.errstate(divide="ignore"):
            phi = before[new] + np.log(rest[new])
        own = doc[new]
        g = _below(phi, top[own], _noise(w.key[own], w.place[unit[new]] + off[new], 2 * r + 2))
        front.append((own, g, new, banned[new]))
        per = [_best(f[0], f[1], n) for f in front]
        tops = np.stack([t for t, _ in per])
        which = tops.argmax(axis=0)
        limit = tops.max(axis=0)
        docs = np.flatnonzero(np.isfinite(limit))
        if r == k - 1 or not len(docs):
            break
        top = np.where(np.isfinite(limit), limit, -np.inf)
        parts, turn = [], np.full(n, -1, dtype=np.int64)
        for q in np.unique(which[docs]):
            mine = docs[which[docs] == q]
            entry = per[q][1][mine]
            front[q][1][entry] = -np.inf
            at, out = front[q][2][entry], front[q][3][entry]
            pu, po, pe, pp = paths[q]
            lo = np.searchsorted(pu, w.unit[mine])
            size = at - lo
            idx = np.repeat(lo - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
            parts.append((pu[idx], po[idx], pe[idx], pp[idx], np.zeros(len(idx)), np.zeros(len(idx), np.int64)))
            e, ep, erest = w.pick(pu[at], po[at], out, r + 1)
            parts.append((pu[at], po[at], e, ep, erest, out | np.left_shift(1, e)))
            turn[mine] = pu[at]
            done = w.go(pu[at], po[at] + e + 1, r + 1)
            parts.append((*done, np.left_shift(1, done[2])))
        later = np.flatnonzero((turn[w.doc] >= 0) & (np.arange(len(w.doc)) > turn[w.doc]))
        done = w.go(later, np.zeros(len(later), dtype=np.int64), r + 1)
        parts.append((*done, np.left_shift(1, done[2])))
        cols = [np.concatenate(c) for c in zip(*parts)]
        order = np.argsort(cols[0] * (int(w.size.max(initial=0)) + 1) + cols[1], kind="stable")
        unit, off, edge, p, rest, banned = (c[order] for c in cols)
        new = np.flatnonzero(banned)
    return found, limit


def _ids(v: Vocab, w: _Walk, unit: np.ndarray, off: np.ndarray, edge: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of the steps, characters without a piece as bytes; and each document's offset."""
    node = w.node(unit, off)
    ids = w.lat.ids[node, edge]
    doc = w.doc[unit]
    raw = np.flatnonzero(ids == -2)
    if len(raw):
        some = {c: [int(v.byte_ids[b]) for b in chr(c).encode("utf-8", "surrogatepass")] for c in np.unique(w.lat.cp[node[raw]]).tolist()}
        spelled = [some[c] for c in w.lat.cp[node[raw]].tolist()]
        width = np.ones(len(ids), dtype=np.int64)
        width[raw] = [len(x) for x in spelled]
        at = np.repeat(np.arange(len(ids)), width)
        out = ids[at]
        out[out == -2] = np.concatenate(spelled)
        ids, doc = out, doc[at]
    return ids, np.searchsorted(doc, np.arange(n + 1))


def _emit(v: Vocab, w: _Walk, doc_id: pa.Array, k: int) -> Iterator[pa.RecordBatch]:
    found, limit = sample_part(w, k)
    for r, (docs, unit, off, edge, total, top) in enumerate(found):
        ids, at = _ids(v, w, unit, off, edge, len(doc_id))
        with np.errstate(over="ignore"):
            inclusion = -np.expm1(-np.exp(np.where(np.isneginf(limit), np.inf, total - limit)))
        lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32()))
        some = pa.array(docs)
        yield pa.RecordBatch.from_arrays([doc_id.take(some), pa.array(np.full(len(docs), r), pa.int32()), lists.take(some),
                                          pa.array(total[docs]), pa.array(top[docs]), pa.array(inclusion[docs])], schema=_SAMPLES)


def _sample(model_file: str, k: int, alpha: float, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = load_vocab(model_file, alpha)
        for b in slices(batches, "text", _SLICE):
            col = b.column("text").cast(pa.large_string()).fill_null("")
            some = np.array([1 if x else 0 for x in pc.utf8_length(col).to_pylist()])
            size = pc.utf8_length(col).to_numpy(zero_copy_only=False).astype(np.int64) + some
            cp = np.frombuffer("".join(" " + x if x else "" for x in col.to_pylist()).encode("utf-32-le"), dtype=np.uint32).copy()
            cp[cp == 32] = BLANK
            key = mix(b.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(U) ^ U(seed))
            at = np.concatenate([[0], np.cumsum(size)])
            walk, lo = _Walk(v, cp, at, key), 0
            while lo < b.num_rows:
                hi = max(lo + 1, int(np.searchsorted(at, at[lo] + _PART, side="right")) - 1)
                yield from _emit(v, walk.part(lo, hi), b.column("doc_id").slice(lo, hi - lo), k)
                lo = hi

    return run


def sample_segmentations(docs: DataFrame, k: int = K, alpha: float = ALPHA, seed: int = SEED, model_file: str = MODEL) -> DataFrame:
    """Up to ``k`` distinct sampled segmentations per document, in sampling order.

    Rows ``doc_id, sample, ids, log_prob, perturbed, inclusion``. ``sample`` counts from 0; a text with fewer
    segmentations has fewer rows, each with inclusion 1. Null and empty texts have one empty
    segmentation. Repeated rows repeat their samples (noise is seeded by ``doc_id``; a null id counts as 0).
    The whole text is segmented; blanks are kept; characters outside the vocabulary become bytes; U+2581 counts as a blank. The model
    file has to be at ``model_file`` on every executor.
    """
    if k < 1:
        raise ValueError("k is at least 1")
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_sample(model_file, k, alpha, seed), _SAMPLES_DDL)


def _decode(model_file: str, ids: str, out_name: str = "decoded"):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = load_vocab(model_file)
        for b in batches:
            col = b.column(ids)
            at = np.concatenate([[0], np.cumsum(pc.list_value_length(col).fill_null(0).to_numpy(zero_copy_only=False))]).astype(np.int64)
            flat = pc.list_flatten(col).to_numpy(zero_copy_only=False).astype(np.int64)
            size = np.diff(v.surface_at)[flat]
            to = np.concatenate([[0], np.cumsum(size)])
            out = v.surface[np.repeat(v.surface_at[flat] - to[:-1], size) + np.arange(to[-1])].tobytes()
            cut = to[at]
            texts = [out[s + (e > s and out[s] == 32):e] for s, e in zip(cut[:-1], cut[1:])]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([t.decode("utf-8", "replace") for t in texts], pa.large_string()).cast(pa.string())],
                                             names=[*b.schema.names, out_name])

    return run


def decode_ids(rows: DataFrame, ids: str = "ids", model_file: str = MODEL) -> DataFrame:
    """``rows`` with ``decoded``: the text of the ids, without the blank that encoding puts in front.

    Underscores are put in front of the new column's name if ``rows`` has a column of that name. Null ids decode to an empty text. The
    vocabulary writes a blank as U+2581, so that character itself comes back as a blank.
    """
    name = free_name("decoded", rows.columns)
    return rows.mapInArrow(_decode(model_file, ids, name), ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + f", {name} string")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        col = b.column("ids")
        at = np.concatenate([[0], np.cumsum(pc.list_value_length(col).fill_null(0).to_numpy(zero_copy_only=False))]).astype(np.int64)
        raw = memoryview(pc.list_flatten(col).to_numpy(zero_copy_only=False).astype("<i4").tobytes())
        ids = [hashlib.sha256(raw[4 * s:4 * e]).hexdigest() for s, e in zip(at[:-1], at[1:])]
        texts = [hashlib.sha256(t.encode()).hexdigest() for t in b.column("decoded").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("sample"), pa.array(np.diff(at)), b.column("log_prob"), b.column("perturbed"), b.column("inclusion"),
             pa.array(ids), pa.array(texts)],
            names=["doc_id", "sample", "n_pieces", "log_prob", "perturbed", "inclusion", "ids_sha256", "decoded_sha256"])


def segmentation_digests(docs: DataFrame, k: int = K, alpha: float = ALPHA, seed: int = SEED, model_file: str = MODEL) -> DataFrame:
    """:func:`sample_segmentations` and :func:`decode_ids` in one stage, with ids (32-bit little-endian) and decoded text told by SHA-256.

    Rows ``doc_id, sample, n_pieces, log_prob, perturbed, inclusion, ids_sha256, decoded_sha256``.
    """
    sample, decode = _sample(model_file, k, alpha, seed), _decode(model_file, "ids")
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        lambda batches: _digest(decode(sample(batches))),
        "doc_id long, sample int, n_pieces long, log_prob double, perturbed double, inclusion double, ids_sha256 string, decoded_sha256 string")
