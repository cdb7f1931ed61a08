"""Spelling variants against a plain version: every pair of words compared letter by letter."""

import random
import re
from collections import Counter
from zlib import crc32

import pytest

from llm_docs import docs, make_docs, texts  # noqa: F401 (fixtures)
from framelake.llm import spelling


def brute_words(rows):
    out = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate({c: c + 32 for c in range(65, 91)})
            h = crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 97 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            if len(run) >= 5:
                out[run] += 1
    return {w: n for w, n in out.items() if n >= 3}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) < len(b):
        a, b = b, a
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1:] == b for i in range(len(a)))


def brute_groups(words):
    out, form = {}, {}
    for w in words:
        near = [v for v in words if abs(len(v) - len(w)) < 2 and one_edit(v, w)]
        best = min(near, key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= 2 * words[w]:
            form[w] = best
        out[w] = len(near)
    rows = []
    for w in words:
        r = w
        while r in form:
            r = form[r]
        f = form.get(w)
        rows.append((w, f, r, words[w], out[w], words[f] if f else None))
    return sorted(rows)


def variants():
    rnd = random.Random(11)
    letters = "abcdeéàÿßð"
    base = ["".join(rnd.choice(letters) for _ in range(rnd.randint(5, 9))) for _ in range(60)] + ["aaaaaa", "aaaaa", "z" * 70, "y" * 64 + "x"]
    rows = []
    for i in range(700):
        w = base[int(len(base) * rnd.random() ** 3)]
        for _ in range(rnd.randint(0, 2)):
            k, c = rnd.randrange(len(w)), rnd.choice(letters)
            w = rnd.choice([w[:k] + w[k + 1:], w[:k] + c + w[k + 1:], w[:k] + c + w[k:], w])
        rows += [(i, f"{w} {w.upper()}, {w}×1-{w} {w}")]
    long = "".join(rnd.choice(letters) for _ in range(3000))
    rows += [(9000 + i, f"{t} {t} {t} " * (3 if i == 0 else 1)) for i, t in enumerate([long, long[:1500] + long[1501:], long[:70] + "q" + long[71:], "z" * 65, "z" * 64, "z" * 63])]
    return rows + [(None, "zzzzzz zzzzzz zzzzzz"), (1, None), (2, ""), (3, "1 2 ¿? Ābcdefg ÀÉÎÕÜ"), (3, "ÀÉÎÕÜ"), (3, "ÀÉÎÕÜ")]


@pytest.mark.parametrize("symbols", [None, 2, 13])
def test_groups_match_brute_force(spark, symbols):
    rows = variants()
    got = spelling.spelling_groups(make_docs(spark, rows).repartition(4), symbols=symbols)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = brute_groups(brute_words(rows))
    assert sorted(tuple(r) for r in got.collect()) == want
    assert len(want) > 300 and any(f and f != r for _, f, r, *_ in want) and any(f and len(w) > 65 for w, f, *_ in want)


def test_vocabulary_of_awkward_texts(spark, docs, texts):
    got = {r["word"]: r["n"] for r in spelling.vocabulary(docs).collect()}
    assert got == brute_words(texts)


def test_no_words(spark, docs):
    assert spelling.spelling_groups(docs.limit(0)).count() == 0
    assert spelling.spelling_groups(make_docs(spark, [(1, None), (2, "a b c")])).count() == 0
