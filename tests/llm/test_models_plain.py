"""Language ID, quality rules and URL trees against plain versions of themselves."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from llm_docs import SF_SMALL, docs, texts  # noqa: F401 (fixtures)
from framelake.llm import langid, quality, urls
from framelake.llm.tokens import mix
from framelake.llm.trees import tree_column


def plain_grams(text):
    """n-gram hashes of a text's words, padded with a blank."""
    words, now = [], ""
    for c in (text or "") + " ":
        if c.isalpha():
            now += c.lower() if len(c.lower()) == 1 else c
        elif now:
            words.append(now)
            now = ""
    out = []
    for w in words:
        padded = [32, *map(ord, w), 32]
        out += padded[1:-1]
        out += [(a << 21) | b for a, b in zip(padded, padded[1:])]
        out += [(a << 42) | (b << 21) | c for a, b, c in zip(padded, padded[1:], padded[2:])]
    return Counter((mix(np.array(out, dtype=np.uint64)) >> np.uint64(24)).tolist()) if out else Counter()


def test_language_id_equals_the_plain_version(spark, docs, texts):
    d = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    learn = d.where(~langid.held_out(F.col("doc_id"))).collect()
    profiles = {}
    for lang in sorted({r["lang"] for r in learn if r["lang"]}):
        total = Counter()
        for r in learn:
            if r["lang"] == lang:
                total += plain_grams(r["text"])
        profiles[lang] = {g: i for i, (g, _) in enumerate(sorted(total.items(), key=lambda x: (-x[1], x[0]))[:langid.DEPTH])}
    rows = [(r["doc_id"], r["text"]) for r in d.collect()] + texts
    got = langid.identify(spark.createDataFrame(rows, "doc_id long, text string"), d).collect()
    want = []
    for i, t in rows:
        top = [g for g, _ in sorted(plain_grams(t).items(), key=lambda x: (-x[1], x[0]))[:langid.DEPTH]]
        far = {n: sum(abs(p[g] - k) if g in p else langid.DEPTH for k, g in enumerate(top)) for n, p in profiles.items()}
        best = min(far, key=lambda n: (far[n], n)) if top else "und"
        want.append((i, best, round(1 - far[best] / (len(top) * langid.DEPTH), 9) if top else 0.0))
    assert sorted(((r["doc_id"], r["lang_pred"], round(r["score"], 9)) for r in got), key=str) == sorted(want, key=str)


def test_too_many_languages_are_no_crash(spark, monkeypatch):
    monkeypatch.setattr(langid, "MAX_LANGUAGES", 3)
    rows = [(i, "the word and that", "en") for i in range(5)] + [(10 + i, "le mot et la", "fr") for i in range(4)]
    rows += [(20 + i, "das wort und der", "de") for i in range(3)] + [(30, "x y z", "zz"), (31, "q", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    with pytest.warns(UserWarning, match="languages"):
        assert set(langid.learn_profiles(df)) == {"en", "fr", "de"}
    assert set(langid.learn_profiles(df, sample_rows=6)) == {"en", "fr", "de"}


def plain_statistics(text):
    raw = (text or "").encode()
    low = bytes(b + 32 if 65 <= b <= 90 else b for b in raw)
    words = [w for w in re.split(rb"[\x20\x09-\x0d]+", low) if w]
    lines = [x for x in re.split(rb"[\x0a-\x0d]+", low) if x]
    n, size = len(words), max(len(raw), 1)
    upper, lower, digits = (sum(a <= b <= z for b in raw) for a, z in ((65, 90), (97, 122), (48, 57)))
    blank = sum(b in b" \t\n\r\x0b\x0c" for b in raw)
    mark = sum(b in b".,;:?'\"()-" for b in raw)
    symbol = sum(b < 128 for b in raw) - upper - lower - digits - blank - mark
    some, n_lines = max(n, 1), max(len(lines), 1)
    return [math.log1p(n), sum(map(len, words)) / some, max(map(len, words), default=0), upper / max(upper + lower, 1), digits / size, symbol / size,
            mark / size, blank / size, len(set(words)) / some, len(set(zip(words, words[1:]))) / max(n - 1, 1), max(Counter(words).values(), default=0) / some,
            sum(a == b for a, b in zip(words, words[1:])) / some, n / n_lines, 1 - len(set(lines)) / n_lines if lines else 0.0]


def test_quality_statistics_and_compiled_rules_equal_the_plain_version(spark, texts):
    d, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    every = [r["text"] for r in d.select("text").collect()] + [t for _, t in texts]
    stats = quality.text_statistics(pa.array(every))
    assert np.allclose(stats, [plain_statistics(t) for t in every])
    scores, model = quality.quality_scores(d, labels)
    assert len(model.rules) > 3
    by_id = {r["doc_id"]: plain_statistics(r["text"]) for r in d.collect()}
    for r in scores.collect():
        x = dict(zip(quality.STATS, by_id[r["doc_id"]]))
        total = model.intercept + sum(w for w, conds in model.rules if all((x[c.feature] <= c.threshold) == c.below for c in conds))
        assert math.isclose(r["score"], 1 / (1 + math.exp(-total)), rel_tol=1e-9) and r["predicted"] == int(r["score"] >= 0.7)


def plain_features(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    url = url or ""
    query = m[1] if (m := re.search(r"\?([^#]*)", url)) else ""
    digits = lambda s: sum(c in "0123456789" for c in s)
    shares = [n / len(url) for n in Counter(url).values()]
    return [len(url), len(host), len(path), path.count("/"), host.count(".") + 1, digits(url) / max(len(url), 1), digits(host), host.count("-"),
            -sum(p * math.log2(p) for p in shares), query.count("&") + 1 if query else 0, len(query), "#" in url,
            bool(re.search(r"\.[A-Za-z0-9]{1,5}$", path))]


def test_url_features_and_compiled_trees_equal_the_plain_version(spark):
    rnd = random.Random(2)
    every = [None, "", "no scheme", "http://A.B-c.org:80/x/y.html?q=1&z=#f", "https://h?x", "ftp://é.com/ä#?", "http://a.b/?a=b=c&&d"]
    every += ["".join(rnd.choice("abz09-._/?&#=:") for _ in range(rnd.randint(0, 60))).replace(":", "://", 1) for _ in range(300)]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(every)], "page_id long, url string")
    names = urls.FEATURES[:-2]
    feats = urls.lexical_features(urls.url_parts(df)).select("page_id", *names)
    got = {r["page_id"]: list(r)[1:] for r in feats.collect()}
    assert all(np.allclose(got[i], [float(v) for v in plain_features(u)]) for i, u in enumerate(every))
    data = VectorAssembler(inputCols=names, outputCol="features").transform(feats.withColumn("label", ((F.col("url_len") + F.col("depth")) % 3 == 0).cast("double")))
    model = GBTClassifier(labelCol="label", maxIter=6, maxDepth=3, seed=5).fit(data)
    margin = sum((F.lit(float(w)) * tree_column(t, names) for w, t in zip(model.treeWeights, model.trees)), F.lit(0.0))
    both = model.transform(data.withColumn("mine", 1 / (1 + F.exp(-2 * margin)))).select("mine", "probability").collect()
    assert np.allclose([r["mine"] for r in both], [r["probability"][1] for r in both])
