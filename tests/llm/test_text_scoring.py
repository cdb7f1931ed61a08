"""Decontamination, language ID, quality rules, language-model scores and sampled segmentations."""

import hashlib
import itertools
import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_docs import SF_SMALL, docs, texts  # noqa: F401 (fixtures)
from framelake.llm import decontam, langid, lm, quality, spm

LOW = {c: c + 32 for c in range(65, 91)}


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def brute_hits(rows, items, size):
    win = {}
    for i, t in items:
        w = alnum(t)
        n = min(size, len(w))
        for p in range(len(w) - n + 1 if n else 0):
            win.setdefault(tuple(w[p:p + n]), set()).update([] if i is None else [str(i)])
    out = []
    for d, t in rows:
        w, hit, found = alnum(t), set(), set()
        for n in {len(k) for k in win}:
            for p in range(len(w) - n + 1):
                if (x := win.get(tuple(w[p:p + n]))) is not None:
                    hit.update(range(p, p + n))
                    found |= x
        out.append((d, len(w), len(hit), sorted(found)))
    return sorted(out, key=str)


ITEMS = [(1, None), (2, ""), (3, "one"), (4, "!!!"), (10, "ONE two"), (11, "x"), (12, "changed1")]


@pytest.mark.parametrize("limit", [decontam.BROADCAST_WINDOWS, 0])
def test_decontamination_matches_brute_force(spark, docs, texts, limit):
    long = next(t for d, t in texts if d == 5006).split()
    items = ITEMS + [(20, " ".join(long[500:530]).upper()), (21, " ".join(long[510:516])), (20, "one"), (None, " ".join(long[900:925]))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    report = decontam.contamination(docs, bench, 10, limit)
    got = sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in report.collect()), key=str)
    assert got == brute_hits(texts, items, 10)
    unique = docs.dropDuplicates(["doc_id"]).filter("doc_id is not null")
    cut = {r["doc_id"]: r["text"] for r in decontam.cut_spans(unique, report.dropDuplicates(["doc_id"])).collect()}
    whole = dict(texts)
    for d, n_words, n_hit, _ in got:
        if d is not None and whole[d] is not None and n_words < 1000:
            assert len(alnum(cut[d])) == n_words - n_hit
    clean = decontam.drop_contaminated(docs, report)
    assert clean.columns == docs.columns and clean.count() == sum(1 for x in got if x[2] == 0)
    digest = {r["doc_id"]: r["items_sha256"] for r in decontam.digest_columns(report).collect()}
    assert digest[5003] == hashlib.sha256(b"20,3").hexdigest()


@pytest.mark.parametrize("limits", [(decontam.BROADCAST_WINDOWS, 1 << 20), (0, 1 << 20), (10, 0)])
def test_items_without_id_and_documents_without_id(spark, monkeypatch, limits):
    """An item without an id is hit; documents without an id are cut; own columns named like the helper's stay."""
    monkeypatch.setattr(decontam, "BROADCAST_BYTES", limits[1])
    words = [f"w{i}" for i in range(40)]
    docs = spark.createDataFrame([(None, "a " + " ".join(words[3:20]) + " z", 1, "s"), (1, " ".join(words), 2, "t"), (2, "clean text", 3, "u")],
                                 "doc_id long, text string, spans int, cut_id string")
    bench = spark.createDataFrame([(None, " ".join(words[:30])), (7, " ".join(words[15:38]))], "item_id long, text string")
    report = decontam.contamination(docs, bench, 10, limits[0])
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in report.collect()}
    assert got == {None: (19, 17, []), 1: (40, 38, ["7"]), 2: (2, 0, [])}
    cut = decontam.cut_spans(docs, report)
    assert cut.schema == docs.schema
    assert {tuple(r) for r in cut.collect()} == {(None, "a  z", 1, "s"), (1, " w38 w39", 2, "t"), (2, "clean text", 3, "u")}


def test_filter_passes_all_windows_and_few_others(spark):
    wins = spark.range(20_000).select(F.xxhash64("id").alias("h"))
    size, flags = decontam.bloom_filter(wins, 20_000)

    def share(df):
        h = df.toPandas()["h"].to_numpy().view(np.uint64)
        one, two = decontam._bits(h, size)
        return (((flags[one >> 3] >> (7 - (one & 7))) & (flags[two >> 3] >> (7 - (two & 7)))) & 1).mean()

    assert share(wins) == 1 and share(spark.range(20_000, 60_000).select(F.xxhash64("id").alias("h"))) < 0.05


def test_decontamination_without_benchmark(spark, docs, texts):
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontam.contamination(docs, empty).agg(F.sum("n_hit"), F.count("*")).first()[:] == (0, len(texts))


def test_language_id_held_out_accuracy_and_edges(spark):
    d = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = {r["doc_id"]: r for r in langid.identify(d, d).collect()}
    truth = {r["doc_id"]: r["lang"] for r in d.select("doc_id", "lang").collect()}
    held = [r for r in out.values() if r["held_out"]]
    assert sum(truth[r["doc_id"]] == r["lang_pred"] for r in held) / len(held) >= 0.95
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 !!"), (None, "the of and"), (5, "中文"), (5, "中文")], "doc_id long, text string")
    got = {(r["doc_id"], r["lang_pred"]): r["score"] for r in langid.identify(odd, d).collect()}
    assert all(got[(i, "und")] == 0.0 for i in (1, 2, 3)) and all(0 <= s <= 1 for s in got.values())
    none = langid.identify(odd, d.limit(0)).collect()
    assert len(none) == 6 and {r["lang_pred"] for r in none} == {"und"}


def test_rare_languages_are_learned_from_a_large_table(spark):
    rows = spark.range(6000).selectExpr("id as doc_id", "if(id % 2 = 0, 'the word and', 'der die und') as text", "if(id % 2 = 0, 'en', 'de') as lang")
    rare = spark.createDataFrame([(7001, "qua quo", "xx"), (7002, "qui que", "xx"), (7003, "zzz", "yy"), (7004, "n", None)], "doc_id long, text string, lang string")
    table = rows.unionByName(rare)
    got = langid.learn_profiles(table, sample_rows=60)
    assert sorted(got) == ["de", "en", "xx", "yy"] and got["xx"] == langid.learn_profiles(rare)["xx"]
    assert sorted(langid.learn_profiles(table, sample_rows=1)) == ["de", "en", "xx", "yy"]


def test_profiles_rank_by_count():
    import pyarrow as pa

    keys = langid.gram_keys(pa.array(["Ab ab", None, "1"]), np.arange(3))
    owner, gram, rank = langid._ranked(keys, 300)
    # 'ab' twice: letters a, b; pairs _a, ab, b_; triples _ab, ab_: seven n-grams, each twice
    assert len(gram) == 7 and set(owner) == {0} and sorted(rank) == list(range(7)) and len(keys) == 14


def test_quality_statistics_by_hand():
    import pyarrow as pa

    x = dict(zip(quality.STATS, quality.text_statistics(pa.array(["AB ab ab\nab ab", None, ""]))[0]))
    assert x["upper_share"] == 0.2 and x["top_word"] == 1.0 and x["distinct_words"] == 0.2 and x["repeated_word"] == 0.8
    assert x["longest_word"] == 2 and x["line_words"] == 2.5 and x["repeated_lines"] == 0.0
    assert not quality.text_statistics(pa.array([None, ""])).any()


def test_quality_rules_held_out_accuracy_and_edges(spark):
    sf = SF_SMALL.replace("sf0.001", "sf0.01")
    d, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    odd = spark.createDataFrame([(900001, None), (900002, ""), (None, "x"), (900003, "As " * 4000)], "doc_id long, text string")
    scores, model = quality.quality_scores(d.select("doc_id", "text").unionByName(odd), labels.unionByName(labels.limit(5)).withColumn("score", F.lit(1)))
    got = scores.collect()
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert sum(truth[r["doc_id"]] == r["predicted"] for r in held) / len(held) >= 0.95
    assert len(got) == d.count() + 4 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got)
    assert 0 < len(model.rules) < 12 * 14 and len(model.describe()) == len(model.rules)
    kept = quality.keep_good(d, scores)
    assert kept.columns == d.columns and kept.count() == sum(r["predicted"] for r in got if r["doc_id"] is not None and r["doc_id"] < 900001)


def test_quality_without_labels(spark):
    d = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    scores, model = quality.quality_scores(d, spark.createDataFrame([], "doc_id long, quality int"))
    assert [round(r["score"], 6) for r in scores.collect()] == [0.99, 0.99] and not model.rules


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))


@pytest.mark.parametrize("order", [1, 2, 3])
def test_stupid_backoff_matches_brute_force(spark, docs, texts, order):
    corpus = [t for _, t in texts if t][:80]
    counts = Counter(tuple(w[i:i + n]) for w in map(words, corpus) for n in range(1, order + 1) for i in range(len(w) - n + 1))
    total = sum(len(words(t)) for t in corpus)

    def score(w):
        s = 0.0
        for i in range(len(w)):
            weight = 1.0
            for n in range(min(order, i + 1), 0, -1):
                g = tuple(w[i - n + 1:i + 1])
                if counts[g]:
                    s += math.log(weight * counts[g] / (counts[g[:-1]] if n > 1 else total))
                    break
                if n > 1:
                    weight *= 0.4
            else:
                s += math.log(weight / (total + 1))
        return s

    corpus_df = spark.createDataFrame([(i, t) for i, t in enumerate(corpus)], "doc_id long, text string").repartition(3)
    got = lm.lm_scores(docs, corpus_df, order=order, block_rows=40).collect()
    exp = sorted((len(words(t)), round(score(words(t)), 6)) for _, t in texts)
    out = sorted((r["n_words"], round(r["log_score"], 6)) for r in got)
    assert [n for n, _ in out] == [n for n, _ in exp] and [s for _, s in out] == pytest.approx([s for _, s in exp])
    assert all((r["mean_log_score"] is None) == (r["n_words"] == 0) for r in got)


def test_scores_of_the_corpus_itself_and_of_nothing(spark, docs, texts):
    own = lm.lm_scores(docs, block_rows=25).agg(F.sum("log_score")).first()[0]
    other = lm.lm_scores(docs, docs, block_rows=60).agg(F.sum("log_score")).first()[0]
    assert own == pytest.approx(other)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert lm.lm_scores(empty).count() == 0
    unseen = lm.lm_scores(docs, empty).filter("n_words = 1").first()
    assert unseen["log_score"] == 0.0  # one unseen word of an empty corpus: 1 / (0 + 1)


def test_registered_scores_use_trigrams_and_lists_pack_without_loss(spark, tmp_path):
    from framelake.llm.queries import QUERIES

    rows = [(1, "a b c a b c a b c"), (2, "x b d x b d x b d"), (3, "a b c"), (4, "a b d")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r["log_score"] for r in QUERIES["op7_stupid_backoff"](spark, str(tmp_path)).collect()}
    assert got[3] - got[4] == pytest.approx(math.log(3 / 4) - math.log(0.4 * 3 / 7))  # c and d differ after 'a b' alone
    rnd = np.random.default_rng(5)
    for n in (1, 7, 5000):
        hashes, counts = np.unique(rnd.integers(0, 1 << 48, n, dtype=np.uint64)), rnd.integers(0, 1 << 33, n)
        counts[n // 2:] %= 3
        assert (lm._unpack_sorted(lm._pack_sorted(hashes), len(hashes)) == hashes).all() and (lm._unpack(lm._pack(counts), n) == counts).all()


def test_registered_scores_leave_out_the_document_itself(spark, tmp_path):
    from framelake.llm.queries import QUERIES

    rows = [(1, "the cat sat on the mat"), (2, "the cat sat on a mat the cat"), (3, "qzx vkw qzx vkw jjq qzx vkw"), (4, "The cat"), (4, "The cat"),
            (5, None), (6, "  "), (7, "mat"), (8, "qzy")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")

    def score(mine):
        rest = [words(t) for i, (_, t) in enumerate(rows) if i != mine]
        counts = Counter(tuple(w[i:i + n]) for w in rest for n in range(1, lm.ORDER + 1) for i in range(len(w) - n + 1))
        total, s, w = sum(map(len, rest)), 0.0, words(rows[mine][1])
        for i in range(len(w)):
            weight = 1.0
            for n in range(min(lm.ORDER, i + 1), 0, -1):
                g = tuple(w[i - n + 1:i + 1])
                if counts[g]:
                    s += math.log(weight * counts[g] / (counts[g[:-1]] if n > 1 else total))
                    break
                weight *= lm.BACKOFF if n > 1 else 1 / (total + 1)
            else:
                s += math.log(weight)
        return s

    got = sorted((r["doc_id"], r["log_score"]) for r in QUERIES["op7_stupid_backoff"](spark, str(tmp_path)).collect())
    assert [s for _, s in got] == pytest.approx([s for _, s in sorted((r[0], score(i)) for i, r in enumerate(rows))])
    assert dict(got)[3] < -7 * math.log(20)  # words found nowhere else


def test_segmentations_round_trip_and_are_distinct(docs, texts):
    got = spm.decode_ids(spm.sample_segmentations(docs, k=3)).collect()
    by_doc = {}
    whole = dict(texts)
    for r in got:
        if r["doc_id"] != 5010:
            assert r["decoded"] == (whole[r["doc_id"]] or "")
        by_doc.setdefault((r["doc_id"], r["sample"]), []).append(tuple(r["ids"]))
        assert 0 <= r["inclusion"] <= 1 and r["log_prob"] <= 1e-4
    for d in {d for d, _ in by_doc if d is not None}:
        mine = [by_doc[(d, s)][0] for s in range(3) if (d, s) in by_doc]
        assert len(set(mine)) == len(mine) >= 1
    assert len(by_doc[(5009, 0)]) == 2 and len(set(by_doc[(5009, 0)])) == 1  # repeated rows repeat their samples
    assert by_doc[(5000, 0)] == [()] and (5000, 1) not in by_doc
    again = {(r["doc_id"], r["sample"]): tuple(r["ids"]) for r in spm.sample_segmentations(docs.coalesce(1), k=3).collect()}
    assert all(again[k] in v for k, v in by_doc.items())  # independent of partitions


def test_segmentation_sampling_follows_the_lattice(spark):
    """First samples follow the path probabilities; without replacement, short texts list every path in k samples."""
    v = spm.load_vocab()
    logp = {int(i): float(p) for i, p in zip(v.ids, v.logp) if i >= 0}
    piece = {}
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=spm.MODEL)
    for i in logp:
        piece[sp.id_to_piece(i)] = i
    text = "\u2581ther"
    paths = []
    for cuts in itertools.product([0, 1], repeat=len(text) - 1):
        at = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(text)]
        parts = [text[a:b] for a, b in zip(at[:-1], at[1:])]
        if all(p in piece for p in parts):
            paths.append((tuple(piece[p] for p in parts), sum(logp[piece[p]] for p in parts)))
    z = math.log(sum(math.exp(s) for _, s in paths))
    n = 4000
    df = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("ther").alias("text"))
    rows = spm.sample_segmentations(df, k=len(paths) + 3, alpha=1.0).collect()
    assert len(rows) == n * len(paths)
    exact = {ids: math.exp(s - z) for ids, s in paths}
    first = Counter(tuple(r["ids"]) for r in rows if r["sample"] == 0)
    for ids, p in exact.items():
        assert abs(first[ids] / n - p) < 4 * math.sqrt(p * (1 - p) / n) + 1e-3
    for r in rows[:200]:
        assert r["log_prob"] == pytest.approx(math.log(exact[tuple(r["ids"])]), abs=1e-4)
    for d in range(20):
        g = [r["perturbed"] for r in sorted((r for r in rows if r["doc_id"] == d), key=lambda r: r["sample"])]
        assert g == sorted(g, reverse=True)
    # inclusion scores make unbiased totals: sum over samples of weight / inclusion is near 1 on average
    two = spm.sample_segmentations(df, k=2, alpha=1.0).collect()
    assert abs(sum(math.exp(r["log_prob"]) / r["inclusion"] for r in two) / n - 1) < 0.05


def test_long_words_have_their_whole_lattice(spark):
    """Against the uncut lattice: normalised log-probabilities, and pieces across every 64th character."""
    import sentencepiece

    v = spm.load_vocab()
    sp = sentencepiece.SentencePieceProcessor(model_file=spm.MODEL)
    logp = {sp.id_to_piece(int(i)): float(p) for i, p in zip(v.ids, v.logp) if i >= 0}
    by_id = {int(i): float(p) for i, p in zip(v.ids, v.logp) if i >= 0}
    texts = ["thereandinternationalinformation" * 32, "\n".join(["theinternational"] * 60), "\u4e2d\u6587\u5b57" * 340, "the " + "QmFzZTY0" * 125 + " end"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = spm.decode_ids(spm.sample_segmentations(df, k=2)).collect()
    assert {r["doc_id"] for r in rows} == {0, 1, 2, 3}
    crossed = 0
    for r in rows:
        text = "\u2581" + texts[r["doc_id"]].replace(" ", "\u2581")
        assert r["decoded"] == texts[r["doc_id"]]
        back = [-math.inf] * len(text) + [0.0]
        for i in range(len(text) - 1, -1, -1):
            edges = [logp[text[i:j]] + back[j] for j in range(i + 1, min(len(text), i + v.longest) + 1) if text[i:j] in logp]
            if text[i] not in logp:
                edges.append(v.byte_logp * len(text[i].encode()) + back[i + 1])
            top = max(edges)
            back[i] = top + math.log(sum(math.exp(e - top) for e in edges))
        assert r["log_prob"] == pytest.approx(sum(by_id.get(i, v.byte_logp) for i in r["ids"]) - back[0], abs=0.01)
        if r["doc_id"] == 0:
            ends = set(itertools.accumulate(len(sp.id_to_piece(i)) for i in r["ids"]))
            crossed += sum(i not in ends for i in range(64, len(text), 64))
    assert crossed > 0


def test_decoding_beside_a_column_of_that_name(spark):
    rows = spm.sample_segmentations(spark.createDataFrame([(1, "a\u2581b c"), (2, None)], "doc_id long, text string"), k=1)
    got = spm.decode_ids(rows.withColumn("decoded", F.lit("own")))
    assert got.columns == [*rows.columns, "decoded", "_decoded"]
    assert {(r["doc_id"], r["decoded"], r["_decoded"]) for r in got.collect()} == {(1, "own", "a b c"), (2, "own", "")}
    none = spm.decode_ids(spark.createDataFrame([(1, None), (2, [])], "x int, ids array<int>")).collect()
    assert [r["decoded"] for r in none] == ["", ""]


def test_long_and_short_units_in_one_slice(spark):
    """Words of very different lengths share the lattice's blocks: each document's samples are those it has alone."""
    texts = ["ab" * 900, "a", "the quick brown fox", "x" * 300 + " é" * 50, "中文" * 200, "b ab " * 40]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    both = {(r["doc_id"], r["sample"]): (r["ids"], r["log_prob"]) for r in spm.sample_segmentations(df, k=3).collect()}
    for i in range(len(texts)):
        for r in spm.sample_segmentations(df.where(F.col("doc_id") == i), k=3).collect():
            ids, logp = both[i, r["sample"]]
            assert ids == r["ids"] and math.isclose(logp, r["log_prob"], rel_tol=1e-9, abs_tol=1e-9)


def test_segmentation_of_an_empty_table(spark):
    assert spm.segmentation_digests(spark.createDataFrame([], "doc_id long, text string")).count() == 0
