"""The manifest against plain Python trees, over groups of many sizes."""

import hashlib
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from llm_docs import SF_SMALL, docs, texts  # noqa: F401 (fixtures)
from framelake.llm import merkle
from framelake.llm.queries import ORACLE, QUERIES
from oracle_compare import duck

DDL = "doc_id long, text string, lang string, source string, n_chars long, at int, block int, digest string, root string"


def h(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(d, text, lang, source, n):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (d, source, lang, n, text)))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i:i + 3])) for i in range(0, len(out[-1]), 3)])
    return out


def brute(rows):
    groups = {}
    for d, text, lang, source, n in rows:
        shown = text.replace("\n", "") if text and d is not None and crc32(str(d).encode()) % 2 == 0 else text
        groups.setdefault(source, []).append(((d is not None, d), leaf(d, text, lang, source, n), leaf(d, shown, lang, source, n)))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels([x[1] for x in sorted(g)]) for s, g in groups.items()}
    over = levels([trees[s][-1][0] for s in order])
    out = []
    for s, g in groups.items():
        for i, (d, lf, shown) in enumerate(sorted(g)):
            folded, proof = shown, ""
            for tree, at in ((trees[s], i), (over, order.index(s))):
                for nodes in tree[:-1]:
                    run = nodes[at // 3 * 3:at // 3 * 3 + 3]
                    proof += "".join(x for k, x in enumerate(run) if k != at % 3)
                    folded = h("".join(folded if k == at % 3 else x for k, x in enumerate(run)))
                    at //= 3
            out.append((d[1], lf, trees[s][-1][0], over[-1][0], h(proof), folded, folded == over[-1][0]))
    return sorted(out, key=str)


def rows_of(sizes):
    out, d = [], 0
    for s, size in sizes.items():
        for i in range(size):
            text = [None, "", "a\nb", "é  x", f"t{d}\n"][d % 5]
            out.append((d, text, None if d % 7 == 0 else "en", s, None if d % 11 == 0 else d * 3))
            d += 1
    out += [(3, "a\nb", "en", "s0", 1)] * 2 + [(None, "x\n", "en", "s0", 1), (None, None, None, None, None)]
    return out


SIZES = {"s0": 1, "s1": 2, "s2": 3, "s3": 4, "s4": 9, "s5": 10, "s6": 28, "ß": 243, "Z": 244, None: 81, "": 82, "hot": 1500, "日本": 30}


@pytest.mark.parametrize("sizes", [SIZES, {"one": 1}, {f"g{i:03}": 1 + i % 2 for i in range(260)}])
def test_manifest_matches_plain_trees(spark, sizes):
    rows = rows_of(sizes)
    df = spark.createDataFrame([(*r, 7, 7, "x", "y") for r in rows], DDL).repartition(6)
    out = merkle.tamper_report(df).drop("source")
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted((tuple(r) for r in out.collect()), key=str) == brute(rows)


def test_awkward_texts_and_no_rows(spark, docs, texts):
    out = merkle.tamper_report(docs).drop("source").collect()
    assert sorted((tuple(r) for r in out), key=str) == brute([(d, t, "en", "s", 1) for d, t in texts])
    assert merkle.tamper_report(docs.limit(0)).count() == 0


def test_real_proofs_and_no_join(spark, docs):
    rows = docs.select("doc_id", "source", merkle.row_digest(F.col("doc_id"), F.col("text")).alias("leaf"))
    out = merkle.manifest(rows, "source", "doc_id", "leaf")
    assert out.columns == ["source", "doc_id", "leaf", "subroot", "root", "proof"]
    assert out.where(merkle.fold(F.col("leaf"), F.col("proof")) != F.col("root")).isEmpty()
    assert out.where("exists(proof, s -> s.at >= size(s.run) or size(s.run) > 3)").isEmpty()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Python" not in plan and "Arrow" not in plan


def test_registered_query_matches_its_sql(spark):
    out = QUERIES["op13_merkle_manifest"](spark, SF_SMALL)
    rel = duck(SF_SMALL).sql(ORACLE["op13_merkle_manifest"])
    assert out.columns == rel.columns
    assert sorted(tuple(r) for r in out.collect()) == sorted(rel.fetchall())
    assert 0 < out.where("verified").count() < out.count()
