"""Small documents with the awkward cases: nulls, empty and long texts, ties, repeated rows, clashing extra columns."""

import random

import pytest

SF_SMALL = "/root/testdata/sf0.001"

DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp long, block int, sha string"


def make_docs(spark, rows):
    """Rows ``(doc_id, text)`` with extra columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, "en", "s", 1, 7, 7, "x") for i, t in rows], DOCS)


@pytest.fixture(scope="session")
def texts():
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(2, 8))) for _ in range(400)]
    base = [" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 120))) for _ in range(60)]
    rows = []
    for i, t in enumerate(base):
        rows.append((i, t))
        w = t.split()
        if len(w) > 30:
            for c in range(3):  # near copies
                v = list(w)
                for _ in range(c):
                    v[rnd.randrange(len(v))] = "changed%d" % c
                rows.append((1000 + 10 * i + c, " ".join(v).upper() if c == 1 else " ".join(v)))
    long = " ".join(rnd.choice(words) for _ in range(20_000))
    rows += [(5000, None), (5001, ""), (5002, "   \n\t "), (5003, "one"), (5004, "ONE"), (5005, "one two three"), (5006, long), (5007, long + " end"),
             (5008, base[0]), (5009, base[0]), (5009, base[0]), (None, base[1]), (5010, "é\u2028ü 中文 \u0085 x"), (5011, "a" * 3000)]
    return rows


@pytest.fixture(scope="session")
def docs(spark, texts):
    return make_docs(spark, texts).repartition(5)
