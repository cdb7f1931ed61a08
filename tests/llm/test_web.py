"""HTML extraction, WARC salvage, URL filter."""

import gzip
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from llm_docs import SF_SMALL
from framelake.llm import urls, warc
from framelake.llm.html import extract_text, main_text
from framelake.llm.queries import ORACLE, QUERIES, URL_RULES

PROSE = "The quick fox was in the garden and it had not been seen by any of the people who were there for the day. "


def test_article_is_kept_whole():
    page = ("<html><head><title>T</title><style>p{}</style></head><body><nav><a href=x>Home</a></nav><div class='ad box'>" + PROSE + "</div>"
            "<article><h1>Head &amp; more</h1><p>Short.<br>next <b>bold<p>" + PROSE + "<!-- hidden --><p>$$$ %%% ###</p>"
            "<div id=comments><p>" + PROSE + "</p></div><form>name <input></form><script>var t='</p>';</script><p>x&nbsp;y\n z</p></article>"
            "<footer>&copy; me</footer></body>")
    assert main_text(page).split("\n") == ["Head & more", "Short. next bold", PROSE.strip(), "$$$ %%% ###", "x y z"]


def test_pages_without_an_article_use_both_passes():
    page = ("<body><div class=menu><p>a menu</p></div><h2>Heading</h2><p>" + PROSE * 3 + "</p><p>Short one.</p><p>" + PROSE * 2 + "</p>"
            "<ul>" + "<li><a href=y>A link that is long enough to count as text here</a></li>" * 5 + "</ul><p>Tail.</p></body>")
    assert main_text(page).split("\n") == ["Heading", (PROSE * 3).strip(), "Short one.", (PROSE * 2).strip()]


def test_wrappers_named_by_their_layout_are_kept():
    for tag in ("body class='single has-sidebar comments-open'", "body class=sidebar", "div class='content no-sidebar'", "div class='page right-sidebar'", "div id=widget"):
        page = f"<{tag}><h2>Head</h2><p>{PROSE * 3}</p><div class='comment-list'><p>{PROSE}</p></div><div id=sidebar-1><p>{PROSE}</p></div></{tag.split()[0]}>"
        assert main_text(page).split("\n") == ["Head", (PROSE * 3).strip()], tag
    inside = f"<article><div class='entry has-related'><p>{PROSE}</p></div><div class='related-posts'><p>{PROSE}</p></div></article>"
    assert main_text(inside) == PROSE.strip()
    assert main_text(f"<div><p>{PROSE * 2}</p></div><div class=comments><p>{PROSE * 9}</p></div>") == (PROSE * 2).strip()


def test_articles_in_comments_are_not_the_main_text():
    comments = f"<div class='comments'><article class='comment'><p>{PROSE}</p></article><article><p>{PROSE}</p></article></div>"
    for end in (comments, comments * 9, f"<article class='comment'><p>{PROSE}</p></article>", f"<div class=sidebar><article><p>{PROSE}</p></article></div>"):
        for page in (f"<div id=page><div class=text><p>{PROSE * 3}</p></div>{end}</div>", f"<article><p>{PROSE * 3}</p>{end}</article>"):
            assert main_text(page) == (PROSE * 3).strip()
    assert main_text(f"<div class=header><article><p>{PROSE}</p></article></div><p>{PROSE * 5}</p>") == PROSE.strip()


def test_excluded_elements_end_with_their_parent():
    article = f"<article><p>{PROSE}</p></article>"
    for head in ("<datalist><option value=a>A<option value=b>B</datalist>", "<div><noscript>Enable it</div>", "<div><iframe src=x></div>", "<iframe src=x>", "<svg><path>",
                 "<div><template><b>t</b></div>", "<select><option>a<option>b</select>", "<option>a", "<noscript><p>Enable it</p></noscript>"):
        for tail in ("", "<iframe src=y></iframe><noscript>n</noscript><select><option>z</option></select>"):
            assert main_text(f"<body>{head}{article}{tail}</body>") == PROSE.strip(), head
    inside = f"<article><p>{PROSE}<svg><title>t</title><text>hidden</text></svg> so <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds<select><option>o<div>p</select>.</p></article>"
    assert main_text(inside) == PROSE + "so x=1 holds."


def test_awkward_pages(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "no markup at all"), (4, "u", "<article><p>cut off &amp; <b"), (5, "u", "<p>&#233;&eacute;&bogus; 1 < 2"),
            (5, "u", "<p>&#233;&eacute;&bogus; 1 < 2"), (None, "u", "<article><p>" + PROSE * 3000 + "</article>"), (6, "u", "<script>never closed")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = {r["page_id"]: r for r in extract_text(df).collect()}
    assert got[1]["text"] == "" and got[2]["text"] == "" and got[2]["url"] is None and got[6]["text"] == ""
    assert got[3]["text"] == "no markup at all" and got[4]["text"] == "cut off &" and got[5]["text"] == "éé&bogus; 1 < 2"
    assert got[None]["n_chars"] == len((PROSE * 3000).strip()) == len(got[None]["text"])
    assert extract_text(df.limit(0)).count() == 0


def _pages(spark):
    big = "x" * 1500 + "é"
    rows = [(1, "http://a/", big), (2, "http://b/\r\nX: y", big), (7, None, big), (3, "u", "small"), (4, "u", "small"), (5, "u", None), (6, "u", ""),
            (8, "u", "WARC/1.1\r\nWARC-Type: response\r\n\r\n" + "z" * 2000), (9, "u", "a\r\n\r\nb" * 300), (9, "u", "a\r\n\r\nb" * 300), (None, "u", "y" * 1200)]
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("salt", F.lit(1))


def test_warc_round_trip(spark, tmp_dir):
    pages = _pages(spark)
    warc.write_archives(pages, f"{tmp_dir}/w", records_per_file=3)
    back = warc.read_archives(spark, f"{tmp_dir}/w")
    assert back.filter("kind = 'gap'").count() == 0
    got = sorted((tuple(r) for r in warc.page_records(back).collect()), key=str)
    exp, top = [], {}
    for r in pages.collect():
        top[r["html"]] = max(top.get(r["html"], -1), -1 if r["page_id"] is None else r["page_id"])
    for r in pages.collect():
        raw = (r["html"] or "").encode()
        again = len(raw) >= 1000 and r["page_id"] is not None and top[r["html"]] != r["page_id"]
        exp.append((r["page_id"], len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", top[r["html"]] if again else None))
    assert got == sorted(exp, key=str)
    payload = {r["record_id"]: bytes(r["payload"]) for r in back.filter("record_type = 'response'").collect()}
    assert payload["<urn:page:8>"] == next(r["html"] for r in pages.collect() if r["page_id"] == 8).encode()
    warc.write_archives(pages.limit(0), f"{tmp_dir}/none")


def test_revisits_are_the_same_either_way(spark):
    pages = _pages(spark)
    cols = ["page_id", "sha1", "response_id"]
    ways = [sorted(map(str, warc.with_revisits(pages, broadcast_groups=n).select(cols).collect())) for n in (0, 100)]
    assert ways[0] == ways[1] and len(ways[0]) == pages.count()


def _record(i, body):
    head = f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{i}>\r\nWARC-Payload-Digest: sha1:{hashlib.sha1(body).hexdigest()}\r\n"
    return (head + f"Content-Length: {len(body)}\r\n\r\n").encode() + body + b"\r\n\r\n"


@pytest.mark.parametrize("zipped", [False, True])
def test_salvage_recovers_later_records_and_logs_gaps(zipped):
    pack = gzip.compress if zipped else (lambda b: b)
    parts = [pack(_record(i, f"body {i} ".encode() * 50)) for i in range(6)]
    bad = bytearray(parts[1])
    bad[len(bad) // 2] ^= 0xFF  # digest or checksum fails
    data = parts[0] + bytes(bad) + parts[2] + parts[3][:-30] + b"junk WARC/1.1\r\nnot a record" + parts[4] + b"trailing"
    rows = list(warc.salvage(data))
    assert [r["record_id"] for r in rows if r["kind"] == "record"] == ["<urn:page:0>", "<urn:page:2>", "<urn:page:4>"]
    assert [r["kind"] for r in rows] == ["record", "gap", "record", "gap", "record", "gap"] and all(r.get("reason") for r in rows if r["kind"] == "gap")
    at = 0
    for r in rows:  # every byte is in exactly one record or gap
        assert r["offset"] == at
        at += r["length"]
    assert at == len(data) and list(warc.salvage(b"")) == []


def test_damaged_files_are_read(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/d")
    for n, data in {"a.warc": _record(1, b"one")[:-6] + _record(2, b"two"), "b.warc.gz": gzip.compress(_record(3, b"three")), "c.warc": b""}.items():
        with open(f"{tmp_dir}/d/{n}", "wb") as f:
            f.write(data)
    rows = warc.read_archives(spark, f"{tmp_dir}/d").collect()
    assert sorted((r["kind"], r["record_id"]) for r in rows if r["kind"] == "record") == [("record", "<urn:page:2>"), ("record", "<urn:page:3>")]
    assert [(os.path.basename(r["file"]), r["offset"]) for r in rows if r["kind"] == "gap"] == [("a.warc", 0)]


def test_registered_warc_equals_its_sql(spark):
    from oracle_compare import duck

    rows = sorted(map(str, (tuple(r) for r in QUERIES["op9_warc_salvage"](spark, SF_SMALL).collect())))
    assert rows == sorted(map(str, duck(SF_SMALL).sql(ORACLE["op9_warc_salvage"]).fetchall()))


CASES = [
    (1, "https://a.example.org/es/1", "a.example.org", "/es/1", "example.org/es/"), (2, "http://example.org/en/12?x=1", "example.org", "/en/12", "example.org/en/1"),
    (3, "http://EXAMPLE.org/en/2#f", "example.org", "/en/2", "org/"), (4, "http://notexample.org/es/", "notexample.org", "/es/", "org/"),
    (5, "http://x.com/fr/", "x.com", "/fr/", "com/fr/"), (6, "http://x.com/de/a://b", "x.com", "/de/a://b", "com/de/"), (7, "http://x.com/FR/", "x.com", "/FR/", None),
    (8, "http://a.org", "a.org", "", None), (9, None, "", "", None), (10, "nothing", "", "", None), (11, "", "", "", None),
    (12, "http://com/fr/?q", "com", "/fr/", "com/fr/"), (13, "ftp://ÄB.Com:80?x#y", "Äb.com:80".replace("b", "b"), "", None), (13, "http://x.net/a/b/c.html", "x.net", "/a/b/c.html", None)]


def test_url_rules_and_verdicts(spark):
    df = spark.createDataFrame([(i, u) for i, u, *_ in CASES], "page_id long, url string").withColumn("host", F.lit("clash"))
    got = {(r["page_id"], r["path"]): r for r in urls.classify_urls(df, URL_RULES).collect()}
    assert len(got) == len(CASES)
    for i, _, host, path, rule in CASES:
        r = got[(i, path)]
        assert (r["host"], r["rule"]) == (host, rule) and r["verdict"] in ("allow", "block") and 0 <= r["score"] <= 1
        if rule:
            assert r["verdict"] == {v: k for k, v in URL_RULES}[rule]
    assert urls.classify_urls(df.limit(0), URL_RULES).count() == 0
    assert {r["verdict"] for r in urls.classify_urls(df, []).collect()} == {"allow"}


def test_url_trees_learn_from_labels(spark):
    rows = [(i, f"http://{'spam-' if i % 2 else ''}site{i % 17}.net/{'x' * (i % 5)}/{i if i % 2 else 'page'}") for i in range(600)]
    df = spark.createDataFrame(rows, "page_id long, url string")
    labelled = df.filter("page_id < 400").select("url", (1 - F.col("page_id") % 2).cast("int").alias("label"))
    out = urls.classify_urls(df.filter("page_id >= 400"), [], labelled).collect()
    assert sum((r["verdict"] == "allow") == (r["page_id"] % 2 == 0) for r in out) / len(out) > 0.95


def test_url_entropy(spark):
    one = spark.createDataFrame([(1, "aabb"), (2, ""), (3, "a")], "page_id long, url string")
    got = [r["entropy"] for r in urls.lexical_features(urls.url_parts(one)).orderBy("page_id").collect()]
    assert got == [1.0, 0.0, 0.0]
