"""The block rules: pages that lost text before, linear work, and a plain version over random pages."""

import random
import time
from html.parser import HTMLParser

import pytest

from framelake.llm import html as rules
from framelake.llm.html import main_text

PROSE = "The quick fox was in the garden and it had not been seen by any of the people who were there for the day. "
CHINESE = "他们在春天的早晨走过长长的河岸看见许多人在那里等待渡船"
RUSSIAN = "Весной люди долго шли вдоль берега реки и видели тех кто ждал парома у старого моста за городом. "
LINKS = "".join(f"<li><a href=/{i}>More on this and that {i}</a></li>" for i in range(4))


def test_a_form_around_the_page_is_no_form():
    page = f"<body><form id=aspnetForm><nav><a href=x>Home</a></nav><h1>Head</h1><p>{PROSE}</p><p>{PROSE}</p><div class=comments><p>{PROSE * 9}</p></div></form>"
    assert main_text(page).split("\n") == ["Head", PROSE.strip(), PROSE.strip()]
    assert main_text(f"<p>{PROSE * 3}</p><form><p>{PROSE}</p><input></form>") == (PROSE * 3).strip()


@pytest.mark.parametrize("text", [CHINESE, RUSSIAN])
def test_scripts_without_blanks_and_languages_without_stop_words(text):
    page = f"<body><ul>{LINKS}</ul><h2>{text[:8]}</h2><p>{text}</p><p>{text}</p><p>{text[:9]}</p><p>{text}</p></body>"
    assert main_text(page).split("\n") == [text[:8].strip(), text.strip(), text.strip(), text[:9].strip(), text.strip()]


@pytest.mark.parametrize("tag", ["main", "article"])
def test_links_inside_the_article_are_left_out(tag):
    menu = "<p><a href=1>Home</a> | <a href=2>About</a> | <a href=3>News</a></p>"
    page = f"<{tag}>{menu}<h1>Head</h1><p>{PROSE}</p><p>Short.</p><p><a href=z>{PROSE}</a></p><p>{PROSE}</p><h3>More stories</h3><ul>{LINKS}</ul></{tag}>"
    assert main_text(page).split("\n") == ["Head", PROSE.strip(), "Short.", PROSE.strip(), PROSE.strip()]


@pytest.mark.parametrize("page", ["<b>x</y>" * 130_000, "<b>" * 100_000 + "<div>y</div>" * 60_000, "<b>" * 60_000 + "<main></main>" * 50_000,
                                  "<b>" * 60_000 + "<option>x<div>y" * 50_000, "<div class=nav>" * 70_000, "<a>" * 120_000 + "</b>" * 120_000])
def test_a_megabyte_of_broken_markup(page):
    start = time.process_time()
    main_text(page)
    assert time.process_time() - start < 2


class Plain(HTMLParser):
    """Blocks of well-formed pages as ``(text, linked text, links, chain of containers)``."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.chain, self.found, self.text, self.linked, self.links = [], [], "", "", 0

    def cut(self):
        text = " ".join(self.text.split())
        if text:
            self.found.append((text, " ".join(self.linked.split()), self.links, list(self.chain)))
        self.text, self.linked, self.links = "", "", 0

    def handle_starttag(self, tag, attrs):
        if tag not in ("a", "b"):
            self.cut()
        self.chain.append((tag, dict(attrs).get("class", ""), object()))
        self.links += tag == "a"

    def handle_endtag(self, tag):
        if tag not in ("a", "b"):
            self.cut()
        assert self.chain.pop()[0] == tag

    def handle_data(self, data):
        self.text += data
        self.linked += data if any(c[0] == "a" for c in self.chain) else ""


def plain_text(page):
    parser = Plain()
    parser.feed(page)
    parser.cut()
    boxes, outside = [], []
    for text, linked, links, chain in parser.found:
        outside.append(any(c[0] in ("nav", "aside", "footer", "header") for c in chain))
    size = {}
    for (text, _, _, chain), out in zip(parser.found, outside):
        for tag, cls, key in chain:
            if (tag == "form" or cls in ("ad", "menu", "share")) and not out:
                size[key] = size.get(key, 0) + len(text)
    total = sum(len(b[0]) for b, out in zip(parser.found, outside) if not out)
    for (text, linked, links, chain), out in zip(parser.found, outside):
        named = any((c[0] == "form" or c[1] in ("ad", "menu", "share")) and 2 * size.get(c[2], 0) <= total for c in chain)
        boxes.append({"text": text, "out": out or named, "main": any(c[0] == "article" for c in chain), "links": links,
                      "dense": len(linked) / len(text) > 0.4, "head": any(c[0] in ("h1", "h2") for c in chain)})
    marked = any(b["main"] and not b["out"] for b in boxes)
    able = [b for b in boxes if not b["out"] and (b["main"] or not marked)]
    for b in boxes:
        b["label"] = False
    for i, b in enumerate(able):
        words = [w.lower() for w in "".join(c if c.isalpha() else " " for c in b["text"]).split()]
        rich = sum(w in rules.STOP_WORDS for w in words) / max(len(words), 1)
        chars = len(b["text"])
        around = [x["dense"] for x in (able[i - 1:i] if i else []) + able[i + 1:i + 2]]
        if b["dense"]:
            b["label"] = None if marked and b["links"] < 2 and not any(around) else False
        elif b["head"]:
            b["label"] = None
        elif sum("一" <= c <= "鿿" for c in b["text"]) * 2 > sum(map(len, words)):
            b["label"] = True if chars >= 24 else None
        else:
            b["label"] = True if chars >= 70 and (rich >= 0.3 or (rich >= 0.12 and (marked or chars >= 200))) else None
    for least in (70, 0):
        if not any(b["label"] for b in able):
            for b in able:
                if b["label"] is None and not b["head"] and not b["dense"] and len(b["text"]) >= least:
                    b["label"] = True
    field = able if marked else boxes
    final = []
    for i, b in enumerate(field):
        label = b["label"]
        if label is None:
            sides = [(abs(j - i), not x["label"]) for j, x in enumerate(field) if x["label"] is not None and (j > i or not b["head"])]
            if not sides and b["head"]:
                sides = [(abs(j - i), not x["label"]) for j, x in enumerate(field) if x["label"] is not None]
            label = not min(sides)[1] if sides else True
        final.append(label)
    return "\n".join(b["text"] for b, keep in zip(field, final) if keep)


def random_page(rnd):
    prose = [PROSE, PROSE * 3, "Short one.", "$$$ ### 12 %%%", RUSSIAN, RUSSIAN * 3, CHINESE, CHINESE[:9], "The end of it."]

    def some(depth):
        out = []
        for _ in range(rnd.randint(1, 6)):
            kind = rnd.randrange(9)
            if kind < 4:
                out.append(f"<p>{rnd.choice(prose)}</p>")
            elif kind == 4:
                out.append(f"<h2>{rnd.choice(['Head', 'More stories', PROSE])}</h2>")
            elif kind == 5:
                out.append("<ul>" + "".join(f"<li><a>{rnd.choice(prose)}</a></li>" for _ in range(rnd.randint(1, 3))) + "</ul>")
            elif kind == 6:
                out.append(f"<p>{rnd.choice(prose)}<a>{rnd.choice(prose)}</a> or <a>that</a></p>")
            elif depth:
                tag = rnd.choice(["div", "div class=ad", "div class=menu", "form", "nav", "aside", "section", "div class=share", "div class=story"])
                out.append(f"<{tag}>{some(depth - 1)}</{tag.split()[0]}>")
        return "".join(out)

    body = some(2)
    if rnd.random() < 0.6:
        body += f"<article>{some(2)}</article>{some(1)}"
    if rnd.random() < 0.2:
        body = f"<form>{body}</form>"
    return f"<html><body>{body}</body></html>"


def test_random_pages_match_the_plain_version():
    rnd = random.Random(8)
    pages = [random_page(rnd) for _ in range(1500)]
    got = [main_text(p) for p in pages]
    for page, text in zip(pages, got):
        assert text == plain_text(page), page
    bare = [p for p, t in zip(pages, got) if "<article>" in p and t]
    assert len(bare) > 300
