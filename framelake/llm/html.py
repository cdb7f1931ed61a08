"""Main text of web pages by two passes of block rules.

A page is cut into blocks at block-level tags. The first pass judges each block by its container (menus, adverts and the
like), link density, stop-word density and length, and leaves short or undecided blocks open; in scripts written without blanks the
length alone speaks for a text. In the second pass an open block takes the label of the nearest decided block, and a heading that of
the next one, so that the heading of a list of links goes with it. Where a page marks its article, only blocks inside it can be
main text, and both passes judge these among themselves: menus and lists of links inside it are left out, a single linked line is not.

Work is linear in the page: elements know their innermost block and container, and end tags without an open element are told by a count.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.llm.tokens import slices

# HTML element names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes".split())
EXCLUDED = frozenset("noscript template iframe svg select option".split())  # closed by their parent at the latest
BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure
footer form frameset h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup p pre section summary table
tbody td tfoot th thead tr ul""".split())
OUTSIDE = frozenset("nav header footer aside head menu button".split())
BOXES = frozenset("form fieldset dialog".split())  # outside too, unless they hold most of the page's text
MAIN = frozenset(("article", "main"))

# Words of class, id and role that name what is not the article.
OUTSIDE_NAMES = frozenset("""ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments
consent cookie cookies copyright disqus footer header login masthead menu menubar modal nav navbar navigation newsletter notice
pagination popup promo promotion related replies respond search share sharing sidebar signup skip social sponsor sponsored
subscribe tags toolbar widget""".split())
COMMENTS = frozenset("comment comments disqus replies respond".split())
LASTING = COMMENTS | frozenset("related sidebar widget".split())  # an article in such a container is outside too
# Words that only say what kind of box a name is for, as in ``comment-list`` or ``site-footer``.
BOX_NAMES = frozenset("""area bar block body bottom box column container group holder inner item items left link links list main outer
page panel posts primary region right secondary section site slot top unit wrap wrapper""".split())

# Frequent words of the languages the rules are tuned for; pass others as a parameter.
STOP_WORDS = frozenset("""a an and are as at be by for from has he in is it its not of on or that the this to was were will with
au aux avec ce ces dans de des du elle en est et il la le les mais ne ou par pas plus pour que qui se sur un une
als auch auf aus bei das dem den der die durch ein eine einer für im ist mit nach nicht oder sich sie sind über um und von
wie zu zum zur al como con del el esta los las más no o para pero por su sus una y""".split())

LONG, LINKED, RICH, POOR = 200, 0.4, 0.30, 0.12
SHORT, SHORT_UNSPACED = 70, 24

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)",
                    re.S)
_NAMED = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[^\W\d_]+")
# Thai to Lao, Myanmar, Khmer, kana, and the ideographs: scripts written without blanks between words.
_UNSPACED = re.compile(r"[\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u3040-\u30FF\u3400-\u4DBF\u4E00-\u9FFF\uF900-\uFAFF\U00020000-\U0003FFFF]")


@dataclass
class Block:
    """One block: its text, the characters inside links, and where it stands."""

    text: str
    linked: int
    outside: bool
    main: bool
    heading: bool
    links: int
    mark: int = -1
    label: str = ""

    @property
    def density(self) -> float:
        return self.linked / len(self.text)


def _named(attrs: str) -> frozenset[str]:
    """The words of a class, id or role that is as a whole the name of something outside."""
    out: set[str] = set()
    for m in _NAMED.finditer(attrs):
        for token in (m[2] or m[3] or m[4] or "").lower().split():
            parts = {x for x in re.split(r"[_\-]+", token) if x and not x.isdigit()}
            if parts <= OUTSIDE_NAMES | BOX_NAMES:
                out |= parts & OUTSIDE_NAMES
    return frozenset(out)


@dataclass
class Mark:
    """A container that is named as outside, or an article in one (without names), in which only ``LASTING`` ones above count."""

    above: int
    names: frozenset[str]
    held: int = 0
    outside: bool = False
    lasting: bool = False
    under: bool = False  # whether it or a container above is named by ``LASTING``
    within: bool = False  # whether it, or what is around a mere form or the like, has a name


def _in_names(marks: list[Mark], mark: int) -> bool:
    """Whether a named container that still counts is around."""
    return mark >= 0 and (marks[mark].within or marks[mark].under)


def _judge_marks(found: list[Block], marks: list[Mark]) -> None:
    """Blocks in named containers are outside, unless the container holds most of the page's text (one of comments also has
    to hold all text that could be main)."""
    real = False
    for b in found:
        if not b.outside:
            real |= not _in_names(marks, b.mark) and len(b.text) >= SHORT and not b.heading
            if b.mark >= 0:
                marks[b.mark].held += len(b.text)
    for m in reversed(marks):
        if m.above >= 0:
            marks[m.above].held += m.held
    total = sum(len(b.text) for b in found if not b.outside)
    for m in marks:
        wrapper = 2 * m.held > total and not (real and m.names & COMMENTS)
        over = marks[m.above] if m.above >= 0 else None
        m.lasting = (not wrapper and bool(m.names & LASTING)) or (over is not None and over.lasting)
        m.outside = m.lasting if not m.names else not wrapper or (over is not None and over.outside)
    for b in found:
        b.outside |= b.mark >= 0 and marks[b.mark].outside


@dataclass(slots=True)
class Element:
    """An open element, with what its content inherits."""

    tag: str = ""
    outside: bool = False
    main: bool = False
    link: bool = False
    heading: bool = False
    mark: int = -1          # innermost named container
    aside: bool = False     # whether an aside or nav is around
    block: int = -1         # place in the stack of the innermost block element
    excluded: int = 0       # 1, or 2 if it has no end tag and ends at the next block
    excluded_from: int = -1  # place of the outermost excluded element


_TOP = Element()
_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))


def blocks(page: str) -> list[Block]:
    """Blocks with visible text, in page order. Unclosed and cut-off markup is taken as far as it goes."""
    out: list[Block] = []
    stack: list[Element] = []
    opened: dict[str, int] = {}  # open elements of each name
    last_end: dict[str, int] = {}
    marks: list[Mark] = []
    parts: list[tuple[str, bool]] = []
    links = 0

    def here() -> Element:
        return stack[-1] if stack else _TOP

    def ends(tag: str, at: int) -> bool:
        """Whether an end tag follows before the next element of that name (which can only stand inside svg and template)."""
        if tag not in last_end:
            last_end[tag] = max((m.start() for m in re.finditer(rf"</{tag}\b", page, re.I)), default=-1)
        if tag == "option" or last_end[tag] < at:
            return False
        return tag in ("svg", "template") or re.compile(rf"<(/?){tag}\b", re.I).search(page, at)[1] == "/"

    def close() -> None:
        nonlocal links
        if parts:
            text = " ".join(html.unescape("".join(t for t, _ in parts)).split())
            if text:
                linked = len(" ".join(html.unescape("".join(t for t, a in parts if a)).split()))
                e = here()
                out.append(Block(text, linked, e.outside, e.main, e.heading, links, e.mark))
            parts.clear()
        links = 0

    def add(above: int, names: frozenset[str]) -> int:
        over = marks[above] if above >= 0 else Mark(-1, frozenset())
        marks.append(Mark(above, names, under=bool(names & LASTING) or over.under, within=bool(names - BOXES) or (bool(names) and over.within)))
        return len(marks) - 1

    def pop_to(i: int) -> None:
        for e in stack[i:]:
            opened[e.tag] -= 1
        del stack[i:]

    def push(e: Element) -> None:
        stack.append(e)
        opened[e.tag] = opened.get(e.tag, 0) + 1

    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        text = page[at:m.start() if m else n]
        if text and not here().excluded:
            parts.append((text, here().link))
        if m is None:
            break
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if not opened.get(tag):
                if tag in BLOCK and not here().excluded:
                    close()
                continue
            i = len(stack) - 1
            while stack[i].tag != tag:
                i -= 1
            if tag in BLOCK and not stack[i].excluded:
                close()
            pop_to(i)
            continue
        empty = tag in VOID or m[3].rstrip().endswith("/")
        if tag in RAW and not empty:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = end.end() if end else n
            continue
        if here().excluded == 2 and tag in BLOCK:
            pop_to(here().excluded_from)
        e = here()
        if e.excluded:
            if not empty:
                push(replace(e, tag=tag))
            continue
        if tag in ("br", "wbr", "img"):
            parts.append((" " if tag != "wbr" else "", False))
            continue
        if tag in BLOCK:
            close()
            if e.block >= 0 and (stack[e.block].tag == "p" or stack[e.block].tag == tag == "li"):
                pop_to(e.block)
        if empty:
            continue
        e, mark = here(), here().mark
        outside, main = e.outside or tag in OUTSIDE, e.main
        if tag in MAIN:
            outside, main = e.outside and e.aside, True
            if mark >= 0:
                mark = add(mark, frozenset())
        names = _named(m[3]) if tag not in ("html", "body") else frozenset()
        if tag in BOXES:
            names |= {tag}
        if names:
            mark = add(mark, names)
        links += tag == "a"
        excluded = (1 if ends(tag, at) else 2) if tag in EXCLUDED else 0
        push(Element(tag, outside, main, e.link or tag == "a", e.heading or tag in _HEADINGS, mark, e.aside or tag in ("aside", "nav"),
                     len(stack) if tag in BLOCK else e.block, excluded, len(stack) if excluded else -1))
    close()
    _judge_marks(out, marks)
    return out


def _eligible(found: list[Block]) -> list[Block]:
    """Blocks that can be main text: those inside the marked article if there is one."""
    kept = [b for b in found if not b.outside]
    return [b for b in kept if b.main] if any(b.main for b in kept) else kept


def first_pass(found: list[Block], stop_words: frozenset[str]) -> None:
    """Label each block: good, bad, or open."""
    for b in found:
        b.label = "bad"
    able = _eligible(found)
    for i, b in enumerate(able):
        if b.density > LINKED:
            beside = any(x.density > LINKED for x in able[max(i - 1, 0):i] + able[i + 1:i + 2])
            b.label = "open" if b.main and b.links < 2 and not beside else "bad"
            continue
        words = [w.lower() for w in _WORD.findall(b.text)]
        rich = sum(w in stop_words for w in words) / max(len(words), 1)
        if b.heading:
            b.label = "open"
        elif 2 * len(_UNSPACED.findall(b.text)) > sum(map(len, words)):
            b.label = "good" if len(b.text) >= SHORT_UNSPACED else "open"
        elif len(b.text) < SHORT:
            b.label = "open"
        else:
            b.label = "good" if rich >= RICH or (rich >= POOR and (b.main or len(b.text) >= LONG)) else "open"
    if not any(b.label == "good" for b in able):  # a language without known stop words: what is long and not linked, or else what is left
        for least in (SHORT, 0):
            for b in able:
                if b.label == "open" and not b.heading and len(b.text) >= least and b.density <= LINKED:
                    b.label = "good"
            if any(b.label == "good" for b in able):
                break


def second_pass(found: list[Block]) -> None:
    """Open blocks take the label of the nearest decided block (good on ties, and if there is none), headings that of the next.

    Where an article is marked, only its own blocks are neighbours; else all blocks of the page are.
    """
    marked = any(b.main and not b.outside for b in found)
    able = [b for b in found if not marked or (b.main and not b.outside)]
    decided = [i for i, b in enumerate(able) if b.label != "open"]
    new, j = {}, 0
    for i, b in enumerate(able):
        if b.label != "open":
            continue
        while j < len(decided) and decided[j] < i:
            j += 1
        sides = [x for x in (j - 1, j) if 0 <= x < len(decided)]
        if b.heading and j < len(decided):
            sides = [j]
        near = [(abs(decided[x] - i), able[decided[x]].label != "good", able[decided[x]].label) for x in sides]
        new[i] = min(near)[2] if near else "good"
    for i, label in new.items():
        able[i].label = label


def main_text(page: str | None, stop_words: frozenset[str] = STOP_WORDS) -> str:
    """The main text: good blocks in page order, one per line; empty if there is none."""
    found = blocks(page or "")
    first_pass(found, stop_words)
    second_pass(found)
    return "\n".join(b.text for b in found if b.label == "good")


def _extract(stop_words: frozenset[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "html"):
            texts = [main_text(x, stop_words) for x in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return run


def extract_text(pages: DataFrame, stop_words: frozenset[str] = STOP_WORDS) -> DataFrame:
    """One row per page: ``page_id, url, text, n_chars`` (code points).

    Null and empty html give an empty text. Character references are decoded, white space in a block becomes one
    blank, blocks are joined by a line feed. Whole pages are read; repeated rows are each extracted; other columns
    are ignored.
    """
    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(
        _extract(stop_words), "page_id long, url string, text string, n_chars long")
