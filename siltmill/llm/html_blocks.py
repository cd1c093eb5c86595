"""Main text of HTML pages from flat text blocks.

A page becomes a flat list of text blocks, each with its word count, its link density, those of its neighbours and
where it stands. A decision tree trained on a small labelled table tells content from the rest. The tree is turned
into one Catalyst expression, so only the markup is read in Python.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK = "text string, words int, links int, frame boolean, hint double, other double, article boolean, beside boolean"

#: Fixed vocabularies of HTML: elements that end the block before them, that hold no text to read, whose content is
#: characters only, that have no end tag, and that frame a page.
_BREAKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
_DROPPED = frozenset("head title template noscript select textarea button iframe object canvas svg math audio video map dialog datalist".split())
_RAW = frozenset("script style xmp noembed noframes".split())
_RAW_IF_CLOSED = frozenset("title textarea iframe".split())
_FOREIGN = ("svg", "math")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: What a head may hold; anything else, text too, ends it: its end tag and body's start tag may be left out.
_IN_HEAD = frozenset("base link meta template title noscript".split()) | _RAW
_FORMATTING = frozenset("a b big code em font i nobr s small strike strong tt u".split())
#: Elements that an open one of these ends, unless one of the lists or tables named stands between them.
_SIBLINGS = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "option": (("option",), ("select", "datalist", "optgroup")),
    "td": (("td", "th"), ("table",)),
    "th": (("td", "th"), ("table",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "tbody": (("tbody", "thead", "tfoot", "tr", "td", "th", "caption"), ("table",)),
    "thead": (("tbody", "thead", "tfoot", "tr", "td", "th", "caption"), ("table",)),
    "tfoot": (("tbody", "thead", "tfoot", "tr", "td", "th", "caption"), ("table",)),
}
_TABLE_PARTS = frozenset("table caption tbody thead tfoot tr td th".split())
#: End tags inside of these end nothing outside of them.
_WALLS = frozenset("td th caption table template".split())
_FRAME = frozenset("nav menu aside footer search".split())
_CONTROLS = frozenset("input select textarea button".split())
#: A form with this many running words a control, and half of the page's, is the page's layout.
_WORDS_A_CONTROL = 20
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: Parts of class names and ids that name what surrounds an article.
_HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner banners breadcrumb breadcrumbs byline comment comments consent cookie cookies copyright disqus disclaimer footer gdpr header login masthead menu menus modal nav navbar navigation newsletter notice notices notification notifications overlay pager pagination paywall popup promo promos promotion related recommended recommendations reply replies share sharing sidebar sidebars signup skip social sponsor sponsored sponsors subscribe subscription tags toolbar topbar widget widgets".split()
)
#: Such parts that may belong to an article, and the parts that say so.
_OWN_HINTS = frozenset("header byline tags".split())
_CONTENT = frozenset("article content entry main post story".split())
_TALK = frozenset("comment comments commentaire commentaires comentario comentarios disqus kommentar kommentare reply replies response responses".split())
_HOLDERS = frozenset("area block body box container content holder inner item list reader readers section thread user users wrap wrapper".split())
#: A quote counts at the start of an attribute's value only, and a slash inside a value is part of it.
_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(?:[!?]|/[^a-zA-Z>])[^>]*+(?:>|\Z)|</>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^\s>\"'][^\s>]*+)?+)*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


def _attributes(text: str) -> dict[str, str]:
    """By name; of repeated attributes the first counts."""
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(text):
        found.setdefault(m[1].lower(), html.unescape(m[2] or m[3] or m[4] or ""))
    return found


def _hidden(found: dict[str, str]) -> bool:
    return "hidden" in found or found.get("aria-hidden", "").lower() == "true" or bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", ""), re.I))


def _names(found: dict[str, str]) -> list[list[str]]:
    """The parts of each class name and of the id."""
    return [[p.lower() for p in _PARTS.findall(x)] for x in f"{found.get('class', '')} {found.get('id', '')}".split()]


def _talks(names: list[list[str]]) -> bool:
    """Whether a name says that the element holds readers' comments."""
    return any(p and _TALK & set(p) and set(p) <= _TALK | _HOLDERS for p in names)


def _hint(names: list[list[str]], in_article: bool) -> float:
    """How much the names hint at what surrounds an article: the largest part of a name that does."""
    most = 0.0
    for parts in names:
        own = in_article or not _CONTENT.isdisjoint(parts)
        hits = sum(p in _HINTS and not (own and p in _OWN_HINTS) for p in parts)
        most = max(most, hits / len(parts)) if parts else most
    return most


def _marks_article(name: str, found: dict[str, str]) -> bool:
    return name in ("article", "main") or found.get("role", "").lower() == "main" or found.get("itemprop", "").lower() == "articlebody"


@dataclass(slots=True)
class _Open:
    """An open element: whether it is a link, frames, holds the article; and where the nearest p that a block would end,
    the nearest block and the nearest wall stand in the stack (itself included, or -1)."""

    name: str
    link: bool
    frames: bool
    holds: bool
    p: int
    block: int
    wall: int
    form: bool = False
    talk: bool = False


class _Reader:
    """Reads one page. The work is linear in the page: whatever is looked for among open elements stands in a count,
    in a list by name, or is passed over once, when it is closed."""

    def __init__(self) -> None:
        self.out: list[dict] = []
        self.stack: list[_Open] = []
        self.places: dict[str, list[int]] = {}  # of open elements in the stack, by name
        self.hints: list[tuple[int, float]] = []  # places of elements whose names hint, the most from the first to each
        self.dropped = self.frames = self.article = self.links = 0
        #: Of each form outside of others: its controls, and whether it holds an article. What they are is seen at the end.
        self.forms: list[list] = []
        self.form = self.talk = False
        self.articles = 0  # elements that mark an article, those of comments included
        self.text: list[str] = []
        self.linked: list[str] = []

    def flush(self) -> None:
        words = " ".join("".join(self.text).split())
        if words:
            links, hint = len("".join(self.linked).split()), self.hints[-1][1] if self.hints else 0.0
            self.out.append({"text": words, "words": words.count(" ") + 1, "links": links, "frame": self.frames > 0, "hint": hint, "other": 0.0, "article": self.article > 0, "beside": False, "form": len(self.forms) - 1 if self.form else -1, "talk": self.talk})
        self.text.clear()
        self.linked.clear()

    def put(self, piece: str) -> None:
        if piece.strip(" \t\n\f\r"):
            self.end_head()
        if piece and not self.dropped:
            piece = html.unescape(piece)
            self.text.append(piece)
            if self.links:
                self.linked.append(piece)

    def last(self, *names: str) -> int:
        return max((at[-1] for at in map(self.places.get, names) if at), default=-1)

    def shut(self, depth: int) -> None:
        while len(self.stack) > depth:
            self.forget(self.stack.pop(), len(self.stack))

    def forget(self, e: _Open, at: int) -> None:
        """Takes what an element that ends stands for out of the counts; at is its place."""
        if e.name:
            self.places[e.name].pop()
        self.frames -= e.frames
        self.article -= e.holds
        self.links -= e.link
        self.dropped -= e.name in _DROPPED
        self.form &= not e.form
        self.talk &= not e.talk
        if self.hints and self.hints[-1][0] == at:
            self.hints.pop()

    def end_head(self, whole: bool = False) -> None:
        """Ends a head that nothing is open in; whole: one that elements without an end tag are open in, too."""
        k = self.last("head")
        if k >= 0 and (k == len(self.stack) - 1 or whole and self.last("template") < k):
            self.shut(k)

    def end(self, name: str) -> None:
        """An end tag: it ends the nearest open element of its name and all inside, but nothing beyond a wall; that of
        an inline element leaves blocks inside open."""
        k = self.last(name)
        if k < 0 or k < (self.last("template", *("table",) * (name != "table")) if name in _TABLE_PARTS else self.stack[-1].wall):
            return
        if name in _BREAKS or name in _DROPPED or k > self.stack[-1].block:
            self.shut(k)
        elif name in _FORMATTING:
            e = self.stack[k]
            self.places[name].pop()
            self.links -= e.link
            e.name, e.link = "", False

    def begin(self, name: str, attributes: str) -> None:
        top = self.stack[-1] if self.stack else None
        if name in _BREAKS and top and top.p >= 0:
            self.shut(top.p)
        if name in _SIBLINGS:
            others, bounds = _SIBLINGS[name]
            if self.last(*others) > self.last(*bounds):
                self.shut(min(k for k in map(self.last, others) if k > self.last(*bounds)))
        if name == "a":
            self.end("a")
        found = _attributes(attributes) if attributes and not attributes.isspace() else {}
        names = _names(found) if "class" in found or "id" in found else []
        page = name in ("html", "body", "main")
        form, talk = name == "form" and not self.form, False
        frames = name in _FRAME or name == "header" and not self.article or _hidden(found) or not page and found.get("role", "").lower() in _ROLES
        if name == "article":  # its class may name features of the page; a comment may be an article too
            hint = float(self.article > 0 and any(not _TALK.isdisjoint(x) for x in names))
            if any(x and _TALK.issuperset(x) for x in names):  # the first of a page may be its article, an opinion
                talk = not self.articles and not frames
                frames = frames or not talk
        else:
            hint = 0.0 if page else _hint(names, self.article > 0)
            frames = frames or not page and _talks(names)
        at = len(self.stack)
        top = self.stack[-1] if self.stack else None
        self.dropped += name in _DROPPED
        holds = not frames and not hint and not self.dropped and _marks_article(name, found)
        self.articles += name == "article" and (talk or frames or holds)
        if form:
            self.form = True
            self.forms.append([0, False])
        if holds and self.form:
            self.forms[-1][1] = True
        self.talk |= talk
        if holds and not self.frames:
            # an article inside says that a class like with-sidebar named the page's layout
            self.hints.clear()
        solid = name in _BREAKS or name in _DROPPED
        link = name == "a" and "href" in found
        p, block, wall = (top.p, top.block, top.wall) if top else (-1, -1, -1)
        self.stack.append(_Open(name, link, frames, holds, at if name == "p" else -1 if solid else p, at if solid else block, at if name in _WALLS else wall, form, talk))
        self.places.setdefault(name, []).append(at)
        self.frames += frames
        self.article += holds
        self.links += link
        if hint:
            self.hints.append((at, max(hint, self.hints[-1][1] if self.hints else 0.0)))

    def read(self, page: str) -> list[dict]:
        at, raw = 0, ""
        unclosed: set[str] = set()
        while at < len(page):
            if raw:  # scripts and styles end at their own end tag only
                end = _raw_end(raw).search(page, at)
                at, raw = end.end() if end else len(page), ""
                continue
            m = _TOKEN.search(page, at)
            self.put(page[at : m.start() if m else len(page)])
            if not m:
                break
            at = m.end()
            if m[2] is None:
                continue
            name = m[2].lower()
            if name in ("body", "br") if m[1] else name not in _IN_HEAD:
                self.end_head(whole=name == "body")
            if name in _BREAKS and not self.dropped:
                self.flush()
            elif name in ("br", "img", "input"):
                self.put(" ")
            if self.form and name in _CONTROLS and not m[1] and not re.search(r"type\s*=\s*[\"']?hidden", m[3], re.I):
                self.forms[-1][0] += 1
            if m[1]:
                self.end(name)
            elif name in _VOID or m[3].endswith("/") and self.last(*_FOREIGN) >= 0 and _self_closed(m[3]):
                continue
            elif name in _RAW:
                raw = name
            elif name in _RAW_IF_CLOSED and name not in unclosed and self.last(*_FOREIGN) < 0:
                end = _raw_end(name).search(page, at)
                if end:
                    at = end.end()
                else:
                    unclosed.add(name)
                    self.begin(name, m[3])
            else:
                self.begin(name, m[3])
        self.flush()
        return self.out


def _self_closed(attributes: str) -> bool:
    """Whether the slash at the end stands outside of an unquoted value."""
    tail = attributes.rsplit(None, 1)[-1]
    return tail[-2:-1] in ("", '"', "'") or "=" not in tail and not attributes[: -len(tail)].rstrip().endswith("=")


@lru_cache(maxsize=16)
def _raw_end(name: str) -> re.Pattern:
    return re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*>?", re.I)


def blocks_of(page: str | None) -> list[dict]:
    """The page's blocks with text, in order. other: of a block whose names hint, the part of the page's running words
    that stands in none such; about 0 where the name is that of the whole page's layout. beside: outside of the article
    of a page that marks one."""
    reader = _Reader()
    out = reader.read(page or "")
    texts = [b for b in out if not b["frame"] and 2 * b["links"] <= b["words"]]
    half, inside = sum(b["words"] for b in texts) / 2, [0] * len(reader.forms)
    for b in texts:
        if b["form"] >= 0:
            inside[b["form"]] += b["words"]
    layout = [article or n >= max(half, controls * _WORDS_A_CONTROL, 1) for (controls, article), n in zip(reader.forms, inside)]
    for b in out:
        form, talk = b.pop("form"), b.pop("talk")
        b["frame"] |= form >= 0 and not layout[form] or talk and reader.articles > 1
    if any(b["article"] and not b["frame"] and not b["hint"] for b in out):
        for b in out:
            b["beside"] = not b["article"]
    running = [b for b in out if not b["frame"] and 2 * b["links"] <= b["words"]]
    total, plain = sum(b["words"] for b in running), sum(b["words"] for b in running if not b["hint"])
    for b in out:
        if b["hint"]:
            b["other"] = plain / total if total else 0.0
    return out


FEATURES = ("words", "link_density", "words_before", "density_before", "words_after", "density_after", "in_frame", "in_article", "beside_article", "hint", "other")
#: The labelled table: FEATURES of blocks of hand-labelled pages, and whether the block is main text. First those of
#: blocks that no name hints at, without the last two features.
_UNNAMED = (
    # menus, headers, footers, sidebars, notices, adverts, forms and comments in their frames
    (1, 1.0, 0, 0.0, 1, 1.0, 1, 0, 0, 0), (1, 1.0, 1, 1.0, 1, 1.0, 1, 0, 0, 0), (2, 1.0, 1, 1.0, 7, 0.0, 1, 0, 0, 0), (8, 0.0, 1, 1.0, 9, 0.0, 1, 0, 0, 0),
    (25, 0.0, 40, 0.0, 30, 0.0, 1, 0, 0, 0), (60, 0.0, 80, 0.0, 6, 0.0, 1, 0, 0, 0), (12, 0.1, 90, 0.0, 0, 0.0, 1, 0, 0, 0), (5, 0.0, 120, 0.0, 0, 0.0, 1, 0, 0, 0),
    (33, 0.0, 22, 0.0, 41, 0.0, 1, 1, 0, 0), (3, 0.0, 64, 0.0, 20, 0.0, 1, 1, 0, 0), (140, 0.0, 35, 0.0, 3, 0.3, 1, 1, 0, 0), (1, 1.0, 50, 0.0, 1, 1.0, 1, 1, 0, 0),
    (15, 0.5, 3, 1.0, 4, 1.0, 1, 0, 0, 0), (18, 0.0, 1, 1.0, 70, 0.0, 1, 0, 0, 0), (75, 0.0, 10, 0.0, 15, 0.0, 1, 1, 0, 0), (4, 0.0, 0, 0.0, 60, 0.0, 1, 1, 0, 0),
    # blocks of an article: headings, paragraphs of any length, lists, quotes, captions, links on their own
    (6, 0.0, 5, 0.0, 80, 0.0, 0, 1, 0, 1), (90, 0.0, 6, 0.0, 75, 0.0, 0, 1, 0, 1), (1, 0.0, 75, 0.0, 1, 0.0, 0, 1, 0, 1), (1, 0.0, 1, 0.0, 60, 0.0, 0, 1, 0, 1),
    (55, 0.2, 1, 0.0, 12, 0.0, 0, 1, 0, 1), (12, 0.0, 55, 0.2, 9, 0.0, 0, 1, 0, 1), (3, 1.0, 40, 0.0, 38, 0.0, 0, 1, 0, 1), (210, 0.0, 0, 0.0, 0, 0.0, 0, 1, 0, 1),
    (2, 0.0, 0, 0.0, 2, 0.0, 0, 1, 0, 1), (7, 0.6, 30, 0.0, 0, 0.0, 0, 1, 0, 1), (18, 0.0, 2, 1.0, 2, 1.0, 0, 1, 0, 1), (4, 0.0, 1, 1.0, 1, 1.0, 0, 1, 0, 1),
    (30, 0.4, 22, 0.1, 3, 1.0, 0, 1, 0, 1), (1, 1.0, 33, 0.0, 24, 0.0, 0, 1, 0, 1), (64, 0.0, 3, 1.0, 5, 0.0, 0, 1, 0, 1), (5, 0.0, 64, 0.0, 44, 0.0, 0, 1, 0, 1),
    # pages that mark neither: text among text is main text, links and short lines among links are not
    (45, 0.0, 6, 0.0, 52, 0.0, 0, 0, 0, 1), (52, 0.05, 45, 0.0, 38, 0.0, 0, 0, 0, 1), (38, 0.0, 52, 0.05, 2, 1.0, 0, 0, 0, 1), (90, 0.1, 1, 1.0, 70, 0.0, 0, 0, 0, 1),
    (26, 0.0, 40, 0.0, 31, 0.1, 0, 0, 0, 1), (31, 0.1, 26, 0.0, 8, 0.0, 0, 0, 0, 1), (120, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 1), (22, 0.0, 2, 1.0, 64, 0.0, 0, 0, 0, 1),
    (9, 0.0, 60, 0.0, 48, 0.0, 0, 0, 0, 1), (3, 0.0, 48, 0.0, 55, 0.0, 0, 0, 0, 1), (1, 0.0, 33, 0.0, 41, 0.0, 0, 0, 0, 1), (7, 0.0, 1, 1.0, 80, 0.0, 0, 0, 0, 1),
    (6, 0.0, 0, 0.0, 45, 0.0, 0, 0, 0, 1), (14, 0.2, 70, 0.0, 90, 0.0, 0, 0, 0, 1), (19, 0.0, 25, 0.0, 28, 0.0, 0, 0, 0, 1), (28, 0.0, 19, 0.0, 17, 0.0, 0, 0, 0, 1),
    (1, 1.0, 1, 1.0, 1, 1.0, 0, 0, 0, 0), (2, 1.0, 1, 1.0, 45, 0.0, 0, 0, 0, 0), (3, 1.0, 60, 0.0, 2, 1.0, 0, 0, 0, 0), (5, 0.8, 3, 1.0, 4, 0.9, 0, 0, 0, 0),
    (4, 0.0, 2, 1.0, 3, 1.0, 0, 0, 0, 0), (6, 0.0, 1, 1.0, 2, 1.0, 0, 0, 0, 0), (12, 0.9, 6, 1.0, 8, 0.8, 0, 0, 0, 0), (30, 0.8, 4, 1.0, 2, 1.0, 0, 0, 0, 0),
    (2, 0.0, 3, 1.0, 0, 0.0, 0, 0, 0, 0), (8, 0.0, 2, 1.0, 0, 0.0, 0, 0, 0, 0), (18, 0.7, 50, 0.0, 60, 0.0, 0, 0, 0, 0), (25, 0.6, 3, 1.0, 40, 0.0, 0, 0, 0, 0),
    (1, 1.0, 40, 0.0, 35, 0.0, 0, 0, 0, 0), (2, 1.0, 0, 0.0, 2, 1.0, 0, 0, 0, 0), (5, 0.0, 4, 1.0, 1, 1.0, 0, 0, 0, 0), (40, 0.9, 30, 0.0, 6, 1.0, 0, 0, 0, 0),
    # a short line before a few links is their heading, before text or a linked sentence it is the text's
    (1, 0.0, 60, 0.0, 2, 1.0, 0, 0, 0, 0), (2, 0.0, 44, 0.0, 1, 1.0, 0, 0, 0, 0), (2, 0.0, 25, 0.0, 3, 1.0, 0, 0, 0, 0), (3, 0.0, 70, 0.0, 4, 1.0, 0, 0, 0, 0), (1, 0.0, 31, 0.1, 1, 1.0, 0, 0, 0, 0), (3, 0.0, 0, 0.0, 1, 1.0, 0, 0, 0, 0),
    (2, 0.0, 48, 0.0, 21, 1.0, 0, 0, 0, 1), (3, 0.0, 66, 0.0, 18, 1.0, 0, 0, 0, 1), (1, 0.0, 35, 0.0, 26, 0.9, 0, 0, 0, 1), (2, 0.0, 52, 0.0, 40, 0.0, 0, 0, 0, 1), (3, 0.0, 41, 0.0, 9, 0.0, 0, 0, 0, 1), (2, 0.0, 30, 0.0, 3, 0.0, 0, 0, 0, 1),
    # text between text and links, or behind links at the end of the page
    (8, 0.0, 60, 0.0, 2, 1.0, 0, 0, 0, 1), (11, 0.0, 45, 0.0, 3, 1.0, 0, 0, 0, 1), (6, 0.0, 70, 0.0, 1, 1.0, 0, 0, 0, 1), (13, 0.1, 38, 0.0, 4, 1.0, 0, 0, 0, 1), (9, 0.0, 28, 0.0, 2, 0.9, 0, 0, 0, 1), (7, 0.0, 51, 0.0, 5, 1.0, 0, 0, 0, 1),
    (60, 0.0, 3, 1.0, 0, 0.0, 0, 0, 0, 1), (150, 0.0, 1, 1.0, 0, 0.0, 0, 0, 0, 1), (30, 0.05, 2, 1.0, 0, 0.0, 0, 0, 0, 1), (22, 0.0, 4, 0.9, 0, 0.0, 0, 0, 0, 1), (5, 0.0, 1, 1.0, 0, 0.0, 0, 0, 0, 0), (9, 0.0, 3, 1.0, 0, 0.0, 0, 0, 0, 0),
    # pages of one block
    (7, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 1), (2, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 1), (1, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 1), (5, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 1),
    # pages that mark their article: whatever is beside it is none
    (40, 0.0, 90, 0.0, 1, 1.0, 0, 0, 1, 0), (12, 0.0, 60, 0.0, 0, 0.0, 0, 0, 1, 0), (75, 0.1, 3, 0.0, 80, 0.0, 0, 0, 1, 0), (3, 0.0, 0, 0.0, 5, 0.0, 0, 0, 1, 0),
    (28, 0.0, 45, 0.0, 31, 0.0, 0, 0, 1, 0), (8, 0.0, 110, 0.0, 22, 0.0, 0, 0, 1, 0), (150, 0.0, 12, 0.0, 4, 0.0, 0, 0, 1, 0), (1, 0.0, 1, 1.0, 70, 0.0, 0, 0, 1, 0),
    (22, 0.2, 30, 0.0, 25, 0.0, 0, 0, 1, 0), (60, 0.0, 0, 0.0, 95, 0.0, 0, 0, 1, 0), (17, 0.0, 80, 0.0, 12, 0.0, 0, 0, 1, 0), (35, 0.0, 2, 1.0, 50, 0.0, 0, 0, 1, 0),
)
#: Blocks that names hint at: the six measures of the block and its neighbours, in_article, hint, other, main text.
_NAMED = (
    # the whole name names what is beside an article
    (9, 0.0, 1, 1.0, 8, 0.0, 0, 1.0, 0.97, 0), (30, 0.0, 6, 1.0, 40, 0.0, 0, 1.0, 0.8, 0), (75, 0.0, 60, 0.0, 52, 0.0, 0, 1.0, 0.4, 0), (4, 1.0, 4, 1.0, 4, 1.0, 0, 1.0, 0.9, 0), (2, 0.0, 50, 0.0, 3, 1.0, 1, 1.0, 0.95, 0), (12, 0.0, 33, 0.0, 28, 0.0, 1, 1.0, 0.7, 0),
    (120, 0.0, 90, 0.0, 80, 0.0, 0, 1.0, 0.15, 0), (6, 0.0, 80, 0.0, 0, 0.0, 0, 1.0, 0.9, 0), (18, 0.0, 0, 0.0, 0, 0.0, 0, 1.0, 0.0, 0), (40, 0.0, 35, 0.0, 44, 0.0, 0, 1.0, 0.0, 0), (3, 0.0, 2, 1.0, 60, 0.0, 0, 1.0, 0.01, 0), (55, 0.1, 0, 0.0, 21, 0.0, 0, 1.0, 0.02, 0),
    # inside an article, running text of its own is the article's whatever its class is called; boxes are not
    (60, 0.0, 50, 0.0, 45, 0.0, 1, 1.0, 0.8, 1), (90, 0.0, 70, 0.0, 66, 0.0, 1, 1.0, 0.7, 1), (75, 0.0, 40, 0.0, 30, 0.0, 1, 1.0, 0.75, 1), (48, 0.0, 60, 0.0, 0, 0.0, 1, 1.0, 0.85, 1), (140, 0.0, 20, 0.0, 90, 0.0, 1, 1.0, 0.5, 1), (55, 0.1, 6, 0.0, 70, 0.0, 1, 1.0, 0.6, 1),
    (30, 0.0, 45, 0.0, 52, 0.0, 1, 1.0, 0.9, 0), (22, 0.0, 60, 0.0, 41, 0.0, 1, 1.0, 0.93, 0), (50, 0.6, 70, 0.0, 33, 0.0, 1, 1.0, 0.8, 0), (16, 0.0, 38, 0.0, 3, 1.0, 1, 1.0, 0.9, 0), (36, 0.0, 80, 0.0, 64, 0.0, 1, 1.0, 0.9, 0), (70, 0.8, 50, 0.0, 40, 0.0, 1, 1.0, 0.7, 0),
    # a part of the name does, and there is other text
    (8, 0.0, 1, 1.0, 9, 0.0, 0, 0.5, 0.96, 0), (25, 0.0, 40, 0.0, 31, 0.0, 0, 0.5, 0.75, 0), (60, 0.0, 8, 0.0, 45, 0.0, 0, 0.5, 0.3, 0), (90, 0.0, 70, 0.0, 66, 0.0, 0, 0.5, 0.1, 0), (3, 1.0, 3, 1.0, 2, 1.0, 0, 0.5, 0.9, 0), (1, 0.0, 40, 0.0, 2, 1.0, 1, 0.5, 0.92, 0),
    (14, 0.0, 50, 0.0, 60, 0.0, 1, 0.5, 0.85, 0), (7, 0.0, 90, 0.0, 0, 0.0, 0, 0.5, 0.94, 0), (33, 0.0, 20, 0.0, 17, 0.0, 0, 0.33, 0.6, 0), (5, 0.0, 30, 0.0, 26, 0.0, 0, 0.33, 0.88, 0), (48, 0.0, 55, 0.0, 3, 1.0, 0, 0.67, 0.2, 0), (10, 0.0, 0, 0.0, 70, 0.0, 0, 0.67, 0.9, 0),
    # a part of the name does, but nearly all text is in such elements: the name is that of the layout
    (6, 0.0, 2, 1.0, 80, 0.0, 0, 0.5, 0.01, 1), (80, 0.0, 6, 0.0, 75, 0.0, 0, 0.5, 0.0, 1), (45, 0.0, 80, 0.0, 30, 0.0, 0, 0.5, 0.02, 1), (30, 0.1, 45, 0.0, 2, 1.0, 0, 0.5, 0.0, 1), (12, 0.0, 0, 0.0, 20, 0.0, 0, 0.33, 0.0, 1), (20, 0.0, 12, 0.0, 0, 0.0, 0, 0.33, 0.03, 1),
    (7, 0.0, 0, 0.0, 64, 0.0, 0, 0.67, 0.0, 1), (64, 0.0, 7, 0.0, 50, 0.0, 0, 0.67, 0.02, 1), (3, 0.0, 50, 0.0, 40, 0.0, 0, 0.5, 0.0, 1), (110, 0.0, 0, 0.0, 0, 0.0, 0, 0.33, 0.0, 1), (3, 1.0, 3, 1.0, 4, 1.0, 0, 0.5, 0.0, 0), (5, 0.9, 60, 0.0, 3, 1.0, 0, 0.33, 0.01, 0),
)
LABELLED = (*((*r[:-1], 0.0, 0.0, r[-1]) for r in _UNNAMED), *((*r[:6], 0, r[6], 0, *r[7:]) for r in _NAMED))


def train(spark: SparkSession, depth: int = 9) -> Column:
    """The decision tree of the labelled table as an expression over a struct column `f` of FEATURES."""
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.feature import VectorAssembler

    names = ", ".join(f"{x} double" for x in (*FEATURES, "label"))
    rows = spark.createDataFrame([tuple(map(float, r)) for r in LABELLED], names)
    model = DecisionTreeClassifier(maxDepth=depth, maxBins=128, seed=1).fit(VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows))

    def grow(node) -> str:  # noqa: ANN001
        if node.numDescendants() == 0:
            return "true" if node.prediction() > 0.5 else "false"
        split = node.split()
        return f"IF(f.{FEATURES[split.featureIndex()]} <= {split.threshold()!r}D, {grow(node.leftChild())}, {grow(node.rightChild())})"

    return grow(model._java_obj.rootNode() if hasattr(model._java_obj, "rootNode") else model._call_java("rootNode"))


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", keep: tuple[str, ...] = ()) -> DataFrame:
    """id, the columns of `keep`, text (empty if none), n_chars (code points), n_blocks, n_main.

    White space inside a block becomes one space and main blocks are joined by one space in page order; nothing else
    is dropped. A null or empty page has an empty text; unclosed markup runs to the end of the page. An empty table
    gives an empty table, repeated rows give repeated rows; other columns, whatever their names, are ignored.
    """

    def parse(texts: pd.Series) -> pd.Series:
        return texts.map(blocks_of, na_action=None)

    reader = F.pandas_udf(parse, f"array<struct<{BLOCK.replace(' ', ':').replace(',:', ',')}>>")
    tree = train(pages.sparkSession)
    read = pages.select(id_col, *keep, reader(F.col(html_col)).alias("b"))
    none = "named_struct('text', '', 'words', 0, 'links', 0, 'frame', false, 'hint', 0D, 'other', 0D, 'article', false, 'beside', false)"
    density = lambda x: f"IF({x}.words > 0, {x}.links / {x}.words, 0D)"
    before, after = f"IF(i > 0, b[i - 1], {none})", f"IF(i + 1 < size(b), b[i + 1], {none})"
    features = f"""named_struct('words', CAST(x.words AS DOUBLE), 'link_density', {density("x")}, 'words_before', CAST(y.words AS DOUBLE), 'density_before', {density("y")},
        'words_after', CAST(z.words AS DOUBLE), 'density_after', {density("z")}, 'in_frame', CAST(x.frame AS DOUBLE), 'in_article', CAST(x.article AS DOUBLE), 'beside_article', CAST(x.beside AS DOUBLE), 'hint', x.hint, 'other', x.other)"""
    around = f"transform(b, (x, i) -> named_struct('x', x, 'y', {before}, 'z', {after}))"
    marked = f"transform({around}, n -> named_struct('text', n.x.text, 'f', {re.sub(r'\b([xyz])\.', r'n.\1.', features)}))"
    rated = read.withColumn("__rated", F.expr(marked)).withColumn("__main", F.expr(f"transform(filter(__rated, r -> {tree.replace('f.', 'r.f.')}), r -> r.text)"))
    text = F.array_join("__main", " ")
    return rated.select(id_col, *keep, text.alias("text"), F.length(text).cast("long").alias("n_chars"), F.size("b").cast("long").alias("n_blocks"), F.size("__main").cast("long").alias("n_main"))
