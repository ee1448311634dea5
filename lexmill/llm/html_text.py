"""Main text of web pages: boosted trees over DOM nodes, then one consistent choice for the whole tree.

A page is parsed into block elements; text that stands beside block children is a node of its own. Each node has features of its
tag, attribute tokens, place, siblings, ancestors and subtree (text, links, markup density). Trees trained on
pages that this module writes itself, where it knows what is article, give log-odds of "article" for each node; they are kept in html_trees.json, which
``python -m lexmill.llm.html_text`` makes. Dynamic programming over the
tree then finds the best choice in which whatever is outside has nothing inside: a node is inside, outside, or a
container that decides nothing, and below an outside node all is outside.
"""

from __future__ import annotations

import html as entities
import json
import math
import random
import re
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lexmill.llm.base import slices, text_or_empty

# HTML's elements by what a parser does with them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea select iframe canvas video audio title".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCK - frozenset(("body", "html", "caption", "td", "th", "tr", "tbody", "thead", "tfoot"))
SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
SCOPE = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",)}

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<[!?][^>]*(?:>|\Z)", re.DOTALL)
_ATTR = re.compile(r"(?:^|[\s\"'])(class|id|role|style|hidden|data-y)(?=[\s=]|$)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.IGNORECASE)
_TOKEN = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)

# Attribute tokens by what they say of a node.
GOOD = frozenset("article articlebody body content entry hentry main maincontent post postcontent story storybody text blogpost prose".split())
BAD = frozenset(
    "ad ads advert advertisement adsbygoogle banner bar breadcrumb breadcrumbs byline combx comment commentlist comments community cookie cookies consent copyright disqus foot footer footnote gdpr head header hero legal login masthead menu menubar meta modal nav navbar navigation newsletter notice notification outbrain pager pagination popup promo promoted related remark replies reply respond rss search share shares sharing shoutbox sidebar signup site skip social sponsor sponsored subscribe subscription tag tags taboola teaser tool toolbar tools top topbar warning widget widgets".split()
)

TAGS = ("p", "heading", "li", "list", "div", "section", "article", "nav", "header", "footer", "aside", "form", "table", "cell", "quote", "text")
_KIND = {"p": "p", "li": "li", "dd": "li", "dt": "li", "ul": "list", "ol": "list", "dl": "list", "menu": "list", "section": "section", "article": "article", "main": "article", "nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "form": "form", "fieldset": "form", "table": "table", "tbody": "table", "tr": "table", "td": "cell", "th": "cell", "blockquote": "quote", "pre": "quote", "figure": "quote", "figcaption": "quote", "#text": "text"} | {f"h{i}": "heading" for i in range(1, 7)}
_AT = {k: i for i, k in enumerate(TAGS)}
_END = re.compile(r"[.!?;,](?:\s|$)")


TREES = Path(__file__).with_name("html_trees.json")


class Page:
    """Nodes of a page in page order; parents come before their children."""

    __slots__ = ("tag", "parent", "good", "bad", "chars", "links", "marks", "kids", "mark", "texts")

    def __init__(self, source: str):
        self.tag, self.parent, self.good, self.bad = ["#page"], [-1], [0], [0]
        self.chars, self.links, self.marks, self.kids, self.mark = [0], [0], [0], [0], [None]
        self.texts: list[list[str]] = [[]]
        self._parse(source)

    def _node(self, tag: str, parent: int, attrs: str = "") -> int:
        good = bad = 0
        mark = self.mark[parent]
        if attrs:
            for m in _ATTR.finditer(attrs):
                name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
                if name == "data-y":
                    mark = int(value)
                elif name == "hidden" or name == "style":
                    bad += 3 * (name == "hidden" or _HIDDEN.search(value) is not None)
                else:
                    for t in _TOKEN.findall(value.lower()):
                        good += t in GOOD
                        bad += t in BAD
        self.tag.append(tag)
        self.parent.append(parent)
        self.good.append(good)
        self.bad.append(bad)
        self.mark.append(mark)
        self.chars.append(0)
        self.links.append(0)
        self.marks.append(0)
        self.kids.append(0)
        self.texts.append([])
        self.kids[parent] += 1
        return len(self.tag) - 1

    def _parse(self, source: str) -> None:
        open_: list[tuple[str, int]] = [("#page", 0)]  # elements, with the node each one's text goes to
        at, anchors, loose = 0, 0, -1
        find = _TAG.search

        def text(piece: str) -> None:
            nonlocal loose
            if piece and not piece.isspace():
                node = open_[-1][1]
                if self.kids[node]:
                    if loose < 0 or self.parent[loose] != node:
                        loose = self._node("#text", node)
                    node = loose
                if "&" in piece:
                    piece = entities.unescape(piece)
                self.texts[node].append(piece)
                n = len(piece)
                self.chars[node] += n
                if anchors:
                    self.links[node] += n
            elif piece:
                node = open_[-1][1]
                if loose >= 0 and self.parent[loose] == node:
                    node = loose
                if self.texts[node]:
                    self.texts[node].append(" ")

        while m := find(source, at):
            text(source[at : m.start()])
            at = m.end()
            if m[2] is None:
                continue
            tag = m[2].lower()
            if m[1]:
                if tag == "a":
                    anchors = max(0, anchors - 1)
                if tag in BLOCK:
                    loose = -1
                for k in range(len(open_) - 1, 0, -1):
                    if open_[k][0] == tag:
                        del open_[k:]
                        break
                    if tag not in BLOCK and open_[k][0] in BLOCK:
                        break
                continue
            if tag in RAW:
                close = re.compile(f"</{tag}\\s*>", re.IGNORECASE).search(source, at)
                at = close.end() if close else (len(source) if tag in ("script", "style", "textarea", "title") else at)
                continue
            if tag in VOID:
                self.marks[open_[-1][1]] += 1
                if tag in ("br", "hr"):
                    text(" ")
                continue
            if tag in BLOCK:
                loose, anchors = -1, 0
                if tag in CLOSES_P:
                    for k in range(len(open_) - 1, 0, -1):
                        if open_[k][0] == "p":
                            del open_[k:]
                            break
                        if open_[k][0] in BLOCK:
                            break
                if tag in SAME:
                    for k in range(len(open_) - 1, 0, -1):
                        if open_[k][0] in SAME[tag]:
                            del open_[k:]
                            break
                        if open_[k][0] in SCOPE[tag]:
                            break
                parent = open_[-1][1]
                open_.append((tag, self._node(tag, parent, m[3])))
            else:
                anchors += tag == "a"
                self.marks[open_[-1][1]] += 1
                open_.append((tag, open_[-1][1]))
        text(source[at:])

    def block(self, i: int) -> str:
        return _SPACE.sub(" ", "".join(self.texts[i])).strip()


NAMES = (*TAGS, "good", "bad", "up_good", "up_bad", "up_article", "up_boiler", "depth", "chars", "own", "link_share", "marks_share", "stops", "words_block", "page_share", "begin", "kids", "siblings", "same", "index", "left_chars", "right_chars", "left_links", "right_links", "parent_chars", "parent_links", "paragraphs")


def features(page: Page) -> np.ndarray:
    """A row of NAMES for each node."""
    n = len(page.tag)
    parent, chars, links = page.parent, page.chars[:], page.links[:]
    own = page.chars
    marks, blocks = page.marks[:], [int(c > 0) for c in own]
    stops = [len(_END.findall(" ".join(t))) if t else 0 for t in page.texts]
    paragraphs = [int(t == "p" and c > 0) for t, c in zip(page.tag, own, strict=True)]
    for i in range(n - 1, 0, -1):
        p = parent[i]
        chars[p] += chars[i]
        links[p] += links[i]
        marks[p] += marks[i] + 1
        stops[p] += stops[i]
        blocks[p] += blocks[i]
        paragraphs[p] += paragraphs[i]
    begin, seen = [0] * n, 0
    kids: list[list[int]] = [[] for _ in range(n)]
    depth, up_good, up_bad, up_article, up_boiler = [0] * n, [0] * n, [0] * n, [0] * n, [0] * n
    for i in range(n):
        begin[i] = seen
        seen += own[i]
        p = parent[i]
        if p >= 0:
            kids[p].append(i)
            depth[i] = depth[p] + 1
            up_good[i] = up_good[p] + min(2, page.good[p])
            up_bad[i] = up_bad[p] + min(3, page.bad[p])
            kind = _KIND.get(page.tag[p])
            up_article[i] = up_article[p] or kind == "article"
            up_boiler[i] = up_boiler[p] or kind in ("nav", "header", "footer", "aside", "form")
    total = max(1, chars[0])
    out = np.zeros((n, len(NAMES)), np.float32)
    base = len(TAGS)
    for i in range(n):
        p = parent[i]
        brothers = kids[p] if p >= 0 else [i]
        out[i, _AT[_KIND.get(page.tag[i], "div")]] = 1
        c = chars[i]
        out[i, base:base + 16] = (page.good[i], page.bad[i], up_good[i], up_bad[i], up_article[i], up_boiler[i], min(depth[i], 30), math.log1p(c), math.log1p(own[i]), links[i] / c if c else 0, marks[i] / (c + 20), stops[i] * 50 / (c + 50), math.log1p(c / max(1, blocks[i])), c / total, begin[i] / total, min(40, len(kids[i])))
        out[i, base + 16] = min(60, len(brothers))
        if p >= 0:
            out[i, base + 23] = math.log1p(chars[p])
            out[i, base + 24] = links[p] / chars[p] if chars[p] else 0
        out[i, base + 25] = min(60, paragraphs[i])
    for brothers in kids:
        m = len(brothers)
        if not m:
            continue
        same: dict[str, int] = {}
        for i in brothers:
            same[page.tag[i]] = same.get(page.tag[i], 0) + 1
        for x, i in enumerate(brothers):
            left, right = brothers[x - 1] if x else -1, brothers[x + 1] if x + 1 < m else -1
            out[i, base + 17 : base + 23] = (same[page.tag[i]] / m, x / m, math.log1p(chars[left]) if left >= 0 else 0, math.log1p(chars[right]) if right >= 0 else 0, links[left] / chars[left] if left >= 0 and chars[left] else 0, links[right] / chars[right] if right >= 0 and chars[right] else 0)
    return out


class Trees:
    """Boosted regression trees for log-odds; grown level by level on binned features. Of splits that gain alike the first feature's lowest cut is taken."""

    def __init__(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.25, bins: int = 48, ridge: float = 2.0):
        self.depth, self.rate = depth, rate
        cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
        binned = np.column_stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)])
        share = float((weight * y).sum() / weight.sum())
        self.base = math.log(share / (1 - share))
        z = np.full(len(y), self.base)
        self.feature = np.zeros((trees, 2**depth - 1), np.int64)
        self.cut = np.full((trees, 2**depth - 1), np.inf, np.float32)
        self.leaf = np.zeros((trees, 2**depth), np.float64)
        width = max(len(c) for c in cuts) + 1
        for t in range(trees):
            p = 1 / (1 + np.exp(-z))
            g, h = weight * (y - p), weight * p * (1 - p)
            node = np.zeros(len(y), np.int64)
            for level in range(depth):
                first, many = 2**level - 1, 2**level
                best = np.full(many, 1e-6)
                for f, c in enumerate(cuts):
                    if not len(c):
                        continue
                    key = node * width + binned[:, f]
                    gs = np.bincount(key, g, many * width).reshape(many, width)
                    hs = np.bincount(key, h, many * width).reshape(many, width)
                    gl, hl = gs.cumsum(1)[:, : len(c)], hs.cumsum(1)[:, : len(c)]
                    ga, ha = gs.sum(1)[:, None], hs.sum(1)[:, None]
                    gain = gl**2 / (hl + ridge) + (ga - gl) ** 2 / (ha - hl + ridge) - ga**2 / (ha + ridge)
                    k = gain.argmax(1)
                    top = gain[np.arange(many), k]
                    for i in np.flatnonzero(top > best):
                        best[i] = top[i]
                        self.feature[t, first + i], self.cut[t, first + i] = f, c[k[i]]
                at = first + node
                node = node * 2 + (x[np.arange(len(y)), self.feature[t, at]] > self.cut[t, at])
            gs, hs = np.bincount(node, g, 2**depth), np.bincount(node, h, 2**depth)
            self.leaf[t] = rate * gs / (hs + ridge)
            z += self.leaf[t][node]

    def to_json(self) -> str:
        return json.dumps({"depth": self.depth, "base": round(self.base, 9), "feature": self.feature.tolist(), "cut": [[None if np.isinf(c) else float(c) for c in r] for r in self.cut], "leaf": np.round(self.leaf, 9).tolist()})

    @classmethod
    def from_json(cls, text: str) -> Trees:
        t, kept = cls.__new__(cls), json.loads(text)
        t.depth, t.base = kept["depth"], kept["base"]
        t.feature, t.leaf = np.array(kept["feature"], np.int64), np.array(kept["leaf"])
        t.cut = np.array([[np.inf if c is None else c for c in r] for r in kept["cut"]], np.float32)
        return t

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for t in range(len(self.leaf)):
            node = np.zeros(len(x), np.int64)
            for level in range(self.depth):
                at = 2**level - 1 + node
                node = node * 2 + (x[rows, self.feature[t, at]] > self.cut[t, at])
            z += self.leaf[t][node]
        return z


def decode(page: Page, odds: np.ndarray) -> list[bool]:
    """Which nodes are inside, in the best choice without a contradiction; only what holds text of its own adds to the value, in part by its length."""
    n = len(page.tag)
    z = np.clip(odds, -6, 6)
    value = [float(z[i]) * (0.5 + 0.25 * math.log1p(page.chars[i])) if page.chars[i] else 0.3 * float(z[i]) for i in range(n)]
    inside, outside, either = value[:], [-v for v in value], [-0.2] * n
    either[0] = 0.0
    for i in range(n - 1, 0, -1):
        if page.chars[i]:
            either[i] = -math.inf  # its own text is in or out
        p = page.parent[i]
        inside[p] += max(inside[i], outside[i])
        outside[p] += outside[i]
        either[p] += max(inside[i], outside[i], either[i])
    state = [0] * n  # 0 container, 1 inside, -1 outside
    state[0] = 0 if not page.chars[0] else (1 if inside[0] > outside[0] else -1)
    for i in range(1, n):
        up = state[page.parent[i]]
        if up < 0:
            state[i] = -1
        elif up > 0:
            state[i] = 1 if inside[i] > outside[i] else -1
        else:
            top = max(inside[i], outside[i], either[i])
            state[i] = 0 if either[i] == top else (1 if inside[i] == top else -1)
    return [s > 0 for s in state]


def training_page(r: random.Random) -> str:
    """A page whose nodes are marked: data-y="1" is article, "0" is not."""
    word = lambda: "".join(r.choice("aeiourstlnmdpcbgv") for _ in range(r.randint(2, 9)))

    def sentence(low=4, high=22):
        return " ".join(word() + ("," if r.random() < 0.1 else "") for _ in range(r.randint(low, high))).capitalize() + r.choice(".....!?")

    prose = lambda low=1, high=7: " ".join(sentence() for _ in range(r.randint(low, high)))
    few = lambda low=1, high=4: " ".join(word() for _ in range(r.randint(low, high)))
    named = r.random() < 0.7  # whether attributes say what a node is

    def attrs(*names):
        return f' {r.choice(("class", "id", "class"))}="{r.choice(names)}{r.choice(("", "", " " + word(), "-" + word()))}"' if named and r.random() < 0.85 else ""

    def tag(name, y, inner, extra=""):
        return f'<{name} data-y="{y}"{extra}>{inner}</{name}>'

    def links(n, item="li"):
        return "".join(f'<{item}><a href="/{word()}">{few(1, 3)}</a></{item}>' for _ in range(n))

    def listed(n):
        return f"<ul>{links(n)}</ul>" if r.random() < 0.7 else r.choice((" | ", " ", "")).join(f'<a href="/{word()}">{few(1, 3)}</a>' for _ in range(n))

    def nav():
        return tag(r.choice(("nav", "div", "nav")), 0, listed(r.randint(3, 12)), attrs("nav", "menu", "navbar", "main-menu", "breadcrumbs", "topbar"))

    def header():
        inner = r.choice((f"<h1>{few()}</h1>", f'<a href="/">{few(1, 2)}</a>', f"<p>{few(2, 8)}</p>", f"<div>{few()}</div>"))
        return tag(r.choice(("header", "header", "div")), 0, inner + (listed(r.randint(2, 6)) if r.random() < 0.5 else ""), attrs("header", "site-header", "masthead", "banner"))

    def footer():
        inner = r.choice((f"&copy; {word()}.example &middot; {sentence(3, 9)}", f"<p>&copy; {r.randint(1999, 2030)} {few()}. {sentence(3, 9)}</p>", listed(r.randint(2, 9)) + f"<p>{sentence(3, 14)}</p>"))
        return tag(r.choice(("footer", "footer", "div")), 0, inner, attrs("footer", "site-footer", "copyright", "legal"))

    def advert():
        inner = r.choice((sentence(3, 14), prose(1, 3), f"<p>{sentence(3, 14)}</p>", f'<a href="/x">{few(2, 8)}</a>', f"<b>{few(1, 3)}</b> {sentence(3, 9)}"))
        return f'<div data-y="0" class="{r.choice(("ad", "ads", "advert", "sponsored", "promo", "ad-banner"))}">{inner}</div>'

    def notice():
        return f'<div data-y="0" {r.choice(("class", "id"))}="{r.choice(("cookie-notice", "notice", "cookies", "gdpr", "consent", "newsletter", "subscribe", "popup"))}">{r.choice((sentence(5, 20), f"<p>{prose(1, 2)}</p>"))}{r.choice(("", "<button>OK</button>", f"<a href=x>{few(1, 3)}</a>"))}</div>'

    def form():
        return tag("form", 0, f'<label>{few(1, 3)}</label><input name="q">{r.choice(("", f"<p>{sentence(3, 12)}</p>"))}<button>{word()}</button>', attrs("search", "login", "newsletter", "contact"))

    def sidebar():
        inner = "".join(r.choice((lambda: f"<h3>{few(1, 3)}</h3>{listed(r.randint(3, 8))}", lambda: f"<div><h4>{few(1, 3)}</h4><p>{sentence(3, 16)}</p></div>", lambda: f"<p>{prose(1, 2)}</p>"))() for _ in range(r.randint(1, 4)))
        return tag(r.choice(("aside", "aside", "div")), 0, inner, ' class="sidebar"' if r.random() < 0.4 else attrs("sidebar", "widget", "related", "side", "teaser"))

    def comments():
        one = lambda: r.choice((f'<div class="comment"><b>{word()}</b> <p>{prose(1, 4)}</p></div>', f"<li><p>{word()}: {prose(1, 3)}</p></li>", f'<p class="comment">{prose(1, 4)}</p>', f"<div><h4>{word()}</h4><p>{prose(1, 3)}</p></div>"))
        return f'<{(t := r.choice(("section", "div", "ul", "ol")))} data-y="0" {r.choice(("class", "id"))}="{r.choice(("comments", "comment-list", "replies", "disqus", "commentlist", "reader-comments"))}">{f"<h3>{few(1, 2)}</h3>" if r.random() < 0.6 and t in ("section", "div") else ""}{"".join(one() for _ in range(r.randint(1, 8)))}</{t}>'

    def paragraph():
        k = r.random()
        if k < 0.62:
            t = prose(1, 7)
            if r.random() < 0.15:
                t = f"<b>{t}" + r.choice(("<br>", "</b>", ""))
            if r.random() < 0.12:
                t += f' <a href="/{word()}">{few(1, 4)}</a> {sentence()}'
            return f"<p>{t}" + ("</p>" if r.random() < 0.9 else "")
        if k < 0.72:
            return f"<p>{few(1, 4).capitalize()}.</p>"
        if k < 0.8:
            return f"<h{(n := r.randint(2, 4))}>{few(1, 7)}</h{n}>"
        if k < 0.87:
            return f"<ul>{''.join(f'<li>{sentence(2, 14)}</li>' for _ in range(r.randint(2, 7)))}</ul>"
        if k < 0.9:
            return f"<blockquote>{r.choice((prose(1, 2), f'<p>{prose(1, 3)}</p>'))}</blockquote>"
        if k < 0.93:
            return f"<table><tr>{''.join(f'<td>{few(1, 4)}</td>' for _ in range(r.randint(2, 5)))}</tr><tr>{''.join(f'<td>{few(1, 4)}</td>' for _ in range(r.randint(2, 5)))}</tr></table>"
        if k < 0.96:
            return f"<pre>{sentence()}</pre>"
        return f"<div>{prose(1, 4)}</div>"

    parts = [paragraph() for _ in range(r.choice((0, 1, 1, 2, 3, 5, 8, 13, 25)))]
    if r.random() < 0.25:  # next to nothing
        parts = [f"<p>{r.choice(('', '<b>'))}{sentence(1, 9)}{r.choice(('', '<br>', '</p>', '</b></p>'))}" for _ in range(r.choice((1, 1, 1, 2)))]
    for _ in range(r.choice((0, 0, 0, 1, 2))):
        parts.insert(r.randint(0, len(parts)), r.choice((advert, advert, notice, sidebar, form, lambda: tag("div", 0, listed(4), attrs("share", "social", "related"))))())
    title = f"<h1>{few(2, 12).capitalize()}</h1>" if r.random() < 0.85 else ""
    if title and r.random() < 0.2:
        title += f'<p data-y="0" class="{r.choice(("byline", "meta", "tags"))}">{few(2, 5)} {r.randint(1, 28)}.{r.randint(1, 12)}.2020</p>'
    tail = r.choice(("", "", comments())) if r.random() < 0.5 else ""
    body = tag(*(("article", 1) if r.random() < 0.55 else (r.choice(("main", "div", "section", "div", "td")), 1)), title + "".join(parts) + tail, attrs("content", "post", "entry", "article-body", "story", "main-content", "text"))
    if r.random() < 0.25:
        body = f"<div>{body}</div>"
    before = [f() for f in (nav, header, notice, advert, form, sidebar) if r.random() < 0.45]
    after = [f() for f in (comments, sidebar, advert, nav, form, footer, footer) if r.random() < 0.4]
    r.shuffle(before)
    page = "".join(before) + body + "".join(after)
    if r.random() < 0.2:
        page = f"<div{attrs('wrapper', 'container', 'page')}>{page}</div>"
    return f'<!DOCTYPE html><html lang="en"><head><title>{few()}</title></head><body>{page}</body></html>'


@lru_cache(1)
def model() -> Trees:
    """The trees that ``fitted`` gives, as they are kept."""
    return Trees.from_json(TREES.read_text())


def fitted(pages: int = 1200, seed: int = 7) -> Trees:
    """Trees of ``pages`` written pages."""
    r = random.Random(seed)
    xs, ys, ws = [], [], []
    for _ in range(pages):
        p = Page(training_page(r))
        x = features(p)
        kinds: list[set] = [set() for _ in p.tag]
        for i in range(len(p.tag) - 1, 0, -1):
            if p.chars[i]:
                kinds[i].add(p.mark[i])
            kinds[p.parent[i]] |= kinds[i]
        keep = [i for i in range(1, len(p.tag)) if len(kinds[i]) == 1 and None not in kinds[i]]
        xs.append(x[keep])
        ys.append(np.array([p.mark[i] if p.chars[i] else next(iter(kinds[i])) for i in keep], float))
        ws.append(np.array([1.0 + 0.3 * math.log1p(p.chars[i]) for i in keep]))
    return Trees(np.concatenate(xs), np.concatenate(ys), np.concatenate(ws))


def texts(sources: list[str], trees: Trees) -> list[str]:
    """The main text of each page: blocks inside, in page order, one on a line."""
    pages = [Page(s) for s in sources]
    if not pages:
        return []
    rows = [features(p) for p in pages]
    odds = trees(np.concatenate(rows))
    out, at = [], 0
    for p, x in zip(pages, rows, strict=True):
        inside = decode(p, odds[at : at + len(x)])
        at += len(x)
        out.append("\n".join(b for b in (p.block(i) for i, k in enumerate(inside) if k and p.texts[i]) if b))
    return out


def main_text(df: DataFrame, id_col: str = "page_id", html_col: str = "html", keep: tuple[str, ...] = ("url",), trees: Trees | None = None) -> DataFrame:
    """(id, the columns ``keep``, text, n_chars) of every page; n_chars are the code points of text.

    A null or empty page, and one without an article, has an empty text. Of choices of equal value a node is rather a container than inside, and rather inside than outside. Pages are read whole, whatever their length or nesting. Repeated
    rows come out as often as they went in; other columns are ignored; an empty table gives no rows.
    """
    trees = trees or model()
    keep = tuple(c for c in keep if c in df.columns)
    source = df.select(df[id_col].alias("__id"), df[html_col].alias("__html"), *(df[c].alias(f"__{i}") for i, c in enumerate(keep)))
    kinds = {f.name: f.dataType.simpleString() for f in source.schema}
    names = ["__id", *(f"__{i}" for i in range(len(keep)))]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in parts:
            for b in slices(whole, "__html"):
                t = texts(text_or_empty(b.column("__html")), trees)
                yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), pa.array(t, pa.string()), pa.array([len(x) for x in t], pa.int64())], [*names, "text", "n_chars"])

    out = source.mapInArrow(run, ", ".join(f"{n} {kinds[n]}" for n in names) + ", text string, n_chars bigint")
    return out.withColumnsRenamed({"__id": id_col, **{f"__{i}": c for i, c in enumerate(keep)}})


if __name__ == "__main__":
    TREES.write_text(fitted().to_json())
