"""Main text of web pages by gradient-boosted trees over DOM nodes, decoded from the root down.

A page is parsed to a tree of elements. Each gets features of its subtree (how dense in text, links and tags), the words
of its attributes, its depth and its siblings; boosted trees turn them to the log odds of belonging to the article. A node is
kept only with its parent: of all such choices the one with the largest sum of log odds, each weighted by the node's own
text, is found from the leaves up, so an ancestor and its descendants never contradict each other.

The trees are fitted on the driver to pages from templates with known main text, whose shapes and words are drawn at
random; no page of the input is used.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ship

# Fixed values of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "math", "select", "object"}
BLOCK = set(
    "address article aside blockquote body button dd details dialog div dl dt fieldset figcaption figure footer form h1 "
    "h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
ENDS_P = BLOCK - {"td", "th", "tr", "tbody", "thead", "tfoot", "option", "body", "head", "html"}
WALLS = BLOCK - {"p"}
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}}
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.DOTALL,
)
#: A slash that closes a tag at once; one at the end of an unquoted value, as in ``<a href=/>``, does not.
CLOSED = re.compile(r"(?:^|[\s\"'])/\Z")
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'=<>`]+)))?")
#: Words of class, id, role and label, by what they hint at.
HINTS = {
    "nav": "nav navigation navbar menu breadcrumb breadcrumbs toc pager pagination topnav tabs skip",
    "header": "header masthead banner topbar logo branding head",
    "footer": "footer copyright colophon legal bottom foot contentinfo",
    "side": "sidebar side aside rail widget widgets complementary secondary",
    "ad": "ad ads advert adverts advertisement sponsor sponsored promo promotion adsense banner-ad dfp outbrain taboola",
    "notice": "cookie cookies consent gdpr notice alert popup modal newsletter subscribe signup paywall overlay dialog toast",
    "comment": "comment comments discussion disqus respond reply replies reviews feedback",
    "form": "form search login input contact",
    "share": "share social sharing related recommended tags more popular trending meta byline",
    "content": "content article main post entry story body text page-content post-body entry-content maincontent prose",
}
HINT_OF = {w: k for k, words in enumerate(HINTS.values()) for w in words.split()}
TAGS = "h1 nav header footer aside form article main section ul ol li p a div table button figure details".split()
#: Elements that say by themselves what a hint says.
MEANS = {t: list(HINTS).index(h) for t, h in {"nav": "nav", "header": "header", "footer": "footer", "aside": "side", "form": "form"}.items()}
FEATURES = (
    [f"tag_{t}" for t in TAGS]
    + ["tag_heading", "tag_inline"]
    + [f"hint_{h}" for h in HINTS]
    + [f"under_{h}" for h in HINTS]
    + ["depth", "own_text", "text", "link_share", "tag_density", "nodes", "punctuation", "sentence", "share_of_page"]
    + ["siblings", "place", "same_tag", "sibling_text", "in_form", "in_list", "paragraphs", "after"]
)


@dataclass
class Node:
    tag: str
    attributes: str
    parent: int
    depth: int
    children: list[int] = field(default_factory=list)
    text: list[str] = field(default_factory=list)


def parse(source: str) -> tuple[list[Node], list[tuple[int, str | None]]]:
    """Elements in page order, and the page as (element, text) with None where a block begins or ends.

    Every tag soup gives a tree: unclosed elements end with their parent, stray ends are ignored, and elements that HTML
    ends by themselves (paragraphs, list items, cells) do so. What is inside scripts, styles and the like is left out.
    """
    nodes, flow, open_, at = [Node("#page", "", -1, 0)], [], [0], 0
    where: dict[str, list[int]] = {}  # places among the open elements, by name; and those of blocks but paragraphs
    walls: list[int] = []

    def put(text: str) -> None:
        if text:
            flow.append((open_[-1], html.unescape(text)))

    def begin(node: Node) -> None:
        where.setdefault(node.tag, []).append(len(open_))
        if node.tag in WALLS:
            walls.append(len(open_))
        open_.append(len(nodes) - 1)

    def close(to: int) -> None:
        ended = [nodes[n].tag for n in open_[to:]]
        if not BLOCK.isdisjoint(ended):
            flow.append((open_[-1], None))
        del open_[to:]
        for tag in ended:
            where[tag].pop()
        while walls and walls[-1] >= to:
            walls.pop()

    def last_open(tags: set[str], stop: set[str] | None = None) -> int | None:
        """Place of the innermost open element of these, if none of ``stop`` is open inside it."""
        found = max((where[t][-1] for t in tags if where.get(t)), default=0)
        if stop is WALLS:
            wall = walls[-1] if walls else 0
        else:
            wall = max((where[t][-1] for t in stop or () if where.get(t)), default=0)
        return found if found > wall else None

    while at < len(source):
        m = TOKEN.search(source, at)
        if not m:
            put(source[at:])
            break
        put(source[at : m.start()])
        at = m.end()
        if m[1]:
            found = last_open({m[1].lower()})
            if found is not None:
                close(found)
        elif m[2]:
            tag = m[2].lower()
            if tag == "br":
                flow.append((open_[-1], " "))
                continue
            if tag in RAW:
                if not m[0].endswith("/>"):
                    end = re.compile(rf"</{re.escape(tag)}[^>]*(?:>|\Z)", re.IGNORECASE).search(source, at)
                    at = end.end() if end else len(source)
                continue
            if tag in ENDS_P:
                found = last_open({"p"}, WALLS)
                if found is not None:
                    close(found)
            if tag in SIBLINGS:
                found = last_open(SIBLINGS[tag], SCOPE[tag])
                if found is not None:
                    close(found)
            if tag in BLOCK:
                flow.append((open_[-1], None))
            if tag in VOID:
                continue
            nodes.append(Node(tag, m[3] or "", open_[-1], nodes[open_[-1]].depth + 1))
            nodes[open_[-1]].children.append(len(nodes) - 1)
            if tag in BLOCK or not CLOSED.search(m[3] or ""):
                begin(nodes[-1])
    return nodes, flow


def hints(attributes: str) -> set[int]:
    found = set()
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        if name.lower() in ("class", "id", "role", "aria-label"):
            for word in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", a or b or c).lower()):
                if word in HINT_OF:
                    found.add(HINT_OF[word])
    return found


def features(nodes: list[Node], flow: list[tuple[int, str | None]]) -> tuple[np.ndarray, np.ndarray]:
    """A row of ``FEATURES`` for each node, and the length of its own text."""
    n = len(nodes)
    own, links, marks, ends = (np.zeros(n) for _ in range(4))
    tag = [x.tag for x in nodes]
    parent = np.array([x.parent for x in nodes])
    for i, text in flow:
        if text is not None:
            t = text.strip()
            own[i] += len(t)
            marks[i] += t.count(".") + t.count(",")
            ends[i] += t.endswith((".", "!", "?"))
    under_a = np.zeros(n, bool)
    inside = {"form": np.zeros(n), "list": np.zeros(n)}
    for i in range(1, n):
        p = parent[i]
        under_a[i] = tag[i] == "a" or under_a[p]
        inside["form"][i] = tag[i] == "form" or inside["form"][p]
        inside["list"][i] = tag[i] in ("ul", "ol", "nav", "menu") or inside["list"][p]
    links[:] = own * under_a
    total = np.stack([own, links, marks, ends, np.ones(n), np.array([t == "p" for t in tag], float)])
    for i in range(n - 1, 0, -1):
        total[:, parent[i]] += total[:, i]
    text, linked, punctuation, sentences, count, paragraphs = total
    x = np.zeros((n, len(FEATURES)), np.float32)
    above, base = len(TAGS) + 2 + len(HINTS), len(TAGS) + 2 + 2 * len(HINTS)
    around_it: list[set[int]] = []  # hints of each node and of all above it
    page, seen = max(1.0, text[0]), 0.0
    place, alike = np.zeros(n), [Counter(tag[j] for j in node.children) for node in nodes]
    for node in nodes:
        place[node.children] = np.arange(len(node.children))
    for i, node in enumerate(nodes):
        if node.tag in TAGS:
            x[i, TAGS.index(node.tag)] = 1
        x[i, len(TAGS)] = node.tag in HEADINGS
        x[i, len(TAGS) + 1] = node.tag not in BLOCK
        mine = hints(node.attributes) if node.attributes else set()
        outer = around_it[node.parent] if i else set()
        for h in mine:
            x[i, len(TAGS) + 2 + h] = 1
        for h in outer:
            x[i, above + h] = 1
        mine = mine | {MEANS[node.tag]} if node.tag in MEANS else mine
        around_it.append(outer | mine if mine else outer)
        around = len(nodes[node.parent].children) if i else 1
        other = text[parent[i]] - text[i] if i else 0
        x[i, base:] = (
            node.depth, np.log1p(own[i]), np.log1p(text[i]), linked[i] / max(1, text[i]), count[i] / max(1, text[i]),
            np.log1p(count[i]), punctuation[i] / max(1, text[i]), sentences[i] > 0, text[i] / page, np.log1p(around),
            place[i] / around, alike[node.parent][node.tag] / around if i else 1, np.log1p(other),
            inside["form"][i], inside["list"][i], np.log1p(paragraphs[i]), seen / page,
        )
        seen += own[i]
    return x, own


@dataclass
class Boosted:
    """Trees of equal depth over the features, as arrays: which feature, which limit, and the leaves' values."""

    base: float
    feature: np.ndarray  # trees x inner nodes
    limit: np.ndarray
    value: np.ndarray  # trees x leaves

    def odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows, depth = np.arange(len(x)), int(np.log2(self.value.shape[1]))
        for f, t, v in zip(self.feature, self.limit, self.value, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (x[rows, f[at]] > t[at])
            out += v[at - (2**depth - 1)]
        return out


def boost(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.3, least: int = 10, share: float = 0.5, seed: int = 3) -> Boosted:
    """Logistic loss; splits at quantiles by the gain of gradient and curvature, each tree on a random share of the rows."""
    random = np.random.default_rng(seed)
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0.03, 0.97, 24))) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
    bins = 26
    base = float(np.log(y.mean() / (1 - y.mean())))
    score = np.full(len(y), base)
    found: list[list[np.ndarray]] = [[], [], []]
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, p * (1 - p)
        mine = random.random(len(y)) < share
        feature, limit = np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, np.inf)
        at = np.zeros(len(y), np.int64)
        for node in range(2**depth - 1):
            all_rows = np.flatnonzero(at == node)
            rows = all_rows[mine[all_rows]]
            best = 1e-6
            if len(rows) >= 2 * least:
                gr, hr = g[rows], h[rows]
                whole = gr.sum() ** 2 / (hr.sum() + 1)
                for j, c in enumerate(cuts):
                    b = binned[rows, j]
                    left_g = np.cumsum(np.bincount(b, gr, bins))[: len(c)]
                    left_h = np.cumsum(np.bincount(b, hr, bins))[: len(c)]
                    left_n = np.cumsum(np.bincount(b, minlength=bins))[: len(c)]
                    gain = left_g**2 / (left_h + 1) + (gr.sum() - left_g) ** 2 / (hr.sum() - left_h + 1) - whole
                    gain[(left_n < least) | (len(rows) - left_n < least)] = 0
                    k = int(gain.argmax())
                    if gain[k] > best:
                        best, feature[node], limit[node] = gain[k], j, c[k]
            at[all_rows] = 2 * node + 1 + (x[all_rows, feature[node]] > limit[node])
        leaf = at - (2**depth - 1)
        value = rate * np.bincount(leaf, g, 2**depth) / (np.bincount(leaf, h, 2**depth) + 1)
        score += value[leaf]
        for kept, new in zip(found, (feature, limit, value), strict=True):
            kept.append(new)
    return Boosted(base, *(np.array(f) for f in found))


def decode(nodes: list[Node], odds: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Which nodes are kept: with their parents, and with the largest sum of weighted log odds."""
    gain = odds * (1 + np.log1p(own))
    gain[0] = 0
    for i in range(len(nodes) - 1, 0, -1):
        if gain[i] > 0:
            gain[nodes[i].parent] += gain[i]
    keep = np.zeros(len(nodes), bool)
    keep[0] = True
    for i in range(1, len(nodes)):
        keep[i] = keep[nodes[i].parent] and gain[i] > 0
    return keep


def blocks(flow: list[tuple[int, str | None]], keep: np.ndarray) -> str:
    """Kept text: blocks joined by line ends, white space within a block made one blank."""
    out, block = [], []
    for i, text in [*flow, (0, None)]:
        if text is None:
            if line := " ".join("".join(block).split()):
                out.append(line)
            block = []
        elif keep[i]:
            block.append(text)
    return "\n".join(out)


class Templates:
    """Pages with known main text, drawn at random: what surrounds articles, in its many forms."""

    def __init__(self, seed: int):
        self.random = np.random.default_rng(seed)
        letters = np.array(list("etaoinshrdlucmfwypvbgk"))
        self.words = ["".join(self.random.choice(letters, self.random.integers(2, 9))) for _ in range(400)]

    def pick(self, *options: str) -> str:
        return options[self.random.integers(len(options))]

    def chance(self, p: float) -> bool:
        return bool(self.random.random() < p)

    def some(self, low: int, high: int) -> str:
        return " ".join(self.words[i] for i in self.random.integers(0, len(self.words), self.random.integers(low, high)))

    def prose(self, low: int, high: int) -> str:
        return " ".join(self.some(3, 14).capitalize() + self.pick(".", ".", "!", "?", ", " + self.some(2, 5) + ".") for _ in range(self.random.integers(low, high)))

    def label(self) -> str:
        """What a link says: words, a sentence or a number, with or without a mark at its end."""
        said = self.pick(self.some(1, 4), self.some(1, 4).capitalize(), self.some(3, 12).capitalize(), str(self.random.integers(1, 2000)))
        return said + self.pick("", "", "", ".", "?", "!", ",", "...")

    def links(self, low: int, high: int) -> str:
        return "".join(f'<li><a href="/{self.some(1, 2)}">{self.label()}</a></li>' for _ in range(self.random.integers(low, high)))

    def named(self, tag: str, hint: str, p: float = 0.85) -> tuple[str, str]:
        """An element with one of the words of a hint, in one of the usual forms, or none."""
        word = self.pick(*HINTS[hint].split())
        form = self.pick(f' class="{word}"', f' id="{word}"', f' class="c-{word} x{self.random.integers(9)}"', f' class="{self.some(1, 2)} {word}-box"')
        other = self.pick("", "", f' class="{self.some(1, 3)}"', f' id="{self.some(1, 2)}"')
        return f"<{tag}{form if self.chance(p) else other}>", f"</{tag}>"

    def clutter(self, kind: str) -> str:
        """One piece of what is not the article; every element in it carries the mark ``data-x``."""
        prose = self.prose(1, 4)
        plain = {
            "nav": lambda: ("nav", f"<ul>{self.links(3, 9)}</ul>" if self.chance(0.6) else self.pick(" ", " / ", " | ", " &gt; ").join(f'<a href="/{self.some(1, 2)}">{self.label()}</a>' for _ in range(self.random.integers(1, 7)))),
            "header": lambda: ("header", f'<a href="/">{self.some(1, 3)}</a><p>{self.some(2, 8)}</p>' + self.pick("", f"<ul>{self.links(2, 6)}</ul>")) if self.chance(0.6) else ("header", f'<a href="/">{self.label()}</a>'),
            "footer": lambda: ("footer", self.pick(f"&copy; {self.some(2, 20)}", f"<p>&copy; {prose}</p><ul>{self.links(2, 6)}</ul>", prose)),
            "side": lambda: ("aside", f"<h3>{self.some(1, 4)}</h3>" + self.pick(f"<ul>{self.links(3, 8)}</ul>", f"<p>{prose}</p>")),
            "ad": lambda: ("div", self.pick(prose, f'<a href="/x">{self.some(3, 9)}</a>', f"<p>{prose}</p>")),
            "notice": lambda: ("div", f"<p>{prose}</p><button>{self.some(1, 3)}</button>"),
            "comment": lambda: (self.pick("section", "div", "ol"), f"<h3>{self.some(1, 3)}</h3>" + "".join(f"<div{self.pick('', ' class=comment')}><b>{self.some(1, 3)}</b><p>{self.prose(1, 5)}</p></div>" for _ in range(self.random.integers(1, 6)))),
            "form": lambda: ("form", f"<label>{self.some(1, 5)}</label><input><p>{self.some(2, 9)}</p><button>{self.some(1, 2)}</button>"),
            "share": lambda: (self.pick("div", "section", "ul"), f"<h4>{self.some(1, 4)}</h4><ul>{self.links(2, 7)}</ul>"),
        }
        tag, inner = plain[kind]()
        needs = tag in ("div", "section", "ul", "ol")
        if self.chance(0.25) and not needs:
            tag, needs = "div", True
        begin, end = self.named(tag, kind, 1.0 if needs else 0.5)
        return re.sub(r"<(\w+)", r"<\1 data-x", begin + inner + end)

    def many(self, most: int) -> int:
        """A number from 1 on, as often of one size as of another."""
        return int(np.exp(self.random.uniform(0, np.log(most))))

    def said(self) -> str:
        """What a cell, an item or a heading says: words, a number or sentences, with a mark at its end or none."""
        return self.pick(self.some(1, 4), self.some(1, 9).capitalize(), self.some(2, 6) + ":", str(self.random.integers(1, 9999)), self.prose(1, 2), self.some(1, 3) + self.pick("", ".", "?"))

    def inline(self) -> str:
        link = f'<a href="/q">{self.some(1, 4)}</a>'
        return self.pick(self.prose(1, 6), self.prose(1, 9), f"<b>{self.some(1, 3)}</b> {self.prose(1, 4)}", f"{self.some(2, 7)} {link} {self.prose(1, 3)}", f"{self.prose(1, 3)} {link} {self.some(1, 3)} <em>{self.some(1, 3)}</em>: {self.prose(1, 2)}", f"{link} {self.prose(1, 4)} {self.pick('', link + '.')}", f"<i>{self.prose(1, 2)}</i>", f"{self.prose(1, 3)}<br>{self.prose(1, 2)}", f"{self.some(1, 4)} <code>{self.some(1, 2)}</code> {self.some(0, 4)}", self.said())

    def block(self, most: int) -> str:
        """One block of an article; lists and tables have up to ``most`` rows."""
        kind, n = self.random.random(), self.many(most)
        if kind < 0.58:
            return f"<p>{self.inline()}" + self.pick("</p>", "</p>", "</p>", "")
        if kind < 0.68:
            tag = self.pick("h2", "h2", "h3", "h4")
            return f"<{tag}>{self.some(1, 7).capitalize()}{self.pick('', '', '?', '.')}</{tag}>"
        if kind < 0.76:
            tag, end = self.pick("ul", "ol"), self.pick("</li>", "")
            linked = self.chance(0.15)
            return f"<{tag}>" + "".join(f'<li>{f"<a href=/q>{self.some(1, 4)}</a> " if linked else ""}{self.said()}{end}' for _ in range(n)) + f"</{tag}>"
        if kind < 0.82:
            wide, cell = int(self.random.integers(1, 5)), self.pick("</td>", "")
            head = "<tr>" + "".join(f"<th>{self.some(1, 3)}</th>" for _ in range(wide)) + "</tr>" if self.chance(0.5) else ""
            rows = "".join("<tr>" + "".join(f"<td>{self.said()}{cell}" for _ in range(wide)) + self.pick("</tr>", "") for _ in range(n))
            return f"<table>{head}{f'<tbody>{rows}</tbody>' if self.chance(0.3) else rows}</table>"
        if kind < 0.87:
            return "<blockquote>" + self.pick(self.inline(), f"<p>{self.inline()}</p>", f"<p>{self.inline()}</p><p>{self.inline()}</p>") + "</blockquote>"
        if kind < 0.91:
            return self.pick("<pre>{}</pre>", "<pre><code>{}</code></pre>").format("\n".join(self.some(1, 6) for _ in range(self.many(12))))
        if kind < 0.95:
            return "<dl>" + "".join(f"<dt>{self.some(1, 4)}</dt><dd>{self.pick(self.said(), self.inline())}</dd>" for _ in range(self.many(12))) + "</dl>"
        return self.pick(f"<figure><img src=x><figcaption>{self.inline()}</figcaption></figure>", f"<div>{self.inline()}</div>", f"<section><h3>{self.some(1, 5)}</h3><p>{self.inline()}</p></section>", f"<div><p>{self.inline()}</p></div>", "<hr>")

    def page(self) -> str:
        body = []
        blocks = [self.block(200 if self.chance(0.15) else 12) for _ in range(self.many(150) if self.chance(0.1) else self.random.integers(1, 15))]
        alone = self.chance(0.15)  # a page that is all article
        if not any("<p>" in b for b in blocks) or self.chance(0.5):
            blocks.insert(0, f"<p>{self.prose(1, 9)}</p>")
        if not alone:
            for i in range(len(blocks)):
                if self.chance(0.06):
                    blocks[i] += self.clutter(self.pick("ad", "share", "notice", "form"))
        title = f"<h1>{self.pick(self.some(1, 10), self.some(1, 6).capitalize(), self.some(1, 4).capitalize() + self.pick('.', '?', '!'))}</h1>" if self.chance(0.85) else ""
        if self.chance(0.15):
            title = f"<header>{title}</header>"
        begin, end = self.pick("<article>", "<main>", "<div>"), ""
        if begin == "<div>" or self.chance(0.4):
            begin, end = self.named(begin[1:-1], "content", 1.0)
        end = end or begin.replace("<", "</")
        tail = "" if alone else "".join(self.clutter(k) for k in ("share", "comment", "form") if self.chance(0.25))
        article = begin + title + "".join(blocks) + (tail if self.chance(0.5) else "") + end + ("" if self.chance(0.5) else tail)
        if self.chance(0.2):
            article = f"<main>{article}</main>" if not article.startswith("<main") else article
        for kind in ("notice", "header", "nav", "ad", "side", "form"):
            if not alone and self.chance({"nav": 0.9, "ad": 0.6, "header": 0.6}.get(kind, 0.4)):
                body.append(self.clutter(kind))
        body.append(article)
        for kind in ("side", "ad", "comment", "share", "notice", "footer"):
            if not alone and self.chance({"footer": 0.9}.get(kind, 0.3)):
                body.append(self.clutter(kind))
        inner = "".join(body)
        if self.chance(0.3):
            inner = f'<div class="{self.pick("wrapper", "container", "page", "site")}">{inner}</div>'
        return f"<html><head><title>x</title></head><body>{inner}" + self.pick("</body></html>", "")


@cache
def trained(pages: int = 1000, seed: int = 1, each: int = 50) -> Boosted:
    """Trees fitted to ``pages`` template pages, and at most ``each`` nodes of a page, drawn at random; always the same."""
    templates = Templates(seed)
    xs, ys = [], []
    for _ in range(pages):
        nodes, flow = parse(templates.page())
        x, _ = features(nodes, flow)
        mine = np.ones(len(nodes))
        for i in range(1, len(nodes)):
            mine[i] = mine[nodes[i].parent] and "data-x" not in nodes[i].attributes
        some = templates.random.permutation(len(nodes) - 1)[:each] + 1
        xs.append(x[some])
        ys.append(mine[some])
    return boost(np.concatenate(xs), np.concatenate(ys))


def main_texts(sources: list[str | None], model: Boosted) -> list[str]:
    """The main text of each page; a null or empty page has none."""
    parsed = [parse(s or "") for s in sources]
    made = [features(*p) for p in parsed]
    if not made:
        return []
    odds = model.odds(np.concatenate([x for x, _ in made]))
    out, at = [], 0
    for (nodes, flow), (_, own) in zip(parsed, made, strict=True):
        out.append(blocks(flow, decode(nodes, odds[at : at + len(nodes)].copy(), own)))
        at += len(nodes)
    return out


def extract(pages: DataFrame, model: Boosted | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url, html): the main text and its code points.

    Character references are decoded, white space inside a block is one blank, and blocks in page order are joined by
    line ends. A null or empty html has an empty text. Repeated rows get the same result each; ids and urls may be null.
    An empty table gives an empty one; other columns are not read.
    """
    ship(pages.sparkSession)
    model = model or trained()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                texts = main_texts(part["html"].to_pylist(), model)
                n = pa.array([len(t) for t in texts], pa.int64())
                yield pa.record_batch([part["page_id"], part["url"], pa.array(texts, pa.string()), n], ["page_id", "url", "text", "n_chars"])

    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")
    )
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
