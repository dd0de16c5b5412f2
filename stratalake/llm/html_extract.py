"""Main text of web pages: boosted trees over DOM nodes, decoded along the tree.

A tolerant one-pass reader turns markup into block nodes (and inline nodes that carry a class,
id or role), each with features of its subtree (text, link and tag density), its attribute
tokens and those of its ancestors, its depth and its siblings.  Gradient-boosted trees, trained
here on pages made from a fixed seed, give the odds that a node holds main text.  Decoding
picks the most likely labels in which a node that is dropped drops everything below it, so a
dropped ancestor never has a kept descendant.

Scripts, styles, comments and other raw elements never become text.
"""

from __future__ import annotations

import html
import math
import random
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stratalake.llm.common import ship, slices

ship(__name__)

# Fixed values of the markup language.
RAW = {"script", "style", "title", "textarea", "noscript", "template", "iframe", "noembed", "svg", "math", "object", "select"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCKS = set(
    "address article aside blockquote body button center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol "
    "optgroup option p pre section summary table tbody td tfoot th thead tr ul caption".split()
)
CLOSES = {  # a start tag that ends an open element of these kinds, up to the given fence
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
P_FENCE = {"button", "table", "td", "th", "caption", "html", "li", "dd", "dt"}
KINDS = [
    {"article", "main"},
    {"nav", "menu"},
    {"header", "hgroup"},
    {"footer"},
    {"aside"},
    {"form", "button", "fieldset", "legend", "label", "option", "dialog"},
    {"section"},
    {"div", "center"},
    {"p"},
    {"h1", "h2", "h3", "h4", "h5", "h6"},
    {"ul", "ol", "dl", "dir"},
    {"li", "dt", "dd"},
    {"table", "tbody", "thead", "tfoot", "tr", "td", "th", "caption"},
    {"figure", "figcaption", "details", "summary"},
    {"blockquote", "pre", "address"},
    {"html", "body"},
]
TOKENS = [  # words in class, id and role that hint at a part of a page
    "content article post entry main story text body page prose".split(),
    "ad ads advert adverts advertisement adsense banner sponsor sponsored promo promotion".split(),
    "nav navbar navigation menu breadcrumb breadcrumbs pagination pager tabs toc links".split(),
    "comment comments reply replies discussion disqus thread respond reader".split(),
    "sidebar side aside related widget share social recommended more popular trending tags rail".split(),
    "cookie cookies consent notice popup modal overlay gdpr newsletter subscribe alert message".split(),
    "header head masthead top logo brand hero".split(),
    "footer foot bottom copyright legal colophon".split(),
    "form login signup signin search register contact".split(),
    "hidden invisible none".split(),
]
_WORD_KIND = {w: i for i, ws in enumerate(TOKENS) for w in ws}
_TAG_KIND = {t: i for i, ts in enumerate(KINDS) for t in ts}

# A quote opens a value only after "=", and each place can be read in one way only, so matching never
# backtracks.  If no ">" follows outside the values, the tag ends at the first ">" (quotes ignored).
_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/<>]*+)"
    r"(?:((?:[^<>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>|([^<>]*+)>)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
_MARK = re.compile(r"(?:^|\s)data-gold=\"([01])\"")  # on the pages that the trainer makes
_SPLIT = re.compile(r"[a-z]+|[A-Z][a-z]*")
_RAW_END = {name: re.compile(rf"</{name}\b[^>]*>?", re.I) for name in RAW}


@dataclass
class Page:
    """Nodes in page order: parent, kind of tag (-1 inline), hint set; pieces of text."""

    parent: list[int] = field(default_factory=list)
    kind: list[int] = field(default_factory=list)
    tag: list[str] = field(default_factory=list)
    hints: list[int] = field(default_factory=list)  # bit set over TOKENS
    gold: list[int] = field(default_factory=list)
    pieces: list[tuple[int, int, str, bool]] = field(default_factory=list)  # node, block, text, link

    def add(self, parent: int, tag: str, attributes: str, marked: bool = False) -> int:
        hints, gold = 0, -1
        if marked and (mark := _MARK.search(attributes)):
            gold = int(mark[1])
        for m in _ATTRIBUTE.finditer(attributes):
            name, value = m[1].lower(), (m[2] or "").strip("\"'")
            if name == "hidden" or (name == "aria-hidden" and value == "true"):
                hints |= 1 << 9
            elif name == "style":
                if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                    hints |= 1 << 9
            else:
                for w in _SPLIT.findall(value):
                    if (k := _WORD_KIND.get(w.lower())) is not None:
                        hints |= 1 << k
        self.parent.append(parent)
        self.kind.append(_TAG_KIND.get(tag, -1))
        self.tag.append(tag)
        self.hints.append(hints)
        self.gold.append(gold)
        return len(self.parent) - 1


def read(markup: str, marked: bool = False) -> Page:
    """Never fails: stray end tags are passed over, open elements end with the page.  The time is in
    proportion to the page, whatever is left open.  ``marked`` pages carry the trainer's marks."""
    page = Page()
    stack: list[tuple[str, int]] = [("", page.add(-1, "html", ""))]
    places: dict[str, list[int]] = {}  # of the open elements of a name, and of all open blocks
    at, block, link = 0, 0, False
    # No tag ends after the last ">"; only a comment left open reaches beyond it.
    last = markup.rfind(">") + 1

    def text(a: int, b: int) -> None:
        if b > a:
            raw = markup[a:b]
            page.pieces.append((stack[-1][1], block, html.unescape(raw) if "&" in raw else raw, link))

    def opened(name: str, attributes: str) -> None:
        for key in (name, "/") if name in BLOCKS else (name,):
            places.setdefault(key, []).append(len(stack))
        stack.append((name, page.add(stack[-1][1], name, attributes, marked)))

    def innermost(names: Iterable[str]) -> int:
        return max((places[name][-1] for name in names if places.get(name)), default=0)

    def end_of(names: Iterable[str], fence: Iterable[str]) -> None:
        """Close the innermost element of one of the names, unless one of ``fence`` is inside it."""
        i = innermost(names)
        if i and i >= innermost(fence):
            for name, _ in stack[i:]:
                for key in (name, "/") if name in BLOCKS else (name,):
                    places[key].pop()
            del stack[i:]

    while m := _MARKUP.search(markup, at, last):
        text(at, m.start())
        at = m.end()
        if m[2] is None:
            if at == last and m[0].startswith("<!--") and not m[0].endswith("-->"):
                at = len(markup)
            continue
        name, attributes = m[2].lower(), m[3] if m[3] is not None else m[4]
        if m[1]:
            if name in BLOCKS:
                block, link = block + 1, False
                end_of((name,), ())
            elif name == "a":
                link = False
            if name not in BLOCKS:
                end_of((name,), ("/",))
            continue
        if name in RAW:
            if not attributes.rstrip().endswith("/"):
                close = _RAW_END[name].search(markup, at)
                at = close.end() if close else len(markup)
            continue
        if name in VOID:
            if name == "br":
                page.pieces.append((stack[-1][1], block, " ", False))
            elif name == "hr":
                block += 1
            continue
        if name in BLOCKS:
            block, link = block + 1, False
            end_of({"p"}, P_FENCE)
            if name in CLOSES:
                end_of(*CLOSES[name])
            if name == "html" and len(stack) == 1:
                continue
            opened(name, attributes)
        else:
            link = link or name == "a"
            if _ATTRIBUTE.search(attributes) and not attributes.rstrip().endswith("/"):
                opened(name, attributes)
    rest = markup.find("<!--", at)
    text(at, len(markup) if rest < 0 else rest)
    return page


FEATURES = len(KINDS) + 1 + 2 * len(TOKENS) + 6 + 16
_WORDS = re.compile(r"\S+")
_STOPS = re.compile(r"[.,;:!?]")


def features(page: Page) -> np.ndarray:
    """One row per node; everything about a subtree is summed from the end of the page."""
    n = len(page.parent)
    own = np.zeros((n, 4))  # characters, linked characters, words, stops
    for node, _, piece, link in page.pieces:
        size = len(piece) if not piece.isspace() else 0
        if size:
            own[node] += (size, size * link, piece.count(" ") + 1, len(_STOPS.findall(piece)))
    below = np.concatenate([own, np.ones((n, 1)), np.zeros((n, 2))], 1)
    kind = page.kind
    children, order = np.zeros(n), np.zeros(n)
    for i in range(n - 1, 0, -1):
        p = page.parent[i]
        below[i, 5] += kind[i] == 8
        below[i, 6] += kind[i] == 11
        below[p] += below[i]
        children[p] += 1
    same, largest = np.zeros(n), np.zeros(n)
    counts: dict[tuple[int, str], int] = {}
    for i in range(1, n):
        p = page.parent[i]
        key = (p, page.tag[i])
        order[i] = counts.get((p, ""), 0)
        counts[(p, "")] = counts.get((p, ""), 0) + 1
        counts[key] = counts.get(key, 0) + 1
        largest[p] = max(largest[p], below[i, 0])
    out = np.zeros((n, FEATURES))
    hints, over, depth = np.array(page.hints), np.zeros(n, np.int64), np.zeros(n)
    kinds_over = np.zeros((n, 6))
    for i in range(1, n):
        p = page.parent[i]
        over[i] = over[p] | hints[p]
        depth[i] = depth[p] + 1
        kinds_over[i] = kinds_over[p]
        if 0 <= kind[p] < 6:
            kinds_over[i, kind[p]] = 1
        same[i] = counts[(p, page.tag[i])]
    k = len(KINDS)
    out[np.arange(n), np.where(np.array(kind) < 0, k, kind)] = 1
    bits = np.arange(len(TOKENS))
    out[:, k + 1 : k + 11] = (hints[:, None] >> bits) & 1
    out[:, k + 11 : k + 21] = (over[:, None] >> bits) & 1
    out[:, k + 21 : k + 27] = kinds_over
    parent = np.maximum(np.array(page.parent), 0)
    total = np.maximum(below[0, 0], 1)
    size = below[:, 0]
    out[:, k + 27 :] = np.stack(
        [
            depth,
            np.log1p(size),
            below[:, 1] / np.maximum(size, 1),
            size / below[:, 4],
            np.log1p(own[:, 0]),
            own[:, 1] / np.maximum(own[:, 0], 1),
            below[:, 3] / np.maximum(below[:, 2], 1),
            below[:, 2] / below[:, 4],
            below[:, 5],
            below[:, 6] / below[:, 4],
            children,
            order / np.maximum(children[parent], 1),
            same / np.maximum(children[parent], 1),
            size / np.maximum(largest[parent], 1),
            size / total,
            np.arange(n) / n,
        ],
        1,
    )
    return out


@dataclass
class Trees:
    """Boosted trees of fixed depth over binned features; leaves hold log-odds."""

    edges: list[np.ndarray]
    split: np.ndarray  # [trees, inner nodes] feature
    cut: np.ndarray  # [trees, inner nodes] bin: left if smaller or equal
    leaf: np.ndarray  # [trees, leaves]
    base: float

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(self.edges)], 1).astype(np.uint8)

    def odds(self, x: np.ndarray) -> np.ndarray:
        return self.of_bins(self.binned(x))

    def of_bins(self, bins: np.ndarray) -> np.ndarray:
        out = np.full(len(bins), self.base)
        rows = np.arange(len(bins))
        depth = int(math.log2(self.leaf.shape[1]))
        for split, cut, leaf in zip(self.split, self.cut, self.leaf, strict=True):
            at = np.zeros(len(bins), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (bins[rows, split[at]] > cut[at])
            out += leaf[at - (2**depth - 1)]
        return out


def boost(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.25) -> Trees:
    """Gradient boosting of the logistic loss; each level picks the best split by histograms."""
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0.02, 0.98, 31))) for j in range(x.shape[1])]
    rate_1 = np.clip(y.mean(), 0.01, 0.99)
    model = Trees(
        edges,
        np.zeros((trees, 2**depth - 1), np.int64),
        np.full((trees, 2**depth - 1), 255),
        np.zeros((trees, 2**depth)),
        float(np.log(rate_1 / (1 - rate_1))),
    )
    bins = model.binned(x)
    score = np.full(len(y), model.base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, p * (1 - p) + 1e-6
        at = np.zeros(len(y), np.int64)
        for level in range(depth):
            nodes, first = 2**level, 2**level - 1
            best = np.full(nodes, 1e-3)
            local = at - first
            for j in range(x.shape[1]):
                cell = local * 32 + bins[:, j]
                gs = np.bincount(cell, g, nodes * 32).reshape(nodes, 32).cumsum(1)
                hs = np.bincount(cell, h, nodes * 32).reshape(nodes, 32).cumsum(1)
                gt, ht = gs[:, -1:], hs[:, -1:]
                gain = gs**2 / (hs + 1) + (gt - gs) ** 2 / (ht - hs + 1) - gt**2 / (ht + 1)
                c = gain.argmax(1)
                top = gain[np.arange(nodes), c]
                better = top > best
                best[better] = top[better]
                model.split[t, first : first + nodes][better] = j
                model.cut[t, first : first + nodes][better] = c[better]
            at = 2 * at + 1 + (bins[np.arange(len(y)), model.split[t][at]] > model.cut[t][at])
        leaf = at - (2**depth - 1)
        gs, hs = np.bincount(leaf, g, 2**depth), np.bincount(leaf, h, 2**depth)
        model.leaf[t] = rate * gs / (hs + 1)
        score += model.leaf[t][leaf]
    return model


# --- training pages ------------------------------------------------------------------------


def _made_page(r: random.Random) -> str:
    """A page with ``data-gold`` 1 on blocks of main text and 0 on blocks of anything else."""

    def words(a: int, b: int) -> str:
        return " ".join("".join(r.choice("abcdeghilmnoprstuv") for _ in range(r.randint(2, 9))) for _ in range(r.randint(a, b)))

    def sentence() -> str:
        return words(4, 18).capitalize() + r.choice([".", ".", "!", "?", ","])

    def element(tag: str, body: str, cls: str = "", gold: int | None = None) -> str:
        mark = f' data-gold="{gold}"' if gold is not None else ""
        name = f' {r.choice(["class", "class", "id"])}="{cls}"' if cls else ""
        end = "" if tag in ("p", "li") and r.random() < 0.2 else f"</{tag}>"
        return f"<{tag}{name}{mark}>{body}{end}"

    def links(k: int) -> str:
        items = [f'<a href="/{words(1, 1)}">{words(1, 3)}</a>' for _ in range(k)]
        if r.random() < 0.7:
            return element(r.choice(["ul", "ol"]), "".join(element("li", i, "", 0) for i in items))
        return element("div", " | ".join(items), "", 0)

    def prose(gold: int, k: int) -> str:
        return "".join(element("p", " ".join(sentence() for _ in range(r.randint(1, 6))), "", gold) for _ in range(k))

    def named(kind: int) -> str:
        word = r.choice(TOKENS[kind])
        return r.choice([word, word, f"{word}-{words(1, 1)}", f"{words(1, 1)}_{word}", f"{word} {words(1, 1)}"])

    def junk(kind: int) -> str:
        tag = {2: "nav", 4: "aside", 6: "header", 7: "footer", 8: "form"}.get(kind, "div")
        tag = tag if r.random() < 0.6 else r.choice(["div", "section", "div"])
        named_tag = tag not in ("div", "section")
        cls = named(kind) if not named_tag or r.random() < 0.5 else ""
        body = {
            2: lambda: links(r.randint(3, 9)),
            3: lambda: element("h3", words(1, 3), "", 0)
            + "".join(element("div", element("p", sentence(), "", 0), r.choice(["comment", "reply", ""])) for _ in range(r.randint(1, 5))),
            4: lambda: element("h3", words(1, 3), "", 0) + r.choice([links(r.randint(3, 8)), prose(0, r.randint(1, 3))]),
            6: lambda: element("h1", words(1, 3), "", 0) + r.choice(["", links(4), prose(0, 1)]),
            7: lambda: r.choice(["&copy; ", ""]) + sentence() + r.choice(["", links(3), prose(0, 1)]),
            8: lambda: "<label>" + words(1, 2) + '</label><input name="q">' + element("button", words(1, 2), "", 0) + r.choice(["", prose(0, 1)]),
        }.get(kind, lambda: r.choice([sentence(), prose(0, r.randint(1, 2)), element("span", words(2, 9))]))()
        return element(tag, body, cls, 0)

    def main() -> str:
        parts = [element(r.choice(["h1", "h1", "h2"]), words(3, 10), "", 1)] if r.random() < 0.85 else []
        for _ in range(r.randint(1, 12)):
            x = r.random()
            if x < 0.75:
                text = " ".join(sentence() for _ in range(r.choice([1, 1, 2, 4, 8])))
                if r.random() < 0.2:
                    text = text.replace(" ", f' <a href="/x">{words(1, 2)}</a> ', 1)
                if r.random() < 0.1:
                    text = "<b>" + text + "<br>"
                parts.append(element("p", text, "", 1))
            elif x < 0.81:
                parts.append(element(r.choice(["h2", "h3"]), words(1, 6), "", 1))
            elif x < 0.87:
                parts.append(element("ul", "".join(element("li", sentence(), "", 1) for _ in range(r.randint(2, 6)))))
            elif x < 0.90:
                parts.append(element(r.choice(["blockquote", "pre", "div"]), sentence(), "", 1))
            elif x < 0.92:
                cells = "".join("<tr>" + "".join(element("td", words(1, 3), "", 1) for _ in range(3)) + "</tr>" for _ in range(3))
                parts.append(f"<table>{cells}</table>")
            else:
                parts.append(junk(r.choice([1, 1, 4, 5, 8])))
        body = "".join(parts)
        style = r.random()
        if style < 0.45:
            body = element("article", body, r.choice(["", "", named(0)]))
        elif style < 0.6:
            body = element("main", body)
        elif style < 0.9:
            body = element(r.choice(["div", "section", "td"]), body, named(0))
        else:
            body = element("div", body, words(1, 1))
        if r.random() < 0.15:
            body = body.replace("</article>", element("div", sentence(), "comments", 0) + "</article>", 1)
        return body

    before = [junk(k) for k in r.sample([1, 2, 5, 6, 8], r.randint(0, 4))]
    after = [junk(k) for k in r.sample([1, 2, 3, 4, 5, 7, 7, 8], r.randint(0, 5))]
    body = "".join([*before, main(), *after])
    for _ in range(r.randint(0, 2)):
        body = element("div", body, r.choice(["", "wrapper", "container", "page", "site"]))
    return f"<html><head><title>{words(2, 5)}</title></head><body>{body}</body></html>"


def _labels(page: Page) -> np.ndarray:
    """1 where a node holds main text: its own mark, the nearest marked ancestor's, or below."""
    n = len(page.parent)
    mark = list(page.gold)
    for i in range(1, n):
        if mark[i] < 0:
            mark[i] = mark[page.parent[i]] if mark[page.parent[i]] == 0 else -1
    y = [1 if m == 1 else 0 for m in mark]
    for i in range(n - 1, 0, -1):
        y[page.parent[i]] = max(y[page.parent[i]], y[i])
    return np.array(y, float)


@lru_cache(maxsize=1)
def trained(pages: int = 900, seed: int = 23) -> Trees:
    r = random.Random(seed)
    made = [read(_made_page(r), marked=True) for _ in range(pages)]
    x = np.concatenate([features(p)[1:] for p in made])
    y = np.concatenate([_labels(p)[1:] for p in made])
    return boost(x, y)


# --- decoding ------------------------------------------------------------------------------


def kept(page: Page, odds: np.ndarray) -> np.ndarray:
    """The most likely labels in which everything below a dropped node is dropped."""
    n = len(page.parent)
    odds = np.clip(odds, -6, 6)
    keep, drop = odds.astype(float), -odds.astype(float)
    gain = keep.copy()
    for i in range(n - 1, 0, -1):
        p = page.parent[i]
        gain[p] += max(gain[i], drop[i])
        drop[p] += drop[i]
    out = np.zeros(n, bool)
    out[0] = True
    for i in range(1, n):
        out[i] = out[page.parent[i]] and gain[i] > drop[i]
    return out


def joined(page: Page, keep: np.ndarray) -> str:
    """Kept text: white space within a block becomes one blank, blocks are joined by a blank line."""
    blocks: dict[int, list[str]] = {}
    for node, block, piece, _ in page.pieces:
        if keep[node]:
            blocks.setdefault(block, []).append(piece)
    texts = (" ".join("".join(parts).split()) for parts in blocks.values())
    return "\n\n".join(t for t in texts if t)


def extract_many(pages: list[str | None], trees: Trees) -> list[str]:
    read_pages = [read(p) if p else None for p in pages]
    rows = [features(p) if p else np.zeros((0, FEATURES)) for p in read_pages]
    odds = trees.odds(np.concatenate(rows)) if rows else np.zeros(0)
    out, at = [], 0
    for page, x in zip(read_pages, rows, strict=True):
        part, at = odds[at : at + len(x)], at + len(x)
        out.append(joined(page, kept(page, part)) if page else "")
    return out


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars for every row of ``pages(page_id, url, html)``.

    Null and empty html gives the empty text.  Broken markup is read as far as it goes.  Other
    columns are ignored; repeated rows get equal results; an empty table gives no rows.
    """
    trees = trained()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            texts = extract_many(batch.column("html").to_pylist(), trees)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars"],
            )

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(
        run, f"page_id {kind}, url string, text string, n_chars long"
    )
