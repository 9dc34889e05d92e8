"""Main text of web pages by a tree-structured graphical model over the DOM.

Every block element and every run of text in one is a binary variable: content or not.  A node's
own evidence (tag, class and id words, length, links, punctuation) is its unary potential; a
parent-child potential, by the kind of parent, couples it with the node it lies in.  Sum-product
messages pass upward to the root and back down, which on a tree gives exact marginals, and the
text runs whose marginal reaches one half are the article.

Potentials are fitted by gradient ascent on the exact likelihood of labelled pages.
"""

from __future__ import annotations

import html
import math
import random
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.llm.common import table, text_batches

# Elements whose text is never page text, and inline elements, which do not break a block.
DROPPED = {"script", "style", "noscript", "template", "title", "textarea", "select", "option", "button", "svg", "annotation", "iframe", "canvas", "head"}
RAW = ("script", "style", "textarea", "title", "noscript", "iframe", "template", "svg")
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr "
             "math mi mn mo ms mtext mspace mrow mfrac msqrt mroot msub msup msubsup munder mover munderover mstyle semantics".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: An open element of the key is ended by the start of any of these.
ENDS = {"p": None, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}}
#: The same inside a dropped element, where end tags may be left out too.
ROWS = {"tbody", "thead", "tfoot"}
DROPPED_ENDS = {**ENDS, "tr": {"tr", *ROWS}, "td": {"td", "th", "tr", *ROWS}, "th": {"td", "th", "tr", *ROWS}, **dict.fromkeys(ROWS, ROWS), "caption": {"colgroup", "tr", *ROWS}, "colgroup": {"tr", *ROWS},
                "rt": {"rt", "rp"}, "rp": {"rt", "rp"}, "option": {"option", "optgroup"}, "optgroup": {"optgroup"}, "button": {"button"}}
#: What may lie in a head; any other start tag ends it.
IN_HEAD = {"html", "head", "base", "basefont", "bgsound", "link", "meta", "title", "script", "style", "noscript", "noframes", "template"}

TAG = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
MARKS = re.compile(r"\b(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
MAY_HIDE = re.compile(r"hidden|display", re.I)
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none", re.I)
LABEL = re.compile(r"\bdata-y=[\"']?([01])")
MARK = re.compile(r"[a-z]+")
SPACE = re.compile(r"\s+")

KINDS = ("article", "nav", "header", "footer", "aside", "form", "list", "item", "table", "cell", "paragraph", "heading", "quote", "figure", "section", "div", "body", "other", "text")
KIND = {"article": "article", "main": "article", "nav": "nav", "menu": "nav", "header": "header", "footer": "footer", "address": "footer", "aside": "aside", "form": "form", "fieldset": "form", "dialog": "aside",
        "ul": "list", "ol": "list", "dl": "list", "li": "item", "dt": "item", "dd": "item", "table": "table", "tbody": "table", "thead": "table", "tr": "table", "td": "cell", "th": "cell", "p": "paragraph",
        **{f"h{i}": "heading" for i in range(1, 7)}, "blockquote": "quote", "pre": "quote", "figure": "figure", "figcaption": "figure", "section": "section", "details": "section", "div": "div", "center": "div", "body": "body", "html": "body"}
# Words of class, id and role attributes, by what they speak for.
GROUPS = {
    "content": "content article post entry story body main text prose markdown",
    "ad": "ad ads advert advertisement advertising sponsor sponsored promo promotion banner dfp",
    "nav": "nav navigation navbar menu breadcrumb breadcrumbs pagination pager toc tabs links sitemap skip",
    "side": "sidebar aside rail widget related recommended recommendations popular trending more teaser",
    "comment": "comment comments reply replies discussion disqus respond feedback review reviews",
    "notice": "notice cookie cookies consent gdpr alert popup modal overlay message warning toast paywall newsletter subscribe subscription signup",
    "frame": "header masthead topbar footer bottom copyright legal colophon site logo brand",
    "share": "share sharing social follow like meta byline tags author rating",
    "form": "form search login register input",
}
GROUP_OF = {w: g for g, words in GROUPS.items() for w in words.split()}
FEATURES = [*(f"tag:{k}" for k in KINDS), *(f"mark:{g}" for g in GROUPS), "short", "medium", "long", "linked", "half linked", "sentence", "no sentence", "sentences", "copyright"]
INDEX = {f: i for i, f in enumerate(FEATURES)}
COUPLINGS = len(KINDS)  # a parent-child potential for each kind of parent


class Page:
    """The tree of a page: parents before children; text runs are leaves."""

    __slots__ = ("parent", "kind", "features", "runs", "label")

    def __init__(self, source: str, labelled: bool = False):
        """``labelled``: a training page, whose elements carry their labels in ``data-y``."""
        self.parent, self.kind, self.features = [-1], [KINDS.index("body")], [(INDEX["tag:body"],)]
        self.runs: dict[int, str] = {}   # text of each leaf, in page order
        self.label: list[int | None] = [None]
        self._read(source, labelled)

    def _node(self, parent: int, kind: str, features: tuple, label: int | None) -> int:
        self.parent.append(parent)
        self.kind.append(KINDS.index(kind))
        self.features.append(features)
        self.label.append(label)
        return len(self.parent) - 1

    def _read(self, source: str, labelled: bool) -> None:
        stack: list[tuple[str, int]] = [("html", 0)]  # open block elements
        held: list[str] = []                          # text of the run being read
        linked, in_link = 0, 0
        dropped: list[str] = []                       # a dropped element and the open elements in it
        at, size, search = 0, len(source), TAG.search

        def flush() -> None:
            nonlocal linked
            if held:
                text = SPACE.sub(" ", html.unescape("".join(held))).strip()
                held.clear()
                if text:
                    top = stack[-1][1]
                    self.runs[self._node(top, "text", _evidence(text, linked), self.label[top])] = text
            linked = 0

        while at < size:
            m = search(source, at)
            end = m.start() if m else size
            if dropped == ["head"] and end > at and source[at:end].strip():
                dropped.clear()  # text ends a head
            if end > at and not dropped:
                held.append(source[at:end])
                linked += in_link and end - at
            if not m:
                break
            at = m.end()
            name = m.group(2)
            if name is None:
                continue
            name, closing = name.lower(), m.group(1)
            if dropped and not closing:
                if dropped[-1] == "head":
                    if name not in IN_HEAD:
                        dropped.clear()
                elif name not in INLINE and name not in VOID:
                    while dropped and dropped[-1] in DROPPED_ENDS and _ends(dropped[-1], name):
                        dropped.pop()
            if name == "br" or name == "hr":
                held.append(" ")
            elif name == "a":
                in_link = 0 if closing else 1
            elif closing:
                if name in dropped:
                    while dropped.pop() != name:
                        pass
                elif name not in INLINE and any(t == name for t, _ in stack[1:]):
                    dropped.clear()  # it lay in the element that ends
                    flush()
                    in_link = 0
                    while stack.pop()[0] != name:
                        pass
            elif name in VOID or name in INLINE:
                continue
            elif name in DROPPED:
                if name == "svg" and m.group(3).rstrip().endswith("/"):
                    continue
                if name in RAW:  # its content is no markup
                    stop = re.compile(f"</{name}[\\s/>]", re.I).search(source, at)
                    at = size if stop is None else (source.find(">", stop.start()) + 1 or size)
                elif name == "select" and name in dropped:  # a second one ends the first
                    while dropped.pop() != name:
                        pass
                elif not m.group(3).rstrip().endswith("/"):
                    dropped.append(name)
            elif name == "body":
                if labelled and (y := LABEL.search(m.group(3))):
                    self.label[0] = int(y.group(1))
            elif not dropped and name != "html":
                flush()
                in_link = 0
                while len(stack) > 1 and stack[-1][0] in ENDS and (ENDS[stack[-1][0]] is None or name in ENDS[stack[-1][0]]):
                    stack.pop()
                attributes = m.group(3)
                if MAY_HIDE.search(attributes) and _hidden(attributes):
                    if not attributes.rstrip().endswith("/"):
                        dropped.append(name)
                    continue
                kind, top = KIND.get(name, "other"), stack[-1][1]
                marks = {GROUP_OF[w] for v in MARKS.findall(attributes) for w in MARK.findall(v.lower()) if w in GROUP_OF} if "=" in attributes else ()
                y = LABEL.search(attributes) if labelled else None
                label = int(y.group(1)) if y else self.label[top]
                stack.append((name, self._node(top, kind, (INDEX[f"tag:{kind}"], *(INDEX[f"mark:{g}"] for g in marks)), label)))
            elif dropped and name != "html" and not m.group(3).rstrip().endswith("/"):
                dropped.append(name)
        flush()


def _hidden(attributes: str) -> bool:
    """Whether an element is hidden by its attributes: the words inside other attributes' values do not count."""
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name == "hidden" or name == "aria-hidden" and value.strip().lower() == "true" or name == "style" and NO_DISPLAY.search(value):
            return True
    return False


def _ends(opened: str, name: str) -> bool:
    """Whether the start tag ``name`` ends an open element of a dropped part."""
    if DROPPED_ENDS[opened] is None:
        return name not in DROPPED
    return name in DROPPED_ENDS[opened]


def _evidence(text: str, linked: int) -> tuple:
    n, found = len(text), [INDEX["tag:text"]]
    found.append(INDEX["short" if n < 40 else "medium" if n < 160 else "long"])
    share = linked / n
    if share > 0.4:
        found.append(INDEX["linked" if share > 0.8 else "half linked"])
    ends = sum(text.count(c) for c in ".!?…。")
    found.append(INDEX["sentence" if ends else "no sentence"])
    if ends > 2:
        found.append(INDEX["sentences"])
    if "©" in text or "(c) " in text.lower():
        found.append(INDEX["copyright"])
    return tuple(found)


def marginals(page: Page, unary: list[float], coupling: list[float]) -> tuple[list[float], list[float]]:
    """Probability of content of every node, and the expected product of spins (+1, -1) on every edge to its parent."""
    n, parent, kind = len(page.parent), page.parent, page.kind
    up = [sum(unary[i] for i in f) for f in page.features]  # log odds of a node and all below it
    message = [0.0] * n
    tie = [math.tanh(j) for j in coupling]
    for i in range(n - 1, 0, -1):
        p = parent[i]
        m = message[i] = 2 * math.atanh(max(-1 + 1e-12, min(1 - 1e-12, tie[kind[p]] * math.tanh(0.5 * up[i]))))
        up[p] += m
    total, pair = [0.0] * n, [0.0] * n
    total[0] = up[0]
    for i in range(1, n):
        p = parent[i]
        rest, j = total[p] - message[i], coupling[kind[p]]  # what the parent holds without this node
        total[i] = up[i] + 2 * math.atanh(max(-1 + 1e-12, min(1 - 1e-12, tie[kind[p]] * math.tanh(0.5 * rest))))
        d = _lncosh(0.5 * (rest + up[i])) - _lncosh(0.5 * (rest - up[i])) + 2 * j
        pair[i] = math.tanh(0.5 * d)
    return [1 / (1 + math.exp(-max(-40.0, min(40.0, t)))) for t in total], pair


def _lncosh(x: float) -> float:
    x = abs(x)
    return x + math.log1p(math.exp(-2 * x))


def fit(pages: list[Page], rounds: int = 120, ridge: float = 0.02) -> tuple[list[float], list[float]]:
    """Unary weights and couplings that maximise the likelihood of the labels, by adaptive gradient ascent."""
    w, j = np.zeros(len(FEATURES)), np.full(COUPLINGS, 0.3)
    sums = np.full(len(w) + len(j), 1e-8)
    for _ in range(rounds):
        gw, gj = -ridge * w, -ridge * j
        for page in pages:
            p, pair = marginals(page, w.tolist(), j.tolist())
            for i, f in enumerate(page.features):
                y = page.label[i] or 0
                gw[list(f)] += y - p[i]
                if i:
                    same = 1 if (page.label[page.parent[i]] or 0) == y else -1
                    gj[page.kind[page.parent[i]]] += same - pair[i]
        g = np.concatenate([gw, gj])
        sums += g * g
        step = 0.4 * g / np.sqrt(sums)
        w, j = w + step[: len(w)], np.clip(j + step[len(w) :], 0.0, 4.0)
    return w.tolist(), j.tolist()


def labelled_pages(count: int = 120, seed: int = 7) -> list[str]:
    """Pages in many layouts whose elements carry their label as ``data-y``; the words are arbitrary."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghilmnoprstu") for _ in range(r.randint(2, 9)))
    phrase = lambda a, b: " ".join(word() for _ in range(r.randint(a, b)))
    prose = lambda a, b: " ".join(phrase(4, 16).capitalize() + r.choice(".....!?") for _ in range(r.randint(a, b)))
    links = lambda n: "".join(f"<li><a href='/{word()}'>{phrase(1, 3)}</a></li>" for _ in range(n))
    named = lambda group: f'class="{r.choice(GROUPS[group].split())}-{word()}"' if r.random() < 0.7 else f'id="{r.choice(GROUPS[group].split())}"'

    def content() -> str:
        parts = []
        if r.random() < 0.25:  # a very short article
            return f"<h1>{phrase(1, 6).capitalize()}.</h1>" * r.randint(0, 1) + r.choice([f"<p>{phrase(1, 6).capitalize()}.</p>", f"<p><b>{phrase(1, 6).capitalize()}.<br>", f"<p>{phrase(1, 4)}</p><p>{prose(1, 1)}</p>"])
        for _ in range(r.randint(1, 7)):
            parts.append(r.choice([f"<p>{prose(1, 6)}</p>"] * 6 + [f"<p><b>{prose(1, 3)}<br><p>{prose(1, 4)}</p>", f"<h2>{phrase(2, 6)}</h2><p>{prose(1, 4)}</p>", f"<blockquote>{prose(1, 2)}</blockquote>", f"<p>{phrase(1, 5)}</p>",
                                   f"<ul><li>{phrase(2, 9)}<li>{prose(1, 1)}</ul>", f"<p>{prose(1, 2)} <a href='/x'>{phrase(1, 4)}</a> {prose(1, 1)}", f"<table><tr><td>{phrase(1, 3)}<td>{phrase(1, 3)}</table>", f"<figure><img src=x><figcaption>{phrase(3, 8)}</figcaption></figure>", f"<pre>{phrase(3, 9)}</pre>",
                                   f"<div>{prose(1, 4)}</div>", f"<section><h3>{phrase(1, 5)}</h3><p>{prose(1, 4)}</p></section>"]))
        return f"<h1>{phrase(2, 9)}</h1>" * (r.random() < 0.8) + "".join(parts)

    def junk(group: str, tag: str, inside: str) -> str:
        tag_ = tag if r.random() < 0.6 else "div"
        marks = named(group) if tag_ == "div" or r.random() < 0.5 else ""
        return f"<{tag_} {marks} data-y=0>{inside}</{tag_}>"

    made = []
    for _ in range(count):
        before = [junk("nav", "nav", f"<ul>{links(r.randint(2, 7))}</ul>"), junk("frame", "header", f"<p>{phrase(1, 4)}</p>"), junk("ad", "div", prose(1, 2)), junk("notice", "div", f"<p>{prose(1, 2)}</p>"), junk("form", "form", f"<p>{phrase(1, 4)} <input name=q>")]
        after = [junk("frame", "footer", f"&copy; {word()}.example &middot; {prose(1, 2)}"), junk("side", "aside", f"<h3>{phrase(1, 3)}</h3><ul>{links(4)}</ul>"), junk("comment", "section", "".join(f"<div class='comment'><p>{prose(1, 3)}</p></div>" for _ in range(r.randint(1, 4)))),
                 junk("share", "div", links(3)), junk("ad", "aside", f"<p>{prose(1, 2)}</p>"), junk("side", "aside", f"<p>{prose(1, 2)}</p>"), junk("comment", "ul", "".join(f"<li><b>{word()}</b> {prose(1, 2)}</li>" for _ in range(3)))]
        top, bottom = (r.sample(v, r.randint(0, 4)) for v in (before, after))
        inner = content()
        if r.random() < 0.35:  # something foreign inside the article
            inner += junk(*r.choice([("share", "div", links(3)), ("ad", "div", prose(1, 1)), ("comment", "section", f"<p>{prose(1, 2)}</p>"), ("side", "aside", f"<ul>{links(3)}</ul>"), ("nav", "nav", f"<ul>{links(3)}</ul>")]))
        article = r.choice([f"<article data-y=1>{inner}</article>"] * 3 + [f"<main data-y=1>{inner}</main>", f"<div {named('content')} data-y=1>{inner}</div>", f"<main><article data-y=1>{inner}</article></main>", f"<div data-y=1>{inner}</div>", f"<div id=page><div {named('content')} data-y=1>{inner}</div></div>"])
        if r.random() < 0.12:  # nothing around the article
            made.append(f"<html><body data-y=1>{''.join(top)}{r.choice([inner, prose(1, 5)])}{''.join(bottom)}")
            continue
        made.append(f"<html><head><title>{phrase(2, 5)}</title></head><body>{''.join(top)}{article}{''.join(bottom)}</body></html>")
    return made


@cache
def model() -> tuple[list[float], list[float]]:
    return fit([Page(s, labelled=True) for s in labelled_pages()])


def blocks(source: str | None, unary: list[float], coupling: list[float], least: float = 0.5) -> list[str]:
    """The content blocks of a page in page order; none for null or empty html."""
    page = Page(source or "")
    if not page.runs:
        return []
    p, _ = marginals(page, unary, coupling)
    return [text for i, text in page.runs.items() if p[i] >= least]


def extracted(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages``; other columns are ignored.

    Null, empty and text-free pages have the empty text.  Rows are independent, so repeated rows
    and null ids or urls need nothing special.
    """
    unary, coupling = model()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            text = [" ".join(blocks(h, unary, coupling)) for h in b["html"]]
            yield pd.DataFrame({"page_id": b["page_id"].astype("Int64"), "url": b["url"], "text": text, "n_chars": [len(t) for t in text]})

    text_batches(pages.sparkSession)
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return pages.mapInPandas(run, "page_id long, url string, text string, n_chars long")


def query(spark, sf_dir: str) -> DataFrame:
    """op3: main text of every page."""
    return extracted(table(spark, sf_dir, "pages"))
