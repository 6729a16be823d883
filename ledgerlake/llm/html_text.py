"""Main text of web pages by composite text density.

A page becomes a tree of its elements. What is no text of the article by its
element (scripts, menus, headers, footers, forms, ...) or by a word of its
class, id or role (adverts, notices, reader comments, ...) goes first. Each other
node gets its composite density: characters per tag, adjusted for the share of
characters and tags that belong to links,

    C/T * ln(C/LC * T/LT) / ln(ln(C/(C-LC) * LC + LCb/Cb * C + e))

(C, LC: characters, those in links; T, LT: tags, link tags; b: the body; zero
divisors and factors count as one). A node's density sum is that of its children, bare
text between elements counting as a child with one tag. The subtree with the
largest sum is the main text. If it lies in an ``article`` or ``main``
element, that whole element is. Otherwise the smallest density on the path from
it up to the body is the threshold: of every other node that reaches it, the
subtree with the largest sum is main text too, as are headings beside the path.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm.common import small_batches, without

# Fixed values of HTML: elements without content, blocks, and blocks that end an open paragraph.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset((
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section summary table tbody td tfoot th thead title tr ul").split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
IN_HEAD = frozenset("base bgsound link meta noscript script style template title".split())
# An element of the key ends the open elements of the value, up to the nearest of its bounds.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dd": (("dd", "dt"), ("dl",)), "dt": (("dd", "dt"), ("dl",)),
    "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "tr": (("tr",), ("table",)), "tbody": (("tbody", "thead", "tfoot"), ("table",)),
    "tfoot": (("tbody", "thead"), ("table",)), "option": (("option",), ("select", "datalist")),
}
# Elements whose content is no text of the article.
NO_TEXT = frozenset((
    "aside audio button canvas datalist dialog embed footer head iframe input label menu meter nav noscript "
    "object optgroup option output progress script search select style svg template textarea title video").split())
# Words of class, id and role that name such parts ...
PARTS = frozenset((
    "ad ads adbox adsense advert adverts advertisement advertising banner breadcrumb breadcrumbs complementary consent "
    "contentinfo cookie cookiebanner cookiebar cookies footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices notification pagination "
    "pager popup promo promoted recommended related search share sharing sidebar social sponsor sponsored subscribe "
    "subscription toolbar widget").split())
# ... and reader comments.
COMMENTS = frozenset("comment comments commentlist disqus replies respond".split())
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_UNSEEN = re.compile(r"(?:display\s*:\s*none|visibility\s*:\s*hidden)")


class Tree(HTMLParser):
    """Elements in page order: ``tag``, ``parent``, ``items`` (texts and child numbers) and ``sort`` of each."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.tag, self.parent, self.items, self.sort = [""], [-1], [[]], [""]
        self.open, self.count = [0], Counter()
        self.feed(html)
        self.close()

    def handle_starttag(self, tag, attrs):
        if tag in ("html", "body", "head") and tag in self.tag:
            return  # a second one adds nothing
        if tag not in IN_HEAD and self.tag[self.open[-1]] == "head":
            self._cut(len(self.open) - 1)
        if tag in BLOCKS:
            self._end(("p",), ("td", "th", "table", "caption", "button"))
        if tag in ENDS:
            self._end(*ENDS[tag])
        here = len(self.tag)
        self.items[self.open[-1]].append(here)
        self.tag.append(tag)
        self.parent.append(self.open[-1])
        self.items.append([])
        self.sort.append(self._sort(tag, attrs))
        if tag not in VOID:
            self.open.append(here)
            self.count[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)  # "/>" ends void elements only

    def handle_endtag(self, tag):
        if not self.count[tag] or tag in ("html", "body"):
            return  # what follows the end of the body still belongs to it
        for k in range(len(self.open) - 1, 0, -1):
            name = self.tag[self.open[k]]
            if name == tag:
                self._cut(k)
                return
            if tag not in BLOCKS and name in BLOCKS or name in ("td", "th") and tag not in (
                    "table", "tr", "tbody", "thead", "tfoot", "body", "html"):
                return  # an inline end tag closes no block; a cell holds its own

    def handle_data(self, data):
        self.items[self.open[-1]].append(data)

    def _cut(self, k):
        self.count.subtract(self.tag[x] for x in self.open[k:])
        del self.open[k:]

    def _end(self, tags, bounds):
        if not any(self.count[t] for t in tags):
            return
        for k in range(len(self.open) - 1, 0, -1):
            name = self.tag[self.open[k]]
            if name in tags:
                self._cut(k)
                return
            if name in bounds:
                return

    def _sort(self, tag, attrs):
        """"gone", "form", "comments", "part" or "" by element and attributes."""
        if tag in NO_TEXT:
            return "gone"
        if tag == "form":
            return "form"
        if tag == "header":
            return "" if self.count["article"] or self.count["main"] else "part"
        if tag in ("html", "body", "main") or tag in HEADINGS and not attrs:
            return ""
        words, roles = set(), set()
        for name, value in attrs:
            if name in ("class", "id"):
                words.update(w.lower() for w in _WORD.findall(value or ""))
            elif name == "role":
                roles.update((value or "").lower().split())
            elif name == "hidden" or name == "aria-hidden" and value == "true" or (
                    name == "style" and _UNSEEN.search((value or "").lower())):
                return "gone"
        if words & COMMENTS:
            return "comments"
        if tag in HEADINGS or tag == "article":
            return ""
        return "part" if (words | roles) & PARTS else ""


def _gone(tree: Tree) -> list[bool]:
    """Which elements are left out, with all they hold. A form, or what its class
    names a part, stays if it holds the article, a main element or a first heading."""
    n = len(tree.tag)
    holds, heads = [False] * n, [False] * n
    for k in range(n - 1, 0, -1):
        p = tree.parent[k]
        holds[p] |= holds[k] or tree.tag[k] in ("article", "main", "h1")
        heads[p] |= heads[k] or tree.tag[k] in ("main", "h1")
    out = [False] * n
    for k in range(1, n):
        kind = tree.sort[k]
        out[k] = out[tree.parent[k]] or kind == "gone" or kind == "comments" and not heads[k] or (
            kind in ("form", "part") and not holds[k])
    return out


def density(chars: int, links: int, tags: int, link_tags: int, body_ratio: float) -> float:
    """Composite density of a node, 0 without characters."""
    if chars == 0:
        return 0.0
    one = lambda x: max(x, 1)
    ratio = chars / one(links) * one(tags) / one(link_tags)
    base = math.log(chars / one(chars - links) * one(links) + body_ratio * chars + math.e)
    return chars / one(tags) * math.log(max(ratio, 1.0)) / math.log(base)


def _length(text: str) -> int:
    return sum(map(len, text.split()))


def select(tree: Tree) -> tuple[int, set[int], list[bool]]:
    """(top, kept, gone): the main text is what elements in ``kept`` hold below ``top``."""
    n = len(tree.tag)
    gone = _gone(tree)
    body = tree.tag.index("body") if "body" in tree.tag else 0
    chars, links, tags, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    bare: list[list[int]] = [[] for _ in range(n)]
    in_link = [False] * n
    for k in range(n):
        in_link[k] = k > 0 and (tree.tag[k] == "a" or in_link[tree.parent[k]])
        if not gone[k]:
            bare[k] = [c for c in (_length(x) for x in tree.items[k] if isinstance(x, str)) if c]
            chars[k] = sum(bare[k])
            links[k] = chars[k] if in_link[k] else 0
    for k in range(n - 1, 0, -1):
        if not gone[k]:
            p = tree.parent[k]
            chars[p] += chars[k]
            links[p] += links[k]
            tags[p] += tags[k] + 1
            link_tags[p] += link_tags[k] + (tree.tag[k] == "a")
    if chars[body] == 0:
        return body, set(), gone
    share = links[body] / chars[body]
    dense = [0.0 if gone[k] else density(chars[k], links[k], tags[k], link_tags[k], share) for k in range(n)]
    total = [0.0] * n
    for k in range(n - 1, -1, -1):
        if gone[k]:
            continue
        inner = [x for x in tree.items[k] if not isinstance(x, str) and not gone[x]]
        if inner:
            total[k] = sum(dense[x] for x in inner) + sum(
                density(c, c if in_link[k] else 0, 1, int(in_link[k]), share) for c in bare[k])
        else:
            total[k] = dense[k]
    best = list(range(n))  # the subtree with the largest sum in each node; on ties the outer, then the earlier one
    for k in range(n - 1, 0, -1):
        p = tree.parent[k]
        if not gone[k] and (total[best[k]] > total[best[p]] or total[best[k]] == total[best[p]] and best[p] != p):
            best[p] = best[k]
    top = best[body]
    if total[top] == 0:
        return body, {body}, gone
    path = [top]
    while path[-1] not in (body, 0):
        path.append(tree.parent[path[-1]])
    for name in ("article", "main"):
        for k in path:
            if tree.tag[k] == name:
                return k, {k}, gone
    threshold = min([dense[k] for k in path if k != body] or [0.0])
    kept, on_path, inside = {top}, set(path), [False] * n
    for k in range(1, n):
        inside[k] = k == top or inside[tree.parent[k]]
        if gone[k] or inside[k] or k in on_path:
            continue
        if tree.tag[k] in HEADINGS and tree.parent[k] in on_path:
            kept.add(k)
        elif dense[k] >= threshold and chars[k] and k > body:
            kept.add(best[k])
    return body, kept, gone


def blocks(tree: Tree) -> list[str]:
    """The main text's blocks in page order, white space turned into one space and trimmed."""
    top, kept, gone = select(tree)
    out: list[str] = []
    now: list[str] = []

    def flush():
        text = " ".join("".join(now).split())
        now.clear()
        if text:
            out.append(text)

    todo = [(top, 0, top in kept)]
    while todo:
        k, at, on = todo.pop()
        if at < len(tree.items[k]):
            todo.append((k, at + 1, on))
            item = tree.items[k][at]
            if isinstance(item, str):
                if on:
                    now.append(item)
            elif not gone[item]:
                if tree.tag[item] in BLOCKS:
                    flush()
                elif tree.tag[item] == "br":
                    now.append(" ")
                todo.append((item, 0, on or item in kept))
        elif tree.tag[k] in BLOCKS:
            flush()
    flush()
    return out


def main_text(html: str | None) -> str:
    """The main text of a page, blocks joined by an empty line; empty if there is none."""
    return "\n\n".join(blocks(Tree(html))) if html else ""


@F.pandas_udf(T.StringType())
def _main_text(html: pd.Series) -> pd.Series:
    return html.map(main_text, na_action=None)


def extract_pages(pages: DataFrame, html: str | Column = "html") -> DataFrame:
    """``pages`` with ``text`` (main text of ``html``, empty if there is none) and ``n_chars`` (its code points).

    Null and empty html have no text. Each row is read on its own and whole, so repeated rows
    give repeated results and no order matters. Columns ``text`` and ``n_chars`` of
    the input are replaced, others kept. A row of many megabytes is held by one task.
    """
    small_batches(pages.sparkSession, 128)
    source = F.col(html) if isinstance(html, str) else html
    kept = without(pages, "text", "n_chars")
    # The page goes through the step as it is; its text is made before the old column of that name goes.
    made = pages.select(*[F.col(f"`{c}`") for c in kept.columns], _main_text(source).alias("text"))
    return made.withColumn("n_chars", F.char_length("text").cast("long"))
