"""Selectors over the element tree, as Arrow-batched helpers on the stdlib parser.

Supported selectors: ``tag``, ``.class``, ``[attr*="text"]``, a tag with such an
attribute test, one ancestor before any of these, and comma-separated unions.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Elements without content.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
SIMPLE = re.compile(r'^([a-zA-Z0-9]*)(?:\.([\w-]+)|\[([\w-]+)\*="([^"]*)"\])?$')


def _simple(text: str):
    match = SIMPLE.match(text)
    if not match or not text:
        raise ValueError(f"unsupported selector: {text}")
    return match.groups()


def _parse(selector: str):
    """A union of paths, each a list of one or two simple tests."""
    return [[_simple(s) for s in path.split()] for path in selector.split(",")]


def _fits(test, tag: str, attrs: dict) -> bool:
    name, cls, attr, part = test
    return (
        (not name or name == tag)
        and (not cls or cls in (attrs.get("class") or "").split())
        and (not attr or part in (attrs.get(attr) or ""))
    )


class _Collector(HTMLParser):
    """Texts of the elements that a predicate on (element, open elements) picks."""

    def __init__(self, pick, wanted=None):
        super().__init__(convert_charrefs=True)
        self.pick, self.wanted = pick, wanted
        self.open, self.found = [], []

    def handle_starttag(self, tag, attrs):
        attrs = dict(reversed(attrs))
        parents = [(t, a) for t, a, _ in self.open]
        hits = []
        for key in self.pick(tag, attrs, parents):
            hits.append(len(self.found))
            self.found.append((key, attrs, []))
        if tag not in VOID:
            self.open.append((tag, attrs, hits))

    handle_startendtag = handle_starttag

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                return

    def handle_data(self, data):
        if self.open and self.open[-1][0] in ("script", "style", "template"):
            return
        for _, _, hits in self.open:
            for hit in hits:
                self.found[hit][2].append(data)


def _joined(pieces: list[str], sep: str) -> str:
    return sep.join(p for p in (x.strip() for x in pieces) if p)


def _run(html: str | None, pick) -> list:
    parser = _Collector(pick)
    parser.feed(html or "")
    parser.close()
    return parser.found


def select_texts(c: Column, selectors: Sequence[str], sep: str = "") -> Column:
    """Text of the first match of every selector, null where nothing matches."""
    unions = [_parse(s) for s in selectors]

    @F.pandas_udf("array<string>")
    def texts(pages: pd.Series) -> pd.Series:
        def one(html):
            seen: set[int] = set()

            def pick(tag, attrs, parents):
                new = [
                    i for i, union in enumerate(unions)
                    if i not in seen and _matches(union, tag, attrs, parents)
                ]
                seen.update(new)
                return new

            out: list = [None] * len(unions)
            for key, _, pieces in _run(html, pick):
                out[key] = _joined(pieces, sep)
            return out

        return pages.map(one)

    return texts(c)


def _matches(union, tag, attrs, parents) -> bool:
    return any(
        _fits(path[-1], tag, attrs)
        and (len(path) == 1 or any(_fits(path[0], t, a) for t, a in parents))
        for path in union
    )


def nested_texts(c: Column, class_part: str, tags: Sequence[str], sep: str = "") -> Column:
    """Texts of the ``tags`` inside any ``div`` whose class names contain ``class_part``."""
    names, part = set(tags), class_part.lower()

    @F.pandas_udf("array<string>")
    def texts(pages: pd.Series) -> pd.Series:
        def inside(parents):
            return any(t == "div" and part in (a.get("class") or "").lower() for t, a in parents)

        def one(html):
            found = _run(html, lambda t, a, up: [0] if t in names and inside(up) else [])
            return [_joined(pieces, sep) for _, _, pieces in found]

        return pages.map(one)

    return texts(c)


def select_links(c: Column, selectors: Sequence[str], container: str | None = None) -> Column:
    """Links matched by any selector: array of (sel, pos, href, title, text)."""
    unions = [_parse(s) for s in selectors]
    box = _simple(container) if container else None

    @F.pandas_udf("array<struct<sel:int,pos:int,href:string,title:string,text:string>>")
    def links(pages: pd.Series) -> pd.Series:
        def one(html):
            def pick(tag, attrs, parents):
                if tag != "a" or (box and not any(_fits(box, t, a) for t, a in parents)):
                    return []
                return [i for i, u in enumerate(unions) if _matches(u, tag, attrs, parents)]

            return [
                {
                    "sel": sel, "pos": pos, "href": attrs.get("href"),
                    "title": attrs.get("title") or "", "text": _joined(pieces, ""),
                }
                for pos, (sel, attrs, pieces) in enumerate(_run(html, pick))
                if attrs.get("href")
            ]

        return pages.map(one)

    return links(c)


def select_first(c: Column, selectors: Sequence[str], longer_than: int = -1, sep: str = "") -> Column:
    """First selector's text above the length gate, in selector order; null when none is."""
    texts = select_texts(c, selectors, sep)
    fit = F.filter(texts, lambda x: F.length(x) > longer_than)
    return F.try_element_at(fit, F.lit(1))
