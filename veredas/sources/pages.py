"""Anchors and visible text of pages, as Arrow batches over the standard library's parser."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veredas.functions.url import canonical_url_py

HIDDEN = frozenset({"script", "style", "noscript", "template"})


class _Anchors(HTMLParser):
    """Links of a page with their text, and whether they are in the main part."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.links: list[tuple[str, str, bool]] = []
        self.text: list[str] = []
        self.hidden = self.main = 0
        self.has_main = False
        self.href: str | None = None
        self.words: list[str] = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.hidden += tag in HIDDEN
        if tag in ("main", "article"):
            self.main += 1
            self.has_main = True
        if tag == "a":
            self._end()
            self.href, self.words = dict(attrs).get("href"), []

    def handle_endtag(self, tag: str) -> None:
        self.hidden = max(0, self.hidden - (tag in HIDDEN))
        if tag in ("main", "article"):
            self.main = max(0, self.main - 1)
        if tag == "a":
            self._end()

    def handle_data(self, data: str) -> None:
        if not self.hidden and data.strip():
            self.text.append(data)
            if self.href is not None:
                self.words.append(data)

    def _end(self) -> None:
        if self.href is not None:
            self.links.append((self.href.strip(), " ".join(" ".join(self.words).split()), self.main > 0))
        self.href = None


def parse_page(body: str | None) -> _Anchors:
    parser = _Anchors()
    parser.feed(body or "")
    parser.close()
    parser._end()
    return parser


def anchors_of(body: str | None, base: str, least_text: int, skip: frozenset[str]) -> list[tuple[str, str]]:
    """(text, url) of a page's links to its own host, first of each canonical URL; those of its main part alone if it has one."""
    page, host, seen, found = parse_page(body), urlsplit(base or "").netloc.lower(), set(), []
    for href, text, inside in page.links:
        if page.has_main and not inside or not href or href.startswith("#"):
            continue
        try:
            url = urljoin(base or "", href)
            parts = urlsplit(url)
        except ValueError:
            continue
        if parts.scheme not in ("http", "https") or parts.netloc.lower() != host or len(text) < least_text or text.lower() in skip:
            continue
        key = canonical_url_py(url)
        if key not in seen:
            seen.add(key)
            found.append((text, url))
    return found


def page_anchors(pages: DataFrame, *, key: str, url: str = "url", body: str = "body", least_text: int = 10, skip: tuple[str, ...] = (), limit: int | None = None) -> DataFrame:
    """(key, anchor_no, text, url): one row per link of each page; ``limit`` is the reference's number of links for a page, where it is wanted."""
    stop = frozenset(s.lower() for s in skip)

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for k, base, text in zip(batch["key"], batch["base"], batch["body"]):
                rows += [(k, i, *a) for i, a in enumerate(anchors_of(text, base, least_text, stop)[:limit])]
            yield pd.DataFrame(rows, columns=["key", "anchor_no", "text", "url"])

    chosen = pages.select(F.col(key).cast("string").alias("key"), F.col(url).alias("base"), F.col(body).alias("body"))
    return chosen.mapInPandas(emit, "key string, anchor_no int, text string, url string")


def _text(bodies: pd.Series) -> pd.Series:
    return bodies.map(lambda b: b if not b or "<" not in b else " ".join(" ".join(parse_page(b).text).split()))


def strip_html(body: Column) -> Column:
    """Visible text of markup, white space collapsed; text without ``<`` stays as it is, null stays null."""
    return F.pandas_udf(_text, "string")(body)


def page_state(body: Column) -> Column:
    """``blocked`` if the first 2048 characters show a check for robots, ``shell`` for a short page with the mark of a script application
    anywhere, else ``page``."""
    whole = F.coalesce(body, F.lit(""))
    head = F.lower(F.left(whole, F.lit(2048)))
    blocked = head.rlike("captcha|access denied|attention required|are you a robot|request unsuccessful|visita no sea autom")
    return F.when(blocked, "blocked").when(F.lower(whole).contains("<app-root") & (F.length(body) < 20_000), "shell").otherwise("page")
