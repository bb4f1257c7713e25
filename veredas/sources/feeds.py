"""Entries of feeds, also of ones that are not well formed."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructType

#: What a feed is made of: sections of plain characters, comments, and tags with a name and attributes.
TOKEN = re.compile(r"<!\[CDATA\[(?P<plain>.*?)(?:\]\]>|\Z)|<!--.*?(?:-->|\Z)|<(?P<close>/?)(?P<name>[\w:.-]+)(?P<rest>[^>]*)>|<[!?][^>]*>", re.S)
HREF = re.compile(r"""\bhref\s*=\s*(?:"([^"]*)"|'([^']*)')""", re.I)
# The elements that hold an entry, and those that hold each of its fields, the first one that has text winning.
ENTRIES = ("item", "entry")
FIELDS = {
    "url": ("link", "guid"),
    "title": ("title",),
    "summary": ("description", "summary", "content"),
    "published": ("pubdate", "published", "updated", "dc:date"),
}
WANTED = {name for names in FIELDS.values() for name in names}


def entries_of(body: str | None) -> list[dict[str, str | None]]:
    """The whole entries of a feed in their order, each with its fields; a field without text is None.

    One pass over the feed's tokens: between an entry's tags the characters go to the outermost wanted element that is open. An entry
    that isn't closed before the next one opens, or at all, is dropped.
    """
    found: list[dict[str, str | None]] = []
    texts: dict[str, list[str]] | None = None
    field = kind = None
    link, at = "", 0
    for token in TOKEN.finditer(body or ""):
        if texts is not None and field:
            texts.setdefault(field, []).append(html.unescape(body[at : token.start()]))
        at = token.end()
        name = (token["name"] or "").lower()
        if token["plain"] is not None:
            if texts is not None and field:
                texts.setdefault(field, []).append(token["plain"])
        elif name in ENTRIES and not token["close"]:
            texts, field, kind, link = {}, None, name, ""
        elif texts is None or not name:
            continue
        elif name == kind:
            shown = {k: " ".join("".join(v).split()) for k, v in texts.items()}
            entry = {key: next((shown[n] for n in names if shown.get(n)), None) for key, names in FIELDS.items()}
            entry["url"] = link or entry["url"] or None
            found.append(entry)
            texts = field = None
        elif token["close"]:
            field = None if name == field else field
            if field:
                texts[field].append(" ")
        else:
            if name == "link" and not link and (href := HREF.search(token["rest"])):
                link = html.unescape(href[1] or href[2] or "").strip()
            if field is None and name in WANTED and not token["rest"].endswith("/"):
                field = name
            elif field:
                texts.setdefault(field, []).append(" ")
    return found


def feed_entries(pages: DataFrame, *, body: str = "body") -> DataFrame:
    """One row per entry: the page's columns but the body, then entry_no, url, title, summary and published as text.

    A broken feed gives those entries that are whole. An entry without link is dropped; a null or empty body gives none. Entries stay
    in the page's order, numbered from 0, also those without link; a title or summary without text is empty, a date without text null.
    """
    kept = [c for c in pages.columns if c != body]
    schema = StructType(pages.select(*kept).schema.fields)
    for name, kind in (("entry_no", IntegerType()), ("url", StringType()), ("title", StringType()), ("summary", StringType()), ("published", StringType())):
        schema = schema.add(name, kind)

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            every = [entries_of(b) for b in batch["_body"]]
            rows = batch[kept].loc[batch.index.repeat([sum(e["url"] is not None for e in x) for x in every])].reset_index(drop=True)
            flat = [(i, e["url"], e["title"] or "", e["summary"] or "", e["published"]) for x in every for i, e in enumerate(x) if e["url"]]
            yield pd.concat([rows, pd.DataFrame(flat, columns=["entry_no", "url", "title", "summary", "published"])], axis=1)

    return pages.select(*kept, F.col(body).alias("_body")).mapInPandas(emit, schema)
