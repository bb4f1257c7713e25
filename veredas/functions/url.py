"""Canonical form of URLs."""

from __future__ import annotations

from urllib.parse import parse_qsl, urlencode, urlsplit

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Query parameters that only track visits.
TRACKING_KEYS = ["fbclid", "gclid", "mc_cid", "mc_eid", "ref", "ref_src"]
TRACKING_PREFIX = "utm_"


def is_tracking(name: str) -> bool:
    name = name.lower()
    return name.startswith(TRACKING_PREFIX) or name in TRACKING_KEYS


def canonical_url_py(url: str | None) -> str | None:
    """Scheme and host in lower case, no fragment, no tracking or blank parameters, the others sorted, no slash at the end of a path.

    Null stays null; an empty or blank URL, and one that can't be split, is None: it names nothing.
    """
    if url is None or not url.strip():
        return None
    try:
        parts = urlsplit(url.strip())
        pairs = sorted(p for p in parse_qsl(parts.query) if not is_tracking(p[0]))
    except ValueError:
        return None
    path = parts.path.rstrip("/") if len(parts.path) > 1 else parts.path
    if not path and not (len(parts.path) > 1):
        path = "/"
    query = f"?{urlencode(pairs)}" if pairs else ""
    return f"{parts.scheme.lower() or 'https'}://{parts.netloc.lower()}{path}{query}"


def _canonical(urls: pd.Series) -> pd.Series:
    known = {url: canonical_url_py(url) for url in urls.unique()}
    return urls.map(known)


def canonical_url(url: Column) -> Column:
    """Column form of :func:`canonical_url_py`, in Arrow batches: exact quoting of parameters has no built-in."""
    return F.pandas_udf(_canonical, "string")(url)
