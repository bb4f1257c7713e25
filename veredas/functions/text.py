"""Text functions as Column expressions, with Python twins for use inside Arrow batches."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = re.compile(r"[^\W_]+")


@lru_cache(maxsize=1)
def accent_table() -> tuple[str, str]:
    """(from, to) for ``translate``: every lower-case letter below U+2000 whose decomposition is one letter and marks."""
    source, target = [], []
    for code in range(0xC0, 0x2000):
        char = chr(code)
        if char != char.lower():
            continue
        bare = "".join(c for c in unicodedata.normalize("NFD", char) if not unicodedata.combining(c))
        if len(bare) == 1 and bare != char:
            source.append(char)
            target.append(bare)
    return "".join(source), "".join(target)


def fold(text: Column) -> Column:
    """Lower case without accents."""
    return F.regexp_replace(F.translate(F.lower(text), *accent_table()), r"\p{Mn}+", "")


def words(text: Column) -> Column:
    """Maximal runs of letters or digits, lower-cased, accents removed, in order; null gives an empty array."""
    return F.regexp_extract_all(fold(F.coalesce(text, F.lit(""))), F.lit(r"([\p{L}\p{Nd}]+)"), 1)


NON_ASCII = re.compile(r"[^\x00-\x7f]+")


@lru_cache(maxsize=100_000)
def _fold_run(run: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", run) if unicodedata.category(c) != "Mn")


def fold_py(text: str) -> str:
    """Python twin of :func:`fold`; only the characters beyond ASCII are looked at one by one."""
    text = text.lower()
    return text if text.isascii() else NON_ASCII.sub(lambda m: _fold_run(m.group()), text)


def words_py(text: str | None) -> list[str]:
    """Python twin of :func:`words`."""
    return WORD.findall(fold_py(text)) if text else []


def collapse_spaces(text: Column) -> Column:
    """Runs of white space as one space, ends trimmed."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))
