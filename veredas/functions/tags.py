"""Dictionary tags: aliases as bounded patterns over folded text."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def alias_pattern(aliases: list[str]) -> str:
    """Any alias, its words parted by anything but letters and digits, and not inside another word."""
    forms = [r"[^a-z0-9]+".join(re.escape(w) for w in alias.split()) for alias in aliases]
    return rf"(?<![a-z0-9])(?:{'|'.join(forms)})(?![a-z0-9])"


def tag_column(folded: Column, dictionary: dict[str, list[str]]) -> Column:
    """Sorted array of the tags that have an alias in the text."""
    found = [F.when(folded.rlike(alias_pattern(aliases)), tag) for tag, aliases in sorted(dictionary.items())]
    return F.filter(F.array(*found), lambda t: t.isNotNull())
