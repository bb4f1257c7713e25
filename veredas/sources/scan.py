"""Scanning many sources at once: each by the reader of its method, and what could not be read as a table beside the items."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The states of a source that keep it from being scanned.
SKIPPED = ["blocked", "deferred", "needs_parser"]


def register(sources: DataFrame) -> DataFrame:
    """``sources`` with ``state``: invalid (no id, no name, or a URL that isn't one), disabled, skipped (no way to read it yet) or registered.

    Nulls count as missing; a null ``enabled`` is false; a null onboarding status is a working one.
    """
    present = F.coalesce(F.length(F.trim("id")) > 0, F.lit(False)) & F.coalesce(F.length(F.trim("name")) > 0, F.lit(False))
    valid = present & F.coalesce(F.lower("url").rlike("^https?://[^/]"), F.lit(False))
    return sources.withColumn(
        "state",
        F.when(~valid, "invalid")
        .when(~F.coalesce("enabled", F.lit(False)), "disabled")
        .when(F.coalesce("onboarding_status", F.lit("working")).isin(SKIPPED), "skipped")
        .otherwise("registered"),
    )


def scan(registered: DataFrame, readers: dict[str, Callable[[DataFrame], DataFrame]], columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """(items, failures) of the registered sources.

    Each reader gets the sources of its fetch method and returns items with a source_id and ``columns``; the methods are one plan, so
    Spark reads them side by side. ``failures`` is (source_id, reason): no_reader for a method without one, no_items for a source whose
    reader gave nothing. A source has items or one failure.
    """
    chosen = registered.where("state = 'registered'")
    items = None
    for method, reader in sorted(readers.items()):
        own = reader(chosen.where(F.col("fetch_method") == method)).select("source_id", *columns)
        items = own if items is None else items.unionByName(own)
    names = chosen.select(F.col("id").alias("source_id"), "fetch_method")
    unread = names.where(~F.coalesce(F.col("fetch_method").isin(*readers), F.lit(False))).select("source_id", F.lit("no_reader").alias("reason"))
    silent = names.where(F.col("fetch_method").isin(*readers)).join(items.select("source_id").distinct(), "source_id", "left_anti")
    return items, unread.unionByName(silent.select("source_id", F.lit("no_items").alias("reason")))
