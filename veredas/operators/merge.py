"""Folding several rows or passes into one row for each key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_known(rows: DataFrame, key: str, fields: list[str], order: list[Column]) -> DataFrame:
    """(key, fields, rows): of each field the non-null value of the last row that has one; null if none has. Partial aggregates only."""
    at = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])
    known = [F.max(F.when(F.col(f).isNotNull(), F.struct(at.alias("at"), F.col(f).alias("v")))).alias(f) for f in fields]
    merged = rows.groupBy(key).agg(*known, F.count("*").alias("rows"))
    return merged.select(key, *[F.col(f"{f}.v").alias(f) for f in fields], "rows")


def priority_union(passes: list[DataFrame], key: str) -> DataFrame:
    """(key, pass): each key once, with the first pass that has it, from 1."""
    marked = [p.select(key).withColumn("pass", F.lit(i)) for i, p in enumerate(passes, 1)]
    return reduce(DataFrame.unionByName, marked).groupBy(key).agg(F.min("pass").alias("pass"))
