"""Joins on sets: exact Jaccard self-join of short texts, groups by shared tags, key-explode links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veredas.operators.set_join import overlap_holds, similar_sets
from veredas.session import materialize


def jaccard_classes(rows: DataFrame, key: str, tokens: str) -> DataFrame:
    """(key, tokens, leader): rows of equal non-empty token arrays share the least key as leader. Arrays must be sorted."""
    used = rows.select(F.col(key), F.col(tokens).alias("tokens")).where("size(tokens) > 0")
    leaders = used.groupBy("tokens").agg(F.min(key).alias("leader"))
    return used.join(leaders, "tokens").select(key, "tokens", "leader")


def jaccard_pairs(sets: DataFrame, key: str, threshold: float) -> DataFrame:
    """(a, b), a < b: all pairs of different token sets with Jaccard of at least ``threshold``, which is 0.4 or more.

    ``sets`` is (key, tokens), the key a unique whole number, tokens distinct texts. Candidates share two tokens of one segment (:mod:`set_join`),
    so a token that is in most sets pairs nothing by itself; they are verified on the tokens themselves. Null or empty sets match nothing.
    """
    sets = materialize(sets.select(F.col(key).cast("long").alias("id"), "tokens").where("size(tokens) > 0"), "token-sets")
    hashed = sets.select("id", F.lit(0).alias("salt"), F.array_sort(F.array_distinct(F.transform("tokens", lambda t: F.xxhash64(t)))).alias("tokens"))
    found = similar_sets(materialize(hashed, "token-hashes"), threshold, exact=False)
    x = sets.select(F.col("id").alias("id_a"), F.col("tokens").alias("x"))
    y = sets.select(F.col("id").alias("id_b"), F.col("tokens").alias("y"))
    close = overlap_holds("x", "y", threshold)
    return found.join(x, "id_a").join(y, "id_b").where(close).select(F.col("id_a").alias("a"), F.col("id_b").alias("b"))


def shared_tag_edges(rows: DataFrame, key: str, group: str, tag: str) -> DataFrame:
    """Edges (a, b) that link all rows with a common tag, if rows of at least two groups have it: to the least key, not pairwise."""
    own = rows.select(F.col(key).alias("b"), F.col(group).alias("g"), F.col(tag).alias("t")).where("t is not null").distinct()
    spread = own.groupBy("t").agg(F.min("b").alias("a"), F.min("g").alias("g0"), F.max("g").alias("g1")).where("g0 <> g1")
    return own.join(spread.select("t", "a"), "t").where("a <> b").select("a", "b").distinct()
