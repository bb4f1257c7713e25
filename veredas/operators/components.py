"""Connected components over a two-dimensional grid of edge partitions."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veredas.session import discard, materialize

EDGES_PER_CELL = 200_000


def _forest(a: np.ndarray, b: np.ndarray, turn: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Union-find over one cell: (vertex, root, the root's rank) of all vertices that are not their own root.

    The root of a tree is its vertex of least rank, a hash that differs in each ``turn``.
    """
    names, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    ranks = pd.util.hash_array(names, hash_key=f"{turn:016d}", categorize=False).astype(np.int64)
    order = np.lexsort((np.arange(len(names)), ranks))
    place = np.empty(len(names), dtype=np.int64)
    place[order] = np.arange(len(names))
    names, ranks, ends = names[order], ranks[order], place[ends]
    parent = list(range(len(names)))
    half = len(a)
    for x, y in zip(ends[:half].tolist(), ends[half:].tolist()):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        while parent[y] != y:
            parent[y] = parent[parent[y]]
            y = parent[y]
        if x < y:
            parent[y] = x
        elif y < x:
            parent[x] = y
    for i in range(len(parent)):  # parents come before their children
        parent[i] = parent[parent[i]]
    root = np.asarray(parent, dtype=np.int64)
    moved = np.flatnonzero(root != np.arange(len(root)))
    return names[moved], names[root[moved]], ranks[root[moved]]


def _cell(turn: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(batch: pd.DataFrame) -> pd.DataFrame:
        vertex, parent, rank = _forest(batch["a"].to_numpy(dtype=object), batch["b"].to_numpy(dtype=object), turn)
        return pd.DataFrame({"vertex": vertex, "parent": parent, "rank": rank})

    return run


def connected_groups(edges: DataFrame, left: str, right: str, edges_per_cell: int = EDGES_PER_CELL, rounds: list[int] | None = None) -> DataFrame:
    """(record_key, group_key) for every record that is linked to another one, directly or not.

    ``group_key`` is the smallest key of the group in text order. Pairs with a null side, self pairs and repeated pairs
    add nothing; an empty table gives no rows; further columns of ``edges`` are ignored whatever their names.

    Each round hashes both ends of every edge into blocks, runs union-find on every block pair by itself, and takes per
    vertex the least parent over its row and column of the grid, then that parent's own. What still disagrees (and the parents that moved) is
    the next, smaller graph; a vertex nobody points to leaves it. Vertices are ranked by another hash in each round, not by
    their keys: of any chain about a third leaves it each round, so the rounds grow with the logarithm of the edges for each
    cell, whatever order the keys come in. A hub's edges lie in all cells of its row or column, so no task holds them
    all, and every level is written to the shared folder. ``rounds``, if given, gets the number of edges of each round.
    """
    a, b = F.col(left).cast("string"), F.col(right).cast("string")
    graph = (
        edges.select(a.alias("_a"), b.alias("_b"))
        .where("_a is not null and _b is not null and _a <> _b")
        .select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b"))
        .distinct()
    )
    graph = materialize(graph, "edges")
    levels: list[DataFrame] = []
    done: list[DataFrame] = []
    while (count := graph.count()) > 0:
        if rounds is not None:
            rounds.append(count)
        done.append(graph)
        blocks = max(1, math.ceil(math.sqrt(count / edges_per_cell)))
        cells = graph.select(
            "a", "b", F.pmod(F.xxhash64("a"), F.lit(blocks)).alias("r"), F.pmod(F.xxhash64("b"), F.lit(blocks)).alias("c")
        )
        found = cells.groupBy("r", "c").applyInPandas(_cell(len(levels)), "vertex string, parent string, rank long")
        if blocks == 1:
            levels.append(materialize(found.select("vertex", "parent"), "level"))
            done.append(levels[-1])
            break
        found = materialize(found, "parents")
        level = found.groupBy("vertex").agg(F.min(F.struct("rank", "parent")).alias("least")).select("vertex", F.col("least.parent").alias("parent"))
        first = materialize(level, "least-parents")
        up = first.select(F.col("vertex").alias("parent"), F.col("parent").alias("upper"))
        level = materialize(first.join(up, "parent", "left").select("vertex", F.coalesce("upper", "parent").alias("parent")), "level")
        levels.append(level)
        done += [found, first, level]
        least = first.join(level.withColumnRenamed("parent", "least"), "vertex")
        open_ends = found.join(least.select("vertex", F.col("parent").alias("own"), "least"), "vertex").where("parent <> own")
        open_ends = open_ends.select(F.col("least").alias("a"), F.col("parent").alias("b"))
        pointed = level.select("parent").unionByName(open_ends.select(F.col("b").alias("parent"))).distinct()
        pointed = pointed.withColumnRenamed("parent", "vertex")
        moved = level.join(pointed, "vertex", "left_semi").select(F.col("parent").alias("a"), F.col("vertex").alias("b"))
        left_over = open_ends.unionByName(moved).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        graph = materialize(left_over.distinct(), "edges")
    if not levels:
        return graph.select(F.col("a").alias("record_key"), F.col("b").alias("group_key"))
    final = levels.pop()
    while levels:
        level = levels.pop()
        up = final.select(F.col("vertex").alias("parent"), F.col("parent").alias("upper"))
        level = level.join(up, "parent", "left").select("vertex", F.coalesce("upper", "parent").alias("parent"))
        # A vertex that moved on in a later level has its final parent there; one that later became a root points to itself.
        level = level.join(final.select("vertex"), "vertex", "left_anti").where("vertex <> parent").unionByName(final)
        final = materialize(level, "resolved")
        done.append(final)
    members = final.select("vertex", "parent").unionByName(final.select(F.col("parent").alias("vertex"), "parent").distinct())
    keys = final.groupBy("parent").agg(F.min("vertex").alias("k")).select("parent", F.least("k", "parent").alias("group_key"))
    groups = materialize(members.join(keys, "parent").select(F.col("vertex").alias("record_key"), "group_key"), "groups")
    for table in done:
        discard(table)
    return groups


def shared_member_edges(rows: DataFrame, record: str, member: str) -> DataFrame:
    """Edges (a, b) that link all records sharing a member to the smallest of them: a star for each member, not all pairs."""
    own = rows.select(F.col(record).alias("b"), F.col(member).alias("m")).where("b is not null and m is not null").distinct()
    least = own.groupBy("m").agg(F.min("b").alias("a"))
    return own.join(least, "m").where("a <> b").select("a", "b").distinct()
