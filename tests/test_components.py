from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from veredas.operators.components import connected_groups, shared_member_edges


def brute(edges):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            ra, rb = find(a), find(b)
            parent[max(ra, rb)] = min(ra, rb)
    groups = {}
    for x in parent:
        groups.setdefault(find(x), set()).add(x)
    return {(x, min(g)) for g in groups.values() if len(g) > 1 for x in g}


def rows(df):
    return {tuple(r) for r in df.collect()}


def test_chains_hubs_nulls_and_repeats(spark):
    random.seed(4)
    edges = [(f"v{random.randint(0, 400)}", f"v{random.randint(0, 400)}") for _ in range(250)]
    edges += [("hub", f"leaf{i}") for i in range(300)] + [(f"c{i}", f"c{i + 1}") for i in range(40)]
    edges += [("a", None), (None, "b"), ("self", "self"), edges[0], (edges[0][1], edges[0][0])]
    df = spark.createDataFrame([(a, b, "x") for a, b in edges], "l string, r string, vertex string")
    for per_cell in (1_000_000, 60):
        assert rows(connected_groups(df, "l", "r", per_cell)) == brute(edges)


def test_empty_table(spark):
    df = spark.createDataFrame([], "l string, r string")
    out = connected_groups(df, "l", "r")
    assert out.columns == ["record_key", "group_key"] and out.count() == 0


def test_shared_members_make_a_star(spark):
    df = spark.createDataFrame([("k2", "m"), ("k1", "m"), ("k3", "m"), ("k3", "n"), ("k9", "o"), (None, "m"), ("k4", None)], "k string, m string")
    assert rows(shared_member_edges(df, "k", "m")) == {("k1", "k2"), ("k1", "k3")}


def test_group_with_one_hot_member_is_whole(spark):
    df = spark.range(3000).select(F.format_string("r%05d", "id").alias("k"), F.lit("m").alias("m"))
    groups = connected_groups(shared_member_edges(df, "k", "m"), "a", "b", 100)
    assert groups.where("group_key = 'r00000'").count() == 3000


@pytest.mark.parametrize("order", ["forward", "backward", "shuffled"])
def test_rounds_grow_with_the_logarithm_of_a_chain(spark, order):
    n, per_cell = 100_000, 5_000
    at = {"forward": F.col("id"), "backward": n - F.col("id"), "shuffled": F.xxhash64("id")}[order]
    after = {"forward": F.col("id") + 1, "backward": n - F.col("id") - 1, "shuffled": F.xxhash64(F.col("id") + 1)}[order]
    name = lambda c: F.format_string("%020d", c)
    edges = spark.range(n).select(name(at).alias("a"), name(after).alias("b"))
    rounds: list[int] = []
    groups = connected_groups(edges, "a", "b", per_cell, rounds)
    least = edges.select(F.least(F.min("a"), F.min("b"))).first()[0]
    assert groups.where(F.col("group_key") == least).count() == n + 1 == groups.count()
    assert len(rounds) <= 3 * math.log2(n / per_cell)


def test_grid_gives_the_groups_of_one_cell(spark, sf):
    links = spark.read.parquet(f"{sf}/bill_matches.parquet")
    one = connected_groups(links, "left_bill_id", "right_bill_id")
    rounds: list[int] = []
    assert rows(connected_groups(links, "left_bill_id", "right_bill_id", 4, rounds)) == rows(one)
    assert len(rounds) > 1
