from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from veredas.operators import set_join
from veredas.operators.matching import jaccard_classes, jaccard_pairs


def titles(seed, n, most, vocabulary):
    draw = random.Random(seed)
    every = [sorted({f"t{int(vocabulary * draw.random() ** 2)}" for _ in range(draw.randint(0, most))}) for _ in range(n)]
    return [(i, t) for i, t in enumerate(every)] + [(n, None), (n + 1, [])]


@pytest.mark.parametrize(("seed", "most", "vocabulary", "threshold"), [(1, 4, 12, 0.4), (2, 12, 40, 0.4), (3, 40, 90, 0.6)])
def test_same_pairs_as_brute_force(spark, monkeypatch, seed, most, vocabulary, threshold):
    monkeypatch.setattr("veredas.operators.set_join.RUN", 8 if seed == 2 else 4_096)
    rows = titles(seed, 150, most, vocabulary)
    df = spark.createDataFrame(rows, "pos long, tokens array<string>")
    leaders = jaccard_classes(df, "pos", "tokens").where("pos = leader").select("pos", "tokens")
    sets = {r.pos: set(r.tokens) for r in leaders.collect()}
    want = sorted((a, b) for a, b in combinations(sorted(sets), 2) if len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]) - 1e-9)
    assert sorted(tuple(r) for r in jaccard_pairs(leaders, "pos", threshold).collect()) == want


def test_a_token_of_all_sets_pairs_nothing_by_itself(spark):
    df = spark.range(3000).select("id", F.array(F.lit("de"), F.concat(F.lit("a"), "id"), F.concat(F.lit("b"), "id"), F.concat(F.lit("c"), "id")).alias("tokens"))
    assert jaccard_pairs(df, "id", 0.4).count() == 0


def texts_of_common_words(n):
    """Sets of 50 of 100 words that all share and 20 of their own, and near copies of every tenth, as (flat, sizes)."""
    draw = np.random.default_rng(5)
    sets = [np.concatenate([draw.permutation(100)[:50], 1_000 + 20 * i + np.arange(20)]) for i in range(n)]
    sets += [np.concatenate([s[5:60], 10_000_000 + 15 * i + np.arange(15)]) for i, s in enumerate(sets[::10])]
    sets = [np.unique(s * 0x9E3779B97F4A7C1 % (1 << 62)).astype(np.int64) for s in sets]
    return sets, np.concatenate(sets), np.array([len(s) for s in sets])


def order_of(flat, n):
    words, counts = np.unique(flat, return_counts=True)
    frequent = counts >= max(3, n // 1000)
    return set_join.Order(words[frequent], counts[frequent])


def test_common_words_do_not_pair_long_sets():
    sets, flat, sizes = texts_of_common_words(3_000)
    _, key, small = set_join.signatures(flat, sizes, np.zeros(len(sizes), dtype=np.int64), order_of(flat, len(sets)), 0.6, rare_alone=True)
    _, at, rows = np.unique(key, return_inverse=True, return_counts=True)
    assert (np.bincount(at, weights=small) * rows).sum() < 100 * len(sets)  # 1,184 with pairs of any words as keys


@pytest.mark.parametrize("rare_alone", [True, False])
@pytest.mark.parametrize(("blocked", "block", "run"), [(2, (3, 5), 1 << 17), (1 << 20, (3, 5), 1 << 17), (64, (128, 512), 1 << 17), (2, (3, 5), 8)])
def test_rows_that_meet_hold_all_pairs(monkeypatch, rare_alone, blocked, block, run):
    monkeypatch.setattr(set_join, "BLOCKED", blocked)
    monkeypatch.setattr(set_join, "BLOCK", block)
    monkeypatch.setattr(set_join, "RUN", run)
    sets, flat, sizes = texts_of_common_words(200)
    frame = pd.DataFrame({"id": np.arange(len(sets)), "salt": 0, "tokens": sets})
    body = set_join.key_rows(order_of(flat, len(sets)), 0.6, rare_alone, 256 if rare_alone else 128)
    keys = pd.concat(body(iter([frame]))).sort_values("key")
    parts = [set_join.key_columns(keys.iloc[at : at + 700]) for at in range(0, len(keys), 700)]
    met = pd.concat(set_join.meet(iter(parts), 0.6))
    pairs, hot = met[met["what"] == set_join.PAIR], met[met["what"] == set_join.HOT]
    got = set(zip(pairs["id"], pairs["other"]))
    assert (len(hot) > 0) == (run == 8)
    for _, rows in hot.groupby("key"):
        got |= set(combinations(sorted(rows["id"]), 2))
    words = [set(s.tolist()) for s in sets]
    want = {(a, b) for a, b in combinations(range(len(sets)), 2) if len(words[a] & words[b]) >= 0.6 * len(words[a] | words[b]) - 1e-9}
    assert len(want) >= 20 and want <= got
    assert all(a < b for a, b in got)
