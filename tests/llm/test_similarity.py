from __future__ import annotations

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from veredas.functions.text import words_py
from veredas.llm.similarity import all_pairs, near_duplicates


def brute(rows, threshold):
    sets = [(k, p, set(words_py(t))) for k, p, t in rows]
    sets = [x for x in sets if x[2] and x[1] is not None]
    return sorted((a[0], min(a[1], b[1]), max(a[1], b[1])) for a, b in combinations(sets, 2) if a[0] == b[0] and len(a[2] & b[2]) >= threshold * len(a[2] | b[2]) - 1e-9)


def found(spark, rows, threshold):
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "kind string, pos long, text string, id int, tokens int")
    members, links = near_duplicates(df, pos="pos", texts=["text"], kind=F.col("kind"), threshold=threshold)
    return sorted(tuple(r) for r in all_pairs(members, links).collect())


def corpus(seed, n, least, most, vocabulary):
    random.seed(seed)
    rows = []
    for i in range(n):
        if rows and random.random() < 0.5:
            base = random.choice(rows)[2].split()
            for _ in range(random.randint(0, max(1, len(base) // 3))):
                at = random.randrange(len(base))
                base[at : at + random.randint(0, 1)] = [f"w{random.randint(0, vocabulary)}"] * random.randint(0, 1)
                base = base or ["w0"]
            random.shuffle(base)
            rows.append(("k", i, " ".join(base)))
        else:
            rows.append(("k", i, " ".join(f"w{random.randint(0, vocabulary)}" for _ in range(random.randint(least, most)))))
    return rows


@pytest.mark.parametrize(("seed", "least", "most", "vocabulary", "threshold"), [(1, 1, 8, 12, 0.6), (2, 5, 30, 60, 0.6), (3, 30, 90, 300, 0.6), (4, 20, 60, 100, 0.8), (5, 1, 60, 200, 0.5)])
def test_same_pairs_as_brute_force(spark, seed, least, most, vocabulary, threshold):
    rows = corpus(seed, 160, least, most, vocabulary)
    rows += [("other", p, t) for _, p, t in rows[:40]]
    assert found(spark, rows, threshold) == brute(rows, threshold)


def test_nulls_empty_long_and_repeated_texts(spark):
    long = " ".join(f"x{i}" for i in range(30_000))
    rows = [("k", 1, None), ("k", 2, ""), ("k", 3, "..!"), ("k", 4, "Árbol río"), ("k", 5, "rio ARBOL"), ("k", 6, long), ("k", 7, long + " y"), ("k", None, "rio arbol"), ("k", 8, "uno")]
    assert found(spark, rows, 0.6) == [("k", 4, 5), ("k", 6, 7)]
    assert found(spark, rows[:0], 0.6) == []


def test_hot_class_stays_one_class(spark):
    df = spark.range(2000).select("id", F.when(F.col("id") % 3 == 0, "la misma nota de siempre").otherwise(F.concat(F.lit("nota "), F.col("id"))).alias("text"))
    members, links = near_duplicates(df, pos="id", texts=["text"], threshold=0.8)
    assert members.where("class_pos = 0").count() == 667 and links.count() == 0
