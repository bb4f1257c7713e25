from __future__ import annotations

import random
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from veredas.llm.packing import pack_texts, plan_bins, slots, token_counter


@pytest.mark.parametrize("seed", range(12))
def test_plan_places_every_item_once(seed):
    random.seed(seed)
    capacity = random.choice([10, 64, 2048])
    histogram = Counter(random.randint(1, capacity) for _ in range(random.randint(1, 3000)))
    runs = plan_bins(dict(histogram), capacity)
    placed = Counter()
    for run in runs:
        used = sum(s * n for s, n in run.items)
        assert run.bins > 0 and used <= capacity and run.gap == capacity - used
        assert sum(n for s, n in run.items if 3 * s > capacity) <= 2
        for s, n in run.items:
            placed[s] += n * run.bins
    assert placed == histogram
    bins = sum(run.bins for run in runs)
    total = sum(s * n for s, n in histogram.items())
    large = sum(n for s, n in histogram.items() if 2 * s > capacity)
    assert bins <= max(-(-total // capacity), large) * 11 / 9 + 1
    assert sum(len(x) for x in slots(runs).values()) >= len(histogram)


def test_whole_result_is_valid(spark):
    random.seed(3)
    texts = [(i, " ".join(random.choice(["casa", "río", "ley 12", "xyzzy"]) for _ in range(random.choice([1, 5, 40, 300, 900])))) for i in range(300)]
    texts += [(1000, None), (1001, ""), (1002, "a b " * 40_000), (None, "x")]
    df = spark.createDataFrame([(*t, 1, 2) for t in texts], "doc_id long, text string, tokens int, part int")
    out = pack_texts(df, capacity=256).toPandas()
    sizes = dict(zip([d for d, _ in texts], token_counter(None)([t or "" for _, t in texts])))
    filled = out[out.tokens > 0]
    assert filled.groupby("container_id").tokens.sum().max() <= 256
    assert filled.groupby("doc_id").tokens.sum().to_dict() == {d: n for d, n in sizes.items() if n and d is not None}
    assert set(out.doc_id) == {d for d, _ in texts if d is not None}
    assert out[out.tokens == 0].container_id.isna().all()
    for doc, parts in filled.groupby("doc_id"):
        parts = parts.sort_values("part")
        assert (parts.first_token == parts.tokens.cumsum() - parts.tokens).all()
        assert len(parts) == 1 or sizes[doc] > 256
    assert pack_texts(df.limit(0), capacity=256).count() == 0


def test_one_size_with_most_rows_is_ranked_in_blocks(spark, monkeypatch):
    monkeypatch.setattr("veredas.llm.packing.RANKED_TOGETHER", 50)
    df = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("casa casa casa").alias("text"))
    out = pack_texts(df, capacity=64).toPandas()
    assert isinstance(out, pd.DataFrame) and len(out) == 400
    assert out.groupby("container_id").tokens.sum().le(64).all() and out.container_id.nunique() == -(-400 // (64 // out.tokens.iloc[0]))
