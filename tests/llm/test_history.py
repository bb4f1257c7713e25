from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from veredas.functions.text import fold_py, words_py
from veredas.functions.url import canonical_url_py
from veredas.llm.history import FingerprintStore, accept_delivery, keyed_batch, replay
from veredas.llm.similarity import word_set
from veredas.operators.set_join import Order
from veredas.session import materialize, scratch

RAW = "run_date string, pos long, source_id string, url string, title string, content string, tokens int, day int"


def brute(raw, contents, threshold):
    texts = {p: set(words_py(t)) for p, t in contents}
    accepted, refused = [], []
    for day, pos, source, url, title in sorted((r for r in raw if r[0] is not None), key=lambda r: r[1]):
        name = re.sub(r"\s+", " ", fold_py(title or "")).strip()
        own = (canonical_url_py(url), (source, name) if name and source is not None else None, texts.get(pos) or None)
        hits = [p for p, (u, t, w) in accepted if own[0] and u == own[0] or own[1] and t == own[1] or own[2] and w and len(w & own[2]) >= threshold * len(w | own[2]) - 1e-9]
        if hits:
            refused.append((min(hits), pos))
        else:
            accepted.append((pos, own))
    return sorted(refused)


def matches(raw, contents, threshold):
    """(pos, the accepted rows it matches) of each refused row, for pos that rises with the batch."""
    texts = {p: set(words_py(t)) for p, t in contents}
    accepted, refused = [], []
    for _, pos, source, url, title in sorted(raw, key=lambda r: r[1]):
        name = re.sub(r"\s+", " ", fold_py(title or "")).strip()
        own = (canonical_url_py(url), (source, name) if name and source is not None else None, texts.get(pos) or None)
        hits = [p for p, (u, t, w) in accepted if own[0] and u == own[0] or own[1] and t == own[1] or own[2] and w and len(w & own[2]) >= threshold * len(w | own[2]) - 1e-9]
        if hits:
            refused.append((pos, hits))
        else:
            accepted.append((pos, own))
    return refused


def made(seed, n):
    random.seed(seed)
    raw, contents = [], []
    for i in range(1, n):
        day = f"2025-01-{1 + i * 20 // n:02d}"
        url = None if random.random() < 0.1 else f"https://Ex.example/{random.randint(0, n)}/?utm_source=a&b={random.randint(0, 1)}#x"
        title = random.choice([None, "", f" Nota  {random.randint(0, n)} ", f"NÓTA {random.randint(0, n)}"])
        raw.append((day, i, random.choice(["s", "t", None]), url, title))
        if random.random() < 0.7:
            if contents and random.random() < 0.6:
                base = (random.choice(contents)[1] or "vacio").split()
                random.shuffle(base)
                base[: random.randint(0, len(base) // 3)] = [f"n{random.randint(0, 90)}"]
                contents.append((i, " ".join(base)))
            else:
                contents.append((i, random.choice([None, "", " ".join(f"w{random.randint(0, 300)}" for _ in range(random.randint(3, 70)))])))
    return raw, contents


@pytest.mark.parametrize(("seed", "together", "settled"), [(1, 20, 0), (2, 10, 300_000), (2, 1, 40)])
def test_same_as_taking_rows_one_by_one(spark, monkeypatch, seed, together, settled):
    monkeypatch.setattr("veredas.llm.history.SETTLED_TOGETHER", settled)
    raw, contents = made(seed, 240)
    rows = spark.createDataFrame([(*r, "clash", 1, 2) for r in raw], RAW)
    texts = spark.createDataFrame(contents, "pos long, text string")
    out = replay(rows, texts, content_texts=["text"], threshold=0.6, together=together)
    assert sorted(tuple(r) for r in out.select("accepted_pos", "pos").collect()) == brute(raw, contents, 0.6)


def test_empty_tables_and_one_hot_url(spark):
    texts = spark.createDataFrame([], "pos long, text string")
    assert replay(spark.createDataFrame([], RAW), texts, content_texts=["text"]).count() == 0
    rows = spark.createDataFrame([(f"d{i // 100}", i, "s", "http://a.example/x", f"t{i}", None, None, None) for i in range(300)], RAW)
    out = replay(rows, texts, content_texts=["text"])
    assert sorted(tuple(r) for r in out.select("accepted_pos", "pos").collect()) == [(0, i) for i in range(1, 300)]


def test_long_chain_ends(spark):
    texts = [(i, " ".join(f"w{k}" for k in range(i, i + 8))) for i in range(120)]
    rows = spark.createDataFrame([("d", i, "s", None, None, None, None, None) for i in range(120)], RAW)
    out = replay(rows, spark.createDataFrame(texts, "pos long, text string"), content_texts=["text"], threshold=0.6)
    assert sorted(tuple(r) for r in out.select("accepted_pos", "pos").collect()) == brute([("d", i, "s", None, None) for i in range(120)], texts, 0.6)


def test_store_is_opened_from_its_folder_in_another_session(spark):
    raw, contents = made(5, 160)
    none = Order(np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64))
    folder = scratch(spark, "kept-store")
    FingerprintStore.create(spark, folder, 0.6, none)
    found = []
    for start in range(0, 160, 40):
        session = spark.newSession()
        part = [(*r, "clash", 1, 2) for r in raw if start <= r[1] < start + 40]
        texts = session.createDataFrame([c for c in contents if start <= c[0] < start + 40], "pos long, text string")
        tokens = texts.select("pos", word_set(F.col("text")).alias("tokens"))
        rows = keyed_batch(session.createDataFrame(part, RAW), tokens, pos="pos", source="source_id", url="url", title="title")
        out = accept_delivery(FingerprintStore.open(session, folder), materialize(rows, "batch"))
        found += [tuple(r) for r in out.collect()]
    assert sorted((a, p) for a, p, _ in found) == brute(raw, contents, 0.6)
    assert any(by_store for *_, by_store in found)


@pytest.mark.parametrize(("together", "settled"), [(1, 300_000), (2, 300_000), (2, 0), (4, 30)])
def test_pos_that_does_not_rise_with_the_batch(spark, monkeypatch, together, settled):
    monkeypatch.setattr("veredas.llm.history.SETTLED_TOGETHER", settled)
    raw, contents = made(7, 160)
    # Copies of a table with shifted keys: each batch has rows of all ranges of pos.
    days = [f"2025-01-{1 + i % 4:02d}" for i in range(len(raw))]
    random.Random(1).shuffle(days)
    raw = [(d, *r[1:]) for d, r in zip(days, raw)]
    turn = {pos: i for i, (_, pos, *_) in enumerate(sorted(raw, key=lambda r: r[:2]))}
    back = {i: pos for pos, i in turn.items()}
    every = matches([(d, turn[p], *rest) for d, p, *rest in raw], [(turn[p], t) for p, t in contents], 0.6)
    rows = spark.createDataFrame([(*r, "clash", 1, 2) for r in raw], RAW)
    out = replay(rows, spark.createDataFrame(contents, "pos long, text string"), content_texts=["text"], threshold=0.6, together=together)
    assert sorted(tuple(r) for r in out.select("accepted_pos", "pos").collect()) == sorted((min(back[h] for h in hits), back[i]) for i, hits in every)
    assert any(min(back[h] for h in hits) > back[i] for i, hits in every) and any(min(hits) != min(hits, key=back.get) for _, hits in every)
