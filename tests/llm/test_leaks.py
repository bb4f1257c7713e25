from __future__ import annotations

import random

from veredas.functions.text import words_py
from veredas.llm.leaks import find_leaks, leak_report


def brute(docs, items, span=12):
    found = set()
    for i, t in items:
        w = words_py(t)
        n = min(span, len(w))
        if not n or i is None:
            continue
        windows = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}
        for d, text in docs:
            v = words_py(text)
            if d is not None and any(tuple(v[k : k + n]) in windows for k in range(len(v) - n + 1)):
                found.add((d, i))
    return sorted(found)


def frames(spark, docs, items):
    return (
        spark.createDataFrame([(*d, 1, "p") for d in docs], "doc_id long, text string, size int, passage string"),
        spark.createDataFrame([(*i, 2) for i in items], "item_id long, text string, doc_id long"),
    )


def test_planted_passages(spark):
    random.seed(6)
    word = lambda: f"w{random.randint(0, 60)}"
    items = [(k, " ".join(word() for _ in range(random.choice([1, 3, 5, 11, 12, 13, 40])))) for k in range(60)]
    docs = []
    for d in range(150):
        words = [word() for _ in range(random.randint(0, 80))]
        if random.random() < 0.6:
            source = words_py(random.choice(items)[1])
            a = random.randint(0, max(0, len(source) - 10))
            at = random.randint(0, len(words))
            words[at:at] = source[a : a + random.randint(8, 14)]
        docs.append((d, ", ".join(words).upper()))
    docs += [(900, None), (901, ""), (None, items[0][1]), (902, items[5][1]), (902, items[5][1]), (903, "x " * 50_000 + items[7][1])]
    items += [(800, None), (801, "  "), (None, "w1 w2"), (3, items[3][1])]
    d, i = frames(spark, docs, items)
    want = brute(docs, items)
    assert sorted(tuple(r) for r in find_leaks(d, i).collect()) == want
    assert sorted(tuple(r) for r in find_leaks(d, i, windows_at_once=100, filter_bits=1 << 16).collect()) == want
    report = dict(tuple(r) for r in leak_report(find_leaks(d, i), i).collect())
    assert report[800] == 0 and sum(report.values()) == len(want)


def test_empty_tables(spark):
    d, i = frames(spark, [(1, "a b")], [(1, "a")])
    assert find_leaks(d.limit(0), i).count() == 0 and find_leaks(d, i.limit(0)).count() == 0
