from __future__ import annotations

import random
from itertools import combinations

from pyspark.sql import functions as F

from veredas.functions.items import legal_acts, number_in_series, number_in_text, truncate_summary
from veredas.functions.url import canonical_url_py
from veredas.operators.matching import jaccard_pairs
from veredas.operators.ranking import diversified_top
from veredas.operators.series import asof_join, carry_forward
from veredas.streaming.items import first_seen, windowed_counts


def test_canonical_urls():
    assert canonical_url_py(" HTTP://A.Example/b/?utm_source=x&z=2&a=1&e=&ref=q#f ") == "http://a.example/b?a=1&z=2"
    assert canonical_url_py("https://a.example") == "https://a.example/"
    assert canonical_url_py("//a.example//") == "https://a.example"
    assert canonical_url_py(None) is canonical_url_py("  ") is canonical_url_py("http://[x") is None


def test_numbers_in_two_notations(spark):
    texts = ["1.234", "1.234,5", "1,234.5", "12,5", "12,345", "$ 7.000.000", "", None, "x", "-3,1"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [tuple(r) for r in df.select(number_in_text(F.col("t")), number_in_series(F.col("t"))).collect()]
    assert got == [(1.234, 1234.0), (1234.5, 1234.5), (1234.5, 1234.5), (12.5, 12.5), (12345.0, 12.345), (None, None), (None, None), (None, None), (None, None), (-3.1, -3.1)]


def test_legal_acts_and_summaries(spark):
    text = "La Resolución No. 0012 de 2020 y el decreto-ley 45/007 del 3 de mayo de 2021; Res. 12 de 2020. Ley 5 de 1990."
    df = spark.createDataFrame([(text,), (None,), ("",)], "t string")
    got = [[tuple(a) for a in r[0]] if r[0] else r[0] for r in df.select(legal_acts(F.col("t"))).collect()]
    assert got == [[("resolucion", "12", "2020"), ("decreto ley", "45-7", "2021"), ("ley", "5", "1990")], None, []]
    long = "palabra " * 60
    cut = spark.createDataFrame([(long,), ("x" * 300,), ("corto",), (None,)], "t string").select(truncate_summary(F.col("t"))).collect()
    assert cut[0][0] == ("palabra " * 35).strip() + "…" and cut[1][0] == "x" * 280 + "…" and cut[2][0] == "corto" and cut[3][0] is None


def test_jaccard_pairs_as_brute_force(spark):
    random.seed(2)
    sets = [sorted({f"t{random.randint(0, 25)}" for _ in range(random.randint(1, 9))}) for _ in range(150)]
    df = spark.createDataFrame(list(enumerate(sets)), "id long, tokens array<string>")
    want = {(a, b) for (a, x), (b, y) in combinations(enumerate(sets), 2) if len(set(x) & set(y)) >= 0.4 * len(set(x) | set(y)) - 1e-9}
    assert {tuple(r) for r in jaccard_pairs(df, "id", 0.4).collect()} == want


def test_diversification_as_the_greedy_rule(spark):
    random.seed(8)
    rows = [(f"k{i:03d}", float(random.randint(0, 30)), random.sample("abcdef", random.randint(0, 3))) for i in range(200)]
    used, want = {}, []
    for key, _, names in sorted(rows, key=lambda r: (-r[1], r[0])):
        if len(want) < 10 and not (names and all(used.get(n, 0) >= 3 for n in names)):
            want.append(key)
            for n in names:
                used[n] = used.get(n, 0) + 1
    got = diversified_top(spark.createDataFrame(rows, "k string, s double, n array<string>"), "k", "s", "n")
    assert [r.key for r in got.orderBy("place").collect()] == want


def test_carry_forward_over_blocks_of_a_hot_key(spark):
    random.seed(5)
    rows = [("hot", i, random.choice([None, None, f"v{i}"])) for i in range(500)] + [("b", 3, None), (None, 4, "z")]
    df = spark.createDataFrame(rows, "k string, at long, v string")
    want, last = {}, None
    for k, i, v in rows[:500]:
        last = v or last
        want[k, i] = last
    want |= {("b", 3): None}
    got = {(r.k, r.at): r.f for r in carry_forward(df, ["k"], "at", F.col("v"), "f", F.floor(F.col("at") / 7)).collect()}
    assert {k: got[k] for k in want} == want


def test_asof_join(spark):
    left = spark.sql("select * from values ('a', timestamp'2025-01-10', 1), ('a', timestamp'2025-01-01', 2), ('b', timestamp'2025-01-10', 3) t(k, at, id)")
    right = spark.sql("select * from values ('a', timestamp'2025-01-10', 5.0), ('a', timestamp'2025-01-10', 7.0), ('a', timestamp'2025-01-02', 1.0) t(k, at, v)")
    got = {r.id: r.hit for r in asof_join(left, right, by=["k"], left_at="at", right_at="at", value="v", name="hit", block=86_400).collect()}
    assert {k: None if v is None else float(v) for k, v in got.items()} == {1: 7.0, 2: None, 3: None}


def test_streams(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.sql("select id, id % 4 as k, timestamp'2025-01-01' + make_interval(0, 0, 0, cast(id as int)) as at from range(12)").coalesce(1).write.parquet(source)
    stream = spark.readStream.schema("id long, k long, at timestamp").parquet(source)
    first = first_seen(stream, F.col("k"), "at").writeStream.format("memory").queryName("first_rows").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c1")).start()
    first.awaitTermination(60)
    assert spark.table("first_rows").select("k").distinct().count() == spark.table("first_rows").count() == 4
    counts = windowed_counts(stream, "at", ["k"], "2 days").writeStream.format("memory").outputMode("complete").queryName("counts").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c2")).start()
    counts.awaitTermination(60)
    assert spark.table("counts").agg(F.sum("rows")).first()[0] == 12
