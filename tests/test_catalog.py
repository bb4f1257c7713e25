"""Every query of the core against its SQL in DuckDB."""

from __future__ import annotations

import sys
from collections import Counter
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tools.compare import plain  # noqa: E402
from veredas.operators.ranking import diversified_order  # noqa: E402
from veredas.plans import catalog, catalog_records, catalog_text, problems  # noqa: E402

QUERIES = {**problems.QUERIES, **catalog.QUERIES, **catalog_text.QUERIES, **catalog_records.QUERIES}
ORACLES = {**problems.ORACLES, **catalog.ORACLES, **catalog_text.ORACLES, **catalog_records.ORACLES}


@pytest.fixture(scope="module")
def duck(sf):
    connection = duckdb.connect()
    connection.execute("set timezone='UTC'")
    for path in Path(sf).glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    names = sorted(df.columns)
    ours = Counter(tuple(plain(r[c]) for c in names) for r in df.collect())
    cursor = duck.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == names
    assert Counter(tuple(plain(r[columns.index(c)]) for c in names) for r in cursor.fetchall()) == ours


def greedy(rows, top_n=10, share=0.3):
    """Places as a loop over all rows gives them."""
    most, used, placed, rest = max(1, int(top_n * share)), Counter(), [], []
    for key, _, sources in sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0])):
        names = {s for s in sources or [] if s is not None}
        if len(placed) >= top_n or names and all(used[s] >= most for s in names):
            rest.append(key)
        else:
            placed.append(key)
            used.update(names)
    return placed, rest


@pytest.mark.parametrize("look", [1, 64])
def test_diversified_order(spark, sf, monkeypatch, look):
    monkeypatch.setattr("veredas.operators.ranking.LOOK", look)
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/clusters.parquet").select("cluster_id", "score", "member_source_ids").collect()]
    rows += [(f"hot{i}", 99.0 + i % 2, ["one", None]) for i in range(60)] + [("none", None, None), ("bare", 98.0, [])]
    df = spark.createDataFrame(rows, "cluster_id string, score double, member_source_ids array<string>")
    got = diversified_order(df, "cluster_id", "score", "member_source_ids").collect()
    placed = [r.key for r in sorted((r for r in got if r.pick == 1), key=lambda r: r.place)]
    rest = [r.key for r in sorted((r for r in got if r.pick == 2), key=lambda r: (r.score is None, -(r.score or 0), r.key))]
    assert (placed, rest) == greedy(rows)
    assert diversified_order(df.limit(0), "cluster_id", "score", "member_source_ids").count() == 0


def test_queries_without_sql_keep_every_row(spark, sf):
    raw = spark.read.parquet(f"{sf}/raw_items.parquet")
    texts = QUERIES["html_texts"](spark, sf)
    assert texts.count() == raw.where("raw_text is not null").count() or texts.count() == raw.count()
    assert QUERIES["diversified_all"](spark, sf).count() == spark.read.parquet(f"{sf}/clusters.parquet").count()
    assert QUERIES["diversified_clusters"](spark, sf).count() == 10


def test_iso_values_of_timestamps_against_sql(spark, sf, duck):
    """The notations that SQL reads too: ISO with an offset."""
    sql = """select pos, epoch_us(try_cast(v as timestamptz)) from (select pos, unnest([published_at, fetched_at]) as v from raw_items)
    where regexp_full_match(v, '[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,6})?(Z|[+-][0-9]{2}:[0-9]{2})') and try_cast(v as timestamptz) is not null"""
    want = duck.execute(sql).fetchall()
    ours = {tuple(r) for r in QUERIES["p5_found"](spark, sf).select("pos", "utc_us").collect()}
    assert len(want) > 100 and set(want) <= ours


def test_shared_project_links_of_a_double_chamber(spark, tmp_path):
    rows = [(1, "a", [("7", "2020", "Senado")]), (2, "b", [("7", "2020", "SENADO"), ("8", "2021", "x")]), (3, "c", [("7", "2020", "Cámara")]), (4, "d", None)]
    schema = "pos long, canonical_bill_id string, project_records array<struct<number:string,year:string,chamber:string>>"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "legislative_reconciliations.parquet"))
    assert sorted(tuple(r) for r in QUERIES["shared_project_links"](spark, str(tmp_path)).collect()) == [(1, "b"), (2, "a")]
    both = [(1, "a", [("007", "2020", "Cámara/Senado")]), (2, "b", [("0", "2020", None), ("", "2021", "x")])]
    spark.createDataFrame(both, schema).write.mode("overwrite").parquet(str(tmp_path / "legislative_reconciliations.parquet"))
    got = sorted(tuple(r) for r in QUERIES["project_keys"](spark, str(tmp_path)).collect())
    assert got == [(1, "a", "7", "2020", "camara"), (1, "a", "7", "2020", "senado"), (2, "b", "0", "2020", "unknown")]
