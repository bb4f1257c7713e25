from __future__ import annotations

from veredas.plans.pipeline import clean_items, run_batch, without_repeats
from veredas.sources.runs import read_artifact

RAW = "pos long, id string, source_id string, url string, title string, published_at string, raw_text string"
SOURCES = "id string, type string, trust_role string, priority string"


def test_cleaning_and_repeats(spark):
    sources = spark.createDataFrame([("s", "news", "media_signal", "low"), ("o", "legal", "official_signal", "high")], SOURCES)
    long = "Una nota con bastante texto para que no sea corta"
    rows = [
        (1, "a", "s", "http://a.example/1?utm_x=1", " Uno ", "d", f"<p>{long}</p> | "),
        (2, "b", "o", "http://a.example/1", "Otro", "d", long),
        (3, "c", "s", None, "Tres", None, ""),
        (4, "d", "s", None, "TRÉS", None, "corto"),
        (5, "e", "s", "http://a.example/5", None, None, None),
        (6, "f", "x", "http://a.example/6", "sin fuente", None, long),
    ]
    cleaned = clean_items(spark.createDataFrame(rows, RAW), sources)
    got = {r.pos: (r.title, r.clean_text, r.quality_notes) for r in cleaned.collect()}
    assert got == {1: ("Uno", long, ""), 2: ("Otro", long, ""), 3: ("Tres", "Tres", "low_quality:short_text"), 4: ("TRÉS", "corto", "low_quality:short_text")}
    assert sorted(r.pos for r in without_repeats(cleaned).collect()) == [2, 3]


def test_batch_writes_its_partition(spark, sf, tmp_path):
    raw, sources = spark.read.parquet(f"{sf}/raw_items.parquet"), spark.read.parquet(f"{sf}/dim_source.parquet")
    day = raw.select("run_date").orderBy("run_date").first()[0]
    root = str(tmp_path)
    out = {r.artifact: r["rows"] for r in run_batch(spark, raw, sources, root, day).collect()}
    assert out["cleaned"] > out["groups"] > 0 and out["top"] == 10
    assert read_artifact(spark, root, "top").select("run_date").distinct().collect()[0][0] == day
