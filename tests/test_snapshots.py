from __future__ import annotations

from pyspark.sql import functions as F

from veredas.operators.snapshots import snapshot_changes

SCHEMA = "day string, k string, at int, name string, size string, _key string"


def run(spark, rows):
    df = spark.createDataFrame([(*r, "extra") for r in rows], SCHEMA)
    out = snapshot_changes(df, snapshot="day", key=F.col("k"), fields=["size", "name"], version=[F.col("at")])
    return sorted(tuple(r) for r in out.collect())


def test_added_removed_changed(spark):
    rows = [("1", "a", 1, "x", "1"), ("1", "b", 1, "y", "1"), ("2", "a", 1, " X ", "2"), ("2", "c", 1, "z", None), ("3", "a", 1, "w", "3"), ("3", "b", 1, "y", "1"), ("3", "c", 1, "z", "")]
    assert run(spark, rows) == [("2", "a", "changed", "size"), ("2", "b", "removed", ""), ("2", "c", "added", ""), ("3", "a", "changed", "name,size"), ("3", "b", "added", "")]


def test_latest_delivery_holds_and_ties_are_stable(spark):
    rows = [("1", "a", 1, "x", "1"), ("2", "a", 1, "old", "1"), ("2", "a", 2, "x", "1"), ("2", "a", 2, "x", "1"), ("2", "a", None, "zz", "1")]
    assert run(spark, rows) == []


def test_null_keys_single_snapshot_and_empty(spark):
    assert run(spark, [("1", "a", 1, "x", "1"), ("1", None, 1, "x", "1"), (None, "b", 1, "x", "1")]) == []
    assert run(spark, []) == []


def test_gap_of_a_key_is_removed_and_added_again(spark):
    rows = [("1", "a", 1, "x", "1"), ("2", "b", 1, "x", "1"), ("3", "a", 1, "x", "1"), ("3", "b", 1, "x", "1")]
    assert run(spark, rows) == [("2", "a", "removed", ""), ("2", "b", "added", ""), ("3", "a", "added", "")]
