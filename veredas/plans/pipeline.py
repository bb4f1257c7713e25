"""One batch from delivered items to ranked groups, written as partitions of the run's date.

``python -m veredas.plans.pipeline --raw items.parquet --sources sources.parquet --root runs --date 2025-10-06``
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veredas.functions.items import title_tokens, truncate_summary
from veredas.functions.text import collapse_spaces, fold
from veredas.functions.url import canonical_url
from veredas.operators.components import connected_groups
from veredas.operators.dedupe import dedupe_two_stage
from veredas.operators.matching import jaccard_classes, jaccard_pairs
from veredas.operators.ranking import diversified_top
from veredas.session import build_session, materialize
from veredas.sources.pages import page_state, strip_html
from veredas.sources.runs import manifest, write_run

SHORT_TEXT, TITLE_THRESHOLD = 40, 0.4


def clean_items(raw: DataFrame, sources: DataFrame) -> DataFrame:
    """Items of known sources with clean text, summary and quality notes.

    Markup goes, white space is collapsed, separators at the end go; a text that comes out empty is the title. Items with neither are dropped.
    Needs pos, id, source_id, url, title, published_at and raw_text; nulls count as empty.
    """
    known = sources.select(F.col("id").alias("source_id"), F.col("type").alias("source_type"), "trust_role", "priority")
    items = raw.select("pos", "id", "source_id", "url", "title", "published_at", "raw_text").join(known, "source_id")
    title = collapse_spaces(F.coalesce("title", F.lit("")))
    text = collapse_spaces(F.regexp_replace(collapse_spaces(strip_html(F.coalesce("raw_text", F.lit("")))), r"(?:\s*\|\s*)+$", ""))
    state = page_state(F.col("raw_text"))
    items = items.select(*[c for c in items.columns if c not in ("title", "raw_text")], title.alias("title"), text.alias("text"), state.alias("state"))
    items = items.withColumn("clean_text", F.when(F.col("text") == "", F.col("title")).otherwise(F.col("text"))).drop("text")
    notes = F.concat_ws(
        ",",
        F.when(F.col("title") == "", "low_quality:no_title"),
        F.when(F.length("clean_text") < SHORT_TEXT, "low_quality:short_text"),
        F.when(F.col("state") == "blocked", "low_quality:blocked"),
    )
    return items.where("clean_text <> ''").withColumns({"summary": truncate_summary(F.col("clean_text")), "quality_notes": notes}).drop("state")


def without_repeats(items: DataFrame) -> DataFrame:
    """One item per URL and per source and title; of a URL's items the most trusted, else the first."""
    title = F.concat_ws(":", "source_id", collapse_spaces(fold(F.col("title"))))
    trust = F.when(F.col("trust_role").isin("official_signal", "resolution_source"), 1).otherwise(0)
    return dedupe_two_stage(items, canonical_url(F.col("url")), title, trust).drop("slot_pos")


def group_titles(items: DataFrame, threshold: float = TITLE_THRESHOLD) -> DataFrame:
    """(pos, group_pos): items linked by similar titles, directly or not."""
    tokens = items.select("pos", title_tokens(F.col("title")).alias("tokens"))
    classes = materialize(jaccard_classes(tokens, "pos", "tokens"), "title-classes")
    key = lambda c: F.lpad(F.col(c).cast("string"), 20, "0")
    edges = jaccard_pairs(classes.where("pos = leader").select("pos", "tokens"), "pos", threshold).select(key("a").alias("a"), key("b").alias("b"))
    groups = connected_groups(edges, "a", "b")
    groups = groups.select(F.col("record_key").cast("long").alias("leader"), F.col("group_key").cast("long").alias("g"))
    joined = items.select("pos").join(classes.select("pos", "leader"), "pos", "left").join(groups, "leader", "left")
    return joined.select("pos", F.coalesce("g", "leader", "pos").alias("group_pos"))


def group_rows(items: DataFrame, groups: DataFrame) -> DataFrame:
    """One row per group: its sources, its longest title, its latest date as text and a score of breadth and priority."""
    weight = F.when(F.col("priority") == "high", 3).when(F.col("priority") == "medium", 2).otherwise(1)
    grouped = items.join(groups, "pos").groupBy("group_pos").agg(
        F.count("*").alias("items"),
        F.array_sort(F.collect_set("source_id")).alias("source_ids"),
        F.max(F.struct(F.length("title").alias("n"), F.col("title").alias("t"))).alias("best"),
        F.max("published_at").alias("latest_published_at"),
        F.max(weight).alias("weight"),
    )
    score = (2 * F.size("source_ids") + 3 * F.col("weight") + F.least(F.col("items"), F.lit(5))).cast("double")
    return grouped.select("group_pos", "items", "source_ids", F.col("best.t").alias("title"), "latest_published_at", score.alias("score"))


def run_batch(spark: SparkSession, raw: DataFrame, sources: DataFrame, root: str, run_date: str) -> DataFrame:
    """Writes cleaned, groups and top of one run and returns its manifest."""
    cleaned = materialize(clean_items(raw, sources), "cleaned")
    kept = materialize(without_repeats(cleaned), "kept")
    rankable = kept.where("quality_notes = '' and published_at is not null")
    groups = materialize(group_rows(rankable, group_titles(rankable)), "groups")
    write_run(kept, root, "cleaned", run_date)
    write_run(groups, root, "groups", run_date)
    write_run(diversified_top(groups, "group_pos", "score", "source_ids"), root, "top", run_date)
    return manifest(spark, root, ["cleaned", "groups", "top"], run_date)


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    for name in ("raw", "sources", "root", "date"):
        parser.add_argument(f"--{name}", required=True)
    args = parser.parse_args()
    spark = build_session()
    raw = spark.read.parquet(args.raw).where(F.col("run_date") == args.date)
    run_batch(spark, raw, spark.read.parquet(args.sources), args.root, args.date).show(truncate=False)


if __name__ == "__main__":
    main()
