"""Queries of the llm operators over the provided tables, and SQL for the same results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veredas.llm.history import replay
from veredas.llm.leaks import find_leaks
from veredas.llm.packing import pack_texts
from veredas.llm.pages import main_content_lines
from veredas.llm.repeated_lines import repeated_lines
from veredas.llm.similarity import all_pairs, near_duplicates
from veredas.llm.truncation import truncated_texts, truncation_rates
from veredas.session import load


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_content_lines(load(spark, sf_dir, "raw_items")).select("pos", "line_no")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = load(spark, sf_dir, "cleaned_items").select(
        F.lit("item").alias("kind"), "pos", F.concat_ws(" ", "title", "clean_text").alias("text")
    )
    clusters = load(spark, sf_dir, "clusters").select(
        F.lit("cluster").alias("kind"), "pos", F.concat_ws(" ", "member_titles").alias("text")
    )
    rows = items.unionByName(clusters)
    return all_pairs(*near_duplicates(rows, pos="pos", texts=["text"], kind=F.col("kind"), threshold=0.6))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = repeated_lines(load(spark, sf_dir, "raw_items"))
    return lines.select("pos", F.col("line_no").cast("long").alias("line_no"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay(
        load(spark, sf_dir, "raw_items"),
        load(spark, sf_dir, "cleaned_items"),
        content_texts=["title", "clean_text"],
        threshold=0.6,
        together=2,
    ).select("accepted_pos", "pos")


def p8_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_texts(load(spark, sf_dir, "documents"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(load(spark, sf_dir, "documents"), load(spark, sf_dir, "eval_items"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncated_texts(load(spark, sf_dir, "documents")).where("truncated").select("doc_id")


def p10_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation_rates(truncated_texts(load(spark, sf_dir, "documents")))


QUERIES = {
    "p1_found": p1_found,
    "p2_found": p2_found,
    "p3_found": p3_found,
    "p4_found": p4_found,
    "p8_pack": p8_pack,
    "p9_found": p9_found,
    "p10_found": p10_found,
    "p10_rates": p10_rates,
}
WORDS_SQL = "regexp_extract_all(strip_accents(lower({0})), '[\\p{{L}}\\p{{N}}]+')"

P2_SQL = f"""
with r as (
  select 'item' as kind, pos, {WORDS_SQL.format("concat_ws(' ', title, clean_text)")} as w from cleaned_items
  union all select 'cluster', pos, {WORDS_SQL.format("array_to_string(member_titles, ' ')")} from clusters
), s as (select kind, pos, list_distinct(w) as w, len(list_distinct(w)) as n from r), t as (select kind, pos, n, unnest(w) as token from s)
select a.kind, a.pos as pos_a, b.pos as pos_b from t a join t b on a.kind = b.kind and a.token = b.token and a.pos < b.pos
group by a.kind, a.pos, b.pos, a.n, b.n having count(*) * 10 >= 6 * (a.n + b.n - count(*))
"""

P9_SQL = f"""
with i as (select item_id, {WORDS_SQL.format("text")} as w from eval_items where text is not null), p as (
  select item_id, w, least(12, len(w)) as n from i where len(w) > 0
), q as (
  select distinct item_id, n, array_to_string(w[k : k + n - 1], ' ') as passage from (select item_id, w, n, unnest(range(1, len(w) - n + 2)) as k from p)
), d as (select doc_id, {WORDS_SQL.format("text")} as w from documents where text is not null), e as (
  select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as k from d, (select distinct n from q) where len(w) >= n
)
select distinct doc_id, item_id from (select doc_id, n, array_to_string(w[k : k + n - 1], ' ') as passage from e) join q using (n, passage)
"""

ORACLES: dict[str, str] = {"p2_found": P2_SQL, "p9_found": P9_SQL}
