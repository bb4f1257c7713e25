"""Lines repeated across one source's texts, as blocks of a graph of consecutive lines."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veredas.functions.text import fold_py
from veredas.llm.pages import visible_lines
from veredas.operators.components import connected_groups
from veredas.session import materialize

LETTERS = re.compile(r"[^a-z]+")


def line_key(visible: str) -> int | None:
    """64-bit hash of the letters a–z of a line, lower-cased and without accents; None without letters."""
    letters = LETTERS.sub("", fold_py(visible))
    return xxhash.xxh64_intdigest(letters.encode()) - (1 << 63) if letters else None


KEYED = "pos long, source string, item long, line_no array<int>, line_key array<long>"


def _keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    known: dict[str, int | None] = {}
    for batch in batches:
        numbers, keys = [], []
        for text in batch["text"]:
            n, k = [], []
            for i, line in enumerate(visible_lines(text), 1):
                key = known.get(line, 0)
                if key == 0:
                    key = line_key(line)
                    if len(line) < 200:
                        if len(known) > 50_000:
                            known.clear()
                        known[line] = key
                if key is not None:
                    n.append(i)
                    k.append(key)
            numbers.append(n)
            keys.append(k)
        yield batch[["pos", "source", "item"]].assign(line_no=numbers, line_key=keys)


def repeated_lines(
    rows: DataFrame,
    *,
    pos: str = "pos",
    source: str = "source_id",
    item: str = "id",
    text: str = "raw_text",
    least_items: int = 10,
    least_share: float = 0.1,
) -> DataFrame:
    """(pos, source, line_no, line_key, block): every occurrence of a line that is repeated within its source.

    Two lines are the same when the letters a–z of their visible text agree. Lines are the nodes, neighbouring lines of a
    text (those without letters skipped) the edges of a graph for each source, weighted by the number of distinct ``item``
    values that have them. Nodes and edges of high support stay: at least ``least_items`` items and at least
    ``least_share`` of the source's. ``block`` names the connected component
    by its least node.

    Rows with a null source belong to no source and are left out; a null item counts as none; a null or empty text has no
    lines but its item counts. Repeated rows of an item count once and each have their occurrences. No rows give no rows.

    A source may hold any share of the rows: occurrences are counted by (source, line, item) first and are never grouped by
    source. A source has at most 1/least_share times its mean number of lines for each item as repeated lines, so the
    table that meets the occurrences stays small beside the texts.
    """
    chosen = rows.select(
        F.col(pos).cast("long").alias("pos"),
        F.col(source).cast("string").alias("source"),
        F.xxhash64(F.col(item).cast("string")).alias("item"),
        F.col(item).isNotNull().alias("has_item"),
        F.col(text).cast("string").alias("text"),
    ).where("source is not null")
    items = chosen.where("has_item").groupBy("source").agg(F.count_distinct("item").alias("items"))
    keyed = (
        chosen.where("text is not null and text <> ''")
        .select("pos", "source", F.when(F.col("has_item"), F.col("item")).alias("item"), "text")
        .mapInPandas(_keys, KEYED)
    )
    keyed = materialize(keyed, "line-keys")
    enough = (F.col("support") >= least_items) & (F.col("support") >= F.col("items") * least_share)

    support = (
        keyed.where("item is not null")
        .select("source", "item", F.explode(F.array_distinct("line_key")).alias("line_key"))
        .distinct()
        .groupBy("source", "line_key")
        .agg(F.count("*").alias("support"))
        .where(F.col("support") >= least_items)
    )
    nodes = materialize(support.join(items, "source").where(enough).select("source", "line_key"), "repeated")

    neighbours = F.transform(
        F.filter(F.sequence(F.lit(1), F.greatest(F.size("line_key") - 1, F.lit(1))), lambda i: i < F.size("line_key")),
        lambda i: F.struct(F.element_at("line_key", i).alias("a"), F.element_at("line_key", i + 1).alias("b")),
    )
    pairs = (
        keyed.where("item is not null and size(line_key) > 1")
        .select("source", "item", F.explode(F.array_distinct(neighbours)).alias("e"))
        .select("source", "item", "e.a", "e.b")
        .join(nodes.withColumnRenamed("line_key", "a"), ["source", "a"], "left_semi")
        .join(nodes.withColumnRenamed("line_key", "b"), ["source", "b"], "left_semi")
        .distinct()
        .groupBy("source", "a", "b")
        .agg(F.count("*").alias("support"))
    )
    edges = pairs.join(items, "source").where(enough)
    name = lambda k: F.concat_ws("|", F.col("source"), F.hex(F.col(k)))
    groups = connected_groups(edges.select(name("a").alias("a"), name("b").alias("b")), "a", "b")
    blocks = nodes.withColumn("record_key", name("line_key")).join(groups, "record_key", "left")
    blocks = blocks.select("source", "line_key", F.coalesce("group_key", "record_key").alias("block"))
    lines = keyed.select("pos", "source", F.explode(F.arrays_zip("line_no", "line_key")).alias("l"))
    return lines.select("pos", "source", "l.line_no", "l.line_key").join(blocks, ["source", "line_key"])


def strip_repeated_lines(rows: DataFrame, repeated: DataFrame, *, pos: str = "pos", text: str = "raw_text") -> DataFrame:
    """``rows`` with a column ``kept_text``: the text without the lines listed in ``repeated`` (pos, line_no).

    All columns of ``rows`` stay (a column named kept_text is replaced); a null text stays null; ``pos`` must be unique.
    """
    gone = repeated.groupBy(F.col("pos").alias("_pos")).agg(F.collect_set(F.col("line_no").cast("int")).alias("_gone"))
    joined = rows.join(gone, rows[pos] == gone["_pos"], "left")
    lines = F.split(F.col(text), "\n", -1)
    kept = F.filter(lines, lambda line, i: ~F.array_contains(F.coalesce("_gone", F.array().cast("array<int>")), i + 1))
    return joined.withColumn("kept_text", F.array_join(kept, "\n")).drop("_pos", "_gone")
