"""Near duplicates among texts: word sets, classes of equal ones, and the similar pairs of different ones."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veredas.functions.text import words_py
from veredas.llm.leaks import WordHashes
from veredas.operators.set_join import similar_sets
from veredas.session import discard, materialize


def _word_hashes(texts: pd.Series) -> pd.Series:
    hashes = WordHashes()
    return pd.Series([np.unique(hashes.of(words_py(t)).astype(np.int64)) for t in texts])


def word_set(*texts: Column) -> Column:
    """Sorted distinct 64-bit hashes of the words of all texts together; in Arrow batches, where folding and splitting cost least."""
    joined = F.concat_ws(" ", *[F.coalesce(t.cast("string"), F.lit("")) for t in texts])
    # Not pushed into filters on its result, which would evaluate it twice.
    return F.pandas_udf(_word_hashes, "array<long>").asNondeterministic()(joined)


def near_duplicates(
    rows: DataFrame, *, pos: str, texts: list[str | Column], kind: Column | None = None, threshold: float = 0.8
) -> tuple[DataFrame, DataFrame]:
    """(members, links) of all rows whose word sets have similarity of at least ``threshold``.

    ``members`` is (kind, pos, class_pos): rows of equal word sets are one class, named by its least pos. ``links`` is
    (kind, class_a, class_b), class_a < class_b: every pair of different classes that is similar enough. Together they hold
    every pair without writing out the copies' pairs. Only rows of one ``kind`` are compared. Rows without words (null or
    empty texts) are in neither; so are rows with a null pos; ``pos`` must be unique within a kind; extra columns
    are ignored; an empty table gives two empty ones.
    """
    texts = [F.col(t) if isinstance(t, str) else t for t in texts]
    kind = F.lit("") if kind is None else kind
    made = rows.select(kind.alias("kind"), F.col(pos).cast("long").alias("pos"), *[t.alias(f"t{i}") for i, t in enumerate(texts)])
    made = made.where("pos is not null and kind is not null")
    made = made.select("kind", "pos", word_set(*[F.col(f"t{i}") for i in range(len(texts))]).alias("tokens")).where("size(tokens) > 0")
    made = materialize(made.withColumn("same", F.md5(F.array_join(F.col("tokens").cast("array<string>"), " "))), "word-sets")
    classes = made.groupBy("kind", "same").agg(F.min("pos").alias("class_pos"))
    members = made.select("kind", "same", "pos").join(classes, ["kind", "same"]).select("kind", "pos", "class_pos")
    members = materialize(members, "members")
    leaders = members.where("pos = class_pos").select("kind", "pos")
    # Ids must be unique over all kinds.
    id_of = F.xxhash64("kind", "pos")
    sets = made.join(leaders, ["kind", "pos"], "left_semi").select(
        id_of.alias("id"), "kind", "pos", (F.xxhash64("kind") % 1_000_003).alias("salt"), "tokens"
    )
    sets = materialize(sets, "leaders")
    discard(made)
    named = sets.select("id", "kind", "pos")
    found = similar_sets(sets, threshold, rare_alone=True)
    links = (
        found.join(named.select(F.col("id").alias("id_a"), "kind", F.col("pos").alias("x")), "id_a")
        .join(named.select(F.col("id").alias("id_b"), F.col("pos").alias("y")), "id_b")
        .select("kind", F.least("x", "y").alias("class_a"), F.greatest("x", "y").alias("class_b"))
    )
    return members, links


def all_pairs(members: DataFrame, links: DataFrame) -> DataFrame:
    """(kind, pos_a, pos_b): the pairs of rows behind ``near_duplicates``' result; as many as there are."""
    a = members.select("kind", F.col("class_pos").alias("class_a"), F.col("pos").alias("x"))
    b = members.select("kind", F.col("class_pos").alias("class_b"), F.col("pos").alias("y"))
    across = links.join(a, ["kind", "class_a"]).join(b, ["kind", "class_b"])
    across = across.select("kind", F.least("x", "y").alias("pos_a"), F.greatest("x", "y").alias("pos_b"))
    same = a.join(b.withColumnRenamed("class_b", "class_a"), ["kind", "class_a"]).where("x < y")
    return across.unionByName(same.select("kind", F.col("x").alias("pos_a"), F.col("y").alias("pos_b")))
