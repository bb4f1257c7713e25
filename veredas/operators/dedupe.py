"""First-wins de-duplication by keys, with an explicit input order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_by_key(rows: DataFrame, key: Column, order: list[Column]) -> DataFrame:
    """One whole row for each non-null key: the least by ``order``, which must be total. A partial aggregate, so hot keys shrink before the shuffle."""
    ranked = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], F.struct(*[F.col(c) for c in rows.columns]).alias("row"))
    picked = rows.select(key.alias("_key"), ranked.alias("_r")).where("_key is not null").groupBy("_key").agg(F.min("_r").alias("_r"))
    return picked.select("_r.row.*")


def dedupe_two_stage(items: DataFrame, url_key: Column, title_key: Column, trust: Column) -> DataFrame:
    """``items`` with slot_pos: one row per URL, then one per source and title.

    Of a URL's rows the first of the highest trust stays, in the slot of the first one; rows without URL are told apart by source
    and title. Of the rows that are left, the first slot of each source and title stays. ``items`` needs a unique pos.
    """
    keyed = items.withColumns({"_u": F.coalesce(url_key, F.concat(F.lit("__no_url__:"), title_key)), "_t": title_key})
    row = F.struct(*[F.col(c) for c in items.columns], F.col("_t"))
    by_url = keyed.groupBy("_u").agg(
        F.min("pos").alias("slot_pos"), F.min(F.struct((-trust).alias("t"), F.col("pos").alias("p"), row.alias("row"))).alias("_r")
    )
    kept = by_url.select("slot_pos", "_r.row.*")
    return first_by_key(kept, F.col("_t"), [F.col("slot_pos")]).drop("_t")
