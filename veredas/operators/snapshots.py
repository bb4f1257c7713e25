"""Change events between consecutive full snapshots of a table, by gaps and islands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veredas.functions.text import collapse_spaces


def compare_form(value: Column) -> Column:
    """Trimmed, spaces collapsed, case ignored, null as empty."""
    return F.lower(collapse_spaces(F.coalesce(value.cast("string"), F.lit(""))))


def snapshot_changes(
    rows: DataFrame,
    *,
    snapshot: str,
    key: Column,
    fields: list[str],
    version: list[Column],
    labels: tuple[str, str, str] = ("added", "removed", "changed"),
) -> DataFrame:
    """(snapshot, record_key, change, changed_fields) for every key added, removed or changed between two snapshots.

    Of several rows of a key in one snapshot the one with the greatest ``version`` (a list of columns, compared in order,
    nulls least) holds; rows with equal versions are told apart by their compared values, so repeated rows change
    nothing. Rows with a null snapshot or key are no records. ``changed_fields`` has the names in alphabetical order joined
    by ``,``. There are no events for the first snapshot; one snapshot or an empty table gives no rows.

    The rows of one key are one island for as long as snapshots follow each other and the row hash stays; islands'
    starts, ends and adjacencies are the events. Versions are chosen by a partial aggregate, so a key that is delivered
    many times is reduced before it is shuffled; after that a key has one row per snapshot at most.
    """
    names = sorted(fields)
    form = F.struct(*[compare_form(F.col(n)).alias(n) for n in names])
    picked = rows.select(
        F.col(snapshot).cast("string").alias("_snap"),
        key.alias("_key"),
        F.struct(*[v.alias(f"v{i}") for i, v in enumerate(version)], form.alias("f")).alias("_row"),
    ).where("_snap is not null and _key is not null")
    latest = picked.groupBy("_snap", "_key").agg(F.max("_row").alias("_row"))
    latest = latest.select("_snap", "_key", F.col("_row.f").alias("f"), F.xxhash64("_row.f").alias("h"))
    # One row per snapshot: small, whatever the table's size.
    calendar = rows.select(F.col(snapshot).cast("string").alias("_snap")).where("_snap is not null").distinct()
    order = Window.orderBy("_snap")
    calendar = calendar.select("_snap", F.row_number().over(order).alias("i"), F.lead("_snap").over(order).alias("next_snap"))
    dated = latest.join(calendar, "_snap")
    of_key = Window.partitionBy("_key").orderBy("i")
    marked = dated.select(
        "*",
        F.lag(F.struct("i", "h", "f")).over(of_key).alias("p"),
        F.lead("i").over(of_key).alias("n"),
    )
    adjacent = F.coalesce(F.col("p.i") == F.col("i") - 1, F.lit(False))
    changed = F.array_join(
        F.filter(
            F.array(*[F.when(~F.col(f"f.{n}").eqNullSafe(F.col(f"p.f.{n}")), F.lit(n)) for n in names]),
            lambda x: x.isNotNull(),
        ),
        ",",
    )
    start = F.when(
        ~adjacent & (F.col("i") > 1), F.struct(F.col("_snap").alias("s"), F.lit(labels[0]).alias("c"), F.lit("").alias("l"))
    ).when(
        adjacent & (F.col("p.h") != F.col("h")),
        F.struct(F.col("_snap").alias("s"), F.lit(labels[2]).alias("c"), changed.alias("l")),
    )
    gone = F.col("next_snap").isNotNull() & (F.col("n").isNull() | (F.col("n") != F.col("i") + 1))
    end = F.when(gone, F.struct(F.col("next_snap").alias("s"), F.lit(labels[1]).alias("c"), F.lit("").alias("l")))
    events = marked.select(F.col("_key"), F.explode(F.filter(F.array(start, end), lambda x: x.isNotNull())).alias("e"))
    return events.select(
        F.col("e.s").alias("snapshot"),
        F.col("_key").alias("record_key"),
        F.col("e.c").alias("change"),
        F.col("e.l").alias("changed_fields"),
    )
