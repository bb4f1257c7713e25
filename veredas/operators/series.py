"""Operators over ordered series: as-of joins, forward fill, streaks; hot keys are split into blocks of the order column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def carry_forward(rows: DataFrame, by: list[str], order: str, value: Column, name: str, block: Column) -> DataFrame:
    """``rows`` with ``name``: the latest non-null ``value`` up to the row, by ``order`` within ``by``.

    ``block`` must not fall as ``order`` rises. Each block is filled by itself; the last value of each block, one row a block, is carried
    over to the next ones: a key with any share of the rows is as many tasks as it has blocks. Ties of the order column
    are taken as they come; make it unique for a defined result.
    """
    marked = rows.withColumns({"_v": value, "_b": block})
    inside = Window.partitionBy(*by, "_b").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = marked.where("_v is not null").groupBy(*by, "_b").agg(F.max_by("_v", order).alias("_l"))
    blocks = marked.select(*by, "_b").distinct().join(last, [*by, "_b"], "left")
    before = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(*by, "_b", F.last("_l", ignorenulls=True).over(before).alias("_c"))
    filled = marked.withColumn("_f", F.last("_v", ignorenulls=True).over(inside)).join(blocks, [*by, "_b"])
    return filled.withColumn(name, F.coalesce("_f", "_c")).drop("_v", "_b", "_f", "_c")


def asof_join(left: DataFrame, right: DataFrame, *, by: list[str], left_at: str, right_at: str, value: str, name: str, block: int = 3_600 * 24 * 366) -> DataFrame:
    """``left`` with ``name``: the right ``value`` of the same key with the latest ``right_at`` up to ``left_at``; null if there is none.

    Both sides become one ordered series and the value is carried forward, so nothing is paired. Of right rows at one time
    the greatest value holds. Times are timestamps; ``block`` seconds of a key are one task.
    """
    points = right.groupBy(*by, F.col(right_at).alias("_at")).agg(F.max(F.struct(F.col(value).alias("v"))).alias("_p"))
    packed = left.select(*by, F.col(left_at).alias("_at"), F.struct(*[F.col(c) for c in left.columns]).alias("_row"))
    empty = points.select(*by, "_at", F.lit(None).cast(packed.schema["_row"].dataType).alias("_row"), "_p")
    both = packed.withColumn("_p", F.lit(None).cast(empty.schema["_p"].dataType)).unionByName(empty)
    # At one time the right side's point comes first.
    both = both.withColumn("_o", F.struct(F.col("_at"), F.col("_row").isNotNull()))
    seconds = F.floor(F.unix_timestamp("_at") / block)
    filled = carry_forward(both, by, "_o", F.col("_p"), "_hit", seconds)
    return filled.where("_row is not null").select("_row.*", F.col("_hit.v").alias(name))


def trailing_streak(rows: DataFrame, key: str, at: str, calendar: DataFrame) -> DataFrame:
    """(key, streak): how many of the calendar's last dates a key has been without a row. Rows with a null date don't count."""
    last = rows.groupBy(key).agg(F.max(at).alias("last_at"))
    days = calendar.select(F.col(at).alias("last_at"), F.lit(1).alias("day")).distinct()
    # One row a date: small, whatever the table's size.
    days = days.unionByName(last.select("last_at", F.lit(0).alias("day")).distinct()).groupBy("last_at").agg(F.max("day").alias("day"))
    later = Window.orderBy(F.desc("last_at")).rowsBetween(Window.unboundedPreceding, -1)
    days = days.select("last_at", F.coalesce(F.sum("day").over(later), F.lit(0)).alias("streak"))
    return last.join(days, "last_at").select(key, "streak")


def blocked_places(rows: DataFrame, by: list[str], block: Column, order: list[Column], name: str = "place") -> DataFrame:
    """``rows`` with ``name``: their place within ``by``, from 1, by ``block`` and then ``order``, which must be total within a block.

    Only a block is ranked together; what the earlier blocks of its group hold, one row a block, is added, so a group may be any share of the rows.
    """
    marked = rows.withColumn("_b", block)
    inside = F.row_number().over(Window.partitionBy(*by, "_b").orderBy(*order)).cast("long")
    counts = marked.groupBy(*by, "_b").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select(*by, "_b", before.alias("_c"))
    return marked.withColumn("_i", inside).join(counts, [*by, "_b"]).withColumn(name, F.col("_i") + F.col("_c")).drop("_b", "_i", "_c")
