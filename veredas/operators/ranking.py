"""Top-k per group, quotas, and greedy diversification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_group(rows: DataFrame, by: list[str], order: list[Column], limit: int, name: str = "rank") -> DataFrame:
    """The first ``limit`` rows of each group by a total order. Ranks are limited before the shuffle (WindowGroupLimit)."""
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(name) <= limit)


def quota_sample(rows: DataFrame, kind: str, quotas: dict[str, int], order: list[Column], total: int) -> DataFrame:
    """At most ``quotas[kind]`` rows of each kind, then the best others until there are ``total``; column pick is 1 for quota rows, else 2."""
    most = max([total, *quotas.values()])
    best = top_per_group(rows, [kind], order, most, "_rank")
    limits = F.create_map(*[x for k, n in quotas.items() for x in (F.lit(k), F.lit(n))])
    marked = best.withColumn("pick", F.when(F.col("_rank") <= F.coalesce(F.element_at(limits, F.col(kind)), F.lit(0)), 1).otherwise(2))
    return marked.orderBy("pick", *order).limit(total).drop("_rank")


def diversified_order(rows: DataFrame, key: str, score: str, sources: str, top_n: int = 10, share: float = 0.3) -> DataFrame:
    """(key, score, pick, place) of all rows: the ``top_n`` placed ones first (pick 1), then the deferred ones by score (pick 2, place null).

    Rows are taken by score, then key. A row is passed over only if every source of it has had its share of the places, and counts for
    each of them; null sources don't count, and a row without sources is never passed over. Rows whose sources have all had their
    share can never be placed later, so they are filtered out and only as many of the others as may fill the places come to the driver:
    at most ``top_n`` times ``LOOK`` rows a round, each round placing at least one. The order of the deferred ones is that of score and key.
    """
    most = max(1, int(top_n * share))
    distinct = F.array_sort(F.array_distinct(F.filter(F.coalesce(sources, F.array().cast("array<string>")), lambda s: s.isNotNull())))
    best = rows.select(F.col(key).alias("key"), F.col(score).alias("score"), distinct.alias("sources"))
    order = [F.desc_nulls_last("score"), F.asc("key")]
    used: dict[str, int] = {}
    placed: list = []
    left = best
    while len(placed) < top_n:
        look = top_n * LOOK
        taken = left.orderBy(*order).limit(look).collect()
        for row in taken:
            if len(placed) < top_n and not (row.sources and all(used.get(s, 0) >= most for s in row.sources)):
                placed.append(row.key)
                for s in row.sources:
                    used[s] = used.get(s, 0) + 1
        if len(taken) < look:
            break
        full = F.array(*[F.lit(s) for s, n in sorted(used.items()) if n >= most]).cast("array<string>")
        open_to = (F.size("sources") == 0) | (F.size(F.array_except("sources", full)) > 0)
        left = best.where(open_to & ~F.col("key").isin(placed))
    places = F.array_position(F.array(*[F.lit(k) for k in placed]).cast(f"array<{best.schema['key'].dataType.simpleString()}>"), F.col("key"))
    return best.select("key", "score", F.when(places > 0, 1).otherwise(2).alias("pick"), F.nullif(places, F.lit(0)).cast("long").alias("place"))


#: Rows for each place that are looked at in one round.
LOOK = 64


def diversified_top(rows: DataFrame, key: str, score: str, sources: str, top_n: int = 10, share: float = 0.3) -> DataFrame:
    """(key, place): the placed rows of :func:`diversified_order`."""
    return diversified_order(rows, key, score, sources, top_n, share).where("pick = 1").select("key", "place")
