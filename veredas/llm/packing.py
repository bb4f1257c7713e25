"""Texts packed into containers of a fixed number of tokens, by large-item matching and best fit."""

from __future__ import annotations

import base64
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veredas.session import materialize

CAPACITY = 2048
#: Pieces of one size that get their ranks together.
RANKED_TOGETHER = 200_000


def vocabulary_path(name: str = "byte_bpe_multi_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def token_counter(path: str | None, pattern: str | None = None) -> Callable[[list[str]], list[int]]:
    """Counts tokens by the ranks in a tiktoken file; the file is read where it is used."""
    import tiktoken

    if path is None or pattern is None:
        import public_tokenizers

        path, pattern = path or vocabulary_path(), pattern or public_tokenizers.PATTERN
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    encoding = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return lambda texts: [len(encoding.encode_ordinary(t)) for t in texts]


_COUNTERS: dict = {}


def count_tokens(path: str | None, pattern: str | None) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key = (path, pattern)
        if key not in _COUNTERS:
            _COUNTERS[key] = token_counter(path, pattern)
        for batch in batches:
            sizes = _COUNTERS[key]([t or "" for t in batch["text"]])
            yield pd.DataFrame({"doc_id": batch["doc_id"], "tokens": np.asarray(sizes, dtype=np.int64)})

    return emit


@dataclass(slots=True)
class Run:
    """``bins`` containers filled alike: (size, how many in each)."""

    bins: int
    gap: int
    items: tuple[tuple[int, int], ...]


def plan_bins(histogram: dict[int, int], capacity: int) -> list[Run]:
    """Fills containers for all items, known by the number of items of each size alone.

    Items above a third of the capacity go first, from the largest: each shares a container with the largest other that fits, and
    no third of them can. Smaller items go, from the largest, to the container with the least gap that holds them, as often
    as they fit; where none is left, new ones are opened. Every step moves all items of one size through all
    containers filled alike, so the work and the result are bounded by the number of sizes, not by the number of items.
    """
    left = {s: n for s, n in histogram.items() if n > 0}
    runs: dict[int, list[Run]] = defaultdict(list)
    gaps: list[int] = []

    def add(run: Run) -> None:
        if run.bins <= 0:
            return
        if run.gap not in runs or not runs[run.gap]:
            insort(gaps, run.gap)
        runs[run.gap].append(run)

    large = sorted(s for s in left if 3 * s > capacity)
    while large:
        s = large[-1]
        at = bisect_left(large, capacity - s + 1) - 1
        t = large[at] if at >= 0 else None
        if t is None:
            n = left[s]
            add(Run(n, capacity - s, ((s, 1),)))
            left[s] = 0
        elif t == s:
            n = left[s] // 2
            add(Run(n, capacity - 2 * s, ((s, 2),)))
            if left[s] % 2:
                lower = large[at - 1] if at > 0 else None
                if lower is not None:
                    add(Run(1, capacity - s - lower, ((s, 1), (lower, 1))))
                    left[lower] -= 1
                else:
                    add(Run(1, capacity - s, ((s, 1),)))
            left[s] = 0
        else:
            n = min(left[s], left[t])
            add(Run(n, capacity - s - t, ((s, 1), (t, 1))))
            left[s] -= n
            left[t] -= n
        large = [x for x in large if left[x] > 0]
    for s in sorted((s for s in left if 3 * s <= capacity), reverse=True):
        n = left[s]
        while n > 0:
            at = bisect_left(gaps, s)
            if at == len(gaps):
                each = capacity // s
                full, rest = divmod(n, each)
                add(Run(full, capacity - each * s, ((s, each),)))
                if rest:
                    add(Run(1, capacity - rest * s, ((s, rest),)))
                break
            gap = gaps[at]
            run = runs[gap].pop()
            if not runs[gap]:
                gaps.pop(at)
            each = gap // s
            full = min(run.bins, n // each)
            n -= full * each
            rest = n if full < run.bins and n else 0
            add(Run(full, gap - each * s, (*run.items, (s, each))))
            if rest:
                add(Run(1, gap - rest * s, (*run.items, (s, rest))))
                n = 0
            add(Run(run.bins - full - bool(rest), gap, run.items))
    return [run for group in runs.values() for run in group]


def slots(runs: list[Run]) -> dict[int, np.ndarray]:
    """For each size rows (first rank, first container, items in each), ordered by rank."""
    found: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    next_rank: dict[int, int] = defaultdict(int)
    first = 0
    for run in runs:
        for size, each in run.items:
            found[size].append((next_rank[size], first, each))
            next_rank[size] += run.bins * each
        first += run.bins
    return {s: np.asarray(x, dtype=np.int64) for s, x in found.items()}


PLACED = "container_id long, doc_id long, part int, first_token long, tokens long"


def place(table: dict[int, np.ndarray], offset: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            container = np.zeros(len(batch), dtype=np.int64)
            sizes, ranks = batch["tokens"].to_numpy(), batch["rank"].to_numpy()
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                own = table[int(size)]
                slot = np.searchsorted(own[:, 0], ranks[at], side="right") - 1
                container[at] = own[slot, 1] + (ranks[at] - own[slot, 0]) // own[slot, 2]
            yield batch.assign(container_id=container + offset)[["container_id", "doc_id", "part", "first_token", "tokens"]]

    return emit


def pack_texts(
    documents: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    vocabulary: str | None = None,
    pattern: str | None = None,
) -> DataFrame:
    """(container_id, doc_id, part, first_token, tokens): every document's tokens, each in one container of ``capacity`` tokens.

    Only a text larger than a container is split: into full containers and a rest that is packed like any other text (part 0, 1, …;
    first_token is the part's offset). ``doc_id`` must be unique. Null or empty texts have no tokens and are listed with a null
    container; rows with a null ``doc_id`` are left out; ties are broken by the hash of the ids, the same on every run.

    The plan is made from the histogram of sizes, which has at most ``capacity`` rows whatever the corpus; items get their
    places by their rank among those of their size. Ranks come from counts of (size, hash block), so that neither one size
    with most of the rows nor the whole corpus is ever sorted in one task.
    """
    chosen = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    sized = materialize(
        chosen.where("doc_id is not null").mapInPandas(count_tokens(vocabulary, pattern), "doc_id long, tokens long"), "sizes"
    )
    whole = sized.where(F.col("tokens") >= capacity)
    full = whole.select(
        "doc_id", F.explode(F.sequence(F.lit(0), F.floor(F.col("tokens") / capacity).cast("int") - 1)).alias("part")
    ).select("doc_id", "part", (F.col("part").cast("long") * capacity).alias("first_token"), F.lit(capacity).cast("long").alias("tokens"))
    rest = sized.select(
        "doc_id",
        F.floor(F.col("tokens") / capacity).cast("int").alias("part"),
        (F.col("tokens") - F.col("tokens") % capacity).alias("first_token"),
        (F.col("tokens") % capacity).alias("tokens"),
    )
    empty = sized.where("tokens = 0").select(
        F.lit(None).cast("long").alias("container_id"), "doc_id", F.lit(0).alias("part"), F.lit(0).cast("long").alias("first_token"), "tokens"
    )
    pieces = full.unionByName(rest.where("tokens > 0"))
    histogram = pieces.groupBy("tokens").count().toPandas()
    plan = plan_bins(dict(zip(histogram["tokens"].tolist(), histogram["count"].tolist())), capacity)
    total = int(histogram["count"].sum())
    blocks = max(1, -(-total // RANKED_TOGETHER))
    blocked = pieces.withColumn("block", F.pmod(F.xxhash64("doc_id", "part"), F.lit(blocks)))
    before = Window.partitionBy("tokens").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocked.groupBy("tokens", "block").count().select(
        "tokens", "block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset")
    )
    inside = Window.partitionBy("tokens", "block").orderBy("doc_id", "part")
    ranked = blocked.withColumn("place", F.row_number().over(inside) - 1).join(offsets, ["tokens", "block"])
    ranked = ranked.select("doc_id", "part", "first_token", "tokens", (F.col("place") + F.col("offset")).alias("rank"))
    return ranked.mapInPandas(place(slots(plan), 0), PLACED).unionByName(empty)
