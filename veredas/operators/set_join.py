"""Exact similarity joins of sets of 64-bit numbers: universe-partition pigeonhole with segment subsets."""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veredas.session import materialize

#: Size bands of the smaller set of a pair: (least size, number of segments its words are hashed into). They grow eightfold,
#: so that most sets have all their partners in one band, and a set has keys in proportion to its size.
BANDS = [(1, 0), (3, 1), (8, 2), *((24 << 3 * k, 8 << 3 * k) for k in range(12))]
EDGES = [least for least, _ in BANDS]
#: A word is frequent if it is in at least this share of the sets: there are at most mean size / share of them.
FREQUENT_SHARE = 0.001
#: Where rare words are keys by themselves, only pairs of frequent words are left to the segments: so many of eight do.
OF_EIGHT = 3
#: Rows of one key that are paired where they meet; those of longer runs go through a join that is split by its rows.
RUN = 1 << 17
#: Rows of one key from which they are compared in blocks of rows, and the rows of either side in a block.
BLOCKED, BLOCK = 64, (128, 512)
#: Pairs that are looked at together.
CHUNK = 1 << 20
#: Sets whose keys are made together.
SETS_AT_ONCE = 2_000


def least_overlap(a: int | np.ndarray, b: int | np.ndarray, threshold: float) -> np.ndarray:
    """Shared words that two sets of these sizes need."""
    return np.ceil(threshold / (1 + threshold) * (np.asarray(a) + np.asarray(b)) - 1e-9).astype(np.int64)


def band_of(size: int) -> int:
    return bisect_right(EDGES, size) - 1


@dataclass(frozen=True)
class Order:
    """A total order of words, rare ones first; ``ranks`` are those of the frequent ones. Any order gives the same pairs."""

    hashes: np.ndarray
    ranks: np.ndarray

    def rank(self, tokens: np.ndarray) -> np.ndarray:
        rank = np.zeros(len(tokens), dtype=np.int64)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, tokens), len(self.hashes) - 1)
            hit = self.hashes[at] == tokens
            rank[hit] = self.ranks[at[hit]]
        return rank


def word_order(sets: DataFrame, count: int, share: float = FREQUENT_SHARE) -> Order:
    """Counts all words of all sets; brings the frequent ones, of which there can be mean size / ``share``, to the driver."""
    least = max(3, math.ceil(count * share))
    frequent = (
        sets.select(F.explode("tokens").alias("w")).groupBy("w").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    ).toPandas()
    frequent = frequent.sort_values("w")
    ranks = frequent["n"].rank(method="min").to_numpy(dtype=np.int64)
    return Order(frequent["w"].to_numpy(dtype=np.int64), ranks)


def together(groups: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All (i, j), i < j, of equal ``groups``, of which equal ones stand together; in arrays by their distance."""
    i, d = np.arange(len(groups) - 1), 1
    while len(i := i[groups[i] == groups[i + d]]):
        yield i, i + d
        d += 1
        i = i[i + d < len(groups)]


KEY = ("key", "id", "size", "small")
#: Columns of the parity in key rows, by its bits.
PARITY = {128: ("low", "high"), 256: ("low", "high", "third", "fourth")}
KEYS = "key long, id long, size int, small boolean, low long, high long"
LONG_KEYS = f"{KEYS}, third long, fourth long"


def signatures(
    flat: np.ndarray, sizes: np.ndarray, salts: np.ndarray, order: Order, threshold: float, rare_alone: bool = False
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(set's index, key, small) of the keys of many sets, whose words stand one after the other in ``flat``.

    With n segments, any n + 1 shared words have two in one segment. A pair that shares ``least_overlap`` words has its first
    n + 1 shared words, in the global order, among each set's first size − least_overlap + n + 1: so the two sets
    share a segment subset of two of those words (without segments: one word). A set has the keys that it needs as the larger
    one of a pair, in the band of each possible smaller one; ``small`` marks those that it needs as the smaller one.

    With ``rare_alone`` a word that is not frequent is a key by itself. Of the first n + 1 shared words one is rare, or two frequent
    ones are in one segment; so there are few segments, and the sets with enough rare words have hardly a key of frequent ones.
    """
    if threshold < 0.4:
        raise ValueError("a threshold below 0.4 does not guarantee a common key")
    owner = np.repeat(np.arange(len(sizes)), sizes)
    rank = order.rank(flat)
    by = np.lexsort((flat, rank, owner))
    flat, rare = flat[by], rank[by] == 0
    at = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    least = np.maximum(1, np.ceil(threshold * sizes - 1e-9).astype(np.int64))
    found = []
    for band in range(band_of(int(least.min(initial=1))), band_of(int(sizes.max(initial=1))) + 1):
        low, segments = BANDS[band]
        if rare_alone and segments >= 8:
            segments = segments * OF_EIGHT // 8
        high = EDGES[band + 1] if band + 1 < len(EDGES) else 1 << 62
        used = (sizes >= low) & (least < high)
        prefix = np.where(used, sizes - least_overlap(sizes, np.maximum(low, least), threshold) + segments + 1, 0)
        own = np.where((sizes >= low) & (sizes < high), sizes - least_overlap(sizes, sizes, threshold) + segments + 1, 0)
        chosen = np.flatnonzero(at < prefix[owner])
        if not len(chosen):
            continue
        who, place, word = owner[chosen], at[chosen], flat[chosen].view(np.uint64)
        base = (salts[who].astype(np.uint64) * np.uint64(31) + np.uint64(band + 1)) * np.uint64(0x9E3779B97F4A7C15)
        alone = rare[chosen] if rare_alone and segments else np.full(len(chosen), not segments)
        if alone.any():
            found.append((who[alone], base[alone] ^ word[alone] * np.uint64(0xBF58476D1CE4E5B9), (place < own[who])[alone]))
            who, place, word, base = who[~alone], place[~alone], word[~alone], base[~alone]
        if not len(who):
            continue
        cell = who * segments + ((word >> np.uint64(7)) % np.uint64(segments)).astype(np.int64)
        by = np.argsort(cell, kind="stable")
        who, place, word, base, cell = who[by], place[by], word[by], base[by], cell[by]
        for i, j in together(cell):
            less, more = np.minimum(word[i], word[j]), np.maximum(word[i], word[j])
            found.append((who[i], less * np.uint64(0xBF58476D1CE4E5B9) + more * np.uint64(0x94D049BB133111EB) + base[i], np.maximum(place[i], place[j]) < own[who[i]]))
    if not found:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), np.empty(0, dtype=bool)
    who, key, small = (np.concatenate(x) for x in zip(*found))
    key ^= key >> np.uint64(29)
    return who, (key & np.uint64((1 << 63) - 1)).astype(np.int64), small


def parities(flat: np.ndarray, sizes: np.ndarray, bits: int, shift: int) -> np.ndarray:
    """For each set ``bits`` // 64 numbers of 64 bits, of which each word flips one bit: as many differ between two sets as words differ, at most."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    at = owner * bits + ((flat >> shift) & (bits - 1))
    odd = (np.bincount(at, minlength=len(sizes) * bits) & 1).astype(np.uint8).reshape(len(sizes), bits)
    return np.packbits(odd, axis=1).view(np.int64).reshape(len(sizes), bits // 64)


def _parts(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, np.ndarray, np.ndarray]]:
    for batch in batches:
        for start in range(0, len(batch), SETS_AT_ONCE):
            part = batch.iloc[start : start + SETS_AT_ONCE]
            sizes = np.fromiter(map(len, part["tokens"]), dtype=np.int64, count=len(part))
            yield part, np.concatenate([np.empty(0, dtype=np.int64), *part["tokens"]]).astype(np.int64), sizes


def key_rows(order: Order, threshold: float, rare_alone: bool = False, bits: int = 128) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """mapInPandas body: one row per key of each set (id, salt, tokens), with a parity of 128 or 256 bits."""

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, flat, sizes in _parts(batches):
            who, key, small = signatures(flat, sizes, part["salt"].to_numpy(dtype=np.int64), order, threshold, rare_alone)
            sketch = parities(flat, sizes, bits, 0)
            yield pd.DataFrame(
                {
                    "key": key,
                    "id": part["id"].to_numpy(dtype=np.int64)[who],
                    "size": sizes.astype(np.int32)[who],
                    "small": small,
                }
                | {c: sketch[who, i] for i, c in enumerate(PARITY[bits])}
            )

    return emit


WIDE = 4
SKETCH = "id long, size int, " + ", ".join(f"w{i} long" for i in range(WIDE))


def wide_sketches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """mapInPandas body: size and a wide parity of each set (id, tokens)."""
    for part, flat, sizes in _parts(batches):
        wide = parities(flat, sizes, 64 * WIDE, 7)
        yield pd.DataFrame({"id": part["id"].to_numpy(dtype=np.int64), "size": sizes.astype(np.int32)} | {f"w{i}": wide[:, i] for i in range(WIDE)})


PAIR, HOT, ASK = 0, 1, 2
MET = f"what byte, other long, {KEYS}"
LONG_MET = f"what byte, other long, {LONG_KEYS}"


def key_frame(what: int, x: dict[str, np.ndarray], keep: np.ndarray | slice) -> pd.DataFrame:
    return pd.DataFrame({"what": np.int8(what), "other": np.int64(0)} | {c: v[keep] for c, v in x.items()})


def _parity(columns: Iterable[str]) -> list[str]:
    return [c for c in columns if c in PARITY[256]]


def _close(x: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
    """Whether the pairs of key rows may be similar: the smaller one has the key as such, and neither sizes nor parities rule it out."""
    a, b = x["size"][i], x["size"][j]
    small = np.where(a < b, x["small"][i], np.where(a > b, x["small"][j], x["small"][i] & x["small"][j]))
    keep = np.flatnonzero(small & (np.minimum(a, b) >= np.maximum(a, b) * threshold - 1e-9) & (x["id"][i] != x["id"][j]))
    i, j = i[keep], j[keep]
    # The count of a negative number's bits is that of its absolute value.
    differ = sum(np.bitwise_count((x[c][i] ^ x[c][j]).view(np.uint64)).astype(np.int64) for c in _parity(x))
    return keep[differ <= (a[keep] + b[keep]) * ((1 - threshold) / (1 + threshold)) + 1e-9]


def _runs(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of equal keys."""
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return starts, np.diff(np.append(starts, len(key)))


def _blocks(x: dict[str, np.ndarray], start: int, end: int, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, j), i < j, of one run in order of size that may be similar by the first 128 bits; i has the key as the smaller one."""
    size, low, high = (x[c][start:end] for c in ("size", "low", "high"))
    smalls = np.flatnonzero(x["small"][start:end])
    rows, columns = BLOCK
    for at in range(0, len(smalls), rows):
        i = smalls[at : at + rows]
        most = int(size[i[-1]])
        last = int(np.searchsorted(size, most / threshold + 1e-6, side="right"))
        for first in range(int(i[0]) + 1, last, columns):
            j = slice(first, min(first + columns, last))
            allowed = np.minimum((most + size[j]) * ((1 - threshold) / (1 + threshold)) + 1e-6, 255).astype(np.uint8)
            differ = np.bitwise_count((low[i, None] ^ low[None, j]).view(np.uint64)) + np.bitwise_count((high[i, None] ^ high[None, j]).view(np.uint64))
            a, b = np.nonzero(differ <= allowed)
            a, b = i[a], b + first
            later = b > a
            yield a[later] + start, b[later] + start


def _pairs(x: dict[str, np.ndarray], threshold: float) -> pd.DataFrame:
    """The distinct (id, other), id < other, of rows that share a key and may be similar; rows of a key stand together.

    In order of size the earlier row of a pair is the smaller one, so only rows that have the key as such look for later ones.
    """
    starts, lengths = _runs(x["key"])
    used = np.repeat((lengths > 1) & np.logical_or.reduceat(x["small"], starts), lengths)
    run = np.repeat(np.arange(len(lengths)), lengths)[used]
    x = {c: v[used] for c, v in x.items()}
    by = np.lexsort((x["size"], run))
    x = {c: v[by] for c, v in x.items()}
    if not len(run):
        return pd.DataFrame()
    starts, lengths = _runs(run)
    ends, blocked = np.repeat(starts + lengths, lengths), lengths >= BLOCKED
    less, more, waiting = [], [], []
    size = 0

    def look() -> None:
        nonlocal size
        i, j = (np.concatenate(y) for y in zip(*waiting))
        keep = _close(x, i, j, threshold)
        a, b = x["id"][i[keep]], x["id"][j[keep]]
        less.append(np.minimum(a, b))
        more.append(np.maximum(a, b))
        waiting.clear()
        size = 0

    def short() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        i, d = np.flatnonzero(x["small"] & ~np.repeat(blocked, lengths)), 1
        while len(i := i[i + d < ends[i]]):
            i = i[x["size"][i] >= x["size"][i + d] * threshold - 1e-9]
            yield i, i + d
            d += 1

    found = [short(), *(_blocks(x, s, s + n, threshold) for s, n in zip(starts[blocked].tolist(), lengths[blocked].tolist()))]
    for i, j in chain.from_iterable(found):
        waiting.append((i, j))
        size += len(i)
        if size >= CHUNK:
            look()
    if waiting:
        look()
    if not less:
        return pd.DataFrame()
    return pd.DataFrame({"id": np.concatenate(less), "other": np.concatenate(more)}).drop_duplicates()


def meet(batches: Iterator[dict[str, np.ndarray]], threshold: float) -> Iterator[pd.DataFrame]:
    """Pairs of the key rows that share a key, from batches in which rows of a key stand together.

    A run of more than ``RUN`` rows is handed on as it is (``HOT``), as the whole run is never held.
    """
    held: dict[str, np.ndarray] | None = None
    hot: int | None = None
    for x in batches:
        if held is not None and len(held["key"]):
            x = {c: np.concatenate([held[c], x[c]]) for c in x}
        key = x["key"]
        if not len(key):
            continue
        if hot is not None:
            end = int(np.argmax(key != hot)) if (key != hot).any() else len(key)
            if end:
                yield key_frame(HOT, x, slice(0, end))
                x = {c: v[end:] for c, v in x.items()}
                key = x["key"]
            if not len(key):
                held = None
                continue
            hot = None
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        lengths = np.diff(np.append(starts, len(key)))
        long = np.repeat(lengths > RUN, lengths)
        if long.any():
            yield key_frame(HOT, x, long)
            if long[-1]:
                hot = int(key[-1])
        whole = ~long
        if not long[-1]:
            whole[starts[-1] :] = False
            held = {c: v[starts[-1] :] for c, v in x.items()}
        else:
            held = None
        yield _found({c: v[whole] for c, v in x.items()}, threshold)
    if held is not None:
        yield _found(held, threshold)


def _found(x: dict[str, np.ndarray], threshold: float) -> pd.DataFrame:
    pairs = _pairs(x, threshold) if len(x["key"]) > 1 else pd.DataFrame()
    n = len(pairs)
    own = {"what": np.full(n, PAIR, dtype=np.int8), "other": pairs["other"].to_numpy() if n else np.empty(0, dtype=np.int64)}
    blank = {c: np.zeros(n, dtype=v.dtype) for c, v in x.items()}
    return pd.DataFrame(own | blank | ({"id": pairs["id"].to_numpy()} if n else {}))


def key_columns(batch: pd.DataFrame) -> dict[str, np.ndarray]:
    return {c: batch[c].to_numpy() for c in (*KEY, *_parity(batch.columns))}


def may_match(a: str, b: str, threshold: float, sketch: tuple[str, ...] = ("low", "high")) -> Column:
    """Bound on the sizes and on the words that differ, from the rows ``a`` and ``b``."""
    one, two = F.col(f"{a}.size"), F.col(f"{b}.size")
    differ = sum((F.bit_count(F.col(f"{a}.{c}").bitwiseXOR(F.col(f"{b}.{c}"))) for c in sketch), F.lit(0))
    return (F.least(one, two) >= F.greatest(one, two) * threshold - 1e-9) & (differ <= (one + two) * ((1 - threshold) / (1 + threshold)) + 1e-9)


def smaller_has_key(a: str, b: str) -> Column:
    """Whether two key rows of one key stand for a pair: the smaller set has the key as the smaller one, of equal sets both."""
    one, two = F.col(f"{a}.size"), F.col(f"{b}.size")
    return (F.col(f"{a}.small") | (one > two)) & (F.col(f"{b}.small") | (two > one))


def overlap_holds(a: str, b: str, threshold: float) -> Column:
    """Exact test on two token arrays."""
    shared = F.size(F.array_intersect(a, b))
    return shared * (1 + threshold) >= (F.size(a) + F.size(b)) * threshold - 1e-9


def hot_pairs(hot: DataFrame, threshold: float) -> DataFrame:
    """(id, other), id < other, of the rows of the keys with long runs, by a join that adaptive execution splits.

    One side has only the rows that have the key as the smaller set."""
    one, two = hot.where("small").alias("a"), hot.hint("merge").alias("b")
    met = one.join(two, F.col("a.key") == F.col("b.key")).where("a.size < b.size or (a.size = b.size and b.small and a.id < b.id)")
    met = met.where(may_match("a", "b", threshold, tuple(_parity(hot.columns))))
    return met.select(F.least("a.id", "b.id").alias("id"), F.greatest("a.id", "b.id").alias("other"))


def candidates(keys: DataFrame, threshold: float) -> DataFrame:
    """(id, other), id < other: the pairs of sets that share a key and that neither sizes nor parities rule out.

    Key rows go through one exchange, whichever role they have, and are paired where they meet, in order of the key.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return meet(map(key_columns, batches), threshold)

    schema = LONG_MET if "third" in keys.columns else MET
    met = materialize(keys.repartition("key").sortWithinPartitions("key").mapInPandas(run, schema), "met")
    pairs = met.where(F.col("what") == PAIR).select("id", "other")
    return pairs.unionByName(hot_pairs(met.where(F.col("what") == HOT), threshold)).distinct()


def near_pairs(pairs: DataFrame, sketches: DataFrame, threshold: float) -> DataFrame:
    """(id_a, id_b): the pairs (id, other) that a wide parity doesn't rule out."""
    mine, theirs = sketches.alias("x"), sketches.alias("y")
    return (
        pairs.alias("p").join(mine, F.col("p.id") == F.col("x.id"))
        .join(theirs, F.col("p.other") == F.col("y.id"))
        .where(may_match("x", "y", threshold, tuple(f"w{i}" for i in range(WIDE))))
        .select(F.col("p.id").alias("id_a"), F.col("p.other").alias("id_b"))
    )


def similar_sets(sets: DataFrame, threshold: float, order: Order | None = None, exact: bool = True, rare_alone: bool = False) -> DataFrame:
    """(id_a, id_b), id_a < id_b: all pairs of distinct sets of equal salt with similarity of at least ``threshold``.

    ``sets`` is a written table (id, salt, tokens) of different non-empty sets. Candidates meet by key, so a pair is
    compared only if it shares a segment subset; a 128-bit parity sketch in the key rows bounds the difference before
    anything else is shuffled, a wider one before the sets are, and the survivors are verified on their whole sets. No key is
    collected: the rows of a hot one are a join that adaptive execution splits. Without ``exact`` the last step is left to the caller.
    ``rare_alone`` is for sets of many words: rare ones are keys by themselves, and the sketch in the key rows has 256 bits.
    """
    order = order or word_order(sets, sets.count())
    body, schema = (key_rows(order, threshold, True, 256), LONG_KEYS) if rare_alone else (key_rows(order, threshold), KEYS)
    keys = sets.select("id", "salt", "tokens").mapInPandas(body, schema)
    sketches = materialize(sets.select("id", "tokens").mapInPandas(wide_sketches, SKETCH), "sketches")
    near = near_pairs(candidates(keys, threshold), sketches, threshold)
    if not exact:
        return near
    a = sets.select(F.col("id").alias("id_a"), F.col("tokens").alias("tokens_a"))
    b = sets.select(F.col("id").alias("id_b"), F.col("tokens").alias("tokens_b"))
    return near.join(a, "id_a").join(b, "id_b").where(overlap_holds("tokens_a", "tokens_b", threshold)).select("id_a", "id_b")
