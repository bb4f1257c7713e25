"""Evaluation items inside a corpus: size-partitioned MinHash containment search, verified by exact containment."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veredas.functions.text import words_py
from veredas.session import materialize

SPAN, WIDTH = 12, 5
#: Item windows whose MinHashes are broadcast as they are; more are broadcast as a filter of so many bits, whatever their number.
WINDOWS_AT_ONCE, FILTER_BITS = 500_000, 1 << 28
STEP = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """64-bit hashes of words, remembered."""

    def __missing__(self, word: str) -> int:
        if len(self) > 300_000:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word)
        return found

    def of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash for each run of ``width`` words."""
    count = len(hashes) - width + 1
    if count < 1:
        return np.empty(0, dtype=np.uint64)
    total = np.zeros(count, dtype=np.uint64)
    for i in range(width):
        total = total * STEP + hashes[i : i + count]
    total ^= total >> np.uint64(31)
    total *= np.uint64(0xBF58476D1CE4E5B9)
    return total ^ (total >> np.uint64(29))


def window_minima(hashes: np.ndarray, span: int, width: int) -> np.ndarray:
    """MinHash of each window of ``span`` words: the least of its shingles of ``width`` words."""
    one = shingles(hashes, width)
    each = span - width + 1
    if len(one) < each:
        return np.empty(0, dtype=np.uint64)
    if each == 1:
        return one
    return np.lib.stride_tricks.sliding_window_view(one, each).min(axis=1)


def size_classes(words: int, span: int, width: int) -> tuple[int, int]:
    """(window, shingle width) for items of this many words: short items are one window of their own size."""
    window = min(words, span)
    return window, min(width, window)


WINDOW = "item_id long, size int, minimum long, passage string"


def item_windows(span: int, width: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for batch in batches:
            out = []
            for item, text in zip(batch["item_id"], batch["text"]):
                words = words_py(text)
                if not words:
                    continue
                window, w = size_classes(len(words), span, width)
                for at, m in enumerate(window_minima(hashes.of(words), window, w).astype(np.int64).tolist()):
                    out.append((item, window, m, " ".join(words[at : at + window])))
            yield pd.DataFrame(out, columns=["item_id", "size", "minimum", "passage"])

    return emit


FOUND = "doc_id long, size int, passage string"


def corpus_hits(index: dict[int, Callable[[np.ndarray], np.ndarray]], width: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """mapInPandas body: the windows of each document whose MinHash may be that of a window of some item of the same size."""

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for batch in batches:
            out = []
            for doc, text in zip(batch["doc_id"], batch["text"]):
                words = words_py(text)
                own = hashes.of(words)
                for size, known in index.items():
                    minima = window_minima(own, size, min(width, size))
                    for i in np.flatnonzero(known(minima)).tolist() if len(minima) else ():
                        out.append((doc, size, " ".join(words[i : i + size])))
            yield pd.DataFrame(out, columns=["doc_id", "size", "passage"]).drop_duplicates()

    return emit


def among(wanted: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    """Whether numbers are in a sorted array."""
    return lambda minima: wanted[np.minimum(np.searchsorted(wanted, minima), len(wanted) - 1)] == minima


def in_filter(packed: np.ndarray, size: int) -> Callable[[np.ndarray], np.ndarray]:
    """Whether numbers may be among those that a filter was made of: a number and its size set one bit."""
    bits = np.uint64(8 * len(packed) - 1)

    def look(minima: np.ndarray) -> np.ndarray:
        at = (minima ^ np.uint64(size << 20)) & bits
        return (packed[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1

    return look


def filter_of(minima: DataFrame, bits: int) -> np.ndarray:
    """The filter over (size, minimum), made in parts of 32,768 bits; ``bits`` / 8 bytes however many numbers there are."""
    at = F.col("minimum").bitwiseXOR(F.shiftleft(F.col("size").cast("long"), 20)).bitwiseAND(F.lit(bits - 1))
    parts = minima.groupBy(F.shiftright(at, 15).alias("part")).agg(F.bitmap_construct_agg(at.bitwiseAND(F.lit((1 << 15) - 1))).alias("bits"))
    packed = np.zeros(max(bits // 8, 4096), dtype=np.uint8)
    for part, held in parts.toLocalIterator():
        packed[part * 4096 : (part + 1) * 4096] = np.frombuffer(held, dtype=np.uint8)
    return packed


def find_leaks(
    documents: DataFrame,
    items: DataFrame,
    *,
    doc_id: str = "doc_id",
    doc_text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    span: int = SPAN,
    width: int = WIDTH,
    windows_at_once: int = WINDOWS_AT_ONCE,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """(doc_id, item_id): all pairs where the document's words hold ``span`` consecutive words of the item, or all its words if fewer.

    Items are partitioned by size; each window of an item (its whole text, if shorter) has a MinHash over its shingles of ``width``
    words, and so has each window of that size of a document: a leaked passage is a window with the same MinHash.
    Hits are verified by comparing the words themselves. The items' MinHashes are broadcast, or beyond ``windows_at_once`` of them a
    filter of ``filter_bits`` bits (32 MB): so any number of items takes one pass over the corpus, and driver and executors hold no more.

    Null or empty texts and texts without words match nothing; rows with null ids are left out; repeated ids or rows give each
    pair once; empty tables give no rows; other columns are ignored.
    """
    windows = (
        items.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text"))
        .where("item_id is not null and text is not null")
        .mapInPandas(item_windows(span, width), WINDOW)
    )
    windows = materialize(windows, "item-windows")
    corpus = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(doc_text).cast("string").alias("text"))
    corpus = corpus.where("doc_id is not null and text is not null")
    minima = windows.select("size", "minimum").distinct()
    count = minima.count()
    sizes = [r[0] for r in minima.select("size").distinct().collect()]  # span at most
    if count <= windows_at_once:
        block = minima.toPandas()
        index = {int(size): among(np.sort(part["minimum"].to_numpy(dtype=np.int64).view(np.uint64))) for size, part in block.groupby("size")}
    else:
        packed = filter_of(minima, filter_bits)
        index = {size: in_filter(packed, size) for size in sizes}
    hits = corpus.mapInPandas(corpus_hits(index, width), FOUND)
    passages = windows.select("item_id", "size", "passage").distinct()
    return hits.join(passages, ["size", "passage"]).select("doc_id", "item_id").distinct()


def leak_report(leaks: DataFrame, items: DataFrame, *, item_id: str = "item_id") -> DataFrame:
    """(item_id, documents): for each item, in how many documents it leaked; 0 where it didn't."""
    counts = leaks.groupBy("item_id").agg(F.count("*").alias("documents"))
    ids = items.select(F.col(item_id).cast("long").alias("item_id")).where("item_id is not null").distinct()
    return ids.join(counts, "item_id", "left").select("item_id", F.coalesce("documents", F.lit(0)).alias("documents"))
