"""Texts that break off: near copies by MinHash banding and alignment, else by how the text closes."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veredas.functions.text import WORD, fold_py
from veredas.llm.leaks import shingles
from veredas.llm.scanning import CHUNK, scan, word_hashes
from veredas.session import materialize

WIDTH, SIMILARITY = 5, 0.8
BANDS, ROWS = 16, 5
COMPLETE, OPEN, BY_DESIGN, NAMES, POINT = 0, 1, 2, 3, 4
#: Characters by which a text's end is found in its copies; bits of the filter of such ends.
TAIL, BITS = 48, 1 << 24
#: Shingles that a near copy of a text shorter than TAIL has at most: 24 words make 20, and 20 / SIMILARITY is 25.
SHORT = 25

# Marks of omission and debris of a transfer at the end of a text.
OMISSION = re.compile(
    r"(?:\s*(?:…|\.\.\.|\[(?:…|\.\.\.)\]|\((?:…|\.\.\.)\)|\(?(?:leer|ver|lea|read|leia|ler) (?:más|mas|more|mais)\)?|(?:siga|sigue|seguir|continue) (?:leyendo|reading)))+\s*\Z",
    re.I,
)
DEBRIS = re.compile(r"(?:\ufffd|[\x00-\x08\x0b\x0c\x0e-\x1f]|<|&#?[a-zA-Z0-9]{1,8}|&)\s*\Z")
OPEN_TAG = re.compile(r"<[a-zA-Z/!][^<>]*\Z")
TERMINAL = re.compile(r"[.?!。！？][\"'”’»›)\]]*\Z")
# Words that a point shortens: those before a capital, and those before a number.
TITLES = "ee|dd|rr|sr|sra|srta|dr|dra|ing|lic|gral|cnel|prof|arq|mons|mr|mrs"
ABBREVIATIONS = TITLES + "|art|arts|n[uú]m|n[uú]ms|nro|p[aá]g|p[aá]gs|p|pp|p[aá]rr|inc|lit|vol|cap|exp|tel|av|cra"
TITLE_POINT = re.compile(rf"(?<![^\W_])(?:{TITLES})\.\Z", re.I)
SHORTENED = re.compile(rf"(?<![^\W_])(?:{ABBREVIATIONS})\.\Z", re.I)
MAYBE_POINT = re.compile(rf"(?:\d|(?<![^\W_])(?:{ABBREVIATIONS}|[^\W\d_]))\.\Z", re.I)
LINK = re.compile(r"(?:https?://|www\.)\S+\Z", re.I)
LABEL = re.compile(r"[^\W\d_]\w*(?: \w+)?: \S+(?: \S+){0,3}\Z")
SMALL_WORDS = frozenset("de del la las los el y e da do das dos of the and for".split())


def strip_end(text: str) -> tuple[str, bool]:
    """The text without white space, omission marks and debris at its end, and whether there were any marks or debris."""
    marked = False
    text = text.rstrip()
    while True:
        match = OMISSION.search(text, max(0, len(text) - 48)) or DEBRIS.search(text, max(0, len(text) - 12))
        if not match:
            at = text.rfind("<", max(0, len(text) - 2000))
            match = OPEN_TAG.match(text, at) if at >= 0 else None
        if not match:
            return text, marked
        text, marked = text[: match.start()].rstrip(), True


def is_name_line(line: str) -> bool:
    """Capitalised words only, small ones between them: a signature or an office."""
    parts = line.split(None, 8)
    return (
        2 <= len(parts) <= 8
        and parts[0][:1].isupper()
        and parts[-1][:1].isupper()
        and all(p[:1].isupper() and p.isalpha() or p in SMALL_WORDS for p in parts)
    )


def closing(text: str) -> tuple[int, str, str, str]:
    """(state, last line's first word, closing word, last 48 characters) of how the text ends."""
    return _closing(*strip_end(text))


def _closing(kept: str, marked: bool) -> tuple[int, str, str, str]:
    if not kept:
        return COMPLETE, "", "", ""
    line = kept[kept.rfind("\n") + 1 :].strip()
    start = WORD.match(line)
    folded = WORD.findall(fold_py(line[-40:]))
    first, last = start.group() if start else "", folded[-1] if folded else ""
    tail = kept[-TAIL:]
    if TERMINAL.search(kept[-8:]):
        return POINT if MAYBE_POINT.search(kept[-12:]) else COMPLETE, first, last, tail
    if marked:
        return OPEN, first, last, tail
    if kept[-1] in "»”" or kept[-1] in ")]" and (line[0] in "([" or TERMINAL.search(kept[-9:-1])):
        return COMPLETE, first, last, tail
    if LINK.match(line) or "\t" in line or " | " in line or LABEL.match(line):
        return BY_DESIGN, first, last, tail
    if is_name_line(line):
        return NAMES, first, last, tail
    if len(kept) < 80 and len(WORD.findall(kept)) <= 3 and not any(c.isdigit() for c in kept):  # a placeholder instead of a text
        return BY_DESIGN, first, last, tail
    return OPEN, first, last, tail


def _coefficients() -> np.ndarray:
    return np.random.default_rng(20_011).integers(0, 1 << 31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


A = _coefficients()


def minima(one: np.ndarray) -> np.ndarray:
    """The MinHash signature of these shingles: the least of each product of 32 bits."""
    short = (one >> np.uint64(32)).astype(np.uint32)
    least = np.full(BANDS * ROWS, 0xFFFFFFFF, dtype=np.uint32)
    for start in range(0, len(short), 1024):
        least = np.minimum(least, (short[start : start + 1024, None] * A).min(axis=0))
    return least


def bands_of(signatures: np.ndarray) -> np.ndarray:
    """A key for each band of each signature."""
    rows = signatures.reshape(-1, BANDS, ROWS).astype(np.uint64)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), rows.shape[:2])
    for i in range(ROWS):
        keys = (keys ^ rows[:, :, i]) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(29)
    return keys.astype(np.int64)


ENDS = (
    "doc_id long, source string, size int, state int, first long, last long, tail string, tail_key long, bands array<long>, "
    "words array<long>, closes array<long>, totals array<long>"
)


def opening_key(word: str) -> int:
    """Words that open lines are counted beside the others, as they are written."""
    return xxhash.xxh64_intdigest(word, seed=1)


def tail_key(tail: bytes) -> int:
    """Hash of the last TAIL characters of a text, or of as many elsewhere, encoded with four bytes for each."""
    return xxhash.xxh64_intdigest(tail)


def _signed(values: list[int]) -> np.ndarray:
    return np.asarray(values, dtype=np.uint64).astype(np.int64)


def _shingles_before_marks(kept: str) -> int:
    words = WORD.findall(fold_py(kept))
    return len(set(zip(*[words[i:] for i in range(WIDTH)])))


def _blocks(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about CHUNK characters together."""
    start = held = 0
    for at, text in enumerate(texts, 1):
        held += len(text)
        if held >= CHUNK or at == len(texts):
            yield start, at
            start, held = at, 0


def _words_and_bands(texts: list[str], complete: list[bool]) -> tuple[np.ndarray, np.ndarray, list[int], list[np.ndarray]]:
    """Hashes of all words and of those that close sentences; each text's number of shingles and bands, none for texts of fewer words than a shingle."""
    words, counts, closes = scan(texts, complete)
    ends = np.cumsum(counts)
    runs = shingles(words, WIDTH)
    sizes, signatures = [], []
    for start, end in zip((ends - counts).tolist(), ends.tolist()):
        own = np.sort(runs[start : max(start, end - WIDTH + 1)])
        sizes.append(len(own) and 1 + int(np.count_nonzero(own[1:] != own[:-1])))
        if len(own):
            signatures.append(minima(own))
    keys = iter(bands_of(np.asarray(signatures, dtype=np.uint32)))
    return words, closes, sizes, [next(keys) if size else np.empty(0, dtype=np.int64) for size in sizes]


def _ends(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each text's ending, bands and number of shingles before marks; the batch's word counts, added up, go with its first row."""
    for batch in batches:
        opens, names = Counter(), Counter()
        rows, bands, firsts, lasts, tails, texts = [], [], [], [], [], batch["text"].tolist()
        every, closed = [np.empty(0, dtype=np.uint64)], [np.empty(0, dtype=np.uint64)]
        before_marks = {}
        for number, text in enumerate(texts):
            kept, marked = strip_end(text)
            if marked:
                before_marks[number] = _shingles_before_marks(kept)
            state, first, last, tail = _closing(kept, marked)
            for line in text.split("\n"):
                start = WORD.match(line)
                if start:
                    word = start.group()
                    opens[word] += 1
                    names[word] += is_name_line(line)
            firsts.append(opening_key(first))
            lasts.append(last)
            tails.append(tail_key(tail.encode("utf-32-le")))
            rows.append((state, tail))
        out = pd.DataFrame(rows, columns=["state", "tail"])
        # What may be cut is no evidence of how sentences close.
        complete, sizes = (out["state"] == COMPLETE).tolist(), []
        for start, end in _blocks(texts):
            words, closes, size, keys = _words_and_bands(texts[start:end], complete[start:end])
            every.append(words)
            closed.append(closes)
            sizes += size
            bands += keys
        out["size"] = [before_marks.get(number, size) for number, size in enumerate(sizes)]
        out["doc_id"], out["source"], out["bands"] = batch["doc_id"].to_numpy(), batch["source"].to_numpy(), bands
        out["first"], out["last"], out["tail_key"] = _signed(firsts), word_hashes(lasts).astype(np.int64), _signed(tails)
        # Words that close nothing here are counted too: they may close sentences of other batches.
        seen, totals = np.unique(np.concatenate(every), return_counts=True)
        # A longer word's last characters, where a sentence's end is looked at, may be no word themselves.
        ending, times = np.unique(np.concatenate(closed), return_counts=True)
        known = np.isin(ending, seen, assume_unique=True)
        closes = np.zeros(len(seen), dtype=np.int64)
        closes[np.searchsorted(seen, ending[known])] = times[known]
        parts = {
            "words": np.concatenate([seen.astype(np.int64), _signed([opening_key(w) for w in opens])]),
            "closes": np.concatenate([closes, np.asarray([names[w] for w in opens], dtype=np.int64)]),
            "totals": np.concatenate([totals, np.asarray(list(opens.values()), dtype=np.int64)]),
        }
        none = np.empty(0, dtype=np.int64)
        for name, values in parts.items():
            out[name] = [values, *[none] * (len(out) - 1)] if len(out) else []
        yield out[["doc_id", "source", "size", "state", "first", "last", "tail", "tail_key", "bands", "words", "closes", "totals"]]


def alignment(short: str, long: str) -> str:
    """How the shorter of two near copies ends against the longer: ``early`` inside a sentence or word, ``boundary``, ``end`` or
    ``none`` if they aren't near copies or the ends can't be aligned."""
    kept, _ = strip_end(short)
    other, _ = strip_end(long)
    one, two = (set(zip(*[w[i:] for i in range(WIDTH)])) for w in (WORD.findall(fold_py(kept)), WORD.findall(fold_py(other))))
    if not one or not two or len(one & two) < SIMILARITY * len(one | two):
        return "none"
    end = other.rfind(kept[-TAIL:])
    return "none" if end < 0 else _break_at(other, end + len(kept[-TAIL:]))


def _inner_point(before: str, after: str) -> bool:
    """Whether the point that ``before`` ends with belongs to an abbreviation or number, by how the text goes on."""
    if not MAYBE_POINT.search(before):
        return False
    if after[:1].isdigit() or after[:1].islower() or after[:1].isalpha() and before[-2].isalpha():
        return True
    start = after.lstrip(" ")[:1]
    return start.islower() or start.isdigit() and bool(SHORTENED.search(before)) or start.isalpha() and bool(TITLE_POINT.search(before))


def _break_at(other: str, end: int) -> str:
    """What kind of place ``end`` is in the text."""
    if end == len(other):
        return "end"
    if _inner_point(other[max(0, end - 12) : end], other[end : end + 12]):
        return "early"
    if TERMINAL.search(other[max(0, end - 8) : end]) or other[end : end + 1] == "\n":
        return "boundary"
    return "early"


def _filter_of(tails: DataFrame) -> np.ndarray:
    """A Bloom filter of one hash over the tail keys, BITS bits whatever the corpus."""
    at = F.col("tail_key").bitwiseAND(F.lit(BITS - 1))
    parts = tails.groupBy(F.shiftright(at, 15).alias("part")).agg(F.bitmap_construct_agg(at.bitwiseAND(F.lit((1 << 15) - 1))).alias("bits"))
    packed = np.zeros(BITS // 8, dtype=np.uint8)
    for part, bits in parts.collect():
        packed[part * 4096 : (part + 1) * 4096] = np.frombuffer(bits, dtype=np.uint8)
    return packed


def _going_on(packed: np.ndarray, widths: list[int]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """mapInPandas body: the places where a text goes on after the tail of another, the last of each tail, by the tail's key."""

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, size, text in zip(batch["doc_id"], batch["size"], batch["text"]):
                other, _ = strip_end(text)
                data = other.encode("utf-32-le")
                for width in (TAIL, *widths) if size <= SHORT else (TAIL,):
                    starts = range(0, len(data) - 4 * width + 1, 4)
                    keys = np.fromiter((tail_key(data[i : i + 4 * width]) for i in starts), dtype=np.uint64, count=len(starts))
                    bit = (keys & np.uint64(BITS - 1)).astype(np.int64)
                    hits = np.flatnonzero((packed[bit >> 3] >> (bit & 7)) & 1)
                    for key, at in dict(zip(keys[hits].astype(np.int64).tolist(), hits.tolist())).items():
                        kind = _break_at(other, at + width)
                        if kind != "end":
                            rows.append((key, doc_id, kind == "early"))
            yield pd.DataFrame(rows, columns=["tail_key", "other", "inside"])

    return emit


def _align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = [alignment(a, b) for a, b in zip(batch["short_text"], batch["long_text"])]
        yield pd.DataFrame({"doc_id": batch["doc_id"], "verdict": found})


def _verdicts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(doc_id, early, boundary) of the pairs (doc_id, other) whose alignment is one of these."""
    return (
        pairs.join(texts.withColumnRenamed("text", "short_text"), "doc_id")
        .join(texts.select(F.col("doc_id").alias("other"), F.col("text").alias("long_text")), "other")
        .select("doc_id", "short_text", "long_text")
        .mapInPandas(_align, "doc_id long, verdict string")
        .groupBy("doc_id")
        .agg(F.bool_or(F.col("verdict") == "early").alias("early"), F.bool_or(F.col("verdict") == "boundary").alias("boundary"))
        .where("early or boundary")
    )


def _copies(texts: DataFrame, ends: DataFrame, is_open: Column) -> DataFrame:
    """(doc_id, early, boundary): what the near copies in any bucket of an open text say about its end.

    Only texts that go on after the open text's tail can say anything, so members of a bucket meet by that tail. The longest of each
    size class goes first; texts it doesn't show as cut meet all others.
    """
    in_bands = F.explode("bands").alias("band")
    shared = ends.select(in_bands, is_open.alias("open")).groupBy("band").agg(F.count("*").alias("n"), F.bool_or("open").alias("open"))
    buckets = ends.select("doc_id", in_bands).join(shared.where("n > 1 and open").select("band"), "band").groupBy("doc_id").agg(F.collect_list("band").alias("bands"))
    members = materialize(ends.select("doc_id", "size", "tail", "tail_key", is_open.alias("open")).join(buckets, "doc_id"), "members")

    tails = members.where("open")
    lengths = tails.select(F.length("tail").alias("n")).where(F.col("n") < TAIL).distinct()
    scan = _going_on(_filter_of(tails), [n for (n,) in lengths.collect()])
    places = texts.join(members.select("doc_id", "size"), "doc_id").select("doc_id", "size", "text")
    places = places.mapInPandas(scan, "tail_key long, other long, inside boolean")

    # Near copies differ in their numbers of shingles by 1 / SIMILARITY at most, so their classes are the same or neighbours.
    size_class = F.floor(F.log("size") / float(np.log(1 / SIMILARITY)))
    others = places.join(members.select(F.col("doc_id").alias("other"), F.col("size").alias("other_size"), size_class.alias("class"), "bands"), "other")
    others = materialize(others.select("tail_key", in_bands, "class", "inside", "other_size", "other"), "copies-going-on")
    opened = tails.select("doc_id", "size", "tail_key", in_bands, F.explode(F.array(size_class - 1, size_class, size_class + 1)).alias("class"))
    near = (
        (F.col("doc_id") != F.col("other"))
        & (F.col("size") >= F.col("other_size") * SIMILARITY)
        & (F.col("other_size") >= F.col("size") * SIMILARITY)
    )
    key = ["tail_key", "band", "class"]
    longest = others.groupBy(*key, "inside").agg(F.max(F.struct("other_size", "other")).alias("top")).select(*key, "top.*")
    first = materialize(opened.join(longest, key).where(near).select("doc_id", "other").distinct(), "links")  # once its size is known, a small one spares the texts their shuffle
    found = materialize(_verdicts(first, texts), "verdicts")

    # A text shown as cut is settled; one that ends at a boundary can only be shown as cut by a copy that goes on inside a sentence.
    rest = (
        opened.join(others, key)
        .where(near)
        .join(found, "doc_id", "left")
        .where("not coalesce(early, false) and (inside or not coalesce(boundary, false))")
        .select("doc_id", "other")
        .distinct()
        .join(first, ["doc_id", "other"], "left_anti")
    )
    rest = materialize(rest, "further-links")
    both = found.unionByName(_verdicts(rest, texts))
    return both.groupBy("doc_id").agg(F.bool_or("early").alias("early"), F.bool_or("boundary").alias("boundary"))


def truncated_texts(
    documents: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    least_terminality: float = 0.9,
    least_support: int = 5,
) -> DataFrame:
    """(doc_id, source, truncated, evidence) for every document.

    ``evidence`` is ``copy`` where a near copy (five-word shingles, similarity of at least 0.8) goes on inside the
    sentence in which the text ends, or ends it just there; ``closing`` where the text's own end decides. By its own end a
    text is truncated if it closes neither with a full stop nor with a line that ends by design (link, table or label line,
    name, note in brackets or quotes, placeholder); omission marks and debris of a transfer are looked through. The
    words decide what looks alike: a line of names is a signature unless its first word opens ordinary lines, and an
    unpunctuated text is at its end if its closing word closes almost everywhere else in the corpus: the score is the word's share of
    closings among its other occurrences, counted over all texts but without the ends that are themselves in doubt.

    Banding links every text that has no full stop, or one that may belong to an abbreviation or number, to the texts of its buckets that go on after the text's last 48 characters: to the
    longest of each size class, and to all others if these don't show a cut. No bucket is collected. Null or empty texts are not truncated; a null
    ``doc_id`` is left out; ids must be unique; other columns are ignored; an empty table gives no rows.
    """
    chosen = documents.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.col(source).cast("string").alias("source"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    ).where("doc_id is not null")
    ends = materialize(chosen.mapInPandas(_ends, ENDS), "text-ends")
    counts = (
        ends.where("size(words) > 0")
        .select(F.explode(F.arrays_zip("words", "closes", "totals")).alias("c"))
        .groupBy(F.col("c.words").alias("word"))
        .agg(F.sum("c.closes").alias("closes"), F.sum("c.totals").alias("total"))
    )
    doubtful = ends.where(F.col("state") != COMPLETE)
    verdicts = _copies(chosen.select("doc_id", "text"), ends, F.col("state") != COMPLETE)

    opening = counts.select(F.col("word").alias("first"), F.col("closes").alias("o_closes"), F.col("total").alias("o_total"))
    ending = counts.select(F.col("word").alias("last"), F.col("closes").alias("e_closes"), F.col("total").alias("e_total"))
    scored = doubtful.join(opening, "first", "left").join(ending, "last", "left").join(verdicts, "doc_id", "left")
    # The record's own line and word are no evidence for it.
    ordinary_start = (F.col("o_total") - 1 >= least_support) & ((F.col("o_closes") - 1) < 0.2 * (F.col("o_total") - 1))
    usual_end = (F.col("e_total") - 1 >= least_support) & (F.col("e_closes") >= least_terminality * (F.col("e_total") - 1))
    own = F.when(F.col("state").isin(BY_DESIGN, POINT), F.lit(False)).when(
        F.col("state") == NAMES, F.coalesce(ordinary_start, F.lit(False))
    ).otherwise(~F.coalesce(usual_end, F.lit(False)))
    decided = F.when(F.col("early"), F.lit(True)).when(F.col("boundary"), F.lit(False)).otherwise(own)
    judged = scored.select(
        "doc_id",
        "source",
        decided.alias("truncated"),
        F.when(F.coalesce("early", F.lit(False)) | F.coalesce("boundary", F.lit(False)), "copy").otherwise("closing").alias("evidence"),
    )
    closed = ends.where(F.col("state") == COMPLETE).select("doc_id", "source", F.lit(False).alias("truncated"), F.lit("closing").alias("evidence"))
    return closed.unionByName(judged)


def truncation_rates(judged: DataFrame) -> DataFrame:
    """(source, documents, truncated, rate): how often each source truncates."""
    return judged.groupBy("source").agg(
        F.count("*").alias("documents"),
        F.count_if("truncated").alias("truncated"),
        (F.count_if("truncated") / F.count("*")).alias("rate"),
    )
