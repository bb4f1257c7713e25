"""Words and closing words of many texts in a few passes over an array of their characters, by the rules of ``fold_py`` and ``WORD``."""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np

from veredas.functions.text import fold_py

#: Characters looked at together; a longer text is parted where a line begins.
CHUNK = 1 << 17
#: A sentence's closing word is looked for among so many last characters.
CLOSING = 40
# A sentence ends with the first of these, maybe the second, and white space; or with white space that holds a line break.
ENDERS, CLOSERS = ".?!…", "\"'”’»)]"
IN_WORD, SPACE, LINE, ENDER, CLOSER, NEW = 1, 2, 4, 8, 16, 128
#: In place of a folded character: a mark that folding drops, one that depends on its neighbours or becomes several, one not met yet.
MARK, HARD, UNKNOWN = 0xFFFFFFFD, 0xFFFFFFFE, 0xFFFFFFFF
LINE_START = re.compile(r"\n(?=\S)")
BASE = 0xD6E8FEB86659FD93


def _fold_of(code: int) -> int:
    found = fold_py(chr(code))
    # A capital sigma is folded by its place in the word, and other marks than dropped ones may change places.
    if code == 0x3A3 or len(found) > 1 or any(unicodedata.combining(c) for c in found):
        return HARD
    return ord(found) if found else MARK


def _kind_of(code: int) -> int:
    char = chr(code)
    return (
        IN_WORD * char.isalnum() | SPACE * char.isspace() | LINE * (char == "\n") | ENDER * (char in ENDERS) | CLOSER * (char in CLOSERS)
    )


class Characters:
    """Folded forms and kinds by code point, found out as characters are met, and the powers that words are hashed with."""

    def __init__(self) -> None:
        self.folds = np.full(sys.maxunicode + 1, UNKNOWN, dtype=np.uint32)
        self.kinds = np.full(sys.maxunicode + 1, NEW, dtype=np.uint8)
        self.powers = self.inverses = np.ones(1, dtype=np.uint64)

    def folded(self, codes: np.ndarray) -> np.ndarray:
        out = self.folds[codes]
        if out.max() == UNKNOWN:
            for code in np.unique(codes[out == UNKNOWN]).tolist():
                self.folds[code] = _fold_of(code)
            out = self.folds[codes]
        return out

    def kinds_of(self, codes: np.ndarray) -> np.ndarray:
        out = self.kinds[codes]
        if out.max() >= NEW:
            for code in np.unique(codes[out == NEW]).tolist():
                self.kinds[code] = _kind_of(code)
            out = self.kinds[codes]
        return out

    def sums(self, codes: np.ndarray) -> np.ndarray:
        """Sums of the characters before each place, times BASE to the power of their places."""
        if len(self.powers) <= len(codes):
            count = len(codes) + CHUNK
            for name, factor in (("powers", BASE), ("inverses", pow(BASE, -1, 1 << 64))):
                all_of = np.full(count, factor, dtype=np.uint64)
                all_of[0] = 1
                setattr(self, name, np.multiply.accumulate(all_of))
        out = np.zeros(len(codes) + 1, dtype=np.uint64)
        np.cumsum(codes * self.powers[: len(codes)], out=out[1:])
        return out

    def hashes(self, sums: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """A hash of the characters of each range, wherever it lies; 0 for empty ones."""
        out = (sums[stops] - sums[starts]) * self.inverses[starts]
        out ^= out >> np.uint64(32)
        out *= np.uint64(0xBF58476D1CE4E5B9)
        out ^= out >> np.uint64(29)
        return out


CHARACTERS = Characters()


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)


def _folded(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Characters of the folded texts with one other before, between and after them, and the places of these."""
    codes = CHARACTERS.folded(_codes("\n" + "\n".join(texts) + "\n"))
    most = codes.max()
    if most == HARD:
        texts = [fold_py(text) for text in texts]
        codes = _codes("\n" + "\n".join(texts) + "\n")
    bounds = np.concatenate([[0], np.cumsum([len(text) + 1 for text in texts])])
    if most == MARK:
        kept = codes != MARK
        bounds -= np.cumsum(~kept)[bounds]
        codes = codes[kept]
    return codes, bounds


def _runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs start and stop; the first and last are none."""
    edges = np.flatnonzero(mask[1:] != mask[:-1]) + 1
    return edges[::2], edges[1::2]


def _start_of(runs: tuple[np.ndarray, np.ndarray], stops: np.ndarray) -> np.ndarray:
    """Where the run that stops at each place starts; the place itself where none does."""
    if not len(runs[0]):
        return stops
    at = np.minimum(np.searchsorted(runs[1], stops), len(runs[1]) - 1)
    return np.where(runs[1][at] == stops, runs[0][at], stops)


def _sentence_ends(kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where what separates sentences starts and stops."""
    starts, stops = _runs((kinds & SPACE) != 0)
    broken = np.zeros(len(starts), dtype=bool)
    broken[np.searchsorted(starts, np.flatnonzero(kinds & LINE), side="right") - 1] = True
    some = np.flatnonzero(broken | ((kinds[starts - 1] & (ENDER | CLOSER)) != 0))
    starts, stops, broken = starts[some], stops[some], broken[some]
    closed = _start_of(_runs((kinds & CLOSER) != 0), starts)
    ended = _start_of(_runs((kinds & ENDER) != 0), closed)
    found = (ended < closed) | broken
    return np.where(ended < closed, ended, starts)[found], stops[found]


def _scan(texts: list[str], complete: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    codes, bounds = _folded(texts)
    kinds = CHARACTERS.kinds_of(codes)
    kinds[bounds] = 0
    sums = CHARACTERS.sums(codes)
    starts, stops = _runs((kinds & IN_WORD) != 0)
    words = CHARACTERS.hashes(sums, starts, stops)
    counts = np.diff(np.searchsorted(starts, bounds))
    if not len(words):
        return words, counts, words

    first, after = _sentence_ends(kinds)
    ends = np.concatenate([first, bounds[1:]])
    order = np.argsort(ends, kind="stable")
    begins = np.concatenate([after, bounds[1:] + 1])[order]
    begins = np.concatenate([[1], begins[:-1]])
    counted = np.concatenate([np.ones(len(first), dtype=bool), complete])[order]
    ends = ends[order]
    last = np.searchsorted(stops, ends, side="right") - 1
    counted &= (last >= 0) & (starts[last] >= begins) & (stops[last] > ends - CLOSING)
    last, ends = last[counted], ends[counted]
    return words, counts, CHARACTERS.hashes(sums, np.maximum(starts[last], ends - CLOSING), stops[last])


def _parts(texts: list[str]) -> Iterator[tuple[int, str, bool]]:
    """(number of the text, part, whether it is the text's last)."""
    for number, text in enumerate(texts):
        at = 0
        while len(text) - at > CHUNK and (found := LINE_START.search(text, at + CHUNK)):
            yield number, text[at : found.end()], False
            at = found.end()
        yield number, text[at:], True


def scan(texts: list[str], complete: list[bool]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, how many each text has, and hashes of the words that close sentences; the last sentence of a text
    counts where the text is complete."""
    counts = np.zeros(len(texts), dtype=np.int64)
    words, closes, parts, held = [], [], [], 0

    def flush() -> None:
        numbers = [number for number, _, _ in parts]
        found, count, closing = _scan([part for _, part, _ in parts], np.asarray([last and complete[number] for number, _, last in parts]))
        np.add.at(counts, numbers, count)
        words.append(found)
        closes.append(closing)
        parts.clear()

    for part in _parts(texts):
        parts.append(part)
        held += len(part[1])
        if held >= CHUNK:
            flush()
            held = 0
    if parts:
        flush()
    none = np.empty(0, dtype=np.uint64)
    return np.concatenate([none, *words]), counts, np.concatenate([none, *closes])


def word_hashes(words: list[str]) -> np.ndarray:
    """The hash of each of these folded words, as :func:`scan` has it."""
    codes = _codes("".join(words))
    stops = np.cumsum([len(word) for word in words], dtype=np.int64)
    starts = np.concatenate([[0], stops[:-1]]) if len(stops) else stops
    return CHARACTERS.hashes(CHARACTERS.sums(codes), starts, stops)
