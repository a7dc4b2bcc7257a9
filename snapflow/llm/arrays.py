"""A batch of texts as flat numpy arrays: bytes, words, lines, windows and their 64-bit hashes.

Words are maximal runs of characters other than space and U+0009 to U+000D.  All of these are single
bytes in UTF-8, so words are found on the bytes and no text becomes a Python object.  Hashes are
polynomials over randomised byte values, finished by a mixer; equal words have equal hashes in every
task and session.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
BASE = U64(0x9E3779B97F4A7C15)
BASE_INVERSE = U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
SLICE_BYTES = 4 << 20  # so many bytes of text are worked on at once; one longer text is a slice of its own


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all output bits."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


BYTE_VALUES = mix(np.arange(1, 257, dtype=U64) * BASE) | U64(1)
_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base to the power 0 .. n - 1, modulo 2**64."""
    known = _powers.get(int(base))
    if known is None or len(known) < n:
        known = np.full(max(n, 1 << 16), base, U64)
        known[0] = 1
        known = np.cumprod(known, dtype=U64)
        if n <= SLICE_BYTES + (1 << 16):
            _powers[int(base)] = known
    return known[:n]


def member_table(chars: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[np.frombuffer(chars.encode("latin-1"), np.uint8)] = True
    return table


SEPARATOR = member_table(" \t\n\x0b\x0c\r")


class TextBatch:
    """Texts laid end to end; ``offsets[i]:offsets[i + 1]`` are the bytes of text i (null: none)."""

    def __init__(self, texts: pa.Array):
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = texts.buffers()[2]
        raw = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
        self.data = raw[offsets[0] : offsets[-1]] if len(texts) else raw[:0]
        self.offsets = offsets - offsets[0] if len(texts) else np.zeros(1, np.int64)
        self.size = len(texts)

    def per_text(self, mask: np.ndarray) -> np.ndarray:
        """How many bytes of each text are set in mask."""
        return counts_between(mask, self.offsets)

    def _runs(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the maximal runs of set bytes, cut at the ends of texts."""
        filled = self.offsets[:-1][np.diff(self.offsets) > 0]
        before = np.empty_like(inside)
        before[:1], before[1:] = False, inside[:-1]
        before[filled] = False
        starts = np.flatnonzero(inside & ~before)
        after = np.empty_like(inside)
        after[-1:], after[:-1] = False, inside[1:]
        after[filled[1:] - 1] = False
        return starts, np.flatnonzero(inside & ~after) + 1

    @cached_property
    def in_word(self) -> np.ndarray:
        return ~SEPARATOR[self.data]

    @cached_property
    def word_spans(self) -> tuple[np.ndarray, np.ndarray]:
        return self._runs(self.in_word)

    @cached_property
    def first_word(self) -> np.ndarray:
        """``first_word[i]:first_word[i + 1]`` are the words of text i."""
        return np.searchsorted(self.word_spans[0], self.offsets)

    @cached_property
    def word_text(self) -> np.ndarray:
        """The text that each word is in."""
        return np.repeat(np.arange(self.size), np.diff(self.first_word))

    @cached_property
    def _prefix(self) -> np.ndarray:
        out = np.zeros(len(self.data) + 1, U64)
        np.cumsum(BYTE_VALUES[self.data] * powers(BASE, len(self.data)), out=out[1:])
        return out

    def hash_spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        shift = powers(BASE_INVERSE, len(self.data) + 1)[starts]
        return mix((self._prefix[ends] - self._prefix[starts]) * shift + (ends - starts).astype(U64))

    @cached_property
    def word_hashes(self) -> np.ndarray:
        return self.hash_spans(*self.word_spans)

    @cached_property
    def line_spans(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and text of every line that has a word; lines end at a line feed or the text's end."""
        breaks = np.flatnonzero(self.data == 10)
        starts = np.unique(np.concatenate([self.offsets[:-1], breaks + 1]))
        starts = starts[starts < len(self.data)]
        text = np.searchsorted(self.offsets, starts, side="right") - 1
        following = np.append(breaks, len(self.data))
        ends = np.minimum(following[np.searchsorted(breaks, starts)], self.offsets[1:][text])
        words = np.searchsorted(self.word_spans[0], ends) > np.searchsorted(self.word_spans[0], starts)
        return starts[words], ends[words], text[words]

    def windows(self, width: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Index of the first word, and hash, of every window of so many words of one text."""
        return window_hashes(self.word_hashes, self.first_word, self.word_text, width, seed)


def window_hashes(hashes, first_word, word_text, width: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    n = max(0, len(hashes) - width + 1)
    out = np.full(n, U64(seed), U64)
    for k in range(width):
        out *= BASE
        out += hashes[k : k + n]
    at = np.arange(n)
    at = at[at + width <= first_word[1:][word_text[:n]]]
    return at, mix(out[at])


def counts_between(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def repeated(keys: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each (text, key): does the text have the key more than once; is it a later occurrence."""
    own = mix(keys + texts.astype(U64) * BASE)
    order = np.argsort(own, kind="stable")
    again = np.zeros(len(own), bool)
    again[1:] = own[order][1:] == own[order][:-1]
    many = again.copy()
    many[:-1] |= again[1:]
    out = np.zeros((2, len(own)), bool)
    out[0][order], out[1][order] = many, again
    return out[0], out[1]


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about so many bytes of text, so that memory does not follow the batch size."""
    for batch in batches:
        length = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        block = (np.cumsum(length) - length) // size
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)
