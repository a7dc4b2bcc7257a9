"""Byte-level BPE encoding and decoding.

Texts are cut into pieces without a regular expression.  Every code point gets a class; a class is a
transition function on eight states; these functions form a small monoid under composition, so the
state before every character comes from an associative scan whose steps are look-ups in the monoid's
multiplication table.  State and neighbouring classes say where pieces begin.  Pieces that the bounded
cache of a Python worker lacks are then merged by rank, many side by side.

Every Arrow batch is worked on by itself: no shuffle, memory bounded by the slice size.
"""

from __future__ import annotations

import base64
import heapq
import sys
import unicodedata
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import slices

# Classes of characters.  APO1 and APO2 are apostrophes before a contraction of one or two letters, END stands
# between texts.
LETTER, NUMBER, OTHER, SPACE, WHITE, APO1, APO2, END = range(8)
# States: what the open piece is.  ONE and TWO await the last one or two letters of a contraction.
S_BREAK, S_SPACE, S_LETTER, S_NUMBER, S_OTHER, S_ONE, S_TWO, S_DONE = range(8)

# The endings that follow an apostrophe, and the characters that count as white space.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
WHITE_SPACE = (
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)

CACHE_PIECES = 150_000  # of each of the cache's two generations
ENCODE_BYTES = 1 << 20  # of text at once: pieces are Python objects
CACHED_CHARS = 64  # longer pieces are merged anew each time
HEAP_BYTES = 48  # longer pieces are merged with a heap
WIDTH_STEP = 4  # shorter ones are merged together with those of the same length, rounded up to this
NEVER = 1 << 40  # in place of a rank


def _step(state: int, kind: int) -> int:
    if kind == LETTER:
        return {S_TWO: S_ONE, S_ONE: S_DONE}.get(state, S_LETTER)
    if kind in (APO1, APO2):
        inside = state in (S_SPACE, S_OTHER)
        return S_OTHER if inside else S_ONE if kind == APO1 else S_TWO
    return {NUMBER: S_NUMBER, OTHER: S_OTHER, SPACE: S_SPACE}.get(kind, S_BREAK)


def _monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The functions of all strings of classes: function of each class, product table, value at each state."""
    of_class = [tuple(_step(s, k) for s in range(8)) for k in range(8)]
    known = {f: i for i, f in enumerate(dict.fromkeys([tuple(range(8)), *of_class]))}
    todo = list(known)
    while todo:
        f = todo.pop()
        for g in of_class:
            h = tuple(g[s] for s in f)
            if h not in known:
                known[h] = len(known)
                todo.append(h)
    functions = list(known)
    product = [[known[tuple(g[s] for s in f)] for g in functions] for f in functions]
    kind = np.uint8 if len(functions) < 256 else np.uint16
    return np.array([known[f] for f in of_class], kind), np.array(product, kind), np.array(functions, np.uint8)


CLASS_FUNCTION, PRODUCT, VALUE = _monoid()


def scan(functions: np.ndarray, width: int = 256) -> np.ndarray:
    """Product of all functions up to and with each place: within rows side by side, then over the rows' ends."""
    n = len(functions)
    if n <= width:
        out = functions.copy()
        for i in range(1, n):
            out[i] = PRODUCT[out[i - 1], functions[i]]
        return out
    rows = -(-n // width)
    grid = np.zeros(rows * width, functions.dtype)  # 0 is the identity
    grid[:n] = functions
    grid = np.ascontiguousarray(grid.reshape(rows, width).T)
    flat, size = PRODUCT.ravel(), np.intp(len(PRODUCT))
    for j in range(1, width):
        grid[j] = flat[grid[j - 1] * size + grid[j]]
    ends = scan(np.ascontiguousarray(grid[-1]), width)
    grid[:, 1:] = flat[ends[:-1] * size + grid[:, 1:]]
    return grid.T.ravel()[:n]


_classes: list[np.ndarray] = []


def class_table() -> np.ndarray:
    """The class of every code point; made once per worker."""
    if not _classes:
        table = np.full(sys.maxunicode + 1, OTHER, np.uint8)
        for i in range(sys.maxunicode + 1):
            major = unicodedata.category(chr(i))[0]
            if major in "LN":
                table[i] = LETTER if major == "L" else NUMBER
        table[list(WHITE_SPACE)] = WHITE
        table[0x20] = SPACE
        _classes.append(table)
    return _classes[0]


def piece_starts(points: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Where pieces begin.  points: code points of the texts, each followed by one more place; stops: those places."""
    kinds = class_table()[points]
    quotes = np.flatnonzero(points == 0x27)
    padded = np.concatenate([points, np.zeros(2, points.dtype)])
    for ending in CONTRACTIONS:
        hit = np.ones(len(quotes), bool)
        for k, letter in enumerate(ending, 1):
            hit &= padded[quotes + k] == ord(letter)
        kinds[quotes[hit]] = APO1 if len(ending) == 1 else APO2
    kinds[stops] = END
    before = np.empty(len(kinds), np.uint8)
    before[:1], before[1:] = S_BREAK, VALUE[scan(CLASS_FUNCTION[kinds]), S_BREAK][:-1]
    last = np.full(len(kinds), END, np.uint8)
    last[1:] = kinds[:-1]
    following = np.full(len(kinds), END, np.uint8)
    following[:-1] = kinds[1:]
    white = (kinds == SPACE) | (kinds == WHITE)
    last_white = (last == SPACE) | (last == WHITE)
    next_black = (following != SPACE) & (following != WHITE) & (following != END)
    start = np.where(white, ~last_white | next_black, OPENS[kinds, before])
    start[stops] = False
    return np.flatnonzero(start)


# Does a character of this class begin a piece in this state?  A space before it is already the piece's beginning.
OPENS = np.ones((8, 8), bool)
OPENS[:, S_SPACE] = False
OPENS[LETTER, [S_LETTER, S_ONE, S_TWO]] = False
OPENS[NUMBER, S_NUMBER] = False
OPENS[[OTHER, APO1, APO2], S_OTHER] = False


class Vocabulary:
    """Ranks of byte strings, with the cache of merged pieces."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.tokens = [b""] * (max(self.ranks.values(), default=-1) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.lengths = np.array([len(t) for t in self.tokens], np.int64)
        self.of_byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @cached_property
    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Every way to make a token of two: left id and right id in one number, ascending, and the token's rank."""
        get, joined = self.ranks.get, {}
        for token, rank in self.ranks.items():
            for i in range(1, len(token)):
                left, right = get(token[:i]), get(token[i:])
                if left is not None and right is not None:
                    joined[left * len(self.tokens) + right] = rank
        keys = np.fromiter(joined, np.int64, len(joined))
        order = np.argsort(keys)
        ranks = np.fromiter(joined.values(), np.int64, len(joined))[order]
        return np.append(keys[order], np.iinfo(np.int64).max), np.append(ranks, NEVER)

    def pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the token that two ids make; NEVER if they make none or one is no id (negative)."""
        keys, ranks = self.pairs
        key = left * len(self.tokens) + right
        at = np.searchsorted(keys, key)
        return np.where((keys[at] == key) & (left >= 0) & (right >= 0), ranks[at], NEVER)

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of each piece: the adjacent pair of lowest rank is joined first, of equal ones the leftmost."""
        out: list[bytes] = [b""] * len(pieces)
        by_width: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                out[i] = whole.to_bytes(4, "little")
            elif len(piece) > HEAP_BYTES:
                out[i] = np.array(self._merge_long(piece), "<u4").tobytes()
            else:
                by_width.setdefault(-(-len(piece) // WIDTH_STEP) * WIDTH_STEP, []).append(i)
        for width, rows in by_width.items():
            self._merge_rows(pieces, np.array(rows), width, out)
        return out

    def _merge_rows(self, pieces: list[bytes], rows: np.ndarray, width: int, out: list[bytes]) -> None:
        """Merge pieces of about one length side by side, a row each: one join per row and round."""
        length = np.array([len(pieces[i]) for i in rows])
        ids = np.full((len(rows), width), -1, np.int64)
        ids[np.arange(width) < length[:, None]] = self.of_byte[np.frombuffer(b"".join(pieces[i] for i in rows), np.uint8)]
        ranks = np.full((len(rows), width), NEVER, np.int64)
        ranks[:, :-1] = self.pair_rank(ids[:, :-1], ids[:, 1:])
        place = np.arange(width)
        while len(rows):
            at = ranks.argmin(1)
            rank = ranks[np.arange(len(rows)), at]
            done = rank == NEVER
            if done.any():
                packed = ids[done][ids[done] >= 0].astype("<u4").tobytes()
                stop = np.cumsum(length[done]) * 4
                for i, a, b in zip(rows[done].tolist(), (stop - length[done] * 4).tolist(), stop.tolist()):
                    out[i] = packed[a:b]
                rows, ids, ranks, length, at, rank = (x[~done] for x in (rows, ids, ranks, length, at, rank))
            each = np.arange(len(rows))
            source = np.minimum(place + (place > at[:, None]), width - 1)  # what follows the joined pair moves up
            ids, ranks = np.take_along_axis(ids, source, 1), np.take_along_axis(ranks, source, 1)
            ids[:, -1], ranks[:, -1] = -1, NEVER
            ids[each, at] = rank
            length = length - 1
            after, before = np.minimum(at + 1, width - 1), np.maximum(at - 1, 0)
            ranks[each, at] = np.where(after > at, self.pair_rank(rank, ids[each, after]), NEVER)
            left = at > 0
            ranks[each[left], before[left]] = self.pair_rank(ids[each, before], rank)[left]

    def _merge_long(self, piece: bytes) -> list[int]:
        n = len(piece)
        end = list(range(1, n + 1))  # of the part that begins here; 0: none begins here
        left = list(range(-1, n - 1))
        get, heap = self.ranks.get, []

        def offer(i: int) -> None:
            middle = end[i]
            if middle < n and (rank := get(piece[i : end[middle]])) is not None:
                heapq.heappush(heap, (rank, i, middle, end[middle]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, middle, last = heapq.heappop(heap)
            if end[i] != middle or end[middle] != last:
                continue
            end[i], end[middle] = last, 0
            if last < n:
                left[last] = i
            offer(i)
            if i:
                offer(left[i])
        out, i = [], 0
        while i < n:
            out.append(self.ranks[piece[i : end[i]]])
            i = end[i]
        return out

    def known(self, pieces: set[str]) -> dict[str, bytes]:
        """The cache, with at least these pieces in it.  Pieces that were not met since it was last full are forgotten."""
        if len(self.recent) > CACHE_PIECES:
            self.recent, self.older = {}, self.recent
        missing = pieces.difference(self.recent)
        found = missing.intersection(self.older)
        self.recent.update((p, self.older[p]) for p in found)
        new = list(missing - found)
        self.recent.update(zip(new, self.merge([p.encode("utf-8") for p in new])))
        return self.recent

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        lengths = np.array([len(t) for t in texts], np.int64)
        stops = np.cumsum(lengths + 1) - 1
        points = np.frombuffer("\0".join([*texts, ""]).encode("utf-32-le"), np.uint32)
        starts = piece_starts(points, stops)
        bounds = np.searchsorted(starts, [0, *(stops + 1).tolist()]).tolist()
        cut = []
        for i, text in enumerate(texts):
            own = (starts[bounds[i] : bounds[i + 1]] - (stops[i] - lengths[i])).tolist()
            cut.append([text[a:b] for a, b in zip(own, [*own[1:], len(text)])])
        distinct = set().union(*cut)
        known = self.known(distinct)
        out = [b"".join(map(known.__getitem__, pieces)) for pieces in cut]
        for piece in distinct:
            if len(piece) > CACHED_CHARS:
                del known[piece]
        return out

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_vocabularies: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """One per worker and file."""
    if path not in _vocabularies:
        _vocabularies[path] = Vocabulary(path)
    return _vocabularies[path]


def _to_encode(df: DataFrame, text_col: str, prefix: str) -> tuple[DataFrame, list[str], list[str]]:
    """What goes into the encoder, its text last, and the fields and names of what comes out."""
    new = {f"{prefix}ids": "binary", f"{prefix}token_ends": "binary", f"{prefix}n_tokens": "bigint"}
    kept = [c for c in df.columns if c not in new]
    source = df.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text_col}`").cast("string").alias("__text"))

    fields = [f"`{c}` {source.schema[c].dataType.simpleString()}" for c in kept] + [f"`{c}` {k}" for c, k in new.items()]
    return source, fields, [*kept, *new]


def _encoded(batches: Iterator[pa.RecordBatch], path: str, names: list[str]) -> Iterator[pa.RecordBatch]:
    words = vocabulary(path)
    for part in slices(batches, "__text", ENCODE_BYTES):
        texts = [t or "" for t in part.column("__text").to_pylist()]
        ids = words.encode(texts)
        ends = [np.cumsum(words.lengths[np.frombuffer(x, "<u4")]).astype("<u4").tobytes() for x in ids]
        yield pa.RecordBatch.from_arrays(
            [
                *part.columns[:-1], pa.array(ids, pa.binary()), pa.array(ends, pa.binary()),
                pa.array([len(x) // 4 for x in ids], pa.int64()),
            ],
            names,
        )


def _decoded(batches: Iterator[pa.RecordBatch], path: str, kept: list[str], ids_col: str, out_col: str) -> Iterator[pa.RecordBatch]:
    words, at = vocabulary(path), kept.index(ids_col)
    for part in slices(batches, ids_col, ENCODE_BYTES):
        raw = [words.decode(x or b"") for x in part.column(at).to_pylist()]
        yield pa.RecordBatch.from_arrays([*part.columns, pa.array(raw, pa.binary())], [*kept, out_col])


def encode(df: DataFrame, vocabulary_path: str, text_col: str = "text", prefix: str = "") -> DataFrame:
    """Add ``ids`` (binary: little-endian unsigned 32-bit integers), ``token_ends`` (binary, the same form: the byte
    offset in the text at which each token ends) and ``n_tokens``, named with the prefix.

    A null or empty text has no tokens.  All other columns stay; a column of one of the new names is replaced.
    The file at vocabulary_path must be there on every executor.
    """
    source, fields, names = _to_encode(df, text_col, prefix)
    return source.mapInArrow(lambda batches: _encoded(batches, vocabulary_path, names), ", ".join(fields))


def decode(df: DataFrame, vocabulary_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """Add the bytes (binary) that the ids stand for; null or empty ids give no bytes."""
    kept = [c for c in df.columns if c != out_col]
    source = df.select(*[F.col(f"`{c}`") for c in kept])
    fields = [f"`{c}` {source.schema[c].dataType.simpleString()}" for c in kept] + [f"`{out_col}` binary"]
    return source.mapInArrow(lambda batches: _decoded(batches, vocabulary_path, kept, ids_col, out_col), ", ".join(fields))


def encode_decode(df: DataFrame, vocabulary_path: str, text_col: str = "text", out_col: str = "decoded") -> DataFrame:
    """:func:`encode`, then :func:`decode` of its ids, a slice at a time in one Python worker: the vocabulary is held once
    and nothing is stored between the two."""
    source, fields, names = _to_encode(df.drop(out_col), text_col, "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _decoded(_encoded(batches, vocabulary_path, names), vocabulary_path, names, "ids", out_col)

    return source.mapInArrow(run, ", ".join([*fields, f"`{out_col}` binary"]))
