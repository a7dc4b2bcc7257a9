"""Periodic runs of words, found by string synchronising sets.

A run is a maximal stretch of words with a smallest period q that is at least 3 q long.  Words and, by doubling, all
windows of 2, 4, 8 ... words get 64-bit names; equal windows have equal names wherever they stand.

At scale t the synchronising set holds the places i where, of the names of the t-word windows that start at
i .. i + t, the smallest is that at i or at i + t.  Whether a place belongs hangs on the 2 t words from it alone, so equal
contexts agree, and about two of t places belong.  Windows with a period of t / 3 or less would all look alike;
they are left out, and the set is empty exactly inside such highly periodic regions.  A run of period q >= 1.5 t
therefore holds, within its first two periods, a place whose context comes again q words later: pairs of places with equal
contexts, 1.5 t to 3 t apart, propose the periods of that scale.  Periods below 6 are omitted by all
scales; their regions are found by comparing words with those up to five places on, and the regions that a scale leaves out
are runs found before.  Proposals are extended to both sides by descending window names, and neighbouring
proposals of one period are joined, so the work is the number of words times the logarithm of the text's length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import BASE, U64, TextBatch, mix, slices
from .substring_dedup import _joined_words

EXPONENT = 3  # the scales below are laid out for runs of three periods or more
DIRECT = 5  # periods that are found by comparing words with later ones
FIRST_SCALE = 4  # its periods are 6 to 11
LEFT_OUT = np.iinfo(U64).max

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
RUN_TYPE = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


class _Found:
    """Runs as rows (text, start in the text, length, period)."""

    def __init__(self):
        self.rows = np.zeros((0, 4), np.int64)

    def add(self, text, start, length, period) -> None:
        period = np.broadcast_to(period, np.shape(start))
        long = length >= EXPONENT * period
        self.rows = np.concatenate([self.rows, np.column_stack([text, start, length, period])[long]])

    def smallest(self) -> np.ndarray:
        """Each stretch once, with its smallest period, by text, start and period."""
        rows = self.rows[np.lexsort((self.rows[:, 3], self.rows[:, 2], self.rows[:, 1], self.rows[:, 0]))]
        new = np.ones(len(rows), bool)
        new[1:] = (rows[1:, :3] != rows[:-1, :3]).any(1)
        rows = rows[new]
        return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


class _Texts:
    """The words of the texts that are long enough for a scale, with the names of their windows of 1, 2, 4 ... words."""

    def __init__(self, words: np.ndarray, sizes: np.ndarray):
        self.names, self.sizes, self.texts = [words], sizes, np.arange(len(sizes))
        self._lay()

    def _lay(self) -> None:
        self.first = np.append(0, np.cumsum(self.sizes))
        self.stop = np.repeat(self.first[1:], self.sizes)
        self.begin = np.repeat(self.first[:-1], self.sizes)
        self.own = np.repeat(np.arange(len(self.sizes)), self.sizes)

    def keep(self, alive: np.ndarray) -> None:
        if not alive.all():
            words = alive[self.own]
            self.names = [x[words] for x in self.names]
            self.sizes, self.texts = self.sizes[alive], self.texts[alive]
            self._lay()

    def window_names(self, level: int) -> np.ndarray:
        """Names of windows of 2**level words; those that pass a text's end mean nothing and are never compared."""
        while len(self.names) <= level:
            half, step = self.names[-1], 1 << (len(self.names) - 1)
            whole = np.zeros_like(half)
            whole[:-step] = mix(half[:-step] * BASE + half[step:])
            self.names.append(whole)
        return self.names[level]

    def extend(self, at: np.ndarray, period: np.ndarray, level: int, forward: bool) -> np.ndarray:
        """How far the words from ``at`` on (or before it) equal those a period later, if that is below 2**(level + 2)."""
        size, x = len(self.own), at.copy()
        stop, begin = self.stop[at], self.begin[at]
        for k in (level, level, *range(level - 1, -1, -1)):
            step = 1 << k
            left = x if forward else x - step
            inside = (left + period + step <= stop) if forward else (left >= begin)
            a, b = np.where(inside, left, 0), np.where(inside, left + period, 0)
            same = inside & (self.names[k][a] == self.names[k][np.minimum(b, size - 1)])
            x = np.where(same, x + step if forward else left, x)
        return x


def _near_periods(words: np.ndarray, first: np.ndarray, found: _Found) -> None:
    """Runs whose period is at most DIRECT."""
    own = np.repeat(np.arange(len(first) - 1), np.diff(first))
    for period in range(1, DIRECT + 1):
        same = np.zeros(len(words) + 2, np.int8)  # padded by a place that differs on both sides
        same[1 : len(words) - period + 1] = (words[:-period] == words[period:]) & (own[:-period] == own[period:])
        turns = np.flatnonzero(np.diff(same))
        start, end = turns[::2], turns[1::2]
        text = own[start]
        found.add(text, start - first[text], end + period - start, period)


def _synchronising_set(texts: _Texts, level: int, found: _Found) -> np.ndarray:
    """The places of the set at scale 2**level, ascending."""
    scale, size = 1 << level, len(texts.own)
    names = np.minimum(texts.window_names(level), LEFT_OUT - U64(1))
    local = np.full(int(texts.texts.max()) + 1, -1, np.int64)
    local[texts.texts] = texts.first[:-1]
    text, start, length, period = found.rows[np.isin(found.rows[:, 0], texts.texts)].T
    periodic = (EXPONENT * period <= scale) & (length >= scale)
    if periodic.any():
        start = local[text[periodic]] + start[periodic]
        cover = np.zeros(size + 1, np.int64)
        np.add.at(cover, start, 1)
        np.add.at(cover, start + length[periodic] - scale + 1, -1)
        names = np.where(np.cumsum(cover[:-1]) > 0, LEFT_OUT, names)
    least, have = names, 1
    while have < scale:  # smallest of `have` places, by doubling
        wider = least.copy()
        np.minimum(least[:-have], least[have:], out=wider[:-have])
        least, have = wider, 2 * have
    near, far = names[:-scale], names[scale:]
    least = np.minimum(least[:-scale], far)
    chosen = ((least == near) | (least == far)) & (least != LEFT_OUT)
    at = np.arange(size - scale)
    return at[chosen & (at + 2 * scale <= texts.stop[: size - scale])]


def _runs_at_scale(texts: _Texts, level: int, found: _Found) -> None:
    scale = 1 << level
    context = texts.window_names(level + 1)
    places = _synchronising_set(texts, level, found)
    names = context[places]
    pairs = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for ahead in range(1, len(places)):
        apart = places[ahead:] - places[:-ahead]
        near = (apart < 3 * scale) & (texts.own[places[ahead:]] == texts.own[places[:-ahead]])
        if not near.any():
            break
        equal = near & (2 * apart >= 3 * scale) & (names[ahead:] == names[:-ahead])
        pairs.append((places[:-ahead][equal], apart[equal]))
    at, period = (np.concatenate(x) for x in zip(*pairs))
    if not len(at):
        return
    order = np.lexsort((at, period))
    at, period = at[order], period[order]
    reach = texts.extend(at + 2 * scale - 1, period, level + 1, True)  # from the last word of the context, which is equal
    apart = np.ones(len(at), bool)  # from the pair before
    apart[1:] = (period[1:] != period[:-1]) | (at[1:] > reach[:-1]) | (texts.own[at[1:]] != texts.own[at[:-1]])
    first = np.flatnonzero(apart)
    last = np.append(first[1:], len(at)) - 1
    period = period[first]
    start = texts.extend(at[first], period, level + 1, False)
    own = texts.own[start]
    found.add(texts.texts[own], start - texts.first[own], reach[last] + period - start, period)


def runs_of(words: np.ndarray, first: np.ndarray, min_length: int = 0) -> np.ndarray:
    """Rows (text, start, length, period) of the runs of every text, by text, start and period.

    words: one 64-bit name per word; ``first[i]:first[i + 1]`` are the words of text i.
    """
    found = _Found()
    if len(words) > DIRECT:
        _near_periods(words, first, found)
    texts, level = _Texts(words, np.diff(first)), FIRST_SCALE.bit_length() - 1
    while True:
        texts.keep(2 * texts.sizes >= 9 * (1 << level))  # three of the smallest period, 1.5 scales
        if not len(texts.sizes):
            break
        _runs_at_scale(texts, level, found)
        level += 1
    runs = found.smallest()
    return runs[runs[:, 2] >= min_length]


def find_runs(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_length: int = 24) -> DataFrame:
    """id, n_words, runs (start, length, period; by start, then period) and collapsed of every row.

    Words are maximal stretches of characters other than space and U+0009 to U+000D; they are numbered from 0.  A
    run is a stretch with smallest period q, at least max(min_length, 3 q) words long, that no neighbouring word extends.
    collapsed has, joined by one space, the words that no run contains after its first q words.  Null, empty and short texts
    have no runs; a null text has no words and collapses to an empty one.  Rows are judged one by one: repeated and null ids
    are kept as they are, an empty table gives an empty result, other columns are left behind.  Memory grows with
    the longest text times its logarithm, not with the table.
    """

    def run(batches):
        for batch in slices(batches):
            texts = TextBatch(batch.column("text"))
            words, first = texts.word_hashes, texts.first_word
            text, start, length, period = runs_of(words, first, min_length).T
            gone = np.zeros(len(words) + 1, np.int64)
            np.add.at(gone, first[text] + start + period, 1)
            np.add.at(gone, first[text] + start + length, -1)
            runs = pa.StructArray.from_arrays([pa.array(x) for x in (start, length, period)], fields=list(RUN_TYPE))
            offsets = pa.array(np.searchsorted(text, np.arange(texts.size + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), pa.array(np.diff(first)), pa.ListArray.from_arrays(offsets, runs),
                    _joined_words(texts, np.cumsum(gone[:-1]) <= 0),
                ],
                ["id", "n_words", "runs", "collapsed"],
            )

    given = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = given.schema["id"].dataType.simpleString()
    return given.mapInArrow(run, f"id {kind}, n_words bigint, runs {RUNS}, collapsed string").withColumnRenamed("id", id_col)


def strongest(runs):
    """Of a column of runs the one with the greatest length / period, compared exactly; the first of equals; null if none."""
    better = lambda best, x: best.isNull() | (x["length"] * best["period"] > best["length"] * x["period"])
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    return F.aggregate(runs, none, lambda best, x: F.when(better(best, x), x).otherwise(best))
