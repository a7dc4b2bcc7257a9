"""Substring deduplication by recompression.

Words are symbols.  In rounds, neighbouring symbols are named as pairs: a symbol's hash puts it into a
left or a right class, anew in each round, and every left symbol followed by a right one becomes one
symbol; runs of one symbol are named too.  A name is a hash of what it stands for, so all tasks name alike.  Whether
two symbols join hangs on these two alone, so equal substrings are parsed alike but for their ends.
Each symbol knows the words that its parse hangs on; if these lie inside a window, every other
occurrence of the window has the symbol at the same place.

A window is represented by the longest such symbol inside it.  A window can only repeat if its symbol
occurs in a second document: shared_names() finds these symbols, and only windows that stand behind them
are verified, by 96-bit hashes of their words and the smallest document that has them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import BASE, U64, TextBatch, mix, window_hashes
from .shared_names import SharedNames, deal, in_buckets, shared_names, table_of

WIDTH = 13
ROUNDS = 3


def _levels(words: np.ndarray, text: np.ndarray):
    """(name, first word, context start, context end, span) arrays of the symbols of every round, and of runs.

    The context is what the parse hangs on; where it passes a text's end it is made too wide for any window.
    """
    n = len(words)
    name, start, end = words.copy(), np.arange(n), np.arange(1, n + 1)
    low, high, text = start.copy(), end.copy(), text.copy()
    yield name, low, high, end - start
    for level in range(1, ROUNDS + 1):
        if len(name) < 2:
            return
        same = text[1:] == text[:-1]
        equal = same & (name[1:] == name[:-1])
        if equal.any():
            yield _runs(name, start, end, low, high, text, equal)
        right = (mix(name + U64(level * int(BASE) % 2**64)) >> U64(63)).astype(bool)
        pair = np.zeros(len(name), bool)
        pair[:-1] = same & ~right[:-1] & right[1:]
        second = np.zeros(len(name), bool)
        second[1:] = pair[:-1]
        # a symbol that stays alone hangs on the neighbour that it could have joined
        far = np.int64(1) << 40
        before, after = np.full(len(name), -far), np.full(len(name), far)
        before[1:], after[:-1] = np.where(same, low[:-1], -far), np.where(same, high[1:], far)
        low = np.where(pair | second | ~right, low, np.minimum(low, before))
        high = np.where(pair | second | right, high, np.maximum(high, after))
        at = np.flatnonzero(pair)
        name = name.copy()
        name[at] = mix(name[at] * U64(3) + mix(name[at + 1] + U64(level)))
        end, high = end.copy(), high.copy()
        end[at], high[at] = end[at + 1], high[at + 1]
        stays = ~second
        name, start, end, low, high, text = (x[stays] for x in (name, start, end, low, high, text))
        yield name, low, high, end - start


def _runs(name, start, end, low, high, text, equal):
    """Symbols for maximal runs; they hang on the symbols on both sides."""
    first = np.flatnonzero(equal & ~np.append(False, equal[:-1]))
    last = np.flatnonzero(equal & ~np.append(equal[1:], False)) + 1
    inner = (first > 0) & (last < len(name) - 1)
    first, last = first[inner], last[inner]
    inside = (text[first - 1] == text[first]) & (text[last + 1] == text[last])
    first, last = first[inside], last[inside]
    names = mix(name[first] + mix((last - first).astype(U64) + U64(77)))
    return names, low[first - 1], high[last + 1], end[last] - start[first]


def representatives(words: np.ndarray, text: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """For every window start: span and name of its symbol, as one number (larger is preferred)."""
    n = len(words)
    best = np.zeros(max(0, n - width + 1), U64)
    by_context: dict[int, np.ndarray] = {}
    for name, low, high, span in _levels(words, text):
        context = high - low
        usable = (low >= 0) & (context <= width) & (context > 0)
        worth = (np.minimum(span, 15).astype(U64) << U64(60)) | (name >> U64(4))
        for c in np.unique(context[usable]).tolist():
            at = np.flatnonzero(usable & (context == c))
            np.maximum.at(by_context.setdefault(c, np.zeros(n, U64)), low[at], worth[at])
    for c, worth in by_context.items():
        reach, have, wide = width - c + 1, 1, worth
        while have < reach:  # largest of the next `reach` places, by doubling
            step = min(have, reach - have)
            moved = wide.copy()
            np.maximum(wide[:-step], wide[step:], out=moved[:-step])
            wide, have = moved, have + step
        np.maximum(best, wide[: len(best)], out=best)
    return best


class _Windows:
    """Windows of a group's texts: place of their first word, document, symbol and hashes."""

    def __init__(self, rows: pa.Table, width: int):
        self.batch = TextBatch(rows.column("text").combine_chunks())
        self.ids = rows.column("id").to_numpy(zero_copy_only=False)
        known = rows.column("id").is_valid().to_numpy(zero_copy_only=False)
        b = self.batch
        self.width = width
        n = max(0, len(b.word_hashes) - width + 1)
        at = np.arange(n)
        text = b.word_text[:n]
        self.at = at[(at + width <= b.first_word[1:][text]) & known[text]]
        self.text = b.word_text[self.at]
        self.symbol = mix(representatives(b.word_hashes, b.word_text, width)[self.at])
        self.doc = np.asarray(self.ids)[self.text].astype(np.int64) if len(self.at) else np.zeros(0, np.int64)

    def choose(self, hit: np.ndarray) -> None:
        self.at, self.text, self.doc = self.at[hit], self.text[hit], self.doc[hit]
        b = self.batch
        place = np.zeros(len(b.word_hashes), np.int64)
        hashes = []
        for seed in (1, 2):
            words = b.word_hashes if seed == 1 else mix(b.word_hashes + BASE)
            at, found = window_hashes(words, b.first_word, b.word_text, self.width, seed)
            place[at] = np.arange(len(at))
            hashes.append(found[place[self.at]])
        self.hashes = [hashes[0], (hashes[1] >> U64(32)).astype(np.uint32)]


def _distinct(h1: np.ndarray, h2: np.ndarray, doc: np.ndarray):
    """Distinct hash pairs, the smallest document of each, and the pair of every entry."""
    order = np.lexsort((h2, h1))
    a, b = h1[order], h2[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    first = np.flatnonzero(new)
    which = np.zeros(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    smallest = np.minimum.reduceat(doc[order], first) if len(first) else doc
    return a[first], b[first], smallest, which


VERIFY = pa.schema([("g", pa.int64()), ("bucket", pa.int64()), ("h1", pa.binary()), ("h2", pa.binary()), ("docs", pa.binary())])
VERIFY_TEXT = "g bigint, bucket bigint, h1 binary, h2 binary, docs binary"


def _arrays(rows: pa.Table) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    columns = (rows.column(c).to_pylist() for c in ("h1", "h2", "docs"))
    return [(np.frombuffer(a, U64), np.frombuffer(b, np.uint32), np.frombuffer(d, np.int64)) for a, b, d in zip(*columns)]


def _join(parts):
    return [np.concatenate(x) for x in zip(*parts)] if parts else [np.zeros(0, U64), np.zeros(0, np.uint32), np.zeros(0, np.int64)]


def remove_repeats(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, carry: tuple[str, ...] = ()
) -> DataFrame:
    """id, n_words, n_removed, kept (the remaining words joined by one space), text (unchanged) and, if columns are carried, a struct ``rest`` of them.

    A word goes if a window of so many words of its document covers it and the same words also stand in a
    document with a smaller id.  Windows are those of the input, not of what is left, and never cross documents.  Ids are
    integers.  Null texts count as empty; empty and short ones keep all their words.  A row with a null id loses
    nothing and takes nothing from others.  Rows with the same id take nothing from each other.  An empty table gives
    an empty result.
    """
    dealt, bits = deal(docs, id_col, text_col, *([F.struct(*[F.col(f"`{c}`") for c in carry]).alias("rest")] if carry else []))
    window_bits = max(0, bits - 1)

    def symbols(rows: pa.Table):
        w = _Windows(rows, width)
        keys = w.symbol + w.text.astype(U64) * BASE  # once per document
        _, first = np.unique(keys, return_index=True)
        return w.symbol[first], np.ones(len(first), np.int64)

    answers = shared_names(dealt.select("g", "id", "text"), bits, symbols)

    def candidates(rows: pa.Table, answer: pa.Table) -> tuple[_Windows, tuple]:
        w = _Windows(rows, width)
        w.choose(SharedNames(answer).documents(w.symbol) > 1)
        return w, _distinct(*w.hashes, w.doc)

    def ask(rows: pa.Table, answer: pa.Table) -> pa.Table:
        out = {f: [] for f in VERIFY.names}
        if rows.num_rows and answer.num_rows:
            _, (h1, h2, smallest, _) = candidates(rows, answer)
            for bucket, at in in_buckets(h1, window_bits, 64) if window_bits else ([(0, slice(None))] if len(h1) else []):
                out["g"].append(rows.column("g")[0].as_py())
                out["bucket"].append(bucket)
                for c, x in (("h1", h1), ("h2", h2), ("docs", smallest)):
                    out[c].append(x[at].tobytes())
        return table_of(out, VERIFY)

    def verify(rows: pa.Table) -> pa.Table:
        parts = _arrays(rows)
        _, _, smallest, which = _distinct(*_join(parts))
        out, k = {f: [] for f in VERIFY.names}, 0
        for (h1, h2, own), g, bucket in zip(parts, rows.column("g").to_pylist(), rows.column("bucket").to_pylist()):
            best = smallest[which[k : k + len(own)]]
            k += len(own)
            less = best < own
            if less.any():
                out["g"].append(g)
                out["bucket"].append(bucket)
                for c, x in (("h1", h1), ("h2", h2), ("docs", best)):
                    out[c].append(x[less].tobytes())
        return table_of(out, VERIFY)

    asked = dealt.select("g", "id", "text").groupBy("g").cogroup(answers.groupBy("g")).applyInArrow(ask, VERIFY_TEXT)
    verified = asked.groupBy("bucket").applyInArrow(verify, VERIFY_TEXT)
    # one table of both kinds of answers, so that the texts meet them once
    both = answers.selectExpr("g", "names", "counts", "CAST(NULL AS binary) h1", "CAST(NULL AS binary) h2", "CAST(NULL AS binary) docs")
    both = both.unionByName(verified.selectExpr("g", "CAST(NULL AS binary) names", "CAST(NULL AS binary) counts", "h1", "h2", "docs"))

    def finish(rows: pa.Table, answer: pa.Table) -> pa.Table:
        kinds = answer.column("names").is_valid()
        batch = TextBatch(rows.column("text").combine_chunks())
        removed = np.zeros(len(batch.word_hashes) + 1, np.int64)
        if answer.num_rows:
            w, (h1, h2, smallest, which) = candidates(rows, answer.filter(kinds))
            r1, r2, rdoc = _join(_arrays(answer.filter(answer.column("h1").is_valid())))
            _, _, least, both_which = _distinct(np.append(h1, r1), np.append(h2, r2), np.append(smallest, rdoc))
            hit = w.at[least[both_which[: len(h1)]][which] < w.doc] if len(h1) else w.at[:0]
            np.add.at(removed, hit, 1)
            np.add.at(removed, hit + width, -1)
        gone = np.cumsum(removed[:-1]) > 0
        kept = _joined_words(batch, ~gone)
        total = np.append(0, np.cumsum(gone))
        n_removed = total[batch.first_word[1:]] - total[batch.first_word[:-1]]
        columns = {"id": rows.column("id"), "n_words": np.diff(batch.first_word), "n_removed": n_removed, "kept": kept}
        columns |= {c: rows.column(c) for c in ("text", "rest") if c in rows.column_names}
        return pa.table(columns)

    rest = ", rest " + dealt.schema["rest"].dataType.simpleString() if carry else ""
    source = dealt if carry else dealt.select("g", "id", "text")
    done = source.groupBy("g").cogroup(both.groupBy("g")).applyInArrow(
        finish, "id bigint, n_words bigint, n_removed bigint, kept string, text string" + rest
    )
    return done.select(F.col("id").alias(id_col), "n_words", "n_removed", "kept", "text", *(["rest"] if carry else []))


def _joined_words(batch: TextBatch, keep: np.ndarray) -> pa.Array:
    """Per text its kept words, joined by one space."""
    starts, ends = (x[keep] for x in batch.word_spans)
    text = batch.word_text[keep]
    size = ends - starts + 1
    stop = np.cumsum(size)
    source = np.arange(stop[-1] if len(stop) else 0) - np.repeat(stop - size - starts, size)
    data = batch.data[np.minimum(source, max(0, len(batch.data) - 1))] if len(source) else np.zeros(0, np.uint8)
    data = data.copy()
    data[stop - 1] = 32
    words = np.bincount(text, minlength=batch.size)
    last = np.cumsum(words)
    bound = np.append(0, stop)[np.append(0, last)]
    out = [data[a : max(a, b - 1)].tobytes() for a, b in zip(bound[:-1].tolist(), bound[1:].tolist())]
    return pa.array(out, pa.binary()).cast(pa.string())
