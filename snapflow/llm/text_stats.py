"""Counts of a text that rules and classifiers read, for many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import TextBatch, counts_between, member_table, repeated, slices

SYMBOLS = member_table("#*$%&|<>")
UPPER = member_table("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
DIGITS = member_table("0123456789")
STOPS = member_table(".,;:?")
BANG = member_table("!")

BASE_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE_COUNTS = ("n_lines", "n_upper", "n_digits", "n_stops", "n_bangs", "n_high", "n_short", "n_distinct")


def text_counts(batch: TextBatch, more: bool = True) -> dict[str, np.ndarray]:
    """All counts, one array entry per text; an empty text has zeros."""
    data, starts, ends = batch.data, *batch.word_spans
    first = batch.first_word
    lines_from, lines_to, line_text = batch.line_spans
    _, again = repeated(batch.hash_spans(lines_from, lines_to), line_text)
    at, hashes = batch.windows(3)
    many, _ = repeated(hashes, batch.word_text[at])
    covered = np.zeros(len(starts) + 2, bool)
    for k in range(3):
        covered[at[many] + k] = True
    out = {
        "n_words": np.diff(first),
        "word_chars": batch.per_text(batch.in_word & ((data & 0xC0) != 0x80)),
        "n_symbols": batch.per_text(SYMBOLS[data]),
        "n_dup_lines": np.bincount(line_text[again], minlength=batch.size),
        "n_repeat_words": counts_between(covered[: len(starts)], first),
    }
    if more:
        _, known = repeated(batch.word_hashes, batch.word_text)
        out |= {
            "n_lines": np.bincount(line_text, minlength=batch.size),
            "n_upper": batch.per_text(UPPER[data]),
            "n_digits": batch.per_text(DIGITS[data]),
            "n_stops": batch.per_text(STOPS[data]),
            "n_bangs": batch.per_text(BANG[data]),
            "n_high": batch.per_text(data >= 0xC0),
            "n_short": counts_between(ends - starts <= 3, first),
            "n_distinct": np.diff(first) - counts_between(known, first),
        }
    return out


def with_counts(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text", more: bool = True) -> DataFrame:
    """The kept columns and the counts of each text; a null text counts as an empty one."""
    names = [*BASE_COUNTS, *(MORE_COUNTS if more else ())]
    source = docs.select(*keep, F.col(text_col).cast("string").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            counts = text_counts(TextBatch(part.column("text")), more)
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in keep), *(pa.array(counts[c], pa.int64()) for c in names)], [*keep, *names]
            )

    kinds = ", ".join(f"`{c}` {source.schema[c].dataType.simpleString()}" for c in keep)
    return source.mapInArrow(count, f"{kinds}, " + ", ".join(f"{c} bigint" for c in names))
