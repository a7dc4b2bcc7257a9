"""Token counts by offset-mapped attribution.

The fields of a row are joined into one document, which is encoded once, as a model would read it.  Each
token's bytes are mapped to characters, and the token spans are interval-joined with the spans of the
fields, or of sections inside them.  A token that crosses a boundary goes to the span that has most of
its characters, of equal shares to the earlier one.

Tokens and sections of a document are made by the same task, so the join is a search in sorted offsets:
no shuffle, and memory bounded by the slice size.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import slices
from .tables import schema_text

#: A sentence with the white space that follows it.
SENTENCES = r"[^.!?\n]*(?:[.!?]+|\n|$)\s*"

_encoders: dict[tuple[str, str], tuple[tiktoken.Encoding, np.ndarray]] = {}


def _encoder(path: str, pattern: str) -> tuple[tiktoken.Encoding, np.ndarray]:
    """Encoder and the number of bytes of each id; one per worker and file."""
    if (path, pattern) not in _encoders:
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            lengths[rank] = len(token)
        encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        _encoders[path, pattern] = encoding, lengths
    return _encoders[path, pattern]


def token_spans(text: str, ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First character and end of each token; a token that begins or ends inside a character touches it."""
    ends = np.cumsum(lengths[ids])
    starts = ends - lengths[ids]
    if text.isascii():
        return starts, ends
    raw = np.frombuffer(text.encode("utf-8"), np.uint8)
    character = np.cumsum((raw & 0xC0) != 0x80) - 1
    return character[starts], character[ends - 1] + 1


def attribute(starts: np.ndarray, ends: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Section of each token, and whether it crosses a boundary.  cuts: ascending section starts, the first is 0.

    Sections tile the document, so a token's overlap with section k is what lies between cuts k and k + 1.
    """
    first = np.searchsorted(cuts, starts, side="right") - 1
    last = np.searchsorted(cuts, ends - 1, side="right") - 1
    best = first.copy()
    edges = np.append(cuts, np.iinfo(np.int64).max)
    for t in np.flatnonzero(last > first):
        k = np.arange(first[t], last[t] + 1)
        overlap = np.minimum(edges[k + 1], ends[t]) - np.maximum(edges[k], starts[t])
        best[t] = k[np.argmax(overlap)]  # the first of the largest
    return best, last > first


def count_tokens(
    df: DataFrame,
    vocabulary_path: str,
    pattern: str,
    *,
    id_col: str = "doc_id",
    fields: tuple[str, ...] = ("text",),
    separator: str = "\n",
    sections: str | None = SENTENCES,
) -> DataFrame:
    """One row per section: id, field, section (from 0 in its field), start and stop (characters in the joined
    document), n_tokens, n_crossing (those of them that also lie in another section).

    The separator belongs to the field before it.  sections: a pattern whose matches tile a field (what it leaves
    over joins the match before); null: the field is one section.  A null field counts as an empty one; an empty field has
    one empty section, to which no token goes.  The n_tokens of a document add up to those of the joined document.
    Null and repeated ids are counted row by row.
    """
    chosen = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(f"__{i}") for i, c in enumerate(fields)]
    source = df.select(F.col(f"`{id_col}`").alias("__id"), *chosen)
    out = source.withColumnRenamed("__id", id_col)
    splitter = re.compile(sections) if sections else None

    def tile(text: str) -> list[int]:
        return [m.start() for m in splitter.finditer(text) if m.end() > m.start()] if splitter else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, lengths = _encoder(vocabulary_path, pattern)
        for part in slices(batches, f"__{len(fields) - 1}"):
            rows, names, numbers, columns = [], [], [], []
            for i, texts in enumerate(zip(*(part.column(f"__{k}").to_pylist() for k in range(len(fields))))):
                cuts, at = [], 0
                for k, text in enumerate(texts):
                    inner = sorted({0, *tile(text)})
                    cuts += [at + x for x in inner]
                    names += [fields[k]] * len(inner)
                    numbers.append(np.arange(len(inner)))
                    at += len(text) + (len(separator) if k + 1 < len(fields) else 0)
                whole = separator.join(texts)
                ids = np.array(encoding.encode_ordinary(whole), np.int64)
                cuts = np.array(cuts, np.int64)
                section, crossing = attribute(*token_spans(whole, ids, lengths), cuts)
                rows.append(np.full(len(cuts), i))
                columns.append([
                    cuts, np.append(cuts[1:], at), np.bincount(section, minlength=len(cuts)),
                    np.bincount(section[crossing], minlength=len(cuts)),
                ])
            joined = [np.concatenate(x) for x in zip(*columns)]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("__id").take(pa.array(np.concatenate(rows))), pa.array(names, pa.string()),
                    pa.array(np.concatenate(numbers), pa.int64()), *(pa.array(x, pa.int64()) for x in joined),
                ],
                [id_col, "field", "section", "start", "stop", "n_tokens", "n_crossing"],
            )

    counts = "field string, section bigint, start bigint, stop bigint, n_tokens bigint, n_crossing bigint"
    return source.mapInArrow(run, f"{schema_text(out, (id_col,))}, {counts}")
