"""Which of very many 64-bit names occur in more than one document, found with little shuffling.

Documents are dealt to groups of a few megabytes by a hash of their id.  Each group sends the set of its
names, cut into buckets by their leading bits, sorted and stored as differences: about four bytes a name
instead of a row each.  A bucket adds up what the groups have sent and returns to each group those
of its names that several documents have.  A name that a third of all documents share is sent once
per group, so no task gathers more than its even share.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GROUP_BYTES = 2 << 20
BUCKET_NAMES = 400_000
BITS = 44  # of a name that are sent; names that agree on them count as one, which only adds candidates
SENT = "g bigint, bucket bigint, names binary, counts binary"


def deal(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> tuple[DataFrame, int]:
    """id, text, more columns and group ``g`` of every row, and the number of leading bits that make a bucket.

    Rows with the same id share a group; rows without one are dealt by their text.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    total = docs.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0
    groups = total // GROUP_BYTES + 1
    key = F.when(F.col(id_col).isNull(), F.xxhash64(text)).otherwise(F.xxhash64(F.col(id_col)))
    dealt = docs.select(
        F.pmod(key, F.lit(groups)).alias("g"), F.col(id_col).cast("long").alias("id"), text.alias("text"), *more
    )
    return dealt, max(0, int(total // 6 // BUCKET_NAMES).bit_length())


def pack(values: np.ndarray) -> bytes:
    """Ascending integers as differences of equal width; the first byte is the width."""
    steps = np.diff(values, prepend=np.uint64(0))
    width = max(1, (int(steps.max(initial=0)).bit_length() + 7) // 8)
    return bytes([width]) + steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpack(packed: bytes) -> np.ndarray:
    width = packed[0]
    steps = np.zeros(((len(packed) - 1) // width, 8), np.uint8)
    steps[:, :width] = np.frombuffer(packed, np.uint8, offset=1).reshape(-1, width)
    return np.cumsum(steps.view("<u8").ravel(), dtype=np.uint64)


def pack_counts(counts: np.ndarray) -> bytes:
    return b"" if (counts == 1).all() else counts.astype("<u4").tobytes()


def unpack_counts(packed: bytes, n: int) -> np.ndarray:
    return np.frombuffer(packed, "<u4").astype(np.int64) if packed else np.ones(n, np.int64)


def short(names: np.ndarray) -> np.ndarray:
    return names >> np.uint64(64 - BITS)


def totals(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sum of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(keys) else counts


def in_buckets(keys: np.ndarray, bits: int, of: int = BITS) -> Iterable[tuple[int, slice]]:
    """Bucket and place of each stretch of ascending keys with the same leading bits."""
    if not len(keys):
        return
    bucket = (keys >> np.uint64(of - bits)).astype(np.int64)
    cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(keys)]
    for a, b in zip(cuts, cuts[1:]):
        yield int(bucket[a]), slice(a, b)


def table_of(columns: dict[str, list], schema: pa.Schema) -> pa.Table:
    return pa.table([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


SENT_SCHEMA = pa.schema([("g", pa.int64()), ("bucket", pa.int64()), ("names", pa.binary()), ("counts", pa.binary())])


def shared_names(dealt: DataFrame, bits: int, names_of: Callable[[pa.Table], tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """g, bucket, names, counts: per group those of its names that at least two documents have, and how many do.

    names_of: the names of a group's rows and the number of documents that have each (names may come repeatedly).
    """

    def send(rows: pa.Table) -> pa.Table:
        names, counts = names_of(rows)
        keys, counts = totals(short(names), counts)
        out = {f: [] for f in SENT_SCHEMA.names}
        for bucket, at in in_buckets(keys, bits):
            out["g"].append(rows.column("g")[0].as_py())
            out["bucket"].append(bucket)
            out["names"].append(pack(keys[at]))
            out["counts"].append(pack_counts(counts[at]))
        return table_of(out, SENT_SCHEMA)

    def answer(rows: pa.Table) -> pa.Table:
        keys = [unpack(x) for x in rows.column("names").to_pylist()]
        counts = [unpack_counts(x, len(k)) for x, k in zip(rows.column("counts").to_pylist(), keys)]
        known, total = totals(np.concatenate(keys), np.concatenate(counts))
        known, total = known[total > 1], total[total > 1]
        out = {f: [] for f in SENT_SCHEMA.names}
        for g, bucket, own in zip(rows.column("g").to_pylist(), rows.column("bucket").to_pylist(), keys):
            at = np.searchsorted(known, own)
            hit = np.zeros(len(own), bool)
            inside = at < len(known)
            hit[inside] = known[at[inside]] == own[inside]
            if hit.any():
                out["g"].append(g)
                out["bucket"].append(bucket)
                out["names"].append(pack(own[hit]))
                out["counts"].append(pack_counts(total[at[hit]]))
        return table_of(out, SENT_SCHEMA)

    return dealt.groupBy("g").applyInArrow(send, SENT).groupBy("bucket").applyInArrow(answer, SENT)


class SharedNames:
    """What a group was answered: how many documents have a name; 1 for names that were not returned."""

    def __init__(self, rows: pa.Table):
        keys = [unpack(x) for x in rows.column("names").to_pylist()]
        counts = [unpack_counts(x, len(k)) for x, k in zip(rows.column("counts").to_pylist(), keys)]
        if keys:
            self.keys, self.counts = totals(np.concatenate(keys), np.concatenate(counts))
        else:
            self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def documents(self, names: np.ndarray) -> np.ndarray:
        out = np.ones(len(names), np.int64)
        if len(self.keys):
            own = short(names)
            at = np.minimum(np.searchsorted(self.keys, own), len(self.keys) - 1)
            hit = self.keys[at] == own
            out[hit] = self.counts[at[hit]]
        return out
