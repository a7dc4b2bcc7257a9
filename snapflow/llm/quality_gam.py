"""Quality classifier: a generalised additive model with pairwise interactions.

Texts are described by a few ratios; each is cut into bins.  Training boosts shallow trees on one
ratio at a time in cyclic order and adds them up into a table of one value per bin; then the pairs of
ratios that explain most of what is left get tables over pairs of coarser bins.  A score is the
logistic function of a sum of looked-up values, so scoring is a few array additions per batch.

The model is fitted on at most ``max_rows`` labelled texts (those with the smallest hash of the id): a
bounded sample, the only data that the driver sees.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import schema_text, written
from .text_stats import BASE_COUNTS, MORE_COUNTS, with_counts

BINS, PAIR_BINS, LEAVES = 32, 8, 4
COUNTS = (*BASE_COUNTS, *MORE_COUNTS)


def ratios(c: dict[str, np.ndarray]) -> np.ndarray:
    """One row per text, one column per ratio; all are finite for empty texts too."""
    c = {k: v.astype(np.float64) for k, v in c.items()}
    words, chars, lines = (np.maximum(c[k], 1) for k in ("n_words", "word_chars", "n_lines"))
    return np.column_stack([
        np.log1p(c["n_words"]), c["word_chars"] / words, c["n_symbols"] / words, c["n_dup_lines"] / lines,
        c["n_repeat_words"] / words, np.log1p(c["n_words"] / lines), c["n_upper"] / chars, c["n_digits"] / chars,
        c["n_stops"] / words, c["n_bangs"] / words, c["n_high"] / chars, c["n_short"] / words, c["n_distinct"] / words,
    ])


@dataclass
class Model:
    edges: list[np.ndarray]  # upper bounds of all bins but the last, per ratio
    intercept: float
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)])

    def coarse(self, b: np.ndarray) -> np.ndarray:
        """Bins of the pair tables: as many of a ratio's own bins, in order, to each; a ratio with few bins keeps them apart."""
        own = np.array([max(len(e) + 1, 1) for e in self.edges])
        return b * np.minimum(own, PAIR_BINS) // own

    def score(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        c = self.coarse(b)
        total = np.full(len(x), self.intercept)
        for j, table in enumerate(self.tables):
            total += table[b[:, j]]
        for (i, j), table in zip(self.pairs, self.pair_tables):
            total += table[c[:, i], c[:, j]]
        return 1 / (1 + np.exp(-total))


def _tree(g: np.ndarray, h: np.ndarray, leaves: int, least: float) -> np.ndarray:
    """Step of every bin: ordered bins are split where the gain is largest, until there are so many leaves."""
    spans = [(0, len(g))]
    cg, ch = np.append(0, np.cumsum(g)), np.append(0, np.cumsum(h))
    value = lambda a, b: (cg[b] - cg[a]) ** 2 / (ch[b] - ch[a] + 1)
    while len(spans) < leaves:
        best = (1e-9, 0, 0)
        for k, (a, b) in enumerate(spans):
            for m in range(a + 1, b):
                if min(ch[m] - ch[a], ch[b] - ch[m]) >= least:
                    best = max(best, (value(a, m) + value(m, b) - value(a, b), k, m))
        gain, k, m = best
        if not m:
            break
        spans[k : k + 1] = [(spans[k][0], m), (m, spans[k][1])]
    out = np.zeros(len(g))
    for a, b in spans:
        out[a:b] = (cg[b] - cg[a]) / (ch[b] - ch[a] + 1)
    return out


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 120, rate: float = 0.1, n_pairs: int = 4) -> Model:
    """Boost on ratios x and labels y (0 or 1).  Without rows, or with one class, the model is a constant."""
    edges = []
    for j in range(x.shape[1]):
        cuts = np.quantile(x[:, j], np.arange(1, BINS) / BINS) if len(x) else np.zeros(0)
        edges.append(np.unique(cuts))
    good = (y.sum() + 0.5) / (len(y) + 1)
    model = Model(edges, float(np.log(good / (1 - good))), [np.zeros(BINS) for _ in edges], [], [])
    if len(np.unique(y)) < 2:
        return model
    b = model.bins(x)
    total = np.full(len(y), model.intercept)
    least = 0.002 * len(y) * good * (1 - good)

    def gradients(cell: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return np.bincount(cell, y - p, size), np.bincount(cell, p * (1 - p), size)

    for _ in range(rounds):
        for j, table in enumerate(model.tables):
            step = rate * _tree(*gradients(b[:, j], BINS), LEAVES, least)
            table += step
            total += step[b[:, j]]
    coarse = model.coarse(b)
    cells = {(i, j): coarse[:, i] * PAIR_BINS + coarse[:, j] for i, j in combinations(range(x.shape[1]), 2)}

    def gain(cell: np.ndarray) -> float:
        g, h = gradients(cell, PAIR_BINS**2)
        return float((g * g / (h + 1)).sum())

    model.pairs = sorted(cells, key=lambda p: -gain(cells[p]))[:n_pairs]
    model.pair_tables = [np.zeros((PAIR_BINS, PAIR_BINS)) for _ in model.pairs]
    for _ in range(rounds // 4):
        for pair, table in zip(model.pairs, model.pair_tables):
            g, h = gradients(cells[pair], PAIR_BINS**2)
            g, h = g.reshape(table.shape), h.reshape(table.shape)
            # a tree on the first ratio whose two branches are trees on the second
            cut = _tree(g.sum(1), h.sum(1), 2, least)
            step = np.zeros_like(table)
            for side in np.unique(cut):
                rows = cut == side
                step[rows] = rate * _tree(g[rows].sum(0), h[rows].sum(0), 2, least)
            table += step
            total += step.ravel()[cells[pair]]
    return model


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that no fit sees.  A null id is held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def train(counts: DataFrame, labels: DataFrame, id_col: str = "doc_id", max_rows: int = 30_000) -> Model:
    """Fit on labelled rows that are not held out: at most max_rows of them, by the smallest hash of the id.

    Labels other than 0 and 1 are ignored; of repeated labels of an id the lower counts.
    """
    known = (
        labels.where(F.col("quality").isin(0, 1) & ~held_out(id_col))
        .groupBy(id_col).agg(F.min("quality").alias("quality"))
    )
    order = F.xxhash64(F.col(id_col).cast("string"))
    # the chosen labels first: few rows then meet the counts
    chosen = known.orderBy(order, F.col(id_col)).limit(max_rows)
    rows = counts.join(chosen, id_col).orderBy(order, F.col(id_col)).select("quality", *COUNTS).limit(max_rows).toPandas()
    rows = rows.sort_values(list(rows.columns))
    x = ratios({c: rows[c].to_numpy(np.float64) for c in COUNTS})
    return fit(x, rows["quality"].to_numpy(np.float64))


def score(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", max_rows: int = 30_000) -> DataFrame:
    """id, held_out, score in [0, 1] for every row of docs; null and empty texts are scored as texts without words."""
    counts = written(with_counts(docs, (id_col,), text_col), "gam_counts")
    model = train(counts, labels, id_col, max_rows)
    source = counts.withColumn("held_out", held_out(id_col))

    def run(batches):
        for batch in batches:
            x = ratios({c: batch.column(c).to_numpy(zero_copy_only=False) for c in COUNTS})
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col), batch.column("held_out"), pa.array(model.score(x), pa.float64())],
                [id_col, "held_out", "score"],
            )

    return source.mapInArrow(run, schema_text(source, (id_col, "held_out")) + ", score double")
