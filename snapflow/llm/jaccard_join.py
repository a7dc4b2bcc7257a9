"""N-gram Jaccard join with signature trees.

1. Every document becomes its set of distinct word shingles.  shared_names() tells how many documents have each
   shingle.  With shingles ordered from rare to common, two sets can only be similar enough if they share one
   of their first few; a document whose first few occur nowhere else has no partner and is done.
2. The others are compared in buckets (those with the same smallest shingle under one of three hashes; a
   crowded bucket is split).  A bucket becomes a signature tree: rows ordered by size, nodes with the OR of
   their bitmaps and their range of sizes.  Pairs of nodes are walked down from the root; a pair is dropped if
   sizes or the largest possible overlap rule every link out, or if all its rows are already connected.
   What is left is verified on the sets, so a bucket yields a spanning forest of its true links.
3. Buckets by each of the first few shingles, as far as they hold more than one component so far, give the
   links that the three hashes missed: again by a tree, pairs of different components only.

The links of 2 and 3 connect exactly what all links connect; no pair inside a component is listed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import BASE, U64, TextBatch, mix
from .components import components
from .shared_names import SharedNames, deal, shared_names, table_of
from .tables import written

SHINGLE = 5
SIMILAR = 80  # per cent
WORDS_64 = 32  # 64-bit words of a bitmap
LEAF, FAN = 16, 8
BUCKET_ROWS = 2048
PAIR_ROWS = 4096  # rows of mixed shingles that a task compares, on average
MAX_TASKS = 10_000
HASHES = 3
LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])

_UPPER = np.arange(256, dtype=np.uint8)
_UPPER[65:91] += 32


class _Sets:
    """Shingle sets of a group's documents, laid end to end; one row stands for all rows of an id."""

    def __init__(self, rows: pa.Table, size: int):
        batch = TextBatch(rows.column("text").combine_chunks())
        batch.data = _UPPER[batch.data]
        words = np.diff(batch.first_word)
        at, hashes = batch.windows(size)
        text = batch.word_text[at]
        few = np.flatnonzero((words > 0) & (words < size))
        whole = [_fold(batch.word_hashes[batch.first_word[t] : batch.first_word[t + 1]]) for t in few]
        hashes, text = np.append(hashes, np.array(whole, U64)), np.append(text, few)
        order = np.lexsort((hashes, text))
        hashes, text = hashes[order], text[order]
        new = np.ones(len(text), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
        self.names, self.text = hashes[new], text[new]
        self.bound = np.searchsorted(self.text, np.arange(rows.num_rows + 1))
        self.size = np.diff(self.bound)
        ids = rows.column("id").to_pylist()
        sums = np.append(U64(0), np.cumsum(mix(self.names + BASE), dtype=U64))
        prints = (sums[self.bound[1:]] - sums[self.bound[:-1]]).tolist()
        chosen: dict[int, int] = {}
        for i, (doc, mark) in enumerate(zip(ids, prints)):
            if doc is not None and (doc not in chosen or (mark, i) < (prints[chosen[doc]], chosen[doc])):
                chosen[doc] = i
        self.ids, self.chosen = ids, chosen
        self.leading = np.array([chosen.get(doc, -1) == i for i, doc in enumerate(ids)], bool)


def _fold(hashes: np.ndarray) -> np.uint64:
    out = np.full(1, len(hashes), U64)
    for h in hashes:
        out = mix(out * U64(5) + h)
    return out[0]


def bitmap(names: np.ndarray) -> np.ndarray:
    out = np.zeros(WORDS_64 * 8, np.uint8)
    place = (names >> U64(32)).astype(np.int64) % (WORDS_64 * 64)
    np.bitwise_or.at(out, place >> 3, (1 << (place & 7)).astype(np.uint8))
    return out.view(U64)


def _bits(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).sum(axis=-1, dtype=np.int64)


class SignatureTree:
    """Rows ordered by set size; a node is a range of rows with the OR of their bitmaps and their sizes."""

    def __init__(self, bitmaps: np.ndarray, sizes: np.ndarray):
        self.bitmaps, self.sizes = bitmaps, sizes
        self.slack = sizes - _bits(bitmaps)  # elements that share a bit with another of their set
        n = len(sizes)
        spans = [(a, min(n, a + LEAF)) for a in range(0, n, LEAF)]
        ors = [np.bitwise_or.reduce(bitmaps[a:b]) for a, b in spans]
        self.nodes = [(a, b, m, int(self.slack[a:b].max()), ()) for (a, b), m in zip(spans, ors)]
        level = list(range(len(self.nodes)))
        while len(level) > 1:
            above = []
            for k in range(0, len(level), FAN):
                parts = level[k : k + FAN]
                own = [self.nodes[i] for i in parts]
                joined = np.bitwise_or.reduce([x[2] for x in own])
                self.nodes.append((own[0][0], own[-1][1], joined, max(x[3] for x in own), tuple(parts)))
                above.append(len(self.nodes) - 1)
            level = above
        self.root = level[0] if level else None

    def possible(self, i: int, j: int) -> bool:
        """May a row of node i and one of node j be similar, as far as sizes and bitmaps tell?"""
        a, b, left, slack_left, _ = self.nodes[i]
        c, d, right, slack_right, _ = self.nodes[j]
        if 100 * self.sizes[b - 1] < SIMILAR * self.sizes[c] or 100 * self.sizes[d - 1] < SIMILAR * self.sizes[a]:
            return False
        needed = -(-SIMILAR * int(self.sizes[a] + self.sizes[c]) // (100 + SIMILAR))
        return int(_bits(left & right)) + min(slack_left, slack_right) >= needed

    def walk(self, connected, visit) -> None:
        """visit(x, y) for all row pairs x < y that sizes and bitmaps allow; connected(rows, rows) cuts a pair of nodes off."""
        stack = [(self.root, self.root)] if self.root is not None else []
        while stack:
            i, j = stack.pop()
            a, b, _, _, left = self.nodes[i]
            c, d, _, _, right = self.nodes[j]
            if connected(slice(a, b), slice(c, d)) or not self.possible(i, j):
                continue
            if not left and not right:
                self._leaves(a, b, c, d, visit)
            elif i == j:
                stack += [(x, y) for k, x in enumerate(left) for y in left[k:]][::-1]
            elif left and (b - a >= d - c or not right):
                stack += [(x, j) for x in left]
            else:
                stack += [(i, y) for y in right]

    def _leaves(self, a, b, c, d, visit) -> None:
        x, y = np.arange(a, b)[:, None], np.arange(c, d)[None, :]
        small, large = np.minimum(self.sizes[x], self.sizes[y]), np.maximum(self.sizes[x], self.sizes[y])
        overlap = _bits(self.bitmaps[a:b, None] & self.bitmaps[None, c:d]) + np.minimum(self.slack[x], self.slack[y])
        fits = (100 * small >= SIMILAR * large) & ((100 + SIMILAR) * overlap >= SIMILAR * (small + large)) & (x < y)
        for p, q in zip(*np.nonzero(fits)):
            visit(a + int(p), c + int(q))


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    """x, y: ascending sets."""
    both = np.sort(np.concatenate([x, y]), kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= SIMILAR * (len(x) + len(y) - common)


def forest(ids: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links that connect what the true links among these rows connect."""
    order = np.argsort([len(s) for s in sets], kind="stable")
    ids, sets = ids[order], [sets[i] for i in order]
    tree = SignatureTree(np.array([bitmap(s) for s in sets]), np.array([len(s) for s in sets], np.int64))
    label = np.arange(len(sets))
    found = []

    def connected(left: slice, right: slice) -> bool:
        first = label[left.start]
        return right.stop - left.start > 1 and bool((label[left] == first).all() and (label[right] == first).all())

    def visit(x: int, y: int) -> None:
        if label[x] != label[y] and similar(sets[x], sets[y]):
            label[label == label[y]] = label[x]
            found.append((int(ids[x]), int(ids[y])))

    tree.walk(connected, visit)
    return found


def _salted(rows: DataFrame, keys: list[str], id_col: str, limit: int) -> DataFrame:
    """Rows of keys with at least two rows, with ``parts``: into how many parts the key is split."""
    counts = rows.groupBy(*keys).count().where("count > 1")
    parts = counts.select(*keys, F.ceil(F.col("count") / limit).cast("int").alias("parts"))
    return rows.join(parts, keys)


def similar_components(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE
) -> DataFrame:
    """id, n_shingles, component_id (the smallest id reachable over links) for every row of docs.

    Words are compared with A-Z lower-cased.  A text with fewer words than a shingle has its whole word sequence as
    its one shingle; a null text or one without words has none and is linked with nothing.  Links are exact: the
    overlap is at least SIMILAR per cent of the union.  Ids are integers; a row with a null id is linked with nothing
    and has a null component.  An id stands for one document: of rows that share it one set counts as the
    document's, and all of them get its component.  An empty table gives an empty result.
    """
    dealt, bits = deal(docs, id_col, text_col)

    def names(rows: pa.Table):
        sets = _Sets(rows, shingle)
        found = sets.names[sets.leading[sets.text]] if len(sets.text) else sets.names
        return found, np.ones(len(found), np.int64)

    answers = shared_names(dealt, bits, names)
    schema = pa.schema([
        ("id", pa.int64()), ("n_shingles", pa.int64()), ("print", pa.binary()), ("names", pa.binary()),
        ("prefix", pa.list_(pa.int64())), ("least", pa.list_(pa.int64())),
    ])

    def candidates(rows: pa.Table, answer: pa.Table) -> pa.Table:
        sets, shared = _Sets(rows, shingle), SharedNames(answer)
        documents = shared.documents(sets.names)
        out = {f: [] for f in schema.names}
        for i, doc in enumerate(sets.ids):
            at = slice(sets.bound[i], sets.bound[i + 1])
            n = int(sets.size[i])
            out["id"].append(doc)
            out["n_shingles"].append(n)
            prefix = None
            if n and sets.leading[i] and (documents[at] > 1).sum() >= -(-SIMILAR * n // 100):
                own, count = sets.names[at], documents[at]
                # a similar set shares at least SIMILAR per cent of this one, so one of these first
                first = np.lexsort((own, count))[: n - -(-SIMILAR * n // 100) + 1]
                prefix = own[first][count[first] > 1].view(np.int64).tolist()
            if prefix:
                out["prefix"].append(prefix)
                out["names"].append(own.tobytes())
                sums = [int(mix(own + U64(k)).sum(dtype=U64)) for k in (11, 12)]
                out["print"].append(np.array([*sums, n], U64).tobytes())
                out["least"].append([int(mix(own ^ U64(1000003 * k + 1)).min().view(np.int64)) for k in range(HASHES)])
            else:
                for c in ("prefix", "names", "print", "least"):
                    out[c].append(None)
        return table_of(out, schema)

    text = "id bigint, n_shingles bigint, print binary, names binary, prefix array<bigint>, least array<bigint>"
    sets = dealt.groupBy("g").cogroup(answers.groupBy("g")).applyInArrow(candidates, text)
    sets = written(sets, "shingle_sets")
    open_rows = sets.where("print IS NOT NULL")
    # equal sets are one class, of which the smallest id goes on
    classes = written(open_rows.groupBy("print").agg(F.min("id").alias("class_id")), "set_classes")
    leaders = open_rows.join(classes.select(F.col("class_id").alias("id")), "id", "left_semi").select("id", "names", "prefix", "least")
    leaders = written(leaders, "set_leaders")

    links = written(_bucket_links(leaders), "links")
    labels = written(components(links), "link_components")
    links = links.unionByName(_missed_links(leaders, labels))
    labels = written(components(links), "link_components")

    member = (
        open_rows.select("id", "print").join(classes, "print")
        .join(labels.withColumnRenamed("node", "class_id"), "class_id", "left")
        .select(F.col("id").alias("__id"), F.coalesce("component", "class_id").alias("component"))
    )
    whole = sets.select("id", "n_shingles").join(member, F.col("id") == F.col("__id"), "left")
    return whole.select(F.col("id").alias(id_col), "n_shingles", F.coalesce("component", "id").alias("component_id"))


def _bucket_links(leaders: DataFrame) -> DataFrame:
    """Step 2: links found in buckets of the same smallest shingle under one of the hashes."""
    keys = leaders.select("id", F.posexplode("least").alias("hash", "key"))
    salted = _salted(keys, ["hash", "key"], "id", BUCKET_ROWS)
    salted = salted.withColumn("part", F.pmod(F.xxhash64("id", "hash"), F.col("parts")))
    rows = leaders.select("id", "names").join(
        salted.groupBy("id").agg(F.collect_list(F.struct("hash", "key", "part")).alias("places")), "id"
    )
    rows = rows.select("id", "names", F.explode("places").alias("p")).select("id", "names", "p.*")

    def compare(group: pa.Table) -> pa.Table:
        ids = group.column("id").to_numpy()
        order = np.argsort(ids)
        names = group.column("names").to_pylist()
        found = forest(ids[order], [np.frombuffer(names[i], U64) for i in order])
        return table_of({"a": [x for x, _ in found], "b": [y for _, y in found]}, LINKS)

    return rows.groupBy("hash", "key", "part").applyInArrow(compare, "a bigint, b bigint")


def _missed_links(leaders: DataFrame, labels: DataFrame) -> DataFrame:
    """Step 3: links between different components that share one of their first shingles."""
    known = leaders.join(labels.withColumnRenamed("node", "id"), "id", "left")
    known = known.select("id", "names", "prefix", F.coalesce("component", "id").alias("component"))
    tokens = known.select("id", "component", F.explode("prefix").alias("token"))
    mixed = (
        tokens.groupBy("token").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("n"))
        .where("x <> y").select("token", F.ceil(F.col("n") / (BUCKET_ROWS // 2)).cast("int").alias("parts"))
    )
    places = written(tokens.join(mixed, "token").select("id", "token", "parts"), "mixed_tokens")

    def sign(batches):
        for batch in batches:
            sets = [np.frombuffer(x, U64) for x in batch.column("names").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), batch.column("component"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([bitmap(s).tobytes() for s in sets], pa.binary()),
                ],
                ["id", "component", "size", "bitmap"],
            )

    needed = places.select("id").distinct()
    signed = known.select("id", "names", "component").join(needed, "id", "left_semi")
    signed = signed.mapInArrow(sign, "id bigint, component bigint, size bigint, bitmap binary")
    # a crowded token is split into parts, and every two parts meet in one task
    part = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    dealt = (
        places.withColumn("part", part).join(signed, "id")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select(
            "token", F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q"),
            "part", "id", "component", "size", "bitmap",
        )
    )

    def pair(group: pa.Table) -> pa.Table:
        size = group.column("size").to_numpy()
        ids, component, part = (group.column(c).to_numpy() for c in ("id", "component", "part"))
        order = np.lexsort((ids, size))
        bitmaps = np.frombuffer(b"".join(group.column("bitmap").to_pylist()), U64).reshape(-1, WORDS_64)[order]
        ids, component, part = ids[order], component[order], part[order]
        across = group.column("p")[0].as_py() != group.column("q")[0].as_py()
        found = []

        def connected(left: slice, right: slice) -> bool:
            first = component[left.start]
            return bool((component[left] == first).all() and (component[right] == first).all())

        def visit(x: int, y: int) -> None:
            if component[x] != component[y] and (part[x] != part[y]) == across:
                found.append((min(ids[x], ids[y]), max(ids[x], ids[y])))

        SignatureTree(bitmaps, size[order]).walk(connected, visit)
        return table_of({"a": [int(x) for x, _ in found], "b": [int(y) for _, y in found]}, LINKS)

    # a number is given, since adaptive merging goes by bytes, and the work by pairs
    tasks = min(MAX_TASKS, int(places.agg(F.sum("parts")).first()[0] or 0) // PAIR_ROWS + 1)
    spread = dealt.repartition(tasks, "token", "p", "q")
    pairs = spread.groupBy("token", "p", "q").applyInArrow(pair, "a bigint, b bigint").distinct()
    sets = leaders.select("id", "names")
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("names").alias("x")), "a")
    both = both.join(sets.select(F.col("id").alias("b"), F.col("names").alias("y")), "b")

    def verify(batches):
        for batch in batches:
            columns = zip(batch.column("x").to_pylist(), batch.column("y").to_pylist())
            hit = pa.array([similar(np.frombuffer(x, U64), np.frombuffer(y, U64)) for x, y in columns], pa.bool_())
            yield batch.select(["a", "b"]).filter(hit)

    return both.mapInArrow(verify, "a bigint, b bigint")
