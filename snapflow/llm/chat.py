"""Chat formatting by quotation linking.

Messages are split into what their author wrote and what they quote, by level.  The paragraphs of both
are normalised and hashed; a quoted paragraph is joined with the first message of its conversation that
wrote it, and the message replies to that one.  Of a paragraph that nobody wrote before as a whole, as when
single lines or sentences are quoted, the longest run of lines and sentences that somebody wrote decides.
Threads are followed to their beginning by pointer jumping, so a chain of n replies takes log2(n) rounds,
each of them a join on (conversation, turn).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import slices
from .tables import schema_text, written

QUOTE = re.compile(r"[ \t]{0,3}((?:>[ \t]?)+)(.*)", re.DOTALL)
SENTENCE_END = re.compile(r"""[.!?\u2026\u3002\uff01\uff1f]["'\u201c\u201d\u2019\u00bb\u300d\u300f)\]}*_]*$""")
WIDE_END = re.compile("([\u3002\uff01\uff1f][\u201d\u2019\u300d\u300f\uff09]*)")
RUN_ROWS = 50_000
ATTRIBUTION_LINES = 3  # a longer paragraph is the author's own, whatever it ends in


def without_attribution(lines: list[str]) -> list[str]:
    """The author's own lines before a quote, without the one that says whose words follow.

    In any language that is a short paragraph of its own that ends in a colon, with nothing but blank lines between it and
    the quote; mail programs wrap it.
    """
    end = len(lines)
    while end and not lines[end - 1].strip():
        end -= 1
    begin = end
    while begin and lines[begin - 1].strip():
        begin -= 1
    if begin < end <= begin + ATTRIBUTION_LINES and lines[end - 1].rstrip().endswith((":", "\uff1a")):
        return lines[:begin]
    return lines


def split_quotes(text: str) -> list[tuple[int, list[str]]]:
    """Runs of lines of one quote level (0: the author's own).  A paragraph like "On Monday X wrote:" before a quote is dropped."""
    runs: list[tuple[int, list[str]]] = []
    for line in text.split("\n"):
        found = QUOTE.fullmatch(line)
        level, content = (found[1].count(">"), found[2]) if found else (0, line)
        if level and runs and runs[-1][0] == 0:
            kept = without_attribution(runs[-1][1])
            runs[-1:] = [(0, kept)] if kept else []
        if runs and runs[-1][0] == level:
            runs[-1][1].append(content)
        else:
            runs.append((level, [content]))
    return runs


def paragraphs(lines: list[str], sentences: bool = True) -> Iterator[list[str]]:
    """Lines and sentences (or lines alone) of each paragraph, a part ending where either does, with white space, case and
    quote marks made alike; blank lines part paragraphs."""
    block: list[str] = []
    for line in [*lines, ""]:
        line = line.replace(">", " ").lower()
        words = (line if line.isascii() else WIDE_END.sub(r"\1 ", line)).split()
        part: list[str] = [] if sentences else words
        for word in words if sentences else ():
            part.append(word)
            if SENTENCE_END.search(word):
                block.append(" ".join(part))
                part = []
        if part:
            block.append(" ".join(part))
        if block and not words:
            yield block
            block = []


def passage_hash(parts: list[str]) -> bytes:
    return hashlib.md5(" ".join(parts).encode()).digest()


def runs_of(parts: list[str], longest: int) -> Iterator[tuple[bytes, int]]:
    """Hash and number of characters of each run of parts, up to ``longest`` characters.  A run without a letter or digit
    says nothing."""
    for i in range(len(parts)):
        running, size, says = hashlib.md5(), -1, False
        for part in parts[i:]:
            size += 1 + len(part)
            if size > longest:
                break
            running.update((part if size == len(part) else " " + part).encode())
            says = says or any(c.isalnum() for c in part)
            if says:
                yield running.digest(), size


def parse_messages(messages: DataFrame, keep: tuple[str, ...], text_col: str) -> DataFrame:
    """The kept columns, ``own_text``, ``own_passages`` (hashes) and ``quoted`` (level, hash and parts)."""
    source = messages.select(*keep, F.col(f"`{text_col}`").cast("string").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "__text"):
            texts, own, quoted = [], [], []
            for text in part.column("__text").to_pylist():
                runs = split_quotes(text) if text is not None else []
                mine = [lines for level, lines in runs if level == 0]
                texts.append(None if text is None else "\n".join("\n".join(x) for x in mine).strip("\n") if len(mine) < len(runs) else text)
                own.append(list(dict.fromkeys(passage_hash(x) for lines in mine for x in paragraphs(lines, sentences=False))))
                quoted.append([{"level": k, "passage": passage_hash(x), "parts": x} for k, lines in runs if k for x in paragraphs(lines)])
            yield pa.RecordBatch.from_arrays(
                [
                    *part.columns[:-1], pa.array(texts, pa.string()), pa.array(own, pa.list_(pa.binary())),
                    pa.array(quoted, pa.list_(pa.struct([("level", pa.int32()), ("passage", pa.binary()), ("parts", pa.list_(pa.string()))]))),
                ],
                [*keep, "own_text", "own_passages", "quoted"],
            )

    added = "own_text string, own_passages array<binary>, quoted array<struct<level: int, passage: binary, parts: array<string>>>"
    return source.mapInArrow(run, f"{schema_text(source, keep)}, {added}")


def passage_runs(blocks: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """The kept columns, ``passage`` (hash) and ``size`` of each run of lines and sentences, up to ``longest`` characters.

    Blocks have ``parts``, those of one paragraph, or else ``own_text``.  A paragraph of n parts has n * n / 2 runs if none is
    too long; they leave the task in batches and are never gathered.
    """
    source = blocks.select(*keep, "longest", blocks.columns[-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place, hashes, sizes = [], [], []

            def made() -> pa.RecordBatch:
                kept = [c.take(pa.array(place, pa.int32())) for c in batch.columns[:-2]]
                return pa.RecordBatch.from_arrays([*kept, pa.array(hashes, pa.binary()), pa.array(sizes, pa.int64())], [*keep, "passage", "size"])

            for i, (longest, block) in enumerate(zip(batch.column("longest").to_pylist(), batch.columns[-1].to_pylist())):
                for parts in paragraphs(block.split("\n")) if isinstance(block, str) else [block]:
                    for digest, size in runs_of(parts, longest):
                        place.append(i)
                        hashes.append(digest)
                        sizes.append(size)
                        if len(place) == RUN_ROWS:
                            yield made()
                            place, hashes, sizes = [], [], []
            yield made()

    return source.mapInArrow(run, f"{schema_text(source, keep)}, passage binary, size bigint")


def link_parts(parsed: DataFrame, lost: DataFrame) -> DataFrame:
    """conv_id, turn, level, parent_turn of quoted paragraphs that nobody wrote before as a whole, by the longest run of their
    lines and sentences that somebody did, of equally long ones the latest original.

    Again originals are aggregated before the join.  Only messages before the last such quote of their conversation are
    looked at, and only runs no longer than the longest one.
    """
    lost = lost.withColumn("longest", F.length(F.array_join("parts", " ")).cast("long"))
    sought = lost.groupBy("conv_id").agg(F.max("longest").alias("longest"), F.max("turn").alias("last_turn"))
    texts = parsed.where("own_text IS NOT NULL").select("conv_id", "turn", "own_text")
    texts = texts.join(sought, "conv_id").where("turn < last_turn").select("conv_id", "turn", "longest", "own_text")
    originals = passage_runs(texts, ("conv_id", "turn")).groupBy("conv_id", "passage").agg(F.min("turn").alias("parent_turn"))
    keys = ("conv_id", "turn", "level", "block")
    blocks = lost.select("conv_id", "turn", "level", F.col("passage").alias("block"), "longest", "parts")
    found = passage_runs(blocks, keys).join(originals, ["conv_id", "passage"]).where(F.col("parent_turn") < F.col("turn"))
    best = F.min_by("parent_turn", F.struct(-F.col("size"), -F.col("parent_turn")))
    return found.groupBy(*keys).agg(best.alias("parent_turn")).drop("block")


def link_quotes(parsed: DataFrame) -> DataFrame:
    """conv_id, turn, parent_turn of every message that quotes an earlier one of its conversation.

    The original of a passage is the first message that wrote it, so originals are aggregated before the join and a
    passage that everyone writes or quotes makes no pairs.  A quoted paragraph that no earlier message has as a
    paragraph of its own is looked up in its parts.  Of several quotes the least nested wins, then the
    latest original.
    """
    quotes = parsed.select("conv_id", "turn", F.explode("quoted").alias("q")).select("conv_id", "turn", "q.*").distinct()
    # only conversations in which something is quoted
    quoting = parsed.where(F.size("quoted") > 0).select("conv_id").distinct()
    originals = (
        parsed.join(quoting, "conv_id", "left_semi")
        .select("conv_id", "turn", F.explode("own_passages").alias("passage"))
        .groupBy("conv_id", "passage").agg(F.min("turn").alias("parent_turn"))
    )
    earlier = F.col("parent_turn") < F.col("turn")
    looked_up = quotes.join(originals, ["conv_id", "passage"], "left").select(
        "conv_id", "turn", "level", "passage", F.when(earlier, F.col("parent_turn")).alias("parent_turn"),
        F.when(F.coalesce(earlier, F.lit(False)), None).otherwise(F.col("parts")).alias("parts"),
    )
    looked_up = written(looked_up, "quotes")
    linked = looked_up.where("parent_turn IS NOT NULL").select("conv_id", "turn", "level", "parent_turn")
    lost = looked_up.where("parent_turn IS NULL").drop("parent_turn")
    if not lost.isEmpty():
        linked = linked.unionByName(link_parts(parsed, lost))
    return linked.groupBy("conv_id", "turn").agg(F.min_by("parent_turn", F.struct("level", -F.col("parent_turn"))).alias("parent_turn"))


def thread_roots(links: DataFrame) -> DataFrame:
    """conv_id, turn, parent_turn, root_turn, depth for every linked message, by pointer jumping."""
    known = written(links.select("*", F.col("parent_turn").alias("up"), F.lit(1).cast("long").alias("depth")), "threads")
    while True:
        above = known.select("conv_id", F.col("turn").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"))
        joined = known.join(above, ["conv_id", "up"], "left")
        moved = joined.select(
            "conv_id", "turn", "parent_turn", F.coalesce("next", "up").alias("up"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.col("next").isNotNull().alias("moved"),
        )
        moved = written(moved, "threads")
        known = moved.drop("moved")
        if moved.where("moved").isEmpty():
            return known.withColumnRenamed("up", "root_turn")


def format_conversations(
    messages: DataFrame,
    *,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    begin: str = "<|{role}|>\n",
    end: str = "\n<|end|>\n",
) -> DataFrame:
    """Every message without its quotes, in reply order.

    conv_id, turn, role, text (null stays null; a message that only quotes becomes empty), parent_turn (null: it starts a
    thread), root_turn, depth and formatted (the turn in the chat template; a null text counts as empty, a null role as
    "unknown").  The result is sorted by conversation, thread (its root's turn) and turn, so threads stand together and
    every reply comes after what it answers.  A message without conversation or turn is linked with nothing.  Rows
    that share conversation and turn are one message as to links; repeated rows stay.  Columns of other names are dropped.
    """
    named = messages.select(
        F.col(f"`{conv_col}`").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"),
        F.col(f"`{role_col}`").alias("role"), F.col(f"`{text_col}`").alias("text"),
    )
    parsed = written(parse_messages(named, ("conv_id", "turn", "role"), "text"), "messages")
    links = thread_roots(link_quotes(parsed.where("conv_id IS NOT NULL AND turn IS NOT NULL")))
    whole = parsed.join(links, ["conv_id", "turn"], "left")
    before, _, after = begin.partition("{role}")
    formatted = F.concat(
        F.lit(before), F.coalesce("role", F.lit("unknown")), F.lit(after), F.coalesce("own_text", F.lit("")), F.lit(end)
    )
    return whole.select(
        "conv_id", "turn", "role", F.col("own_text").alias("text"), "parent_turn",
        F.coalesce("root_turn", "turn").alias("root_turn"), F.coalesce("depth", F.lit(0).cast("long")).alias("depth"),
        formatted.alias("formatted"),
    ).orderBy("conv_id", "root_turn", "turn")
