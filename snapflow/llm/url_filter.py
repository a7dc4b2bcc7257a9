"""URL filter: a trie over reversed host labels and then path segments, with longest-match precedence."""

from __future__ import annotations

import string
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"


def url_host(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def _segments(path: str) -> list[str]:
    """Pieces that end with their slash; the last may lack one."""
    return [s + "/" for s in path.split("/")[:-1]] + [s for s in path.split("/")[-1:] if s]


class UrlTrie:
    """Nodes are dicts: a host label or a path segment with its slash leads on; "" holds what ends here.

    What ends here: rules by the unfinished last segment of their path (mostly none).  A rule fits its host and all
    subdomains, and every path that starts with its own.  Of the rules that fit a url the one with the longest text
    wins, of equally long ones that with the longer host; a rule that is both allowed and blocked blocks.
    """

    def __init__(self, rules: Iterable[tuple[str, str]]):
        self.root: dict = {}
        for rule, verdict in sorted(rules, key=lambda r: (r[1] == BLOCK, r[0])):  # block overwrites allow
            if verdict not in (ALLOW, BLOCK):
                raise ValueError(f"{rule!r}: the verdict must be {ALLOW} or {BLOCK}")
            host, slash, path = rule.partition("/")
            node = self.root
            for label in reversed(host.lower().split(".")):
                node = node.setdefault(label, {})
            node = node.setdefault("/", {})  # from labels to segments; no label holds a slash
            pieces = _segments(slash + path)
            tail = "" if not pieces or pieces[-1].endswith("/") else pieces.pop()
            for piece in pieces:
                node = node.setdefault(piece, {})
            node.setdefault("", {})[tail] = (rule, verdict, len(host))

    def longest(self, host: str, path: str) -> tuple[str, str] | None:
        best, pieces = None, None
        node = self.root
        for label in reversed(host.split(".")):
            node = node.get(label)
            if node is None:
                break
            inner = node.get("/")
            if inner is None:
                continue
            pieces = _segments(path) if pieces is None else pieces
            for piece in [*pieces, ""]:
                for tail, (rule, verdict, size) in inner.get("", {}).items():
                    if piece.startswith(tail) and (best is None or (len(rule), size) > best[0]):
                        best = (len(rule), size), rule, verdict
                inner = inner.get(piece) if piece else None
                if inner is None:
                    break
        return best and best[1:]


def filter_urls(df: DataFrame, rules: Iterable[tuple[str, str]], *, url_col: str = "url", default: str = ALLOW) -> DataFrame:
    """All columns of df, and host, path, rule (the winning one; null if none fits) and verdict (default if none fits).

    rules: (text like ``example.net/en/``, "allow" or "block") pairs.  They come from the caller, so the trie, which is
    broadcast, is as large as the caller's list whatever the data.  A null or malformed url has empty host and path
    and fits no rule.  Columns of df with the new names are replaced.  Rows are judged one by one: repeated rows
    get the same verdict, an empty table an empty result.
    """
    new = ("host", "path", "rule", "verdict")
    trie = df.sparkSession.sparkContext.broadcast(UrlTrie(rules))
    kept = [c for c in df.columns if c not in new]
    url = F.col(f"`{url_col}`").cast("string")
    parts = df.select(*[F.col(f"`{c}`") for c in kept], url_host(url).alias("host"), url_path(url).alias("path"))

    @F.pandas_udf("rule string, verdict string")
    def judge(hosts, paths):
        found = map(trie.value.longest, hosts, paths)
        return pd.DataFrame([x or (None, default) for x in found], columns=["rule", "verdict"])

    judged = parts.withColumn("__found", judge("host", "path"))
    return judged.select(*parts.columns, "__found.rule", "__found.verdict")
