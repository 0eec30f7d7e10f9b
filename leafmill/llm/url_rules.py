"""URL filters: allow and block rules of a host and a path, by a trie over reversed host labels and path segments.

A rule fits its host and all subdomains, where the URL's path starts with the rule's (`/en/1` fits `/en/12`). Of the rules
that fit, that with the most host labels wins, then that with the longest path; of two with the same host and path, the
allow rule. What no rule fits gets `default`.

The trie is broadcast, MOST_RULES rules at most; more rules become several tries, each broadcast and asked in turn, and the
longest of their answers stays. A URL is looked up where it lies: nothing is shuffled and no URL meets another.

parts()  The host is what comes after the first `://` up to `/`, `?`, `#` or the end, with A-Z lower-cased; the path what then
         comes up to `?`, `#` or the end. A null URL or one without `://` has an empty host and an empty path. Host and path
         are taken as they are: a port, a user or a last dot belong to the host.

Rows come out one for each row, repeated ones alike. The columns host, path, rule and verdict replace columns of the
input with these names, in any case; the others stay. A table without rows gives none; without rules every verdict is `default`.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the registered query: (verdict, host, path).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: Rules of one trie at most, and what is said where no rule fits.
MOST_RULES, DEFAULT = 200_000, "allow"
RESULT = ("host", "path", "rule", "verdict")
#: In the order that answers are compared in; of equal rules the allowing one is the greater.
ANSWER = "struct<labels: int, size: int, allowed: boolean, verdict: string, rule: string>"

Rule = tuple[str, str, str]


class Trie:
    """Host labels from the last to the first, then path segments. A node: next labels or segments, and the last segments of
    rules that end there, by their length; a rule ends inside a segment, so its last segment only has to begin the URL's."""

    def __init__(self, rules: Iterable[Rule]):
        self.root: dict = {}
        for k, (verdict, host, path) in enumerate(rules):
            if verdict not in ("allow", "block"):
                raise ValueError(f"rule {k}: verdict {verdict!r}")
            node = self.root
            for label in reversed(host.lower().split(".")):
                node = node.setdefault("labels", {}).setdefault(label, {})
            node = node.setdefault("path", {})
            *whole, last = path.split("/")
            for segment in whole:
                node = node.setdefault("segments", {}).setdefault(segment, {})
            ends = node.setdefault("ends", {}).setdefault(len(last), {})
            if ends.get(last, ("block",))[0] != "allow":
                ends[last] = (verdict, host.lower() + path, (host.count(".") + 1, len(path)))

    def find(self, host: str, path: str) -> tuple[str, str, tuple[int, int]] | None:
        """(verdict, rule, its rank) of the rule that wins; of two rules the longer has the greater rank."""
        node, found, segments = self.root, None, path.split("/")
        for label in reversed(host.split(".")):
            node = node.get("labels", {}).get(label)
            if node is None:
                break
            found = (self._along(node["path"], segments) if "path" in node else None) or found
        return found

    @staticmethod
    def _along(node: dict, segments: list[str]) -> tuple[str, str, tuple[int, int]] | None:
        found = None
        for segment in segments:
            for size in sorted(node.get("ends", ()), reverse=True):
                if (hit := node["ends"][size].get(segment[:size])) is not None and size <= len(segment):
                    found = hit
                    break
            node = node.get("segments", {}).get(segment)
            if node is None:
                break
        return found


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL."""
    at = F.instr(url, "://")
    rest = F.coalesce(F.when(at > 0, F.substring_index(F.substring_index(F.substr(url, at + 3), "#", 1), "?", 1)), F.lit(""))
    host = F.substring_index(rest, "/", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.substr(rest, F.length(host) + 1)


def blocks(rules: Iterable[Rule], most: int) -> Iterator[list[Rule]]:
    it = iter(rules)
    while held := list(itertools.islice(it, most)):
        yield held


def judge(pages: DataFrame, rules: Iterable[Rule] = RULES, default: str = DEFAULT, url: str = "url", most: int = MOST_RULES) -> DataFrame:
    """pages with host, path, rule (host and path of the rule that won; null if none) and verdict (allow or block)."""
    host, path = parts(F.col(f"`{url}`").cast("string"))
    kept = [c for c in pages.columns if c.lower() not in RESULT]
    # The input goes along as one struct, so that no name of its columns meets one of ours.
    rows = pages.select(F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)]).alias("row"), host.alias("host"), path.alias("path"))
    answers = []
    for k, held in enumerate(blocks(rules, most)):
        rows = rows.withColumn(f"a{k}", asking(pages.sparkSession.sparkContext.broadcast(Trie(held)))("host", "path"))
        answers.append(F.col(f"a{k}"))
    best = F.array_max(F.filter(F.array(*answers), lambda a: a["rule"].isNotNull())) if answers else F.lit(None).cast(ANSWER)
    rows = rows.withColumn("best", best)
    return rows.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(kept)], "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


def asking(trie):
    """The answers of a broadcast trie, nulls where no rule fits."""

    @F.arrow_udf(ANSWER)
    def ask(hosts: pa.Array, paths: pa.Array) -> pa.Array:
        find = trie.value.find
        found = [find(h, p) for h, p in zip(hosts.to_pylist(), paths.to_pylist(), strict=True)]
        rows = [(*f[2], f[0] == "allow", f[0], f[1]) if f else (None,) * 5 for f in found]
        columns = list(zip(*rows, strict=True)) or [()] * 5
        kinds = (pa.int32(), pa.int32(), pa.bool_(), pa.string(), pa.string())
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["labels", "size", "allowed", "verdict", "rule"])

    return ask
