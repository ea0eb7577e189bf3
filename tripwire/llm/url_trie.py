"""URL filter: allow and block rules in one trie, longest match decides.

The trie runs over the host's labels from the right (`org`, `example`, ...) and
then over the segments of the path. A rule fits its host and every subdomain, if
the path of the URL starts with the path of the rule (character by character, so
`/en/1` fits `/en/123`). The rule with the most host labels wins, among these the
one with the longest path; an allow and a block entry for the same place: block.

Defined results: a URL that is null or has no `://` has host and path empty; when
no rule fits, `rule` is null and the verdict is `default`. Repeated rows and null
ids pass through one by one; an empty table gives an empty table. Only the
named columns are read, so further columns of any name do no harm.
"""
from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame

ALLOW, BLOCK = "allow", "block"

# One broadcast trie holds at most this many rules; longer lists are matched in
# several passes over the URLs, each with the next part of the rules.
RULES_PER_TRIE = 200_000

_URL = re.compile(r"://([^/?#]*)([^?#]*)", re.S)
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path of a URL."""
    m = _URL.search(url) if url else None
    return (m[1].translate(_LOWER), m[2]) if m else ("", "")


class _Paths:
    """Path part of the trie below one host: whole segments lead on, the last,
    possibly partial one is kept by its text."""
    __slots__ = ("next", "ends", "lengths")

    def __init__(self):
        self.next: dict[str, _Paths] = {}
        self.ends: dict[str, tuple[str, str]] = {}
        self.lengths: list[int] = []

    def add(self, path: str, rule: str, verdict: str) -> None:
        *whole, last = path.split("/")
        node = self
        for segment in whole:
            node = node.next.setdefault(segment, _Paths())
        if node.ends.get(last, ("", ""))[1] != BLOCK:
            node.ends[last] = (rule, verdict)
        node.lengths = sorted({len(x) for x in node.ends}, reverse=True)

    def longest(self, segments: Sequence[str]) -> tuple[str, str] | None:
        node, best = self, None
        for segment in segments:
            for n in node.lengths:
                if n <= len(segment) and (hit := node.ends.get(segment[:n])):
                    best = hit
                    break
            node = node.next.get(segment)
            if node is None:
                break
        return best


class UrlTrie:
    def __init__(self, rules: Sequence[tuple[str, str, str]]):
        """rules: (verdict, host, path)."""
        self.root: dict = {}
        for verdict, host, path in rules:
            if verdict not in (ALLOW, BLOCK) or (path and not path.startswith("/")):
                raise ValueError(f"not a rule: {verdict} {host}{path}")
            host, node = host.translate(_LOWER), self.root
            for label in reversed(host.split(".")):
                node = node.setdefault(label, {})
            node.setdefault(_Paths, _Paths()).add(path, f"{host}{path}", verdict)

    def match(self, host: str, path: str) -> tuple[str, str, int] | None:
        """(rule, verdict, host labels) of the rule that wins."""
        node, places = self.root, []
        for depth, label in enumerate(reversed(host.split(".")), 1):
            node = node.get(label)
            if node is None:
                break
            if _Paths in node:
                places.append((depth, node[_Paths]))
        segments = path.split("/") if places else ()
        for depth, paths in reversed(places):
            if hit := paths.longest(segments):
                return hit[0], hit[1], depth
        return None


def judge_urls(df: DataFrame, rules: Sequence[tuple[str, str, str]], id_col: str = "page_id",
               url_col: str = "url", default: str = ALLOW) -> DataFrame:
    """id, host, path, rule and verdict of every row. One map pass for each
    RULES_PER_TRIE rules; nothing is shuffled."""
    spark, kind = df.sparkSession, df.schema[id_col].dataType.simpleString()
    out = df.select(df[id_col], df[url_col])
    parts = [rules[i:i + RULES_PER_TRIE] for i in range(0, len(rules), RULES_PER_TRIE)] or [[]]
    for k, part in enumerate(parts):
        trie = spark.sparkContext.broadcast(UrlTrie(part))
        last = k == len(parts) - 1
        out = out.mapInArrow(
            _judge(trie, k == 0, last, default),
            f"`{id_col}` {kind}, host string, path string, rule string, verdict string"
            + ("" if last else ", labels int"))
    return out


def _judge(trie, first: bool, last: bool, default: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = trie.value.match
        for b in batches:
            if first:
                found = [(*split_url(u), None, None, 0) for u in b.column(1).to_pylist()]
            else:
                found = list(zip(*(b.column(i).to_pylist() for i in range(1, 6))))
            out = []
            for host, path, rule, verdict, labels in found:
                hit = match(host, path)
                if hit and (rule is None or (hit[2], len(hit[0])) > (labels, len(rule))
                            or hit[0] == rule and hit[1] == BLOCK):
                    rule, verdict, labels = hit
                out.append((host, path, rule, verdict or default if last else verdict, labels))
            cols = list(zip(*out)) if out else [()] * 5
            arrays = [b.column(0)] + [pa.array(c, pa.string()) for c in cols[:4]]
            names = [b.schema.names[0], "host", "path", "rule", "verdict"]
            if not last:
                arrays, names = arrays + [pa.array(cols[4], pa.int32())], names + ["labels"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)
    return run
