"""Allow and block rules for URLs as a trie over reversed host labels and path segments (operator 12).

A rule is a host and the beginning of a path. Its host's labels are read from the last one on (``com``,
``example``, ``www``), so a host and all its subdomains share a way down the trie; at a host's node the path's whole
segments lead on, and the unfinished last segment is kept as a beginning that the URL's next segment must have. A URL
walks its labels once and its segments once per node that has paths, and keeps the longest rule met, whether it
allows or blocks.

The trie is broadcast, so its text is bounded (``MOST_TEXT`` characters of rules, checked); larger rule tables
are joined instead, with the same result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwise.llm.common import holds_caches, map_texts
from cartwise.session import cut_lineage

ALLOW, BLOCK = "allow", "block"
MOST_TEXT = 8_000_000  # characters of all rules; a trie node is about 300 bytes
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ASCII_LOWER = str.maketrans(_UPPER, _LOWER)


class Rule(NamedTuple):
    verdict: str  # allow or block
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    at = url.find("://") if url else -1
    if at < 0:
        return "", ""
    rest = url[at + 3 :]
    for mark in "?#":
        rest = rest.partition(mark)[0]
    host, slash, path = rest.partition("/")
    return host.translate(_ASCII_LOWER), slash + path


class Node:
    __slots__ = ("children", "paths")

    def __init__(self):
        self.children: dict[str, Node] = {}
        self.paths: Segment | None = None  # where the rules' paths at this host start


class Segment:
    __slots__ = ("children", "starts")

    def __init__(self):
        self.children: dict[str, Segment] = {}
        self.starts: dict[int, dict[str, tuple]] = {}  # beginnings of the next segment, by length


class Trie:
    """The rules; ``best`` gives the rule of a host and path.

    The longest rule (characters of host and path) wins, then the longer host; of an allow and a block entry for
    the same host and path, the block entry.
    """

    def __init__(self, rules: Iterable[Rule]):
        self.root = Node()
        for r in rules:
            self._add(r)

    def _add(self, rule: Rule) -> None:
        if rule.verdict not in (ALLOW, BLOCK):
            raise ValueError(f"verdict of {rule.text}: {rule.verdict}")
        node = self.root
        for label in reversed(rule.host.translate(_ASCII_LOWER).split(".")):
            node = node.children.setdefault(label, Node())
        at = node.paths = node.paths or Segment()
        *whole, rest = rule.path.split("/")
        for segment in whole:
            at = at.children.setdefault(segment, Segment())
        key = (len(rule.text), len(rule.host), rule.verdict == BLOCK)
        held = at.starts.setdefault(len(rest), {})
        if rest not in held or held[rest][0] < key:
            held[rest] = (key, rule.host.translate(_ASCII_LOWER) + rule.path, rule.verdict)

    def best(self, host: str, path: str) -> tuple | None:
        """``(key, rule text, verdict)`` of the rule that decides, or None."""
        found, node, segments = None, self.root, path.split("/")
        for label in reversed(host.split(".")):
            node = node.children.get(label)
            if node is None:
                break
            at = node.paths
            for segment in segments if at is not None else ():
                for n, starts in at.starts.items():
                    hit = starts.get(segment[:n])
                    if hit is not None and (found is None or found[0] < hit[0]):
                        found = hit
                at = at.children.get(segment)
                if at is None:
                    break
        return found


_TRIES: dict[str, Trie] = {}


def _trie(name: str, sent) -> Trie:
    """The broadcast rules as a trie, built once per worker process."""
    if name not in _TRIES:
        _TRIES.clear()
        _TRIES[name] = Trie(sent.value)
    return _TRIES[name]


holds_caches("urls", _TRIES.clear)


def by_trie(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``(id, host, path, rule, ruled)`` of every row by the broadcast trie; rows stay where they are."""
    name, sent = uuid.uuid4().hex, pages.sparkSession.sparkContext.broadcast(list(rules))

    def run(urls: list) -> dict[str, list]:
        best = _trie(name, sent).best
        parts = [split_url(u) for u in urls]
        hits = [best(h, p) for h, p in parts]
        return {
            "host": [h for h, _ in parts],
            "path": [p for _, p in parts],
            "rule": [hit[1] if hit else None for hit in hits],
            "ruled": [hit[2] if hit else None for hit in hits],
        }

    return map_texts(pages, run, "host string, path string, rule string, ruled string", url_col, (id_col,), caches="urls")


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path as columns, by the same rule as ``split_url``."""
    after = r"(?s)^.*?://"
    host = F.coalesce(F.regexp_extract(url, after + "([^/?#]*)", 1), F.lit(""))
    return F.translate(host, _UPPER, _LOWER), F.coalesce(F.regexp_extract(url, after + "[^/?#]*([^?#]*)", 1), F.lit(""))


def by_join(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """The same rows for rule tables of any size: ``rules(verdict, host, path)`` are joined, not broadcast.

    Every distinct (host, path) asks for its host's suffixes together with its path up to each of its first
    slashes (no more than a rule has); a rule waits at its host and its path up to the last slash.
    """
    host, path = url_parts(F.col(f"`{url_col}`").cast("string"))
    urls = cut_lineage(pages.select(F.col(f"`{id_col}`").alias("__id"), host.alias("host"), path.alias("path")))
    r_host = F.translate("host", _UPPER, _LOWER)
    waits = rules.select("verdict", r_host.alias("r_host"), F.col("path").alias("r_path"), F.regexp_extract("path", "(?s)^(.*/)?", 0).alias("folder"))
    waits = waits.withColumn("depth", F.size(F.split("folder", "/")) - 1)
    deepest = waits.agg(F.max("depth")).first()[0] or 0
    distinct = urls.select("host", "path").distinct()
    labels, segments = F.split("host", r"\."), F.split("path", "/")
    hosts = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    folders = F.transform(F.sequence(F.lit(0), F.least(F.size(segments) - 1, F.lit(deepest))), lambda d: F.when(d == 0, F.lit("")).otherwise(F.concat(F.array_join(F.slice(segments, F.lit(1), d), "/"), F.lit("/"))))
    asks = distinct.select("host", "path", F.explode(hosts).alias("r_host"), folders.alias("f")).select("host", "path", "r_host", F.explode("f").alias("folder"))
    met = asks.join(waits, ["r_host", "folder"]).where(F.startswith("path", F.col("r_path")))
    text = F.concat("r_host", "r_path")
    rank = F.struct(F.length(text).alias("n"), F.length("r_host").alias("h"), (F.col("verdict") == BLOCK).alias("b"), text.alias("rule"), F.col("verdict").alias("ruled"))
    best = met.groupBy("host", "path").agg(F.max(rank).alias("b"))
    out = urls.join(best, ["host", "path"], "left")
    return out.select(F.col("__id").alias(id_col), "host", "path", F.col("b.rule").alias("rule"), F.col("b.ruled").alias("ruled"))


def judge(pages: DataFrame, rules: list[Rule] | DataFrame, default: str = ALLOW, id_col: str = "page_id", url_col: str = "url", most_text: int = MOST_TEXT) -> DataFrame:
    """``(id, host, path, rule, verdict)`` of every row: the longest fitting rule's text and verdict, else null and ``default``.

    ``rules``: a list of ``Rule`` or a table ``(verdict, host, path)``. A rule fits its host and all subdomains when
    the path starts with its path; host and path are as in ``split_url``, so a null, empty or relative URL has neither and
    no rule fits it. Very long URLs are taken whole. Repeated rows are judged each, a null id is kept, an empty table gives an empty
    one, no rules give the default. Only the two columns are read, so others cannot clash.

    Rules of up to ``most_text`` characters are broadcast as a trie, more are joined (``by_join``).
    """
    if isinstance(rules, DataFrame):
        size = rules.agg(F.sum(F.length("host") + F.length("path"))).first()[0] or 0
        if size <= most_text:
            rules = [Rule(r["verdict"], r["host"], r["path"]) for r in rules.select("verdict", "host", "path").collect()]
    elif sum(len(r.text) for r in rules) > most_text:
        rules = pages.sparkSession.createDataFrame(rules, "verdict string, host string, path string")
    found = by_join(pages, rules, id_col, url_col) if isinstance(rules, DataFrame) else by_trie(pages, rules, id_col, url_col)
    return found.select(F.col(f"`{id_col}`"), "host", "path", "rule", F.coalesce("ruled", F.lit(default)).alias("verdict"))
