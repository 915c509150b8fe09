"""URL filters: a trie over reversed host labels and path segments, broadcast, longest match first.

A rule is (action, host, path). It fits its host and all subdomains, if the url's path starts with the rule's path.
Among fitting rules the one with more host labels wins, then the one with the longer path; of equal rules, block wins.

Cases: a null url, or one without "://", has an empty host and path and fits no rule; a url that fits no rule gets the
default action; repeated rows are judged alike; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bound on the text of all rules in one broadcast trie. Longer lists go over the urls in several tries, one after the other.
MAX_TRIE_CHARS = 32 << 20


@dataclass(frozen=True)
class Rule:
    action: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return f"{self.host}{self.path}"


@dataclass
class _Node:
    """below: next host label or path segment; rules: the rest of a rule's path after its last full segment -> rule; lengths: of these rests, longest first."""

    below: dict = field(default_factory=dict)
    paths: _Node | None = None
    rules: dict = field(default_factory=dict)
    lengths: list = field(default_factory=list)

    def longest(self, segment: str) -> Rule | None:
        """The rule with the longest rest that the segment starts with: a look-up per length, however many rules there are."""
        for n in self.lengths:
            if n <= len(segment) and (rule := self.rules.get(segment[:n])) is not None:
                return rule
        return None


class RuleTrie:
    """Host labels from the right, then path segments from the left. A path rule may end within a segment."""

    def __init__(self, rules: Iterable[Rule]):
        self.root = _Node()
        for rule in rules:
            node = self.root
            for label in reversed(rule.host.translate(str.maketrans(UPPER, LOWER)).split(".")):
                node = node.below.setdefault(label, _Node())
            if node.paths is None:
                node.paths = _Node()
            *full, rest = rule.path.split("/")
            node = node.paths
            for segment in full:
                node = node.below.setdefault(segment, _Node())
            if len(rest) not in node.lengths:
                node.lengths = sorted([*node.lengths, len(rest)], reverse=True)
            if rest not in node.rules or rule.action == "block":
                node.rules[rest] = rule

    def find(self, host: str, path: str) -> Rule | None:
        """The fitting rule with the most host labels, then the longest path."""
        fits, node = [], self.root
        for label in reversed(host.split(".")):
            node = node.below.get(label)
            if node is None:
                break
            if node.paths is not None:
                fits.append(node.paths)
        segments = path.split("/")
        for paths in reversed(fits):
            best, node = None, paths
            for i, segment in enumerate(segments):
                best = node.longest(segment) or best  # a deeper rule's path is longer
                if i == len(segments) - 1:
                    break
                node = node.below.get(segment)
                if node is None:
                    break
            if best is not None:
                return best
        return None


def url_parts(url):
    """Columns host and path: the host from the first "://" up to "/", "?", "#" or the end, the path from there up to "?" or "#"."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def _tries(rules: list[Rule]) -> Iterator[list[Rule]]:
    part, size = [], 0
    for rule in rules:
        if part and size + len(rule.name) > MAX_TRIE_CHARS:
            yield part
            part, size = [], 0
        part.append(rule)
        size += len(rule.name)
    yield part


def judge_urls(pages: DataFrame, rules: Iterable[Rule], *, id_column: str = "page_id", url_column: str = "url", default: str = "allow") -> DataFrame:
    """One row per page: its id, host, path, rule (host and path of the rule that decides, or null) and verdict."""
    spark = pages.sparkSession
    host, path = url_parts(F.col(url_column))
    out = pages.select(F.col(id_column), host.alias("host"), path.alias("path")).withColumn("_rule", F.lit(None).cast("struct<host:string,path:string,action:string>"))
    for part in _tries(list(rules)):
        trie = spark.sparkContext.broadcast(RuleTrie(part))

        @F.pandas_udf("host string, path string, action string")
        def match(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
            find = trie.value.find
            for hosts, paths in batches:
                found = [find(h, p) for h, p in zip(hosts, paths)]
                yield pd.DataFrame([(r.host, r.path, r.action) if r else (None, None, None) for r in found], columns=["host", "path", "action"])

        new = F.col("_new")
        labels = lambda c: F.size(F.split(c["host"], r"\."))
        # Two rules that match a page with as many labels and as long a path are the same but for the action.
        longer = (F.length(new["path"]) > F.length("_rule.path")) | ((F.length(new["path"]) == F.length("_rule.path")) & (new["action"] == "block"))
        better = F.col("_rule").isNull() | F.col("_rule.host").isNull() | (labels(new) > labels(F.col("_rule"))) | ((labels(new) == labels(F.col("_rule"))) & longer)
        out = out.withColumn("_new", match("host", "path")).withColumn("_rule", F.when(new["host"].isNotNull() & better, new).otherwise(F.col("_rule"))).drop("_new")
    return out.select(id_column, "host", "path", F.concat("_rule.host", "_rule.path").alias("rule"), F.coalesce(F.col("_rule.action"), F.lit(default)).alias("verdict"))
