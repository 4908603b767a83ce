"""URL filters: one trie over reversed host labels and path segments, longest match between allow and block."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import durable

#: The trie is broadcast only up to this many bytes of rules; beyond it rules are matched by an equi-join.
MAX_BROADCAST_BYTES = 32 << 20
_URL = re.compile(r"(?s)^.*?://([^/?#]*)([^?#]*)")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@dataclass(frozen=True)
class Rule:
    """host and all its subdomains, with paths that start with path."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return f"{self.host}{self.path}"

    @classmethod
    def parse(cls, verdict: str, text: str) -> Rule:
        host, slash, path = text.partition("/")
        return cls(host.translate(_LOWER), slash + path, verdict)


@dataclass
class _Node:
    """A host label or a path segment.  tails: rule ends within the next segment, as its prefix."""

    labels: dict[str, _Node] = field(default_factory=dict)
    segments: dict[str, _Node] = field(default_factory=dict)
    tails: list[tuple[str, Rule]] = field(default_factory=list)


class UrlTrie:
    """Longest match: more host labels first, then the longer path; equal rules: block wins."""

    def __init__(self, rules: Iterable[Rule]):
        self.root = _Node()
        for rule in sorted(rules, key=lambda r: (r.name, r.verdict != "block")):
            node = self.root
            for label in reversed(rule.host.split(".")):
                node = node.labels.setdefault(label, _Node())
            *whole, tail = rule.path.split("/")
            for segment in whole:
                node = node.segments.setdefault(segment, _Node())
            if all(t != tail for t, _ in node.tails):
                node.tails.append((tail, rule))
                node.tails.sort(key=lambda x: -len(x[0]))

    def match(self, host: str, path: str) -> Rule | None:
        if not host:
            return None
        best, node = None, self.root
        segments = path.split("/")
        for label in reversed(host.split(".")):
            node = node.labels.get(label)
            if node is None:
                break
            best = self._path(node, segments) or best
        return best

    @staticmethod
    def _path(node: _Node, segments: list[str]) -> Rule | None:
        best = None
        for segment in segments:
            for tail, rule in node.tails:
                if segment.startswith(tail):
                    best = rule
                    break
            node = node.segments.get(segment)
            if node is None:
                break
        return best


def split_url(url: str | None) -> tuple[str, str]:
    """host (A-Z lowered) and path; ('', '') for null or without ://."""
    found = _URL.match(url) if url is not None else None
    return (found[1].translate(_LOWER), found[2]) if found else ("", "")


def judge_urls(df: DataFrame, rules: list[Rule], id_col: str, url_col: str, default: str = "allow", max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """One row per row of df: id_col, host, path, rule, verdict.

    Null urls and urls without :// have an empty host and path and take the default.  Repeated rows stay
    repeated, an empty table gives an empty result, other columns are ignored.  The trie goes to the executors
    only while the rules are under max_bytes; larger lists are joined on (host suffix, path prefix) instead.
    """
    spark = df.sparkSession
    src = df.select(F.col(id_col).alias("k"), F.col(url_col).cast("string").alias("u"))
    out = f"`{id_col}` {df.schema[id_col].dataType.simpleString()}, host string, path string, rule string, verdict string"
    if sum(len(r.name.encode()) + 64 for r in rules) > max_bytes:
        return _judge_by_join(src, rules, id_col, default)
    held = spark.sparkContext.broadcast(UrlTrie(rules))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = held.value
        for batch in batches:
            parts = [split_url(u) for u in batch.column(1).to_pylist()]
            found = [trie.match(h, p) for h, p in parts]
            cols = [[h for h, _ in parts], [p for _, p in parts], [r and r.name for r in found], [r.verdict if r else default for r in found]]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.string()) for c in cols)], names=[id_col, "host", "path", "rule", "verdict"])

    return src.mapInArrow(judge, out)


def _judge_by_join(src: DataFrame, rules: list[Rule], id_col: str, default: str) -> DataFrame:
    """The same verdicts for lists too large to broadcast: an equi-join on every host suffix."""
    spark = src.sparkSession
    table = spark.createDataFrame([(r.host, r.path, r.verdict, r.name) for r in rules], "rh string, rp string, v string, rule string")
    url = src.select("k", F.monotonically_increasing_id().alias("n"), F.regexp_extract("u", r"(?s)^.*?://([^/?#]*)", 1).alias("h"), F.regexp_extract("u", r"(?s)^.*?://[^/?#]*([^?#]*)", 1).alias("path"))
    url = url.select("k", "n", F.coalesce(F.translate("h", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path"))
    url = durable(url, "urls")  # a row keeps its number when a task is repeated
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, -i, i), "."))
    hits = url.select("n", "path", F.explode(suffixes).alias("rh")).join(table, "rh").where(F.col("path").startswith(F.col("rp")) & (F.col("rh") != ""))
    order = F.struct(F.size(F.split("rh", r"\.")), F.length("rp"), (F.col("v") == "block").cast("int"), "rule", "v")
    best = hits.groupBy("n").agg(F.max(order).alias("b"))
    return url.join(best, "n", "left").select(F.col("k").alias(id_col), "host", "path", F.col("b.rule").alias("rule"), F.coalesce("b.v", F.lit(default)).alias("verdict"))
