from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest

from pyspark.sql import functions as F

from plinth.llm import suffix_dedup
from plinth.llm.bwt import ShardBwt, repeated
from plinth.llm.suffix_dedup import dedup_passages, merge_spans


def shard(strings):
    data = np.frombuffer(b"".join(strings) + b"\0", dtype=np.uint8)
    n = np.array([len(s) for s in strings])
    return ShardBwt.of(data, np.cumsum(n) - n, n)


def test_merged_intervals_are_the_repeats():
    rng = random.Random(3)
    for _ in range(40):
        depth, letters = rng.choice([1, 3, 7, 9, 12]), rng.choice([b"ab", b"abcd", b"a", b"\0b"])
        strings = [bytes(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(1, 12))]
        owner = np.array([rng.randint(0, 4) for _ in strings])
        half = len(strings) // 2
        parts = [p for p in (slice(0, half), slice(half, None)) if strings[p]]
        for p in parts:
            s = shard(strings[p])
            order = [(strings[p][a][b:], a) for a, b in zip(s.string, s.offset, strict=True)]
            assert order == sorted(order)
        block, string, offset = repeated([shard(strings[p]) for p in parts], [owner[p] for p in parts], depth)
        got, want = defaultdict(set), defaultdict(set)
        for x, y, z in zip(block.tolist(), string.tolist(), offset.tolist(), strict=True):
            got[x].add((y, z))
        for i, t in enumerate(strings):
            for o in range(len(t) - depth + 1):
                want[t[o : o + depth]].add((i, o))
        want = [sorted(v) for v in want.values() if len({owner[i] for i, _ in v}) > 1]
        assert sorted(map(sorted, got.values())) == sorted(want)


def plain(rows):
    first = {}
    key = lambda i: float("inf") if i is None else i
    for i, t in sorted(rows, key=lambda r: key(r[0])):
        b = (t or "").encode()
        for p in range(len(b) - 49):
            first.setdefault(b[p : p + 50], key(i))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 49):
            if first[b[p : p + 50]] < key(i):
                gone[p : p + 50] = b"\1" * 50
        spans = []
        for k in range(len(b)):
            if gone[k] and (k == 0 or not gone[k - 1]):
                spans.append([k, k])
            if gone[k]:
                spans[-1][1] = k + 1
        out.append((i, len(b), [tuple(s) for s in spans], bytes(x for x, g in zip(b, gone, strict=True) if not g)))
    return sorted(out, key=repr)


def got(df, **options):
    return sorted(((r["doc_id"], r["n_bytes"], [(s["start"], s["end"]) for s in r["spans"]], bytes(r["kept"])) for r in dedup_passages(df, **options).collect()), key=repr)


@pytest.mark.parametrize("hot", [None, 2])
def test_against_brute_force(spark, awkward, rows, hot, monkeypatch):
    if hot:  # every anchor that is there twice takes the way of common ones
        monkeypatch.setattr(suffix_dedup, "RATE", 1)
    assert got(awkward, hot=hot) == plain([(r[0], r[1]) for r in rows])


@pytest.mark.parametrize("hot", [None, 2])
def test_rows_of_one_id_are_told_apart(spark, rows, hot, monkeypatch):
    if hot:
        monkeypatch.setattr(suffix_dedup, "RATE", 1)
    base = rows[5][1]
    more = [(r[0], r[1]) for r in rows] + [(None, "own start of a text " + base[40:400]), (None, "x" * 30 + base[100:300] + "another end"), (4, "other " * 3 + rows[3][1][:120]), (4, base[:200]), (2, base[50:150])]
    df = spark.createDataFrame(more, "doc_id long, text string").repartition(3)
    assert got(df, hot=hot) == plain(more)


def test_common_anchors_are_found_and_spread(spark):
    """A passage in every document: its anchors are hot, their records go over all buckets, the result stays."""
    rng = random.Random(4)
    noise = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    shared = noise(200)
    rows = [(i, noise(rng.randint(20, 60)) + shared + noise(rng.randint(20, 60))) for i in range(2500)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    hot = suffix_dedup.hot_anchors(df.select(F.col("doc_id").alias("doc"), F.col("text").alias("t")), 4000)
    assert 5 <= len(hot) <= 40
    assert got(df) == plain(rows)


def test_periodic_and_shifted(spark):
    rng = random.Random(9)
    noise = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    shared = noise(180)
    rows = [(i, noise(rng.randint(0, 90)) + shared[rng.randint(0, 60) : rng.randint(100, 180)] + noise(40)) for i in range(30)]
    rows += [(50, "ab" * 70), (51, "x" + "ab" * 40), (52, "b" * 49), (53, "b" * 50), (54, "b" * 51), (55, "é" * 30), (56, "zé" + "é" * 30)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got(df) == plain(rows)


def test_empty(nothing):
    assert dedup_passages(nothing).count() == 0
    assert merge_spans(np.array([1, 3, 9]), np.array([3, 5, 12])).tolist() == [[1, 5], [9, 12]]


def test_too_many_texts_of_one_id_are_an_error(spark, monkeypatch):
    monkeypatch.setattr("plinth.llm.suffix_dedup.ROWS", 2)
    df = spark.createDataFrame([(None, f"text {i}") for i in range(5)], "doc_id long, text string")
    with pytest.raises(ValueError, match="texts"):
        dedup_passages(df)
