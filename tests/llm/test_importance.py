from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from plinth.llm.importance import resample

LOWER = {c: c + 32 for c in range(65, 91)}


def runs(text, longest):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return len(w), [" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


def plain(rows, target, percent, least, longest, buckets, seed):
    at = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = (Counter(at(f) for x in texts for f in runs(x, longest)[1]) for texts in ([r[1] for r in rows], target))
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s.values()) + buckets) / ((s[b] + 1) * (sum(t.values()) + buckets)))) for b in range(buckets)]
    out = []
    for key, text in rows:
        n, f = runs(text, longest)
        weight = sum(gain[at(x)] for x in f)
        h = int(hashlib.sha256(f"{seed}:{'null' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append([key, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), n >= least])
    order = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    most = len(order) * percent // 100
    return sorted(([*r[:4], k + 1 if k < most else None] for r, k in [(r, k) for k, r in enumerate(order)] + [(r, most) for r in out if not r[4]]), key=repr)


def told(df):
    return sorted((list(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)


@pytest.mark.parametrize(("percent", "longest"), [(10, 1), (50, 2), (100, 3), (0, 1)])
def test_against_plain(spark, awkward, rows, percent, longest):
    target = ["alpha beta gamma delta", None, "", "the of the of 日本語 niño"]
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    out = resample(awkward, goal, percent, 5, longest, 97, keep=["doc_id"])
    assert told(out) == plain([(r[0], r[1]) for r in rows], target, percent, 5, longest, 97, "2024")


def test_ties_within_a_score(spark):
    """All rows have one score: ids decide, and rows without an id come last."""
    rows = [(None, "one two")] * 30 + [(7, "one two")] * 40
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    goal = spark.createDataFrame([("one",)], "text string")
    out = resample(df, goal, 50, 1, 1, 11).collect()
    assert sorted(r["rank"] for r in out if r["rank"]) == list(range(1, 36))
    assert told(resample(df, goal, 50, 1, 1, 11)) == plain(rows, ["one"], 50, 1, 1, 11, "2024")


def test_columns_and_empty_tables(spark, awkward, nothing):
    goal = spark.createDataFrame([], "text string")
    clash = awkward.withColumnsRenamed({"copy": "rank", "h": "score"})
    out = resample(clash, goal)
    assert out.columns == [*(c for c in clash.columns if c not in ("rank", "score")), "n_features", "weight", "score", "rank"]
    assert out.count() == awkward.count()
    assert resample(nothing, goal).count() == 0
