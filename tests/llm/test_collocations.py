from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from plinth.llm import collocations as C

LOWER = {c: c + 32 for c in range(65, 91)}


def grams(text, longest):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
        w = re.findall(r"[^\x20\x09]+", piece)
        for n in range(1, longest + 1):
            for i in range(len(w) - n + 1):
                yield tuple(w[i : i + n])


def plain(rows, longest, least, share, top):
    f = defaultdict(Counter)
    for text, lang in rows:
        f["und" if lang is None else lang].update(grams(text, longest))
    out = []
    for lang, c in f.items():
        found = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        inside = Counter()
        for p, a in found.items():
            for n in range(2, len(p)):
                for i in range(len(p) - n + 1):
                    inside[p[i : i + n]] = max(inside[p[i : i + n]], a)
        told = []
        for p, a in found.items():
            if 100 * inside[p] >= share * a and inside[p]:
                continue
            score, k = min((1_000_000 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            told.append((score, a, " ".join(p), c[p[:k]], c[p[k:]]))
        told.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        n = sum(a for p, a in c.items() if len(p) == 1)
        out += [(lang, i, p, a, l_, r, n, s) for i, (s, a, p, l_, r) in enumerate(told[:top], 1)]
    return sorted(out)


@pytest.mark.parametrize(("longest", "least", "top"), [(3, 3, 2000), (4, 2, 5), (2, 10, 2000)])
def test_against_plain(awkward, rows, longest, least, top):
    got = sorted(tuple(r) for r in C.collocations(awkward, longest, least, 50, top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())
    assert got and got == plain([(r[1], r[2]) for r in rows], longest, least, 50, top)


def test_full_sketches_lose_nothing(awkward, rows):
    """Far fewer counters than n-grams: all survive the first pass, and the second one counts them exactly."""
    counts, words = C.phrase_counts(awkward, "text", "lang", 3, 3, most=C.FEWEST)
    wide = sorted(map(tuple, counts.collect()))
    text = awkward.selectExpr("coalesce(lang, 'und') AS lang", "CAST(concat(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '\\n') AS BINARY) AS t")
    cells = C.BLOCK
    marks = C.frequent(C.sketch(text, cells, 3, 2), cells, 3)
    assert np.unpackbits(marks).mean() > 0.2
    narrow = C.survivors(text, marks, cells, 3).groupBy("lang", "phrase", "size").agg({"n": "sum"}).where("sum(n) >= 3 AND size > 0").selectExpr("lang", "CAST(phrase AS STRING)", "size", "`sum(n)`")
    assert sorted(map(tuple, narrow.collect())) == wide
    assert sum(r["n"] for r in words.collect()) == sum(len(g) == 1 for r in rows for g in grams(r[1], 1))


def test_short_runs_lose_no_phrase(monkeypatch):
    texts = ["one two three four five six", "", "a b.c d e", "x" * 50 + " y z", " . ", "tail"]
    want = Counter(g for t in texts for g in grams(t, 3))
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * len(texts)), pa.array([f"{t}\n".encode() for t in texts], pa.binary())], names=["lang", "t"])
    for size in (1, 5, 12, 1000):
        monkeypatch.setattr(C, "SLICE", size)
        got = Counter()
        for words, _, _, seeds in C._runs(batch, 3):
            known = words.words.to_pylist()
            for n, first, h in words.grams(seeds, 3):
                assert len(first) == len(h)
                got.update(tuple(known[c].decode() for c in words.code[i : i + n]) for i in first.tolist())
        assert got == want


def test_products_beyond_64_bits(spark):
    rows = [("en", "a", 1, 4 * 10**12), ("en", "b", 1, 5 * 10**12), ("en", "a b", 2, 3 * 10**12)]
    r = C.scores(spark.createDataFrame(rows, "lang string, phrase string, size int, n long")).first()
    assert r["score"] == 1_000_000 * 9 * 10**24 // (20 * 10**24)


def test_empty_table(nothing):
    assert C.collocations(nothing).count() == 0
