from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plinth.llm import language_id
from plinth.llm.language_id import LEAD, ORDER, UNIT, identify, learn, predict

from ..conftest import DATA


class Plain:
    """Prediction by partial matching, a byte and a context at a time."""

    def __init__(self, rows, nodes):
        self.n = defaultdict(Counter)
        for text, lang in rows:
            if text is not None and lang is not None:
                data = LEAD + text.encode()
                for i in range(ORDER, len(data)):
                    for k in range(ORDER + 1):
                        self.n[lang, k][data[i - k : i + 1]] += 1
        # a language whose texts are all empty has no counts, so it is not learned
        self.langs = sorted({lang for lang, _ in self.n})
        self.bits, self.escape = {}, {}
        for lang in self.langs:
            whole = sum(self.n[lang, 0].values())
            for k in range(ORDER + 1):
                total, kinds, own = Counter(), Counter(), Counter()
                kept = {g: c for g, c in self.n[lang, k].items() if c * nodes >= whole * len(self.langs)}
                for g, c in self.n[lang, k].items():
                    total[g[:-1]] += c
                    kinds[g[:-1]] += 1
                    own[g[:-1]] += c if g in kept else 0
                cost = lambda p: math.floor(-math.log2(p) * UNIT + 0.5)
                for g, c in kept.items():
                    self.bits[lang, g] = cost(c / (total[g[:-1]] + kinds[g[:-1]]))
                for c in own:
                    if own[c]:
                        self.escape[lang, c] = cost((total[c] + kinds[c] - own[c]) / (total[c] + kinds[c]))

    def length(self, lang, text):
        data, total = LEAD + text.encode(), 0
        for i in range(ORDER, len(data)):
            for k in range(ORDER, -1, -1):
                g = data[i - k : i + 1]
                if (lang, g) in self.bits:
                    total += self.bits[lang, g]
                    break
                total += self.escape.get((lang, g[:-1]), 0)
            else:
                total += 8 * UNIT
        return total

    def told(self, text):
        if text is None or not any(c.isalpha() for c in text) or not self.langs:
            return "und", 0.0
        bits = [self.length(x, text) for x in self.langs]
        best = min(bits)
        return self.langs[bits.index(best)], 1 / sum(2.0 ** -min((b - best) / UNIT, 1000) for b in bits)


@pytest.mark.parametrize("nodes", [1 << 19, 40])
def test_against_plain(awkward, rows, nodes):
    model = Plain([(r[1], r[2]) for r in rows], nodes)
    got = predict(awkward, learn(awkward, "text", "lang", nodes), "text", keep=["text"]).collect()
    assert len(got) == len(rows)
    for r in got:
        lang, score = model.told(r["text"])
        assert r["lang_pred"] == lang and abs(r["score"] - score) < 1e-3


def test_slices_give_every_byte_once(monkeypatch):
    """Short slices: each coded byte of each text, with its context, in order."""
    texts = ["abcdefghijklmnopqrstuvwxyz", "", "é", "x" * 100, "", "ab"]
    want = [[int.from_bytes((LEAD + t.encode())[i : i + ORDER + 1], "big") for i in range(len(t.encode()))] for t in texts]
    for size in (7, 16, 33, 1000):
        monkeypatch.setattr(language_id, "SLICE", size)
        got = [[] for _ in texts]
        for grams, rows, lengths in language_id._slices(pa.array([LEAD + t.encode() for t in texts], pa.binary())):
            at = 0
            for r, n in zip(rows.tolist(), lengths.tolist(), strict=True):
                got[r] += grams[at : at + n].tolist()
                at += n
            assert at == len(grams)
        assert got == want


def test_held_out_rows_are_told_right(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet")
    got = identify(docs, keep=["doc_id", "lang"]).where("held_out").collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in got)
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= 0.98 * len(got) > 0


def test_held_out_rows_are_not_learned_from(spark):
    rows = [(k, "abc" if zlib.crc32(str(k).encode()) % 4 == 2 else "xyz", "no" if zlib.crc32(str(k).encode()) % 4 == 2 else "yes") for k in range(40)]
    got = identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert {r["lang_pred"] for r in got} == {"yes"}


def test_awkward_and_empty_tables(spark, awkward, nothing):
    clash = awkward.withColumnRenamed("h", "score").withColumn("held_out", F.lit(3))
    out = identify(clash)
    assert out.columns == [*(c for c in clash.columns if c not in ("score", "held_out")), "held_out", "lang_pred", "score"]
    for r in out.collect():
        assert 0 <= r["score"] <= 1
        assert (r["lang_pred"] == "und") == (r["text"] is None or not re.search(r"[^\W\d_]", r["text"]))
    assert identify(nothing).count() == 0
    unknown = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert [(r["lang_pred"], r["score"]) for r in identify(unknown).collect()] == [("und", 0.0)]
