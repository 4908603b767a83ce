from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import functions as F

import numpy as np

from plinth.llm import queries
from plinth.llm.quality_rules import DELTA, PATH, POOL, RISK, STEPS, STRATA, binomial_at_most, cutoffs, judge, keep_good

from ..conftest import DATA
from ..oracle import duck, same

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(t):
    w = WORD.findall(t or "")
    lines = [x for x in (t or "").split("\n") if WORD.search(x)]
    win = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if win[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    n = len(w)
    return n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(covered), n < 20 or 100 * len(covered) > 30 * n


def none(spark):
    return spark.createDataFrame([], "doc_id long, quality int")


def test_counts(spark, awkward, rows):
    more = spark.createDataFrame([(i, t, "en") for i, t in enumerate(["a b c d e f g h " * 3 + "x y", "1 2 3 4 5 6 7 8 1 2 3 4 5 6 7 8", "z " * 50, "q\x0bw\x0ce\r\nr\u00a0t\u2003u"])], "doc_id long, text string, lang string")
    for df in (awkward, more):
        plain = sorted(((r["doc_id"], *counts(r["text"])) for r in df.collect()), key=repr)
        got = sorted(((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in judge(df, none(spark)).collect()), key=repr)
        assert got == plain


def test_bound_is_the_exact_tail(spark):
    for k, n, p in ((0, 10, 0.3), (3, 40, 0.2), (5, 2000, 0.01), (90, 30_000, 0.004)):
        want = sum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)) for i in range(k + 1))
        got = spark.range(1).select(binomial_at_most(F.lit(k).cast("long"), F.lit(n).cast("long"), p)).first()[0]
        assert abs(got - want) < 1e-9 or got == 1.0 and k > n * p


def test_cutoffs_keep_good_documents(spark):
    words = "one two three four five six seven eight nine ten alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi"
    rows = [(i, f"{words} {i}", "en", 1) for i in range(3000)] + [(i, " ".join(w + "###" for w in f"{words} {i}".split()), "en", 0) for i in range(3000, 3200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, quality int")
    out = judge(df, df.select("doc_id", "quality")).collect()
    assert sum(r["kept"] for r in out if r["doc_id"] < 3000) >= (1 - RISK) * 3000
    assert not any(r["kept"] for r in out if r["doc_id"] >= 3000)
    few = judge(df, df.select("doc_id", "quality").where("doc_id < 100")).collect()
    assert all(r["kept"] for r in few)  # too few for any bound: only the base rules reject


def test_against_oracle_where_cutoffs_hold(spark):
    sf = f"{DATA}/sf0.01"
    con = duck(sf)
    same(spark, con, queries.op5_quality_rules, queries.OP5_SQL, sf)
    assert con.execute(f"SELECT count(*) FROM ({queries.OP5_SQL}) WHERE NOT base_failed AND NOT kept").fetchone()[0] > 0


def test_cutoffs_against_brute_force(spark):
    """Strata with their own bound, two small ones that pool, one whose first step fails, and rules that differ."""
    rng = np.random.default_rng(3)
    rows = []
    for stratum, n, scale in (("en", 900, 0.5), ("de", 260, 0.4), ("fr", 130, 0.3), ("es", 90, 0.2), ("*", 300, 6.0)):
        for _ in range(n):
            values = [float(v) for v in rng.exponential(scale * np.array([cuts[-1] if cuts[-1] > 0 else 0.1 for cuts in PATH.values()]) / 2)]
            values[4] = -5.0 + float(rng.exponential(scale / 6))
            rows.append((len(rows), stratum, bool(rng.random() < 0.05), *values))
    feats = spark.createDataFrame(rows, "id long, stratum string, base_failed boolean, " + ", ".join(f"{r} double" for r in PATH))
    labels = spark.createDataFrame([(r[0], int(r[0] % 40 > 0)) for r in rows] * 2 + [(None, 1), (-1, 1)], "doc_id long, quality int")
    level = DELTA / (len(STRATA) + 2)
    held = [r for r in rows if not r[2] and r[0] % 40]
    first = {r[0]: next((j for j in range(STEPS) if any(v > cuts[j] for v, cuts in zip(r[3:], PATH.values(), strict=True))), STEPS) for r in held}
    tail = lambda k, n: sum(math.comb(n, i) * RISK**i * (1 - RISK) ** (n - i) for i in range(k + 1))
    members = {s: [r for r in held if r[1] == s] for s in {r[1] for r in held}}
    small = {s for s, m in members.items() if tail(0, len(m)) > level}
    assert small == {"fr", "es"}
    want = {}
    for s, own in members.items():
        of = [r for x in small for r in members[x]] if s in small else own
        step = None
        for j in range(STEPS):
            k = sum(first[r[0]] <= j for r in of)
            if k > RISK * len(of) or tail(k, len(of)) > level:
                break
            step = j
        want[s] = (s in small, len(of), step)
    got = {r["stratum"]: (r["pooled"], r["n"], r["step"]) for r in cutoffs(feats, labels, "doc_id", "quality", STRATA).collect()}
    assert got == want and POOL not in got
    assert want["*"][2] is None and len({w[2] for w in want.values()}) > 2


def test_filter_and_empty(spark, awkward, nothing):
    kept = keep_good(awkward, none(spark))
    assert kept.columns == awkward.columns
    told = judge(awkward, none(spark)).where("kept").count()
    assert kept.count() == told
    assert judge(nothing, none(spark)).count() == 0
