from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from plinth.operators import pointcloud as pc
from plinth.operators.quantiles import aggregated, ordered_key, selected

WANTED = {"low": ("v", 0.0, None), "p10": ("v", 0.1, None), "mid": ("v", 0.5, None), "p95": ("v", 0.95, None), "top": ("v", 1.0, None), "odd": ("v + 1", 0.3, "k % 2 = 1"), "none": ("v", 0.5, "k < 0")}


def told(df, by):
    return {tuple(r[b] for b in by): {n: r[n] for n in WANTED} | {"n": r["n"]} for r in df.collect()}


def test_keys_follow_the_order_of_doubles(spark):
    v = [float("-inf"), -1e300, -2.5, -5e-324, 0.0, 5e-324, 1.0, 1.0000000000000002, 1e300, float("inf"), float("nan")]
    got = [r["k"] for r in spark.createDataFrame([(x,) for x in v], "v double").coalesce(1).select(ordered_key("v").alias("k")).collect()]
    assert got == sorted(set(got)) and len(got) == len(v)
    assert len({r["k"] for r in spark.createDataFrame([(0.0,), (-0.0,)], "v double").select(ordered_key("v").alias("k")).collect()}) == 1


@pytest.mark.parametrize("limit", [0, 50, 1 << 20])
def test_groups_above_and_below_the_limit_agree(spark, limit):
    rng = np.random.default_rng(3)
    rows = [("normal", k, float(x)) for k, x in enumerate(rng.normal(0, 1e6, 300))] + [("few", k, float(x)) for k, x in enumerate(rng.integers(-3, 3, 200))]
    rows += [("wide", k, float(x)) for k, x in enumerate(10.0 ** rng.uniform(-300, 300, 60))] + [("same", k, 2.0) for k in range(70)] + [("one", 1, -7.5), ("null", 1, None), (None, 2, 4.0), (None, 3, 8.0)]
    df = spark.createDataFrame(rows, "g string, k long, v double").repartition(4)
    plain = F.expr
    want = told(df.groupBy("g").agg(F.count("*").alias("n"), *(plain(f"percentile({c}, {p}D)" + (f" FILTER (WHERE {w})" if w else "")).alias(n) for n, (c, p, w) in WANTED.items())), ["g"])
    assert told(aggregated(df, ["g"], [F.count("*").alias("n")], WANTED, limit), ["g"]) == want


def test_a_million_values_of_one_group(spark):
    """Rounds of bins: a mixed congruential order of 10**6 distinct values, most of them in one bin of the first round."""
    n = 1_000_003
    df = spark.range(n, numPartitions=8).select(F.lit(1).alias("g"), (1024.0 + F.pmod(F.col("id") * 7919 + 11, F.lit(n)) / float(n)).alias("v"), F.col("id").alias("k"))
    r = selected(df, ["g"], {"p25": ("v", 0.25, None), "mid": ("v", 0.5, None), "p999": ("v", 0.999, None)}).first()
    v = 1024.0 + np.arange(n) / n
    for name, p in (("p25", 0.25), ("mid", 0.5), ("p999", 0.999)):
        at = p * (n - 1)
        lo, hi = int(np.floor(at)), int(np.ceil(at))
        assert r[name] == (v[lo] if lo == hi else (hi - at) * v[lo] + (at - lo) * v[hi])


def test_without_groups_and_rows(spark):
    df = spark.range(101).select(F.col("id").alias("k"), F.col("id").cast("double").alias("v"))
    for limit in (10, 1000):
        assert aggregated(df, [], [F.count("*").alias("n")], {"mid": ("v", 0.5, None)}, limit).first().asDict() == {"n": 101, "mid": 50.0}
    assert aggregated(df.limit(0), ["k"], [], {"mid": ("v", 0.5, None)}, 0).count() == 0


def test_steps_cross_the_borders_of_ranges(spark):
    """One tile holds nearly all rows, so its rows lie in all ranges; numbers and steps are those of a window."""
    rng = np.random.default_rng(8)
    rows = [("hot", float(t), i) for i, t in enumerate(rng.integers(0, 300, 2000))] + [(f"t{i % 3}", float(i), i) for i in range(10)] + [(None, 1.0, 1), (None, 5.0, 2)]
    df = spark.createDataFrame(rows, "tile string, gps_time double, pid long").repartition(5)
    got = sorted((r["tile"], r["__n"], r["gps_time"], r["pid"], r["step"]) for r in pc.stepped(df, "tile", "gps_time", ["pid"], ["pid"]).where("tile IS NOT NULL").collect())
    want = []
    for tile in sorted({r[0] for r in rows if r[0]}):
        own = sorted((t, i) for g, t, i in rows if g == tile)
        want += [(tile, t, i, t - own[k - 1][0] if k else None) for k, (t, i) in enumerate(own)]
    assert [(a, c, d, e) for a, _, c, d, e in got] == want
    for tile in {w[0] for w in want}:
        n = [b for a, b, *_ in got if a == tile]
        assert n == list(range(n[0], n[0] + len(n)))
