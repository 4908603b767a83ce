from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import functions as F

from plinth.llm.mixing import mix, poisson_cdf


def test_distribution(spark):
    for rate in (0.01, 0.7, 3.0, 900.0):
        cdf = spark.range(1).select(poisson_cdf(F.lit(rate)).alias("c")).first()["c"]
        total = 0.0
        for k in range(len(cdf)):
            total += math.exp(-rate + k * math.log(rate) - math.lgamma(k + 1))
            assert abs(cdf[k] - total) < 1e-9
        assert cdf[-1] > 1 - 1e-9
    assert spark.range(1).select(poisson_cdf(F.lit(0.0)).alias("c")).first()["c"] == [2.0]


def test_shares(spark):
    df = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("word " * 20).alias("text"), F.when(F.col("id") % 10 == 0, "a").otherwise("b").alias("source"))
    out = mix(df, {"a": 1.0, "b": 1.0}).groupBy("source").count().collect()
    n = {r["source"]: r["count"] for r in out}
    assert abs(n["a"] / 10_000 - 1) < 0.05 and abs(n["b"] / 10_000 - 1) < 0.05


def test_edges(awkward, nothing):
    out = mix(awkward, {"src0": 2.0, "src1": 0.0, "gone": 1.0}).collect()
    assert not [r for r in out if r["source"] == "src1"]
    assert Counter((r["doc_id"], r["text"], r["copy"]) for r in out if r["doc_id"] is not None).most_common(1)[0][1] <= 2
    assert mix(nothing, {"src0": 1.0}).count() == 0
    again = mix(awkward.repartition(7), {"src0": 2.0, "src1": 0.0, "gone": 1.0}).collect()
    key = lambda rows: Counter((r["doc_id"], r["copy"]) for r in rows)
    assert key(out) == key(again)
