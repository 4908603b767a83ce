"""Connected components by alternating large-star and small-star rounds, without gathering a neighbourhood."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import durable, last_written, release, written

MAX_ROUNDS = 40


def components(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node reachable) for each node of edges (a, b: longs; both directions are one edge).

    Each round is two grouped minima, pre-aggregated map-side, and two joins that AQE may split at a hot node;
    what it leaves is written, so a lost executor repeats one round at most.
    """
    since = written()
    held = durable(_oriented(edges, "a", "b"), "edges")
    n = held.count()
    for _ in range(MAX_ROUNDS if n else 0):
        both = held.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(held.select(F.col("lo"), F.col("hi")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = durable(_oriented(both.join(durable(least, "least"), "u").where("v > u"), "v", "m"), "large")
        low = durable(large.groupBy("hi").agg(F.min("lo").alias("m")), "low")
        small = large.join(low, "hi")
        links = small.select(F.col("lo").alias("a"), F.col("m").alias("b")).union(small.select("hi", "m"))
        new = durable(_oriented(links, "a", "b"), "edges")
        at, before, n = last_written(), n, new.count()
        settled = n == before and new.join(held, ["hi", "lo"], "left_anti").isEmpty()
        held = new
        release(held.sparkSession, since, (at,))  # the round is over
        if settled:
            break
    else:
        if n:
            raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return held.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(held.select("lo", "lo").distinct())


def _oriented(edges: DataFrame, a: str, b: str) -> DataFrame:
    return edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct()

