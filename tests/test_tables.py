from __future__ import annotations

import threading

from pyspark.sql import functions as F

from plinth.operators import relational
from plinth.tables import durable, release, written


def test_threads_release_their_own_tables(spark):
    """Two queries at once: what one releases the other still reads."""
    wrote, released, told = threading.Event(), threading.Event(), {}

    def first():
        since = written()
        df = durable(spark.range(10), "first")
        wrote.set()
        released.wait(60)
        told["first"] = df.count()
        release(spark, since)

    def second():
        wrote.wait(60)
        since = written()
        durable(spark.range(3), "second")
        release(spark, since)
        told["left"] = written() - since
        released.set()

    threads = [threading.Thread(target=f) for f in (first, second)]
    for t in threads:
        t.start()
    for t in threads:
        t.join(120)
    assert told == {"first": 10, "left": 0}


def test_profile_counts_distinct_values_without_expand(spark):
    df = spark.range(100).select(F.when(F.col("id") % 4 > 0, F.col("id") % 7).alias("a"), F.lit(None).cast("string").alias("b"), F.concat(F.lit("x"), F.col("id") % 3).alias("c"), (F.col("id") % 2 == 0).alias("d"), (F.col("id") * 0.5).alias("e"))
    p = relational.profile(df)
    assert {r["column"]: (r["nulls"], r["distinct"]) for r in p.collect()} == {"a": (25, 7), "b": (100, 0), "c": (0, 3), "d": (0, 2), "e": (0, 100)}
    assert "Expand" not in p._jdf.queryExecution().executedPlan().toString()
    assert {r["column"]: (r["rows"], r["distinct"]) for r in relational.profile(df.limit(0)).collect()} == {c: (0, 0) for c in "abcde"}
