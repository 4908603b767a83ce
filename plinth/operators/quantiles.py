"""Exact quantiles of groups of any size.

The built-in percentile keeps a count for each distinct value of a group in one buffer.  Groups of up to LIMIT rows take it;
the ranks asked of larger groups are found by rounds of histograms over 64-bit keys in the order of the values: a round
counts 2**16 bins, goes down into the bins that hold a rank, and drops all other rows.  Bins are rows of a table, so
no task holds a group; a bin of few rows is sorted, a bin of one value is done.  Results are the same to the last bit.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType
from pyspark.sql.window import Window

from ..tables import durable

#: Rows of a group that the built-in percentile takes, and rows of a bin that are sorted instead of cut again.
LIMIT, FEW = 1 << 20, 1 << 16
#: Bits of a key that a round looks at.
STEP = 16

#: (expression, share from 0 to 1, condition or None)
Quantile = tuple[str, float, str | None]


@F.pandas_udf(LongType())
def ordered_key(v: pd.Series) -> pd.Series:
    """The bits of a double as a number in the order of the doubles; zeros are equal, NaN comes last."""
    bits = (v.to_numpy(dtype=np.float64) + 0.0).view(np.int64)
    return pd.Series(np.where(bits < 0, bits ^ np.int64(0x7FFFFFFFFFFFFFFF), bits))


def _built_in(name: str, q: Quantile) -> Column:
    return F.expr(f"percentile({q[0]}, {float(q[1])}D)" + (f" FILTER (WHERE {q[2]})" if q[2] else "")).alias(name)


def aggregated(df: DataFrame, by: Sequence[str], plain: Sequence[Column], wanted: Mapping[str, Quantile], limit: int | None = None) -> DataFrame:
    """by, the plain aggregates, and the quantiles by name (linear between ranks, null where there is no value)."""
    limit = LIMIT if limit is None else limit
    built_in = [_built_in(n, q) for n, q in wanted.items()]
    large = durable(df.groupBy(*by).agg(F.count("*").alias("__n")).where(F.col("__n") > limit).select(*by, F.lit(True).alias("__large")), "large")
    if large.isEmpty():
        return df.groupBy(*by).agg(*plain, *built_in)
    if not by:
        return df.agg(*plain).crossJoin(selected(df.withColumn("__all", F.lit(0)), ["__all"], wanted).drop("__all"))  # one row each
    small = df.join(large.drop("__large"), list(by), "left_anti").groupBy(*by).agg(*plain, *built_in)
    rows = df.join(large.drop("__large"), list(by), "left_semi")
    out = selected(rows, by, wanted)
    out = rows.groupBy(*by).agg(*plain).join(out, list(by)) if plain else out
    return small.unionByName(out)


def selected(df: DataFrame, by: Sequence[str], wanted: Mapping[str, Quantile]) -> DataFrame:
    """by (not null) and the quantiles by name, by rounds of histograms."""
    spark, by = df.sparkSession, list(by)
    series = list(dict.fromkeys((q[0], q[2]) for q in wanted.values()))
    value = lambda c, when: (F.expr(f"CASE WHEN {when} THEN {c} END") if when else F.expr(c)).cast("double")
    melted = df.select(*by, F.inline(F.array(*(F.struct(F.lit(i).alias("s"), value(*x).alias("v")) for i, x in enumerate(series))))).where("v IS NOT NULL")
    live = durable(melted.withColumn("key", ordered_key("v")), "values")
    asked = spark.createDataFrame([(n, series.index((q[0], q[2])), float(q[1])) for n, q in wanted.items()], "name string, s int, p double")
    position = live.groupBy(*by, "s").agg(F.count("*").alias("n")).join(F.broadcast(asked), "s").withColumn("at", F.col("p") * (F.col("n") - 1))
    ends = F.inline(F.array(*(F.struct(F.lit(side).alias("side"), f("at").cast("long").alias("rank")) for side, f in (("low", F.floor), ("high", F.ceil)))))
    position = durable(position.select(*by, "s", "name", "at"), "positions")
    open_ = position.select(*by, "s", "name", ends).withColumn("prefix", F.lit(0).cast("long"))
    live = live.withColumn("prefix", F.lit(0).cast("long"))
    found = []
    for shift in range(64 - STEP, -1, -STEP):
        keys = [*by, "s", "prefix"]
        bins = live.groupBy(*keys, F.shiftright("key", shift).alias("bin")).agg(F.count("*").alias("n"), F.min("v").alias("least"), F.max("v").alias("most"))
        up = F.sum("n").over(Window.partitionBy(*keys).orderBy("bin")) - F.col("n")  # 2 ** STEP bins at most
        hit = open_.join(bins.withColumn("before", up), keys).where((F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("n")))
        hit = durable(hit.withColumn("rank", F.col("rank") - F.col("before")).drop("before", "prefix"), "bins")
        told = (F.col("least") == F.col("most")) | F.lit(shift == 0)
        found.append(hit.where(told).select(*by, "name", "side", F.col("least").alias("value")))
        cut = live.drop("prefix").withColumn("bin", F.shiftright("key", shift))
        few = hit.where(~told & (F.col("n") <= FEW))
        lists = cut.join(few.select(*by, "s", "bin").distinct(), [*by, "s", "bin"], "left_semi").groupBy(*by, "s", "bin").agg(F.sort_array(F.collect_list("v")).alias("sorted"))
        found.append(few.join(lists, [*by, "s", "bin"]).select(*by, "name", "side", F.get("sorted", F.col("rank").cast("int")).alias("value")))
        open_ = hit.where(~told & (F.col("n") > FEW)).select(*by, "s", "name", "side", "rank", F.col("bin").alias("prefix"))
        if shift == 0 or open_.isEmpty():
            break
        live = durable(cut.withColumnRenamed("bin", "prefix").join(open_.select(*keys).distinct(), keys, "left_semi"), "values")
    ends_of = reduce(DataFrame.unionByName, found).groupBy(*by, "name").agg(*(F.max(F.when(F.col("side") == s, F.col("value"))).alias(s) for s in ("low", "high")))
    told = position.join(ends_of, [*by, "name"])
    between = (F.ceil("at") - F.col("at")) * F.col("low") + (F.col("at") - F.floor("at")) * F.col("high")
    told = told.withColumn("value", F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(between))
    out = told.groupBy(*by).agg(*(F.max(F.when(F.col("name") == n, F.col("value"))).alias(n) for n in wanted))
    return df.select(*by).distinct().join(out, by, "left")
