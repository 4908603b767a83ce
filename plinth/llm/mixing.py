"""Mixing sources to target weights by Poisson replication.  DataFrame functions only."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

SEED = 42


def uniform(seed: int, *parts: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of an MD5 of the seed and the parts (null: the word null)."""
    text = F.concat_ws(":", F.lit(str(seed)), *(F.coalesce(p.cast("string"), F.lit("null")) for p in parts))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def poisson_cdf(rate: Column) -> Column:
    """P(X <= k) for k = 0, 1 ... until the rest is below 1e-16: running sums, in logarithms, so that any rate will do."""
    top = F.ceil(rate + 12 * F.sqrt(rate) + 40).cast("int")
    none = F.exp(-rate)
    start = F.struct((-rate).alias("log"), none.alias("sum"), F.array(none).alias("cdf"))

    def step(a: Column, k: Column) -> Column:
        log = a["log"] + F.ln(rate) - F.ln(k.cast("double"))
        total = a["sum"] + F.exp(log)
        return F.struct(log.alias("log"), total.alias("sum"), F.array_append(a["cdf"], total).alias("cdf"))

    return F.when(rate > 0, F.aggregate(F.sequence(F.lit(1), top), start, step, lambda a: a["cdf"])).otherwise(F.array(F.lit(2.0)))


def repetition_rates(df: DataFrame, weights: Mapping[str, float], source_col: str, size: Column) -> DataFrame:
    """bucket, rate, cdf: one row for each named source that has rows, and one (null) for all others, which keep rate 1.

    The rows are at most len(weights) + 1 whatever the data, so the table may be broadcast.
    """
    spark = df.sparkSession
    named = spark.createDataFrame([(k, float(w)) for k, w in weights.items()], "bucket string, weight double")
    sizes = df.select(_bucket(weights, source_col).alias("bucket"), size.alias("n")).groupBy("bucket").agg(F.sum("n").cast("double").alias("n"))
    held = sizes.join(F.broadcast(named), "bucket", "left")
    total = held.where("bucket is not null and n > 0").agg(F.sum("n").alias("all_n"), F.sum("weight").alias("all_w"))
    rate = F.when(F.col("bucket").isNull() | (F.col("n") <= 0), 1.0).otherwise(F.col("weight") / F.col("all_w") * F.col("all_n") / F.col("n"))
    rates = held.join(F.broadcast(total)).select("bucket", F.coalesce(rate, F.lit(1.0)).alias("rate"))
    return rates.select("bucket", "rate", poisson_cdf(F.col("rate")).alias("cdf"))


def _bucket(weights: Mapping[str, float], source_col: str) -> Column:
    source = F.col(f"`{source_col}`").cast("string")
    return F.when(source.isin(*weights), source) if weights else F.lit(None).cast("string")


def mix(df: DataFrame, weights: Mapping[str, float], id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = SEED) -> DataFrame:
    """df with each row 0, 1, 2 ... times, in a global random order, plus copy (from 0) and shuffle_key.

    A source's rows repeat at the mean rate that brings its share of the text's bytes to its weight among the
    named sources; sources without a weight (and a null source) repeat at the mean rate 1, weight 0 removes a
    source.  The number of copies is the inverse of the Poisson distribution at a hash of the id, so it does not
    depend on partitions or retries; rows that repeat an id get equal numbers.  Null and empty texts count no
    bytes but are mixed like others; an empty table gives an empty result.  Columns named copy or shuffle_key are
    replaced.  A hot source is dealt out by the hash of row and copy, so no task holds more of it than another.
    """
    bytes_of = F.coalesce(F.octet_length(F.col(f"`{text_col}`")), F.lit(0)).cast("long")
    rates = repetition_rates(df, weights, source_col, bytes_of)
    rest = [F.col(f"`{c}`") for c in df.columns if c not in ("copy", "shuffle_key")]
    rows = df.select(*rest, _bucket(weights, source_col).alias("__b"), uniform(seed, F.col(f"`{id_col}`")).alias("__u"))
    rates = F.broadcast(rates.select(F.col("bucket").alias("__c"), F.col("cdf").alias("__cdf")))
    drawn = rows.join(rates, F.col("__b").eqNullSafe(F.col("__c"))).withColumn("__n", F.size(F.filter("__cdf", lambda c: c <= F.col("__u"))))
    copies = drawn.where("__n > 0").select(*rest, F.explode(F.sequence(F.lit(0), F.col("__n") - 1)).alias("copy"))
    key = F.md5(F.concat_ws(":", F.lit(f"{seed}/order"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("null")), F.col("copy").cast("string")))
    return copies.withColumn("shuffle_key", key).repartition("shuffle_key").sortWithinPartitions("shuffle_key")
