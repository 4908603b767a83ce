"""Importance resampling of documents towards the n-gram distribution of a target, by DataFrame functions.

A bucket's gain is the log ratio of its smoothed shares in the target and in the corpus; all gains are one array of
buckets entries, whatever the data.  A document's score is the sum of its gains and Gumbel noise of its id, so the
highest scores are a draw without replacement.  The draw never sorts the corpus: an exact histogram of the integer
scores, summed from the top, gives the rank of each score's first row and the cutoff.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from .common import ascii_lower, durable, let, shuffle_width

#: A word (of a lower-cased text), the buckets and the seed of the noise.
WORD = r"[0-9a-z\x{80}-\x{10FFFF}]+"
BUCKETS, SEED = 10_000, "2024"


def features(text: Column, longest: int) -> tuple[Column, Column]:
    """The number of words, and the array of all runs of 1 to longest words, joined by a space, with repeats."""
    words = F.regexp_extract_all(ascii_lower(F.coalesce(text.cast("string"), F.lit(""))), F.lit(WORD), F.lit(0))
    return F.size(words), words if longest == 1 else let(words, lambda w: F.concat(w, *(_joined(w, n) for n in range(2, longest + 1))))


def _joined(words: Column, n: int) -> Column:
    starts = F.when(F.size(words) >= n, F.sequence(F.lit(1), F.size(words) - (n - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.array_join(F.slice(words, i, n), " "))


def bucket_counts(df: DataFrame, text_col: str, longest: int, buckets: int) -> DataFrame:
    """bucket, n: features a bucket; a task sends one row a bucket at most."""
    runs = df.select(F.explode(features(F.col(f"`{text_col}`"), longest)[1]).alias("f"))
    return runs.groupBy(F.pmod(F.crc32("f"), F.lit(buckets)).alias("bucket")).agg(F.count("*").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, text_col: str, target_col: str, longest: int, buckets: int) -> list[int]:
    """floor(1000 ln) of the ratio of a bucket's shares, each with one added, for the buckets in order."""
    s, t = (bucket_counts(d, c, longest, buckets).withColumnRenamed("n", name) for d, c, name in ((corpus, text_col, "s"), (target, target_col, "t")))
    both = corpus.sparkSession.range(buckets).select(F.col("id").alias("bucket")).join(s, "bucket", "left").join(t, "bucket", "left").na.fill(0, ["s", "t"]).orderBy("bucket")
    rows = both.collect()  # one row a bucket
    all_s, all_t = (float(sum(r[c] for r in rows) + buckets) for c in ("s", "t"))
    return [math.floor(1000 * math.log((r["t"] + 1.0) * all_s / ((r["s"] + 1.0) * all_t))) for r in rows]


def scored(df: DataFrame, gain: list[int], id_col: str, text_col: str, longest: int, seed: str) -> DataFrame:
    """df with __words, n_features, weight and score."""
    n_words, runs = features(F.col(f"`{text_col}`"), longest)
    table = F.split(F.lit(",".join(map(str, gain))), ",").cast("array<bigint>")  # folded to a constant once
    at = F.transform("__runs", lambda f: F.pmod(F.crc32(f), F.lit(len(gain))).cast("int"))
    weight = F.aggregate(at, F.lit(0).cast("long"), lambda a, b: a + F.get(table, b))
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296.0)))
    out = df.withColumn("__runs", runs)
    out = out.withColumns({"__words": F.size("__runs") if longest == 1 else n_words, "n_features": F.size("__runs").cast("long"), "weight": weight}).drop("__runs")
    return out.withColumn("score", F.col("weight") + noise)


def offsets(scores: DataFrame) -> DataFrame:
    """score, n, above: the histogram of the scores, and how many rows lie above each.

    The histogram is dealt by ranges of scores and summed from the top within a range; the ranges' totals, one row
    a partition, give what lies above it.
    """
    counts = scores.groupBy("score").agg(F.count("*").alias("n"))
    dealt = durable(counts.repartitionByRange(shuffle_width(scores.sparkSession), F.desc("score")).withColumn("part", F.spark_partition_id()), "histogram")
    totals = dealt.groupBy("part").agg(F.sum("n").alias("n"))
    before = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    inside = Window.partitionBy("part").orderBy(F.desc("score"))
    above = F.col("before") + F.sum("n").over(inside) - F.col("n")
    return dealt.join(F.broadcast(before), "part").select("score", "n", above.alias("above"))


def drawn(rows: DataFrame, histogram: DataFrame, most: int, id_col: str) -> DataFrame:
    """rows, of scores that the draw reaches, with rank: rows above their score, plus their number by id within it.

    Rows are dealt by ranges of (score, id), so one score may have any number of rows; those of the same score in
    earlier ranges count as above.  Rows that tie in both are told apart by their other numbers.
    """
    tie = [F.col(f"`{id_col}`").asc_nulls_last(), F.col("n_features"), F.col("weight")]
    near = rows.join(histogram.where(F.col("above") < most).select("score", "above"), "score")
    dealt = durable(near.repartitionByRange(shuffle_width(rows.sparkSession), F.desc("score"), *tie).withColumn("__part", F.spark_partition_id()), "survivors")
    pieces = dealt.groupBy("score", "__part").agg(F.count("*").alias("__n"))
    earlier = pieces.select("score", "__part", (F.sum("__n").over(Window.partitionBy("score").orderBy("__part")) - F.col("__n")).alias("__earlier"))
    number = F.row_number().over(Window.partitionBy("score", "__part").orderBy(*tie))
    return dealt.withColumn("rank", number).join(earlier, ["score", "__part"]).withColumn("rank", F.col("above") + F.col("__earlier") + F.col("rank")).drop("above", "__part", "__earlier")


def resample(df: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, longest: int = 1, buckets: int = BUCKETS, seed: str = SEED, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """keep (default: all columns of df), n_features, weight, score, rank for each row of df.

    Drawn are, of the N rows with at least least_words words, the floor(percent N / 100) highest scores; rank counts
    them from 1, ties go to the smaller id, others have a null rank.  A null or empty text has no feature and weight
    0; a null id counts as the word null and comes last among ties; rows that repeat an id share the noise and are
    ranked one by one.  Columns of those four names are replaced.  An empty table gives an empty result, without a
    target all gains come from the smoothing.
    """
    mine = ("n_features", "weight", "score", "rank")
    rest = [c for c in keep or df.columns if c not in mine]
    need = df.select(*(F.col(f"`{c}`") for c in dict.fromkeys([*rest, id_col, text_col])))
    gain = gains(df.select(F.col(f"`{text_col}`").cast("string").alias("text")), target.select(F.col(f"`{target_col}`").cast("string").alias("text")), "text", "text", longest, buckets)
    told = scored(need, gain, id_col, text_col, longest, seed)
    held = durable(told.select(*(F.col(f"`{c}`") for c in dict.fromkeys([*rest, id_col])), (F.col("__words") >= least_words).alias("__able"), "n_features", "weight", "score"), "scores")
    able = held.where("__able")
    most = able.count() * percent // 100
    histogram = durable(offsets(able), "ranks")
    cut = histogram.where(F.col("above") < most).agg(F.min("score")).first()[0]
    reached = F.col("__able") & (F.col("score") >= F.lit(cut)) if cut is not None else F.lit(False)
    over = drawn(held.where(reached), histogram, most, id_col)
    over = over.withColumn("rank", F.when(F.col("rank") <= most, F.col("rank")))
    under = held.where(~reached).withColumn("rank", F.lit(None).cast("long"))
    out = [F.col(f"`{c}`") for c in rest] + [F.col(c).cast("long").alias(c) for c in mine]
    return over.select(*out).unionByName(under.select(*out))
