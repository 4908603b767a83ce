"""Sharding by sampled splitters: near equal bytes, gapless slots."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from .common import durable

#: Least ranges for each shard, most bytes of a mean range, samples for each range, and how full a range may be, in
#: mean ranges, before it is subdivided.  Driver and closures hold a splitter and a count for each range.
RANGES, RANGE_BYTES, SAMPLES, FULL = 128, 4 << 30, 4, 2.0
#: Share of a mean shard up to which equal texts are never parted.
WHOLE = 1 / 32
#: Rounds of subdivision; each one cuts every overfull range, so more are never needed and an error if they were.
ROUNDS = 64
#: Repeated rows that one task numbers at a time.
REPEATS = 1 << 16
_START = -(1 << 63)


def _ranges_of(keys: np.ndarray, ties: np.ndarray):
    """A column function: the number of splitters (key, tie) that are not above a row's (key, tie)."""

    @F.pandas_udf("int")
    def range_of(key: pd.Series, tie: pd.Series) -> pd.Series:
        k, t = key.to_numpy(), tie.to_numpy()
        low, high = np.searchsorted(keys, k, "left"), np.searchsorted(keys, k, "right")
        out = low.copy()
        rows = np.flatnonzero(high > low)
        for at in np.unique(low[rows]):
            own = rows[low[rows] == at]
            out[own] = at + np.searchsorted(ties[at : high[own[0]]], t[own], "right")
        return pd.Series(out.astype(np.int32))

    return range_of


def _drawn(seed: int, rate: float) -> Column:
    """Rows by chance, in proportion to their size; the same ones whatever the partitions."""
    return (F.pmod(F.xxhash64(F.lit(seed), "tie"), F.lit(1 << 40)).cast("double") / float(1 << 40)) < F.col("size") * rate


def _sample(rows: DataFrame, seed: int, rate: float) -> list[tuple[int, int]]:
    return sorted(map(tuple, rows.where(_drawn(seed, rate)).select("key", "tie").collect()))


def _thinned(sample: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Every SAMPLES-th, or the middle one."""
    return sample[SAMPLES - 1 :: SAMPLES] or sample[len(sample) // 2 :][:1]


def _keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, size, crc, key (a hash of the text) and tie, a hash of the id and of the row's number among its repeats.

    Repeats are alike in all of these, so they are counted and numbered anew; a table read in other splits gives the same rows.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    named = ["id", "size", "crc", "key"]
    rows = df.select(F.col(f"`{id_col}`").alias("id"), (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("crc"), F.xxhash64(text).alias("key"))
    counted = rows.groupBy(*named).agg(F.count("*").alias("n"))
    # repeats of one row are dealt in runs, so that none makes one task's work
    runs = counted.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / REPEATS)))).repartition("id", "key", "run")
    low = F.col("run") * REPEATS
    return runs.withColumn("nth", F.explode(F.sequence(low, F.least(low + REPEATS, F.col("n")) - 1))).select(*named, F.xxhash64("id", "nth").alias("tie"))


def shard_by_bytes(df: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: id, size, text_crc32, shard, slot.

    Rows are ordered by a hash of the text, so that equal texts lie together, then by a hash of the id.  Splitters
    are drawn from a sample weighted by size and lie before the first row of a text; ranges that turn out overfull
    are sampled again, and where the rows of one text make more than WHOLE of a shard, splitters lie among them.
    Ranges, with exact sizes, are then laid end to end into shards; slots count from 0 in each shard, without gaps.
    So equal texts share a shard, but for those of over WHOLE of a shard among which a shard's border falls.
    Size is the text's UTF-8 bytes (null: none) plus 8, the CRC of a null text is 0.  An empty table gives an empty
    result, repeated rows get slots of their own, other columns are ignored.  The order of rows and their splits change nothing.  One row is never divided, so a shard
    may exceed the mean by about the largest row.
    """
    spark = df.sparkSession
    rows = durable(_keyed(df, id_col, text_col), "keys")
    total = rows.agg(F.sum("size")).first()[0] or 0
    want = max(shards * RANGES, -(-total // RANGE_BYTES))
    rate = want * SAMPLES / max(total, 1)
    cuts = sorted({(k, _START) for k, _ in _thinned(_sample(rows, 11, rate))})
    for attempt in range(ROUNDS):
        range_of = _ranges_of(np.array([c[0] for c in cuts], dtype=np.int64), np.array([c[1] for c in cuts], dtype=np.int64))
        placed = rows.withColumn("range", range_of("key", "tie"))
        told = placed.groupBy("range").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"), F.max("size").alias("largest"), F.min("key").alias("low"), F.max("key").alias("high"))
        stats = {r["range"]: r for r in told.collect()}  # a row for each range
        most = {True: WHOLE * total / shards, False: FULL * total / want}
        over = {k: r for k, r in stats.items() if r["n"] > 1 and r["bytes"] > max(most[r["low"] == r["high"]], 1.5 * r["largest"])}
        if not over:
            break
        drawn: dict[int, list[tuple[int, int]]] = {k: [] for k in over}
        for k, key_, tie in placed.where(F.col("range").isin(list(over)) & _drawn(13 + attempt, 2 * rate)).select("range", "key", "tie").collect():
            drawn[k].append((key_, tie))
        found = set()
        for k, sample in drawn.items():
            low, high = over[k]["low"], over[k]["high"]
            picked = _thinned(sorted(sample))
            # among different texts a splitter lies before a text; the first one's end parts it from the others
            found |= set(picked) if low == high else {(key_, _START) if key_ > low else (low + 1, _START) for key_, _ in picked}
        cuts = sorted({*cuts, *found})
    else:
        raise RuntimeError(f"ranges still overfull after {ROUNDS} rounds")
    plan, done, slots = [], 0, [0] * shards
    for r in sorted(stats):
        shard = min(shards - 1, int((done + stats[r]["bytes"] / 2) * shards / max(total, 1)))
        plan.append((r, shard, slots[shard]))
        slots[shard] += stats[r]["n"]
        done += stats[r]["bytes"]
    layout = F.broadcast(spark.createDataFrame(plan, "range int, shard int, base long"))  # a row for each range
    inside = Window.partitionBy("range").orderBy("key", "tie")
    out = placed.withColumn("n", F.row_number().over(inside)).join(layout, "range")
    return out.select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard", (F.col("base") + F.col("n") - 1).cast("long").alias("slot"))


def write_shards(df: DataFrame, path: str, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes df under path/shard=N, and returns the assignment.  Ids must be unique and not null, which is checked.

    Columns named shard or slot are replaced.
    """
    told = durable(shard_by_bytes(df, shards, id_col, text_col), "shards")
    if not told.groupBy(id_col).count().where(f"count > 1 OR `{id_col}` IS NULL").isEmpty():
        raise ValueError("ids must be unique and not null to write shards")
    rest = df.select(*(F.col(f"`{c}`") for c in df.columns if c not in ("shard", "slot")))
    rest.join(told.select(id_col, "shard", "slot"), id_col).repartition("shard", F.floor(F.col("slot") / 100_000)).write.partitionBy("shard").parquet(path)
    return told
