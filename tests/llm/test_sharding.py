from __future__ import annotations

import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

import pytest

from plinth.llm.queries import SHARDS, op10_sharding
from plinth.llm.sharding import WHOLE, shard_by_bytes, write_shards

from ..conftest import DATA


def test_query_against_plain_rules(spark):
    """Every row of the table: sizes, CRCs, balance, slots and groups of equal texts."""
    sf = f"{DATA}/sf0.01"
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = {r["doc_id"]: r for r in op10_sharding(spark, sf).collect()}
    assert out.keys() == texts.keys()
    size, slots, shards_of = Counter(), defaultdict(list), defaultdict(set)
    for i, r in out.items():
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(texts[i]) + 8, zlib.crc32(texts[i]), "bytes", None)
        size[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        shards_of[texts[i]].add(r["shard"])
    mean, largest = sum(size.values()) / SHARDS, max(map(len, texts.values()))
    assert set(size) <= set(range(SHARDS)) and all(abs(v - mean) <= mean / 32 + largest for v in size.values())
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    copies = Counter(texts.values())
    assert all(len(s) == 1 or copies[t] * (len(t) + 8) > WHOLE * mean for t, s in shards_of.items())
    assert len(shards_of) < len(texts)


def test_write(spark, tmp_path):
    df = spark.range(500).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"), F.lit(1).alias("shards"))
    told = {(r["doc_id"], r["shard"], r["slot"]) for r in write_shards(df, f"{tmp_path}/a", 4).collect()}
    back = spark.read.parquet(f"{tmp_path}/a")
    assert {(r["doc_id"], r["shard"], r["slot"]) for r in back.collect()} == told and back.count() == 500
    with pytest.raises(ValueError):
        write_shards(df.union(df), f"{tmp_path}/b", 4)


def test_near_equal_and_gapless(spark):
    # a third of all rows share one text
    df = spark.range(12_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "the same text").otherwise(F.concat(F.lit("own "), F.repeat(F.lit("x"), (F.col("id") % 97).cast("int")), F.col("id").cast("string"))).alias("text"))
    out = shard_by_bytes(df, 24).collect()
    size, slots = Counter(), defaultdict(list)
    for r in out:
        size[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    mean = sum(size.values()) / 24
    assert len(size) == 24 and max(size.values()) < 1.05 * mean and min(size.values()) > 0.95 * mean
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert len({r["doc_id"] for r in out}) == 12_000
    # the hot text alone is cut, at shard borders
    where = defaultdict(set)
    for r in out:
        where[r["doc_id"] if r["doc_id"] % 3 else "hot"].add(r["shard"])
    assert all(len(v) == 1 for k, v in where.items() if k != "hot")


def test_columns(awkward, nothing, rows):
    out = shard_by_bytes(awkward, 5).collect()
    text = lambda r: (r[1] or "").encode()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == Counter((r[0], len(text(r)) + 8, zlib.crc32(text(r))) for r in rows)
    assert len({(r["shard"], r["slot"]) for r in out}) == len(rows)
    assert shard_by_bytes(nothing, 5).count() == 0


def test_the_same_in_any_splits(spark, monkeypatch):
    """Repeats in runs of three, null ids; the rows of a shard do not depend on how the table is read."""
    monkeypatch.setattr("plinth.llm.sharding.REPEATS", 3)
    rows = [(i % 400 if i % 7 else None, f"text {i % 90} " * (i % 5)) for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    one, other = (Counter(map(tuple, shard_by_bytes(d, 6).collect())) for d in (df.coalesce(1), df.repartition(9).orderBy(F.rand(3))))
    assert one == other and sum(one.values()) == 2000
    assert Counter((r[0], r[1], r[2]) for r in one.elements()) == Counter((i, len(t) + 8, zlib.crc32(t.encode())) for i, t in rows)
