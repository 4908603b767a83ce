"""Exact dedup by content-defined chunk recipes.  DataFrame functions only.

A document is cut where its own content says so, each chunk is replaced by a verified identifier, and documents
are compared by the ordered list of identifiers.  Whole texts never move: a chunk's content is shuffled once, to
verify that its hash names no other content, and documents travel as recipes of eight bytes a chunk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import ascii_lower, durable

#: A chunk ends where its content says so: within the first two letters of a word, b to d and a to h, after a word that
#: ends in a vowel, which is about every 400 characters of prose.  With 16 characters at least (and 4096 at most), nearly
#: every such place is a border wherever the chunk before began, so texts that differ meet again at the next one.
CHUNK = r"(?s).{16,4092}?[aeiouy]\s[b-d][a-h]|.{1,4096}"


def chunks(text: Column) -> Column:
    """The chunks of a text in order; their concatenation is the text.  Empty text: no chunk."""
    return F.regexp_extract_all(text, F.lit(CHUNK), F.lit(0))


def _hash64(chunk: Column) -> Column:
    return F.xxhash64(chunk)


def colliding(df: DataFrame, text: Column, hash_of=_hash64) -> DataFrame:
    """h, chunk: all contents of every hash that names two contents or more.

    Each distinct chunk is shuffled once; only if hashes collide are their contents fetched by a second pass.
    """
    cut = df.select(F.explode(chunks(text)).alias("chunk")).select(hash_of(F.col("chunk")).alias("h"), "chunk").distinct()
    twice = durable(cut.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "collisions")
    return twice.withColumn("chunk", F.lit("")) if twice.isEmpty() else durable(cut.join(twice, "h", "left_semi"), "collided")


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_of=_hash64) -> DataFrame:
    """One row per row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lowering A-Z; null counts as empty.  Of equal texts the row with the
    largest id stays (a null id is smaller than any other; rows that repeat an id are all kept or all dropped
    with it).  An empty table gives an empty result; other columns are ignored.
    """
    src = df.select(F.col(id_col).alias("k"), ascii_lower(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("t"))
    recipe = src.select("k", F.sha2("t", 256).alias("text_sha256"), F.transform(chunks(F.col("t")), lambda c: F.struct(hash_of(c).alias("h"), F.lit(0).alias("v"))).alias("recipe"))
    bad = colliding(src, F.col("t"), hash_of)
    if not bad.isEmpty():
        recipe = _resolved(src, bad, hash_of)
    # a recipe without collisions is an array of longs; the version is carried only where it decides
    recipe = recipe.select("k", "text_sha256", F.transform("recipe", lambda c: c["h"]).alias("r"), F.transform(F.filter("recipe", lambda c: c["v"] > 0), lambda c: c["v"]).alias("v"))
    recipe = durable(recipe, "recipes")
    groups = recipe.groupBy("r", "v").agg(F.max("k").alias("keep_id"), F.count("*").alias("group_size"))
    joined = recipe.join(durable(groups, "groups"), ["r", "v"])  # written, so that AQE may split a hot group's rows
    return joined.select(F.col("k").alias(id_col), "keep_id", "group_size", F.col("k").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def _resolved(src: DataFrame, bad: DataFrame, hash_of) -> DataFrame:
    """Recipes in which the contents that share a hash have versions 1, 2 ... in their order."""
    versions = bad.groupBy("h").agg(F.array_sort(F.collect_set("chunk")).alias("all")).select("h", F.posexplode("all").alias("v", "chunk"))
    rows = src.withColumn("row", F.monotonically_increasing_id())
    rows = durable(rows, "rows")
    cut = rows.select("row", F.posexplode(chunks(F.col("t"))).alias("pos", "chunk")).withColumn("h", hash_of(F.col("chunk")))
    told = cut.join(versions, ["h", "chunk"], "left").select("row", "pos", "h", F.coalesce(F.col("v") + 1, F.lit(0)).alias("v"))
    lists = told.groupBy("row").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "h", "v"))), lambda c: F.struct(c["h"].alias("h"), c["v"].alias("v"))).alias("recipe"))
    empty = F.array().cast("array<struct<h:bigint,v:int>>")
    return rows.join(lists, "row", "left").select("k", F.sha2("t", 256).alias("text_sha256"), F.coalesce("recipe", empty).alias("recipe"))
