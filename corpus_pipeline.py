"""The corpus pipeline: quality rules, line dedup, SimHash near-dedup, mixing to weights, SentencePiece encoding.

Each stage takes (spark, docs, sf_dir) and all that its predecessor kept, and returns a DataFrame; all but the last
return the columns of documents.  Between stages the rows are written to the folder in spark.checkpoint.dir and
read again, so a lost executor repeats one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from plinth.llm import line_dedup, mixing, piece_bpe, quality_rules, simhash_wide
from plinth.llm.common import durable, last_written, release, table, written
from plinth.llm.queries import MIN_SITES, MIX_WEIGHTS, tokenizer_path

#: Near-duplicates: words of a shingle and the least similarity.
SHINGLE, SIMILARITY = 5, 0.8


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or a risk-controlled cutoff reject go."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many sites share stay in the first document only; no document goes."""
    cut = line_dedup.dedup_lines(docs, MIN_SITES)
    size = F.when(F.col("n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", size).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return simhash_wide.keep_one(docs, shingle=SHINGLE, similarity=SIMILARITY)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources repeat at the rates that bring them to their weights; the order is random."""
    return mixing.mix(docs, MIX_WEIGHTS).select(docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, ids and the hash of the text that the ids decode to."""
    proto = piece_bpe.read_model(tokenizer_path())
    told = piece_bpe.encode(docs.select("doc_id", "source", "text"), proto).select("doc_id", "source", "ids")
    back = piece_bpe.decode(told, proto)
    return back.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality rules", quality), ("line dedup", lines), ("near duplicates", near_duplicates), ("mixing", mixture), ("encoding", encoding)]

#: Similarity and encoding are beyond SQL; tests hold all rows of run() against plain stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents after all stages.  A stage's tables are deleted when its result is written; the last result is the caller's."""
    docs, since = table(spark, sf_dir, "documents"), written()
    for name, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir), name.replace(" ", "_"))
        release(spark, since, (last_written(),))
    return STAGES[-1][1](spark, docs, sf_dir)
