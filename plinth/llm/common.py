"""What the training-data operators share: durable tables, hot-key joins, text helpers."""

from __future__ import annotations

import gc
import time
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..tables import _written, durable, last_written, release, shared_folder, written  # noqa: F401

#: Fixed value: the ASCII white space that separates words.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bucketed(df: DataFrame, key: str, width: int) -> tuple[DataFrame, str]:
    """df written to the shared folder in buckets of key, and the name of its table, which is the caller's to drop.

    Groups and joins by key then read it in place: only the other side is shuffled.  No row moves to be written; the
    files are release()d as those of durable().
    """
    spark, name = df.sparkSession, f"plinth_{uuid.uuid4().hex}"
    path = f"{shared_folder(spark)}/plinth/{name}"
    df.write.option("path", path).option("compression", "uncompressed").bucketBy(width, key).saveAsTable(name, format="parquet")
    _written().append(path)
    return spark.table(name), name


def free_shuffles(spark: SparkSession) -> None:
    """Let the JVM drop the shuffle files of finished jobs before the next large one starts."""
    for _ in range(2):  # what Python lets go in the first round the JVM finds in the second
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.6)  # the cleaner works on a thread of its own


def let(value: Column, body) -> Column:
    """body(value) with value evaluated once a row, also where body uses it inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def ascii_lower(text: Column) -> Column:
    """A-Z lowered and nothing else.  Pure ASCII rows take the fast built-in path."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the runs starts[i] .. starts[i] + lengths[i], one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
