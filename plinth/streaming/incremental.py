"""Incremental runs: what is new since the last one, once, by Structured Streaming over files.

The engine's inputs arrive as files; a run takes those that came since, and the checkpoint remembers them.  A stage
that keeps keys drops those already written, so a repeated file adds no second row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..catalog import pending


def new_files(spark: SparkSession, folder: str, schema: str, form: str = "parquet", per_trigger: int = 1000) -> DataFrame:
    """IN-01: a stream of the files of a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).format(form).load(folder)


def run_once(stream: DataFrame, stage: Callable[[DataFrame], DataFrame], to: str, checkpoint: str, key: Sequence[str]) -> None:
    """IN-01..03: all that is there now through stage, appended by key; ends when it has caught up."""
    spark = stream.sparkSession

    def put(batch: DataFrame, _: int) -> None:
        out = stage(batch).dropDuplicates(list(key))
        try:
            done = spark.read.parquet(to).select(*key)
        except Exception as e:  # the first run has no table yet
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
            done = None
        (out if done is None else pending(out, done, key)).write.mode("append").parquet(to)

    stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def redo(done: DataFrame, files: DataFrame, path_col: str, least: int = 1) -> DataFrame:
    """IN-02: rows whose output file is missing or too short, to be done again."""
    good = files.where(F.col("length") >= least).select(F.regexp_replace("path", "^file:/*", "/").alias("__p"))
    return done.join(good, F.regexp_replace(F.col(path_col), "^file:/*", "/") == F.col("__p"), "left_anti")
