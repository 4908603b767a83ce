"""Tables between the steps of a job, in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The cluster's spark.checkpoint.dir.  Only in local mode, where it may be unset, a folder is made and set."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        if held.isDefined():
            return held.get()
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        at = f"file://{tempfile.mkdtemp(prefix='plinth-')}"
        spark.sparkContext.setCheckpointDir(at)
        return spark.sparkContext._jsc.sc().getCheckpointDir().get()
    return at


def durable(df: DataFrame, name: str = "t", compression: str = "snappy") -> DataFrame:
    """df written to the shared folder and read again: lineage ends there and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/plinth/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    _written().append(path)
    return spark.read.schema(df.schema).parquet(path)


#: Tables that durable() wrote in this thread since the last release(); queries in other threads have lists of their own.
#: Who calls an operator owns what it leaves for its result to read: release() it when the result is stored.  What an
#: operator itself reads no more it releases itself.
_OWN = threading.local()


def _written() -> list[str]:
    if not hasattr(_OWN, "paths"):
        _OWN.paths = []
    return _OWN.paths


def written() -> int:
    """How many tables are there: a mark to release() from."""
    return len(_written())


def last_written() -> str:
    return _written()[-1]


def release(spark: SparkSession, since: int = 0, but: tuple[str, ...] = ()) -> None:
    """Deletes what durable() wrote after its first since tables; to be called when results that read it are stored."""
    paths = _written()
    gone = [p for p in paths[since:] if p not in but]
    paths[since:] = [p for p in paths[since:] if p in but]
    for at in gone:
        path = spark._jvm.org.apache.hadoop.fs.Path(at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
