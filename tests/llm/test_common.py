from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from plinth.llm.common import ascii_lower, durable, let, release


def test_written_tables_are_released(spark):
    df = durable(spark.range(5), "t")
    assert df.count() == 5
    path = df.inputFiles()[0].rsplit("/", 1)[0]
    release(spark)
    with pytest.raises(AnalysisException):
        spark.read.parquet(path).count()


def test_lowering_touches_ascii_alone(spark):
    rows = spark.createDataFrame([("ÀB É z",), ("ABC",), ("",), (None,)], "t string").select("t", ascii_lower(F.col("t")).alias("l")).collect()
    assert {r["t"]: r["l"] for r in rows} == {"ÀB É z": "Àb É z", "ABC": "abc", "": "", None: None}


def test_let(spark):
    assert spark.range(1).select(let(F.lit(3), lambda v: v * v).alias("x")).first()["x"] == 9
