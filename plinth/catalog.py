"""Scans, writers and resumption over a folder of Parquet tables, with one entry point each.

SC-01/02/07 (open, named table, Parquet by path), SK-01..07 (overwrite, create, buffered append, export, query).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .schemas import STAGE_SCHEMAS
from .sources import stores


class Catalog:
    """Tables under one root: root/name.  Tables with a region_name are partitioned by it, so a region prunes files."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def exists(self, name: str) -> bool:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path(name))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def table(self, name: str) -> DataFrame:
        if name not in STAGE_SCHEMAS:
            return self.spark.read.parquet(self.path(name))
        if not self.exists(name):
            return self.spark.createDataFrame([], STAGE_SCHEMAS[name])
        return self.spark.read.schema(STAGE_SCHEMAS[name]).parquet(self.path(name))

    def scan(self, name: str, columns: Iterable[str] | None = None, region: str | None = None, filters: Mapping[str, object] | None = None) -> DataFrame:
        """SC-03: optional region, equality filters (None: IS NULL), projection.  All reach the Parquet scan."""
        return scan(self.table(name), columns, region, filters, region_col="name" if name == "regions" else "region_name")

    def _write(self, df: DataFrame, name: str, mode: str) -> None:
        writer = df.write.mode(mode)
        (writer.partitionBy("region_name") if "region_name" in df.columns else writer).parquet(self.path(name))

    def overwrite(self, df: DataFrame, name: str) -> None:
        self._write(df, name, "overwrite")

    def append(self, df: DataFrame, name: str, key: Iterable[str] = ("id",)) -> int:
        """One append a stage; rows whose key is there already are left out, so a rerun adds no second row."""
        new = pending(df, self.table(name), key) if self.exists(name) else df
        new = new.persist()
        try:
            count = new.count()
            if count:
                self._write(new, name, "append")
            return count
        finally:
            new.unpersist()

    def ensure(self, name: str) -> None:
        """SK-03: the empty table, if it is not there."""
        if not self.exists(name):
            self._write(self.spark.createDataFrame([], STAGE_SCHEMAS[name]), name, "ignore")

    def drop(self, name: str) -> None:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path(name))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def query(self, sql: str, tables: Iterable[str] = ()) -> DataFrame:
        """SK-07: SQL over tables of the catalog."""
        for name in tables:
            self.table(name).createOrReplaceTempView(name)
        return self.spark.sql(sql)

    def export(self, names: Iterable[str], to: str, form: str = "parquet") -> None:
        for name in names:
            writer = self.table(name).write.mode("overwrite")
            (writer.option("header", True) if form == "csv" else writer).format(form).save(f"{to}/{name}")


def scan(df: DataFrame, columns: Iterable[str] | None = None, region: str | None = None, filters: Mapping[str, object] | None = None, region_col: str = "region_name") -> DataFrame:
    if region is not None:
        df = df.where(F.col(region_col) == region)
    for name, value in (filters or {}).items():
        df = df.where(F.col(name).isNull() if value is None else F.col(name) == F.lit(value))
    return df.select(*columns) if columns else df


def pending(df: DataFrame, done: DataFrame, key: Iterable[str]) -> DataFrame:
    """JN-17: rows whose key is not done yet; nulls equal nulls."""
    key = list(key)
    keys = done.select(*(F.col(k).alias(f"__{k}") for k in key)).distinct()
    match = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in key]
    on = match[0]
    for m in match[1:]:
        on &= m
    return df.join(keys, on, "left_anti")


def standardised(df: DataFrame, names: Mapping[str, str], required: Mapping[str, str] | None = None) -> DataFrame:
    """PF-02/03: lower-case names, renamed by a map, and null columns for those that are missing."""
    out = df.select(*(F.col(f"`{c}`").alias(names.get(c.lower(), c.lower())) for c in df.columns))
    missing = {c: F.lit(None).cast(t) for c, t in (required or {}).items() if c not in out.columns}
    return out.withColumns(missing) if missing else out


def labelled(tables: Mapping[str, DataFrame], **columns: Mapping[str, object]) -> DataFrame:
    """ST-01: one table a region, with literal columns, as one bag; columns that some lack are null."""
    out = None
    for name, df in tables.items():
        df = df.withColumns({c: F.lit(v[name]) for c, v in columns.items()})
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def lookup(column: Column, names: Mapping[str, str | None]) -> Column:
    """PF-17: the name of a code; null for others."""
    entries = [F.lit(x) for pair in names.items() for x in pair]
    return F.try_element_at(F.create_map(*entries), column)


def valid_files(files: DataFrame, least: int = 1, magic: bytes | None = None) -> DataFrame:
    """VF-01: of a binaryFile scan, whether a file is long enough and begins as its type must."""
    ok = F.col("length") >= least
    if magic is not None:
        ok &= F.substring(F.hex("content"), 1, 2 * len(magic)) == magic.hex().upper()
    return files.withColumn("valid", ok)


def file_hashes(files: DataFrame, chunk: int = 1 << 20) -> DataFrame:
    """VF-02: of files (path, length), hashes read in chunks where the task runs, so a file may have any size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told: tuple[list[str], list[str]] = ([], [])
            for path in batch.column(0).to_pylist():
                store, at = stores.opened(path)
                both = hashlib.md5(), hashlib.sha256()
                with store.open_input_stream(at) as f:
                    while part := f.read(chunk):
                        for h in both:
                            h.update(part)
                for out, h in zip(told, both, strict=True):
                    out.append(h.hexdigest())
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(t, pa.string()) for t in told)], names=["path", "length", "md5", "sha256"])

    return files.select("path", "length").mapInArrow(run, "path string, length bigint, md5 string, sha256 string")


def file_index(spark: SparkSession, folder: str, pattern: str = "*.la[sz]") -> DataFrame:
    """SC-09/10: stem, path and length of files below a folder; of a stem's files .las comes before .laz."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(folder)
    name = F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1)
    kind = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))
    best = files.select(name.alias("stem"), F.struct(kind.alias("kind"), "path", "length").alias("f")).groupBy("stem").agg(F.min("f").alias("f"))
    return best.select("stem", "f.path", "f.length")


def stamped(df: DataFrame) -> DataFrame:
    """SF-10: the time of processing, without zone."""
    return df.withColumn("processed_at", F.current_timestamp().cast("timestamp_ntz"))


def limited(df: DataFrame, key: str, sample: float | None = None, limit: int | None = None, seed: int = 7) -> DataFrame:
    """IN-04: a share of the rows by the hash of their key, and at most limit of them by that hash; both are asked for."""
    h = F.xxhash64(F.lit(seed), F.col(key))
    if sample is not None:
        df = df.where(F.pmod(h, F.lit(1_000_000)) < sample * 1_000_000)
    return df.orderBy(h, key).limit(limit) if limit is not None else df


def table_names(text: str) -> list[str]:
    """Names in a comma list, in order, once each."""
    return list(dict.fromkeys(x for x in re.split(r"[,\s]+", text) if x))
