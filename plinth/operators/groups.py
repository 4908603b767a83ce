"""Groups of up to SMALL rows, each worked on as a whole by one task; larger ones take the operators' joins."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ..tables import durable

#: Rows of a group that a task compares all with all.
SMALL = 1 << 12


def parted(rows: DataFrame, by: Sequence[str], small: int | None = None) -> tuple[DataFrame, DataFrame | None]:
    """rows in groups of up to small rows, and the other rows (None if there are none); rows with a null in by are in no group."""
    by = list(by)
    rows = rows.dropna(subset=by)
    n = rows.groupBy(*by).agg(F.count("*").alias("__n")).where(F.col("__n") > (SMALL if small is None else small))
    large = durable(n.select(*by), "large")  # at most one group in small rows
    if large.isEmpty():
        return rows, None
    return rows.join(large, by, "left_anti"), rows.join(large, by, "left_semi")


def dealt(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """rows with those of a group in one task, one after the other."""
    return rows.repartition(*by).sortWithinPartitions(*by)


def begins(keys: Sequence[pa.Array]) -> np.ndarray:
    """Where the groups of sorted rows begin; keys are their columns, all of some length."""
    new = np.zeros(len(keys[0]) - 1, dtype=bool)
    for c in keys:
        new |= pc.not_equal(c.slice(1), c.slice(0, len(c) - 1)).to_numpy(zero_copy_only=False)
    return np.append(0, np.flatnonzero(new) + 1)


def together(batches: Iterator[pa.RecordBatch], n_by: int) -> Iterator[pa.RecordBatch]:
    """Sorted rows in batches of about as many, none of which ends within a group."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = begins(batch.columns[:n_by])[-1]
        if held and (last or any(held[-1].column(i)[-1] != batch.column(i)[0] for i in range(n_by))):
            yield pa.Table.from_batches([*held, batch.slice(0, last)]).combine_chunks().to_batches()[0]
            held.clear()
        elif last:
            yield batch.slice(0, last)
        held.append(batch.slice(last))
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def packed(rows: DataFrame, by: Sequence[str], most: int) -> DataFrame:
    """Rows dealt by dealt() or the like, one after the other, as arrays: by, rows; a group of over most rows, or of more than one batch, has several."""
    n, rest = len(by), [f for f in rows.schema if f.name not in by]
    order = [*by, *(f.name for f in rest)]
    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in by)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                new = begins(batch.columns[:n])
                at = np.concatenate([np.arange(lo, hi, most) for lo, hi in zip(new, [*new[1:], batch.num_rows], strict=True)])
                held = pa.StructArray.from_arrays(batch.columns[n:], names=order[n:])
                lists = pa.ListArray.from_arrays(pa.array([*at, batch.num_rows], pa.int32()), held)
                yield pa.RecordBatch.from_arrays([*(c.take(pa.array(at)) for c in batch.columns[:n]), lists], names=[*by, "rows"])

    return rows.select(*order).mapInArrow(run, f"{kinds}, rows array<struct<{', '.join(f'`{f.name}`: {f.dataType.simpleString()}' for f in rest)}>>")


def runs(batches: Iterator[pa.RecordBatch], n_by: int) -> Iterator[pa.RecordBatch]:
    """The groups of sorted rows, each in one batch; the first n_by columns name the group."""
    held: list[pa.RecordBatch] = []

    def whole() -> pa.RecordBatch:
        out = held[0] if len(held) == 1 else pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        held.clear()
        return out

    for batch in batches:
        if not batch.num_rows:
            continue
        if held and any(held[-1].column(i)[-1] != batch.column(i)[0] for i in range(n_by)):
            yield whole()
        ends = [*begins(batch.columns[:n_by]), batch.num_rows]
        for lo, hi in zip(ends, ends[1:], strict=False):
            held.append(batch.slice(lo, hi - lo))
            if hi < batch.num_rows:
                yield whole()
    if held:
        yield whole()
