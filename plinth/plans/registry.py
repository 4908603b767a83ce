"""Queries by name, each with its operators' ids and, where SQL can express it, its oracle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .standins import ctes, view

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    name: str
    ids: str
    run: Query
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def query(ids: str, *views: str, sql: str | None = None) -> Callable[[Callable[..., DataFrame]], Callable[..., DataFrame]]:
    """Registers f(view, view, ...) under its name.  sql reads the same views; it follows their WITH clause."""

    def register(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(*(view(spark, sf_dir, v) for v in views))

        text = None
        if sql is not None:
            body = sql.strip()
            head = ctes(*views) if views else ""
            text = f"{head},\n{body[len('WITH '):]}" if head and body.startswith("WITH ") else f"{head}\n{body}"
        ENTRIES[f.__name__] = Entry(f.__name__, ids, run, text)
        return f

    return register


def r4(*columns: str) -> list[Column]:
    return [F.round(c, 4).alias(c) for c in columns]


def rounded_as_sql(*columns: str) -> list[Column]:
    """To four places in doubles, halves away from zero, as the SQL's round(): for many rows, as F.round() goes by decimal digits and takes longer than all else."""
    return [(F.signum(c) * F.floor(F.abs(c) * 10000.0 + 0.5) / 10000.0).alias(c) for c in columns]


def rounded(df: DataFrame, places: int = 4) -> DataFrame:
    """Doubles rounded at the query's boundary; operators keep them whole."""
    return df.select(*(F.round(c, places).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes))
