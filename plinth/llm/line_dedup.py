"""Line dedup by distinct-site spread: HyperLogLog sketches per line hash, exact counts near the threshold."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import WORD, durable

#: Relative error of the sketches, and the number of errors within which a line is counted exactly.
RSD, BAND = 0.138, 6


def split_lines(df: DataFrame, id_col: str, text_col: str, site_col: str) -> DataFrame:
    """id, th (hash of the text; id and th name a row), site, pos and a 128-bit hash of each line that has a word."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    src = df.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("th"), F.coalesce(F.col(f"`{site_col}`").cast("string"), F.lit("")).alias("site"), text.alias("t"))
    cut = src.select("id", "th", "site", F.posexplode(F.split("t", "\n", -1)).alias("pos", "line")).where(F.col("line").rlike(WORD))
    return cut.select("id", "th", "site", "pos", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(7), F.col("line")).alias("h2"))


def widespread(lines: DataFrame, min_sites: int, rsd: float = RSD) -> DataFrame:
    """h1, h2, first (smallest id): the lines that min_sites sites or more have.

    Sketches of a few dozen bytes merge map-side.  A line with fewer occurrences than sites are asked for, or of one
    site alone, is out for sure; one whose estimate is within BAND errors of the threshold is counted exactly, on its
    distinct (line, site) pairs alone.
    """
    site = F.xxhash64("site")
    est = lines.groupBy("h1", "h2").agg(F.approx_count_distinct("site", rsd).alias("est"), F.min("id").alias("first"), F.count("*").alias("n"), (F.min(site) < F.max(site)).alias("several"))
    low = int(min_sites * (1 - BAND * rsd))
    high = int(min_sites * (1 + BAND * rsd)) + 1
    able = (F.col("n") >= min_sites) & (F.col("several") | F.lit(min_sites < 2)) & (F.col("est") > low)
    est = durable(est.where(able), "spread")
    sure = est.where(F.col("est") > high).select("h1", "h2", "first")
    near = est.where(F.col("est") <= high).select("h1", "h2", "first")
    pairs = lines.join(near.select("h1", "h2"), ["h1", "h2"], "left_semi").select("h1", "h2", "site").distinct()
    exact = pairs.groupBy("h1", "h2").agg(F.count("*").alias("n")).where(F.col("n") >= min_sites).select("h1", "h2")
    return sure.unionByName(near.join(exact, ["h1", "h2"], "left_semi"))


def dedup_lines(df: DataFrame, min_sites: int = 5, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source") -> DataFrame:
    """df with text_col without its boilerplate lines, plus n_lines and n_removed.

    A line (between \\n, compared exactly, with a word in it) that min_sites sites or more have is removed from
    all documents but the one with the smallest id, where all its occurrences stay.  Rows are never dropped: a
    text may become empty.  A null text stays null with no lines, a null site is a site of its own, a null id is
    never the first.  Repeated rows are treated alike; columns named n_lines or n_removed are replaced.
    """
    lines = durable(split_lines(df, id_col, text_col, site_col), "lines")
    gone = durable(widespread(lines, min_sites), "boilerplate")
    hits = lines.join(gone, ["h1", "h2"]).where(~F.col("id").eqNullSafe(F.col("first")))
    cut = hits.groupBy(F.col("id").alias("__i"), F.col("th").alias("__h")).agg(F.collect_set("pos").alias("__gone"))
    rest = [F.col(f"`{c}`") for c in df.columns if c not in ("n_lines", "n_removed")]
    th = F.xxhash64(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
    rows = df.select(*rest, th.alias("__t"))
    out = rows.join(durable(cut, "cuts"), F.col(f"`{id_col}`").eqNullSafe(F.col("__i")) & (F.col("__t") == F.col("__h")), "left")
    parts = F.split(F.col(f"`{text_col}`"), "\n", -1)
    left = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("__gone"))
    text = F.when(F.col("__gone").isNull(), F.col(f"`{text_col}`")).otherwise(F.array_join(F.transform(left, lambda i: F.get(parts, i)), "\n"))
    return out.select(
        *(text.alias(c) if c == text_col else F.col(f"`{c}`") for c in df.columns if c not in ("n_lines", "n_removed")),
        F.coalesce(F.size(parts), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("__gone"), F.lit(0)).cast("long").alias("n_removed"),
    )
