"""Quality rules with risk-controlled thresholds.  DataFrame functions only."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .common import SPACE, WORD, durable, let

#: One path of cutoffs from lenient to strict: at each step every rule rejects above its cutoff of that step.  A
#: parameter, not fitted; the last step is the strictest that is wanted.
PATH: dict[str, tuple[float, ...]] = {
    "symbols_per_word": (3.0, 2.5, 2.0, 1.5, 1.2, 1.0, 0.8, 0.6, 0.5, 0.4, 0.3, 0.2, 0.15, 0.1, 0.05),
    "duplicate_line_share": (0.95, 0.9, 0.85, 0.8, 0.75, 0.7, 0.65, 0.6, 0.55, 0.5, 0.5, 0.45, 0.45, 0.4, 0.4),
    "repeated_word_share": (0.3, 0.29, 0.28, 0.27, 0.26, 0.25, 0.25, 0.24, 0.24, 0.23, 0.23, 0.22, 0.22, 0.21, 0.2),
    "long_words": (14.0, 13.0, 12.0, 11.0, 10.5, 10.0, 9.5, 9.0, 8.5, 8.0, 7.5, 7.0, 6.5, 6.25, 6.0),
    "short_words": (-2.0, -2.25, -2.5, -2.75, -3.0, -3.1, -3.2, -3.3, -3.4, -3.5, -3.6, -3.75, -4.0, -4.25, -4.5),
    "shouting": (0.9, 0.85, 0.8, 0.7, 0.6, 0.5, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1, 0.075, 0.05),
}
STEPS = len(PATH["shouting"])
#: Share of good documents that all rules together may reject in a stratum, and the chance that any bound fails.
RISK, DELTA = 0.025, 0.05
STRATA = ("en", "de", "fr", "es")
POOL = "pool"
WINDOW = 8


def _repeated(words: Column) -> Column:
    """Words in 8-word windows found twice or more.  Sorting happens only where two windows are equal."""

    def covered(hashes: Column) -> Column:
        def sorted_cover(ordered: Column) -> Column:
            twin = F.filter(ordered, lambda w, j: (w["h"] == F.get(ordered, j + 1)["h"]) | ((j > 0) & (w["h"] == F.get(ordered, F.greatest(j - 1, F.lit(0)))["h"])))
            places = F.array_sort(F.transform(twin, lambda w: w["i"]))
            start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
            step = lambda a, i: F.struct((i + WINDOW).alias("end"), (a["n"] + WINDOW - F.greatest(F.lit(0), a["end"] - i)).alias("n"))
            return F.aggregate(places, start, step, lambda a: a["n"])

        same = F.size(F.array_distinct(hashes)) == F.size(hashes)
        return F.when(same, F.lit(0)).otherwise(let(F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), sorted_cover))

    windows = F.transform(F.sequence(F.lit(1), F.size(words) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(words, i, F.lit(WINDOW))))
    return F.when(F.size(words) < WINDOW + 1, F.lit(0)).otherwise(let(windows, covered))


def features(df: DataFrame, id_col: str, text_col: str, stratum_col: str, strata: Sequence[str]) -> DataFrame:
    """doc id, stratum, counts of the whole text and the values that rules compare."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    lang = F.col(f"`{stratum_col}`").cast("string")
    src = df.select(F.col(f"`{id_col}`").alias("id"), F.when(lang.isin(*strata), lang).otherwise(F.lit("*")).alias("stratum"), text.alias("t"))

    def of_words(words: Column) -> Column:
        return F.struct(F.size(words).cast("long").alias("n"), _repeated(words).cast("long").alias("rep"))

    def of_lines(lines: Column) -> Column:
        return F.struct(F.size(lines).cast("long").alias("n"), (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("dup"))

    src = src.select(
        "id",
        "stratum",
        F.xxhash64("t").alias("th"),
        let(F.filter(F.split("t", f"{SPACE}+", -1), lambda w: w != ""), of_words).alias("w"),
        (F.char_length("t") - F.regexp_count("t", F.lit(SPACE))).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count("t", F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        let(F.filter(F.split("t", "\n", -1), lambda x: x.rlike(WORD)), of_lines).alias("l"),
    )
    src = src.select("id", "stratum", "th", F.col("w.n").alias("n_words"), "word_chars", "n_symbols", F.col("l.dup").alias("n_dup_lines"), F.col("w.rep").alias("n_repeat_words"), F.col("l.n").alias("n_lines"), "n_upper")
    words, lines = F.greatest("n_words", F.lit(1)), F.greatest("n_lines", F.lit(1))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return src.select(
        "*",
        failed.alias("base_failed"),
        (F.col("n_symbols") / words).alias("symbols_per_word"),
        (F.col("n_dup_lines") / lines).alias("duplicate_line_share"),
        (F.col("n_repeat_words") / words).alias("repeated_word_share"),
        (F.col("word_chars") / words).alias("long_words"),
        (-F.col("word_chars") / words).alias("short_words"),
        (F.col("n_upper") / F.greatest("word_chars", F.lit(1))).alias("shouting"),
    )


def binomial_at_most(k: Column, n: Column, p: float) -> Column:
    """P(Bin(n, p) <= k), exactly, in logarithms; 1 where k is above n p, since no test passes there."""
    odds, rest = math.log(p) - math.log1p(-p), math.log1p(-p)
    start = F.struct((n * F.lit(rest)).alias("log"), F.exp(n * F.lit(rest)).alias("sum"))

    def step(a: Column, i: Column) -> Column:
        log = a["log"] + F.ln(n - i + 1) - F.ln(i) + F.lit(odds)
        return F.struct(log.alias("log"), (a["sum"] + F.exp(log)).alias("sum"))

    few = F.filter(F.sequence(F.lit(0).cast("long"), F.least(k, F.floor(n * F.lit(p)))), lambda i: i > 0)
    return F.when(k > n * p, F.lit(1.0)).otherwise(F.aggregate(few, start, step, lambda a: a["sum"]))


def _tests(strata: Sequence[str], risk: float, delta: float) -> tuple[float, int]:
    """The level of each stratum's test, and the fewest documents that can pass it."""
    level = delta / (len(strata) + 2)  # the named strata, all others, the pool
    return level, math.ceil(math.log(level) / math.log1p(-risk))


def first_rejection() -> Column:
    """The first step of the path that rejects a row; STEPS if none does."""
    spared = [F.when(F.greatest(*(F.col(r) - cuts[j] for r, cuts in PATH.items())) > 0, 0).otherwise(1) for j in range(STEPS)]
    return sum(spared[1:], spared[0])


def cutoffs(feats: DataFrame, labels: DataFrame, id_col: str, label_col: str, strata: Sequence[str], risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """One row for each stratum with labelled good documents: stratum, pooled, n, k, p, step.

    The holdout is every labelled good document that passes the base rules.  A step passes if, were it to reject a
    share risk of good documents, so few rejections as the k seen among n would have a chance p of at most
    delta / (strata + 2).  Steps are nested, so p rises along the path, and testing in its order up to the first
    failure needs no correction; over the strata it is Bonferroni's.  step is the last that passes (null: none).
    A stratum with too few documents to pass even without a rejection is tested in one pool with the other small
    ones, and the bound holds for the pool.
    """
    level, least = _tests(strata, risk, delta)
    good = labels.where(F.col(f"`{label_col}`") == 1).select(F.col(f"`{id_col}`").alias("id")).distinct()
    held = feats.where(~F.col("base_failed")).join(good, "id", "left_semi").select("stratum", first_rejection().alias("first"))
    counts = held.groupBy("stratum").agg(F.count("*").alias("n"), *(F.count_if(F.col("first") <= j).alias(f"k{j}") for j in range(STEPS)))
    own = counts.select("*", (F.col("n") < least).alias("pooled"))
    tested = own.groupBy(F.when(F.col("pooled"), POOL).otherwise(F.col("stratum")).alias("test"), "pooled").agg(F.sum("n").alias("n"), *(F.sum(f"k{j}").alias(f"k{j}") for j in range(STEPS)))
    steps = F.array(*(F.struct(F.lit(j).alias("step"), F.col(f"k{j}").alias("k"), binomial_at_most(F.col(f"k{j}"), F.col("n"), risk).alias("p")) for j in range(STEPS)))
    tested = tested.select("test", "pooled", "n", F.filter(steps, lambda s: s["p"] <= level).alias("passed"))
    last = F.try_element_at("passed", F.lit(-1))
    tested = tested.select("test", "pooled", "n", last["k"].alias("k"), last["p"].alias("p"), last["step"].alias("step"))
    name = own.select("stratum", F.when(F.col("pooled"), POOL).otherwise(F.col("stratum")).alias("test"), "pooled")
    return name.join(tested, ["test", "pooled"]).select("stratum", "pooled", "n", "k", "p", "step")


def report(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang", label_col: str = "quality", strata: Sequence[str] = STRATA, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """The rows of cutoffs() for a table: which strata are certified, by how many documents and with which bound."""
    return cutoffs(features(df, id_col, text_col, stratum_col, strata), labels, id_col, label_col, strata, risk, delta)


def judge(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang", label_col: str = "quality", strata: Sequence[str] = STRATA, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """One row per row: id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, rejected_by.

    Counts are of the whole text; a null text has no words and fails the base rules.  Strata outside the named
    ones (and null) are judged together; where neither a stratum nor the pool of small ones has enough labelled
    documents for a bound no cutoff holds and only the base rules reject.  Labels that are null or repeat count once
    or not at all; without labels the method rejects nothing.  An empty table gives an empty result, repeated rows
    are judged alike, other columns are ignored.  Cutoffs are one row for each stratum, at most len(strata) + 1,
    and are broadcast.
    """
    told = _verdicts(df, labels, id_col, text_col, stratum_col, label_col, strata, risk, delta)
    return told.select(F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rejected_by")


def _verdicts(df: DataFrame, labels: DataFrame, id_col: str, text_col: str, stratum_col: str, label_col: str, strata: Sequence[str], risk: float, delta: float) -> DataFrame:
    feats = durable(features(df, id_col, text_col, stratum_col, strata), "features")
    cuts = F.broadcast(cutoffs(feats, labels, id_col, label_col, strata, risk, delta).select("stratum", "step"))
    told = feats.join(cuts, "stratum", "left")
    by = F.filter(F.array(*(F.when(F.col(r) > F.get(F.array(*map(F.lit, cuts)), F.col("step")), F.lit(r)) for r, cuts in PATH.items())), lambda x: x.isNotNull())
    told = told.withColumn("by", by)
    return told.withColumns({"kept": ~F.col("base_failed") & (F.size("by") == 0), "rejected_by": F.array_join("by", ",")})


def keep_good(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang", label_col: str = "quality", strata: Sequence[str] = STRATA, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """The rows of df that judge() keeps, with the columns of df.  A row is known by its id and its text's hash."""
    told = _verdicts(df, labels, id_col, text_col, stratum_col, label_col, strata, risk, delta)
    gone = durable(told.where("not kept").select(F.col("id").alias("__i"), F.col("th").alias("__h")).distinct(), "rejected")
    th = F.xxhash64(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
    return df.join(gone, F.col(f"`{id_col}`").eqNullSafe(F.col("__i")) & (th == F.col("__h")), "left_anti")
