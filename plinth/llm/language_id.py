"""Language identification by prediction by partial matching over bytes.

A language's statistics are counts of byte n-grams up to ORDER + 1 bytes, aggregated over all its training texts and
then frozen into a context tree: a context of up to ORDER bytes codes the next byte in log2 of (total + distinct) /
count bits, or escapes, with what is left of the probability, to the context one byte shorter; after the empty context
every byte costs eight bits.  A text's code length is a sum over its bytes, so long texts are read in slices, and costs
are whole multiples of 2**-16 bits, so sums do not depend on slices or partitions.

The tree is pruned by relative frequency: an n-gram stays if it makes up a NODES-th of its language's bytes, with NODES
shared evenly by the languages.  Of each length at most NODES n-grams can, so what scoring tasks hold is bounded
whatever the data, by (ORDER + 1) * NODES rows; the counts before that cover every byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import durable

ORDER, NODES = 4, 1 << 19
#: Bytes read at once, and the counts that a task holds before it sends them on.
SLICE, HELD = 1 << 20, 1 << 21
#: Code lengths are counted in this many parts of a bit.
UNIT = 1 << 16
#: Every text begins after so many of these bytes, so that each position has a full context.
LEAD = b"\n" * ORDER


def _texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a column of binaries, and where each value begins and ends."""
    column = column.cast(pa.large_binary())
    ends = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    return data, ends


def _slices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of about SLICE bytes: the codes of the n-grams that end at each byte, the rows, and where each row's run begins.

    A long text comes in several runs.  Texts carry LEAD before them, which is context and is not coded itself.
    """
    data, ends = _texts(column)
    row = 0
    start = int(ends[0]) if len(ends) else 0
    while row < len(ends) - 1:
        last = int(np.searchsorted(ends, start + SLICE, side="right")) - 1  # rows up to here end within the slice
        stop = int(ends[last]) if last > row else min(start + SLICE, int(ends[row + 1]))
        last = max(last, row + 1)
        here = start if start > ends[row] else int(ends[row]) + ORDER
        bounds = np.minimum(np.r_[here, ends[row + 1 : last] + ORDER], stop)  # first coded byte of each row
        tails = np.minimum(ends[row + 1 : last + 1], stop)
        lengths = np.maximum(tails - bounds, 0)
        code = np.zeros(max(stop - (here - ORDER) - ORDER, 0), dtype=np.int64)
        for k in range(ORDER + 1):
            code = (code << 8) | data[here - ORDER + k : here - ORDER + k + len(code)]
        begin = bounds - here
        keep = np.zeros(len(code) + 1, dtype=np.int8)
        np.add.at(keep, np.minimum(begin, len(code)), 1)
        np.add.at(keep, np.minimum(begin + lengths, len(code)), -1)
        code = code[np.cumsum(keep[:-1]) > 0]
        yield code, np.arange(row, last), lengths
        if stop == ends[last]:
            row, start = last, stop
        else:
            row, start = last - 1, stop


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, gram, n: counts of full-length n-grams, added up until HELD are held."""
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def add(lang: str, u: np.ndarray, n: np.ndarray) -> None:
        if lang in held:
            u, back = np.unique(np.concatenate([held[lang][0], u]), return_inverse=True)
            n = np.bincount(back, weights=np.concatenate([held[lang][1], n])).astype(np.int64)
        held[lang] = u, n

    def sent() -> Iterator[pa.RecordBatch]:
        for lang, (u, n) in held.items():
            for at in range(0, len(u), 1 << 18):
                part = u[at : at + (1 << 18)]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part), pa.string()), pa.array(part), pa.array(n[at : at + len(part)])], names=["lang", "gram", "n"])
        held.clear()

    for batch in batches:
        langs = pd.Series(batch.column(0).to_pylist(), dtype=object)
        codes, names = pd.factorize(langs)
        fresh: dict[int, list[np.ndarray]] = {}
        for grams, rows, lengths in _slices(batch.column(1)):
            of = np.repeat(codes[rows], lengths)
            for k in np.unique(of):
                fresh.setdefault(int(k), []).append(grams[of == k])
            if sum(len(g) for parts in fresh.values() for g in parts) >= 4 * SLICE:
                for k, parts in fresh.items():
                    add(names[k], *np.unique(np.concatenate(parts), return_counts=True))
                fresh = {}
        for k, parts in fresh.items():
            add(names[k], *np.unique(np.concatenate(parts), return_counts=True))
        if sum(len(u) for u, _ in held.values()) >= HELD:
            yield from sent()
    yield from sent()


def learn(df: DataFrame, text_col: str, lang_col: str, nodes: int = NODES) -> DataFrame:
    """lang, size, gram, bits, escape: the frozen trees.

    size is the n-gram's length (0: the empty context) and gram its bytes, packed; bits codes its last byte after the
    others (null: only a context), escape leaves it as a context (null: not one).  Rows with a null language or text
    are not learned from.
    """
    texts = df.where(F.col(f"`{lang_col}`").isNotNull() & F.col(f"`{text_col}`").isNotNull()).select(F.col(f"`{lang_col}`").cast("string").alias("lang"), _led(F.col(f"`{text_col}`")).alias("t"))
    full = texts.mapInArrow(_counts, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    full = durable(full, "grams")
    sizes = F.explode(F.array(*(F.lit(k) for k in range(1, ORDER + 2)))).alias("size")
    suffix = lambda c, size: F.col(c).bitwiseAND(F.expr(f"shiftleft(1L, 8 * ({size})) - 1"))
    grams = full.select("lang", "gram", "n", sizes).select("lang", "size", suffix("gram", "size").alias("gram"), "n").groupBy("lang", "size", "gram").agg(F.sum("n").alias("n"))
    totals = durable(full.groupBy("lang").agg(F.sum("n").alias("all")), "sizes")
    # an n-gram that stays occurs at least once in all * langs / nodes bytes of its language
    stays = F.col("n") * F.lit(nodes) >= F.col("all") * F.lit(totals.count())
    grams = grams.join(F.broadcast(totals), "lang").select("lang", "size", "gram", "n", stays.alias("stays"))
    grams = durable(grams, "suffixes")
    contexts = grams.groupBy("lang", (F.col("size") - 1).alias("size"), F.shiftright("gram", 8).alias("gram")).agg(F.sum("n").alias("total"), F.count("*").alias("kinds"), F.sum(F.when(F.col("stays"), F.col("n")).otherwise(0)).alias("own"))
    contexts = durable(contexts.where("own > 0").withColumn("whole", F.col("total") + F.col("kinds")), "contexts")
    bits = lambda share: F.round(-F.log2(share) * UNIT).cast("int")
    escape = contexts.select("lang", "size", "gram", bits((F.col("whole") - F.col("own")) / F.col("whole")).alias("escape"))
    at = contexts.select("lang", (F.col("size") + 1).alias("size"), F.col("gram").alias("__c"), "whole")
    kept = grams.where("stays").withColumn("__c", F.shiftright("gram", 8))
    coded = kept.join(at, ["lang", "size", "__c"]).select("lang", "size", "gram", bits(F.col("n") / F.col("whole")).alias("bits"))
    return coded.join(escape, ["lang", "size", "gram"], "full_outer").select("lang", "size", "gram", "bits", "escape")


def _led(text: Column) -> Column:
    """The text's UTF-8 bytes after LEAD."""
    return F.concat(F.lit(LEAD.decode()), text.cast("string")).cast("binary")


class Trees:
    """The trees of all languages side by side: of each length the n-grams in order, and a cost a language."""

    def __init__(self, rows: pa.Table):
        lang = rows["lang"].to_pandas()
        self.langs = sorted(lang.unique())
        of = lang.map({x: i for i, x in enumerate(self.langs)}).to_numpy(dtype=np.int64)
        size, gram = rows["size"].to_numpy(), rows["gram"].to_numpy()
        self.levels = []
        for k in range(ORDER + 2):
            here = size == k
            keys, at = np.unique(gram[here], return_inverse=True)
            cost = np.full((2, len(keys), len(self.langs)), -1, dtype=np.int32)  # bits and escape; -1: none
            for i, name in enumerate(("bits", "escape")):
                cost[i, at, of[here]] = rows[name].to_pandas().fillna(-1).to_numpy(dtype=np.int32)[here]
            self.levels.append((keys, *cost))

    def _row(self, size: int, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = self.levels[size][0]
        at = np.minimum(np.searchsorted(keys, grams), max(len(keys) - 1, 0))
        return at, (keys[at] == grams) if len(keys) else np.zeros(len(grams), dtype=bool)

    def costs(self, grams: np.ndarray) -> np.ndarray:
        """What the last byte of each full-length n-gram costs in each language."""
        total = np.zeros((len(grams), len(self.langs)), dtype=np.int64)
        open_ = np.ones(total.shape, dtype=bool)
        for k in range(ORDER, -1, -1):
            at, there = self._row(k + 1, grams & ((1 << 8 * (k + 1)) - 1))
            bits = np.where(there[:, None], self.levels[k + 1][1][at], -1) if len(self.levels[k + 1][0]) else np.full(total.shape, -1)
            up, known = self._row(k, (grams >> 8) & ((1 << 8 * k) - 1))
            escape = np.where(known[:, None], np.maximum(self.levels[k][2][up], 0), 0) if len(self.levels[k][0]) else np.zeros(total.shape, dtype=np.int64)
            hit = open_ & (bits >= 0)
            total += np.where(hit, bits, np.where(open_, escape, 0))
            open_ &= ~hit
        return total + 8 * UNIT * open_

    def lengths(self, column: pa.Array) -> np.ndarray:
        """Code length of each text (after LEAD) in each language."""
        out = np.zeros((len(column), len(self.langs)), dtype=np.int64)
        for grams, rows, lengths in _slices(column):
            codes, seen = pd.factorize(grams)
            if not len(seen):
                continue
            cost = self.costs(seen)
            some = lengths > 0
            starts = (np.cumsum(lengths) - lengths)[some]
            for k in range(len(self.langs)):
                out[rows[some], k] += np.add.reduceat(cost[:, k][codes], starts)
        return out


def predict(df: DataFrame, trees: DataFrame, text_col: str, keep: list[str] | None = None) -> DataFrame:
    """keep (default: all columns of df), lang_pred, score.

    The language whose tree codes the text shortest, the first by name of equal ones; score is its share of the
    probability that the trees give to the text, each language being as likely before.  A null text, or one without
    a letter, is und with score 0, and so is all where nothing was learned.  Columns of those two names are replaced.
    """
    spark = df.sparkSession
    rest = [c for c in (keep or df.columns) if c not in ("lang_pred", "score")]
    rows = trees.toArrow()  # bounded by the pruning
    held = spark.sparkContext.broadcast(Trees(rows)) if rows.num_rows else None
    text = F.col(f"`{text_col}`")
    able = text.isNotNull() & text.rlike(r"\p{L}")
    src = df.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)), F.when(able, _led(text)).alias("__t"))
    names, schema = [f"c{i}" for i in range(len(rest))], src.drop("__t").schema
    kinds = ", ".join(f"{n} {schema[n].dataType.simpleString()}" for n in names)

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(names))
            asked = np.asarray(texts.is_valid())
            lang, score = np.full(len(asked), "und", dtype=object), np.zeros(len(asked))
            if held is not None and asked.any():
                model = held.value
                bits = model.lengths(texts.filter(pa.array(asked)))
                best = bits.argmin(axis=1)
                lang[asked] = np.array(model.langs, dtype=object)[best]
                over = (bits - bits.min(axis=1, keepdims=True)) / UNIT
                score[asked] = 1.0 / np.exp2(-np.minimum(over, 1000)).sum(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(lang, pa.string()), pa.array(score)], names=[*names, "lang_pred", "score"])

    out = src.mapInArrow(told, f"{kinds}{', ' if names else ''}lang_pred string, score double")
    return out.select(*(F.col(n).alias(c) for n, c in zip(names, rest, strict=True)), "lang_pred", "score")


def held_out(id_col: str, parts: int = 4, part: int = 2) -> Column:
    """Whether a row is kept from training: the CRC of its id's text modulo parts (a null id: the CRC of an empty text)."""
    return F.pmod(F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))), F.lit(parts)) == part


def identify(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", keep: list[str] | None = None) -> DataFrame:
    """keep, held_out, lang_pred, score for each row of df: learned from the rows that are not held out, told for all.

    Repeated rows are learned from and told one by one; an empty table gives an empty result.
    """
    out = held_out(id_col)
    rest = [c for c in (keep or df.columns) if c not in ("held_out", "lang_pred", "score")]
    trees = learn(df.where(~out), text_col, lang_col)
    return predict(df.withColumn("held_out", out), trees, text_col, [*rest, "held_out"])
