"""Collocations: phrases of words that occur together more often than their parts would by chance.

Two passes over the texts.  The first adds every n-gram of up to LONGEST words to count-min sketches, one a task, whose
counters stop at 255; sketches are cut into blocks that are merged by sums.  An estimate is never below the true
count, so the n-grams whose counters all reach the least count hold all that do.  The second pass aggregates those n-grams
alone, by their words, and drops the few that were overestimated.  Parts of a frequent phrase are at least as
frequent as it is, so their counts are there too.

Counters are at most MOST bytes a task and a bit each in what the second pass looks up, whatever the data.  Where the corpus
has many more n-grams than counters, more of them survive and the second pass aggregates more; results are the same.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from .common import ascii_lower, durable, shuffle_width

#: What ends a piece, and what separates words within it.
PIECE_END, BLANK = b".,;:!?\n\x0b\x0c\r", b" \t"
#: Counters an n-gram, counters of a block, and the fewest and most counters of a row.  A row has about as many as there
#: are bytes in SHARE bytes of text: some two n-grams of any kind to a counter.
DEPTH, BLOCK, FEWEST, MOST, SHARE = 2, 4096, 1 << 18, 1 << 26, 8
#: Bytes of text taken at once.
SLICE = 1 << 21
_BREAK = re.compile(b"[" + re.escape(PIECE_END + BLANK) + b"]")
_WORD = re.compile(b"[^" + re.escape(PIECE_END + BLANK) + b"]+")
_KIND = np.zeros(256, dtype=np.uint8)  # 0: of a word, 1: between words, 2: between pieces
_KIND[list(BLANK)] = 1
_KIND[list(PIECE_END)] = 2


def _mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: shifts and odd multipliers."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class _Words:
    """The words of a run of texts, each text ended by a piece's end."""

    def __init__(self, data: np.ndarray, own: int):
        """data: bytes; words that begin before own are this run's, the others only follow them."""
        kind = _KIND[data]
        word = np.r_[False, kind == 0, False]
        edge = np.flatnonzero(word[1:] != word[:-1])
        self.data, self.start, self.end = data, edge[::2], edge[1::2]
        size = self.end - self.start
        at = np.r_[0, np.cumsum(size)]
        values = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data[kind == 0]))])
        told = values.dictionary_encode()
        self.words = told.dictionary
        self.code = told.indices.to_numpy().astype(np.int64)
        # a piece ends between two words if the count of ends before them differs
        ends = np.cumsum(kind == 2, dtype=np.int64)
        self.piece = ends[self.start] if len(self.start) else ends[:0]
        self.own = int(np.searchsorted(self.start, own))

    def grams(self, lang: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """n, the words at which this run's n-grams of n words begin, and a hash of each n-gram and its language."""
        known = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in self.words.to_pylist()), dtype=np.uint64, count=len(self.words))
        of = known[self.code] if len(known) else np.zeros(0, dtype=np.uint64)
        h = _mixed(of ^ lang)
        yield 1, np.arange(self.own), h[: self.own]
        for n in range(2, longest + 1):
            last = min(self.own, len(self.code) - n + 1)
            if last <= 0:
                return
            h = _mixed(h[: len(h) - 1] * np.uint64(0xA24BAED4963EE407) + of[n - 1 :])
            first = np.flatnonzero(self.piece[:last] == self.piece[n - 1 : n - 1 + last])
            yield n, first, h[first]


def _runs(batch: pa.RecordBatch, longest: int) -> Iterator[tuple[_Words, np.ndarray, np.ndarray, np.ndarray]]:
    """Words of about SLICE bytes of a batch (lang, text), the languages, each word's one as a number, and a hash of it.

    A run ends at the end of a word; it sees longest - 1 words of the next one, so no n-gram is lost at the border.
    """
    langs = batch.column(0)
    codes, names = pd.factorize(pd.Series(langs.to_pylist(), dtype=object))
    seeds = np.array([xxhash.xxh3_64_intdigest(x, seed=1) for x in names], dtype=np.uint64)
    column = batch.column(1).cast(pa.large_binary())
    ends = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    text = memoryview(data)
    at, stop = (int(ends[0]), int(ends[-1])) if len(ends) else (0, 0)
    while at < stop:
        cut = _BREAK.search(text, min(at + SLICE, stop), stop)
        own = cut.start() if cut else stop
        far = own
        for _ in range(longest - 1):
            more = _WORD.search(text, far, stop)
            far = more.end() if more else stop
        words = _Words(data[at:far], own - at)
        of = codes[np.searchsorted(ends, words.start + at, side="right") - 1] if len(words.start) else np.zeros(0, dtype=np.int64)
        yield words, names, of, seeds[of]
        at = own


def _cell(h: np.ndarray, d: int, cells: int) -> np.ndarray:
    """The counter of each n-gram in row d of a sketch; rows lie one after the other."""
    return (_mixed(h + np.uint64(0x632BE59BD9B4E019 * d % (1 << 64))) & np.uint64(cells - 1)).astype(np.int64) + d * cells


def sketch(texts: DataFrame, cells: int, longest: int, tasks: int) -> DataFrame:
    """block, counts: merged count-min sketches of texts (lang, t), without blocks of zeros.  cells: a power of two."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(DEPTH * cells, dtype=np.uint8)
        for batch in batches:
            for words, _, _, seeds in _runs(batch, longest):
                for _, _, h in words.grams(seeds, longest):
                    for d in range(DEPTH):
                        found, n = np.unique(_cell(h, d, cells), return_counts=True)
                        own[found] = np.minimum(own[found] + n, 255)
        blocks = own.reshape(-1, BLOCK)
        used = np.flatnonzero(blocks.any(axis=1))
        for some in np.array_split(used, max(1, len(used) // 1024)):
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array([blocks[b].tobytes() for b in some], pa.binary())], names=["block", "counts"])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, total = None, None
        for batch in batches:
            out = []
            for b, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                more = np.frombuffer(counts, dtype=np.uint8)
                if b == block:
                    total = np.minimum(total + more, 255)
                    continue
                if block is not None:
                    out.append((block, total.astype(np.uint8).tobytes()))
                block, total = b, more.astype(np.uint16)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out]), pa.array([x[1] for x in out], pa.binary())], names=["block", "counts"])
        if block is not None:
            yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([total.astype(np.uint8).tobytes()], pa.binary())], names=["block", "counts"])

    parts = texts.coalesce(tasks).mapInArrow(counted, "block bigint, counts binary")
    # all tasks send the same blocks, and a block is read a row at a time: no row of a block is more than BLOCK bytes
    return parts.repartition("block").sortWithinPartitions("block").mapInArrow(merged, "block bigint, counts binary")


def frequent(sketched: DataFrame, cells: int, least: int) -> np.ndarray:
    """A bit for each counter: whether it reaches least.  At most DEPTH * MOST bits, whatever the data."""

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [np.packbits(np.frombuffer(c, dtype=np.uint8) >= least).tobytes() for c in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(held, pa.binary())], names=["block", "bits"])

    rows = sketched.mapInArrow(bits, "block bigint, bits binary").toArrow()
    out = np.zeros((DEPTH * cells // BLOCK, BLOCK // 8), dtype=np.uint8)
    for b, held in zip(rows["block"].to_pylist(), rows["bits"].to_pylist(), strict=True):
        out[b] = np.frombuffer(held, dtype=np.uint8)
    return out.reshape(-1)


def _passing(marks: np.ndarray, h: np.ndarray, cells: int) -> np.ndarray:
    """Which n-grams have all their counters marked, as positions."""
    left = np.arange(len(h))
    for d in range(DEPTH):
        at = _cell(h[left], d, cells)
        left = left[(marks[at >> 3] >> (7 - (at & 7)) & 1).astype(bool)]
    return left


def survivors(texts: DataFrame, marks: np.ndarray, cells: int, longest: int) -> DataFrame:
    """lang, phrase, size, n: counts, a run of text at a time, of the n-grams whose counters all reach the least count.

    Rows of size 0 count all words.
    """
    held = texts.sparkSession.sparkContext.broadcast(marks)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, names, langs, seeds in _runs(batch, longest):
                known = words.words.to_pylist()
                every = np.bincount(langs[: words.own], minlength=len(names))
                rows = [(names, [b""] * len(names), np.zeros(len(names)), every)]
                for n, first, h in words.grams(seeds, longest):
                    first = first[_passing(held.value, h, cells)]
                    key = langs[first].astype(np.int64)
                    for k in range(n):  # exact: runs of word numbers, numbered pair by pair
                        key = pd.factorize(key * len(known) + words.code[first + k])[0].astype(np.int64)
                    _, at, count = np.unique(key, return_index=True, return_counts=True)
                    begin = first[at]
                    phrases = [b" ".join(known[c] for c in row) for row in words.code[begin[:, None] + np.arange(n)].tolist()]
                    rows.append((names[langs[begin]], phrases, np.full(len(at), n), count))
                for lang, phrases, size, count in rows:
                    yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(phrases, pa.binary()), pa.array(size.astype(np.int32)), pa.array(count)], names=["lang", "phrase", "size", "n"])

    return texts.mapInArrow(counted, "lang string, phrase binary, size int, n bigint")


def phrase_counts(df: DataFrame, text_col: str, lang_col: str, least: int, longest: int, most: int = MOST) -> tuple[DataFrame, DataFrame]:
    """lang, phrase, size, n of the n-grams of up to longest words that occur least times or more; lang, n of all words."""
    spark = df.sparkSession
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    lang = F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und"))
    texts = df.select(lang.alias("lang"), F.concat(ascii_lower(text), F.lit("\n")).cast("binary").alias("t"))
    size = df.select(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0
    cells = FEWEST
    while cells < most and cells * SHARE < size:
        cells *= 2
    sketched = durable(sketch(texts, cells, longest, 2 * spark.sparkContext.defaultParallelism), "sketch")
    found = survivors(texts, frequent(sketched, cells, least), cells, longest).groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n"))
    told = durable(found.where((F.col("n") >= least) | (F.col("size") == 0)).select("lang", F.col("phrase").cast("string").alias("phrase"), "size", "n"), "phrases")
    return told.where("size > 0"), told.where("size = 0").select("lang", "n")


def scores(counts: DataFrame) -> DataFrame:
    """lang, phrase, size, a, l, r, score of each phrase of two words or more, by its lowest-scoring cut.

    Products are decimals of 38 digits: exact for counts up to 10**15.
    """
    words = F.split("phrase", " ")
    cuts = counts.where("size > 1").select("lang", "phrase", "size", F.col("n").alias("a"), words.alias("w"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "size", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("left"), F.array_join(F.slice("w", F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("right"))
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(counts.select("lang", F.col("phrase").alias(side), F.col("n").alias(name)), ["lang", side])
    score = F.expr("(CAST(1000000 AS DECIMAL(7,0)) * (CAST(a AS DECIMAL(15,0)) * CAST(a AS DECIMAL(15,0)))) DIV (CAST(l AS DECIMAL(15,0)) * CAST(r AS DECIMAL(15,0)))")
    best = cuts.withColumn("score", score).groupBy("lang", "phrase", "size", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("b"))
    return best.select("lang", "phrase", "size", "a", "b.l", "b.r", "b.score")


def subsumed(scored: DataFrame, counts: DataFrame, share: int) -> DataFrame:
    """scored without the phrases inside a longer one that occurs share percent as often or more.

    Each longer phrase names the shorter ones inside it; what a shorter one needs is the most frequent of them.
    """
    words = F.split("phrase", " ")
    longer = counts.where("size > 2").select("lang", F.col("n").alias("a"), "size", words.alias("w"))
    longer = longer.select("lang", "a", "size", "w", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("m"))
    inside = longer.select("lang", "a", "w", "m", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("m") + 1)).alias("i"))
    most = inside.select("lang", F.array_join(F.slice("w", F.col("i"), F.col("m")), " ").alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("__most"))
    return scored.join(most, ["lang", "phrase"], "left").where(F.col("__most").isNull() | (F.col("__most") * 100 < F.lit(share) * F.col("a"))).drop("__most")


def collocations(df: DataFrame, longest: int = 3, least: int = 10, share: int = 50, top: int = 2000, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first top phrases of 2 to longest words of each language.

    A text (null: empty) is lower-cased (A-Z) and split into pieces and words; phrases lie within a piece.  A null
    language is und.  a, l and r count the phrase and the parts of its lowest-scoring cut, n all words of the
    language; score is floor(10**6 a a / (l r)).  Phrases inside a longer frequent one go (see subsumed), the
    rest are ranked by score, a and phrase.  Repeated rows count each; an empty table gives an empty result; other columns
    are ignored.  The first of each of many shares of a language meet in one task, top rows a share.
    """
    counts, words = phrase_counts(df, text_col, lang_col, least, longest)
    left = subsumed(scores(counts), counts, share)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    shares = F.pmod(F.xxhash64("phrase"), F.lit(shuffle_width(df.sparkSession)))
    first = left.withColumn("__s", shares).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "__s").orderBy(*order))).where(F.col("rank") <= top)
    out = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    out = out.join(F.broadcast(words), "lang")  # a row a language
    return out.select("lang", *(F.col(c).cast("long").alias(c) if c != "phrase" else F.col(c) for c in ("rank", "phrase", "a", "l", "r", "n", "score")))
