"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of characters.

Characters are written as symbols of 12 bits, so an n-gram of order 5 is one 64-bit code everywhere: code points below
DIRECT are one symbol, all others two (a lead and a trail), by a fixed rule and without an alphabet of the data.

The model is a set of tables (stratum, code, ...), one for each order, made and joined by Spark in shards; nothing
of it is broadcast, so it may grow with the trusted text.  Documents are written once in packs.  A pack asks for its
distinct codes in one blob a shard; the shard answers with one blob of log probabilities in the order of the codes, and
the pack scores its documents with them.  Codes and strata do not travel back.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
import zstandard
from pyspark.sql import DataFrame, functions as F

from .common import bucketed, durable, free_shuffles, last_written, release, shuffle_width, written

ORDER, BOS = 5, "\x02"
#: Bits of a symbol; code points of one symbol; first symbol of the second halves of all others.
BITS, DIRECT, TRAIL = 12, 1984, 3072
#: Symbols counted at once, and characters of a pack.
SLICE, PACK = 1 << 19, 16 << 20
#: Shards of codes that ask and answer (a prime, so that a remainder depends on all symbols), and packs that one task answers.
SHARDS, TOGETHER = 37, 4096
STRATA = ("en", "de", "fr", "es")
#: Kept: perplexity up to this quantile of held-out trusted documents of the language, so one good document in 20 goes.
#: Twenty of them are enough to estimate it, and one odd document does not set it.
#: One trusted document in HOLDOUT, by the hash of its id, is held out of the model.
QUANTILE, HOLDOUT = 0.95, 5


def _symbols(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of a text, and how many each character takes."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    wide = points >= DIRECT
    width = wide + 1
    if not wide.any():
        return points, width
    at = np.cumsum(width) - width
    out = np.empty(int(width.sum()), dtype=np.int64)
    out[at] = np.where(wide, DIRECT + (points >> 10), points)
    out[at[wide] + 1] = TRAIL + (points[wide] & 1023)
    return out, width


def _slices(pack: pa.Table) -> Iterator[tuple[int, int, int, np.ndarray, np.ndarray]]:
    """First row, row after the last, stratum, codes of all n-grams, and where each row's codes end.

    pack: s, lead, t ordered by s.  Each symbol of t ends one n-gram; lead gives the ORDER - 1 characters before it.
    """
    strata = pack["s"].to_numpy()
    sizes = pa.compute.utf8_length(pack["t"]).to_numpy()
    part = np.cumsum(sizes) // SLICE
    edges = np.flatnonzero((np.diff(part) != 0) | (np.diff(strata) != 0)) + 1
    for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(strata)], strict=True):
        if a == b:
            continue
        leads, texts = pack["lead"].slice(a, b - a).to_pylist(), pack["t"].slice(a, b - a).to_pylist()
        symbols, width = _symbols("".join(x for pair in zip(leads, texts, strict=True) for x in pair))
        lengths = np.array([(len(x), len(t)) for x, t in zip(leads, texts, strict=True)], dtype=np.int64).ravel()
        own = np.repeat(np.repeat(np.tile([False, True], b - a), lengths), width)
        code = np.zeros(max(len(symbols) - ORDER + 1, 0), dtype=np.int64)
        for k in range(ORDER):
            code = (code << BITS) | symbols[k : k + len(code)]
        of_text = own[ORDER - 1 :]
        ends = np.cumsum(np.r_[0, own])[np.cumsum(np.r_[0, width])[np.cumsum(lengths)[1::2]]]
        yield a, b, int(strata[a]), code[of_text], ends


def _distinct(pack: pa.Table) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each stratum of a pack its distinct codes in order, and their counts."""
    parts: dict[int, list] = {}
    for _, _, s, code, _ in _slices(pack):
        parts.setdefault(s, []).append(np.unique(code, return_counts=True))
    out = {}
    for s, found in parts.items():
        codes, back = np.unique(np.concatenate([u for u, _ in found]), return_inverse=True)
        n = np.bincount(back, weights=np.concatenate([c for _, c in found]), minlength=len(codes)).astype(np.int64)
        out[s] = codes, n
    return out


def _packs(batches: Iterator[pa.RecordBatch], strata: Sequence[str]) -> Iterator[pa.Table]:
    """Runs of about PACK characters: row, id, s, lead, t, cut, ordered by s.

    A text longer than a pack is cut; its pieces share the number row, and cut is true.  t is in lower case.
    """
    number = {s: i for i, s in enumerate(strata)}
    base, rows, held, n = int.from_bytes(uuid.uuid4().bytes[:8], "little") >> 1, [], 0, 0
    id_type = pa.null()

    def packed() -> pa.Table:
        rows.sort(key=lambda r: r[2])
        names = ("row", "id", "s", "lead", "t", "cut")
        types = (pa.int64(), id_type, pa.int32(), pa.large_string(), pa.large_string(), pa.bool_())
        return pa.table({k: pa.array(c, y) for k, c, y in zip(names, zip(*rows, strict=True), types, strict=True)})

    for batch in batches:
        id_type = batch.column(0).type
        for key, s, t in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            t = (t or "").lower()
            n += 1
            for at in range(0, max(len(t), 1), PACK):
                lead = t[at - ORDER + 1 : at] if at else BOS * (ORDER - 1)
                rows.append(((base + n) % (1 << 63), key, number.get(s, len(strata)), lead, t[at : at + PACK], len(t) > PACK))
                held += len(rows[-1][4]) + ORDER
                if held >= PACK:
                    yield packed()
                    rows, held = [], 0
    if rows:
        yield packed()


def gram_counts(df: DataFrame, strata: Sequence[str]) -> DataFrame:
    """stratum, code, n of the distinct n-grams of runs of documents of df (id, s, t); a code may come in several runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pack in _packs(batches, strata):
            for s, (codes, n) in _distinct(pack).items():
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(codes), s, dtype=np.int32)), pa.array(codes), pa.array(n)], names=["stratum", "code", "n"])

    return df.mapInArrow(run, "stratum int, code bigint, n bigint")


def packed(df: DataFrame, strata: Sequence[str]) -> DataFrame:
    """pack, blob: runs of documents of df (id, s, t) under a number of their own; to be written before it is used twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        for table in _packs(batches, strata):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema) as writer:
                writer.write_table(table)
            number = int.from_bytes(uuid.uuid4().bytes[:8], "little", signed=True)
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([squeeze.compress(sink.getvalue().to_pybytes())], pa.binary())], names=["pack", "blob"])

    return df.mapInArrow(run, "pack bigint, blob binary")


def _unpacked(blob: bytes) -> pa.Table:
    return pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(blob)).read_all().combine_chunks()


def _squeezed(codes: np.ndarray) -> bytes:
    """Codes in order as differences; the planes of their bytes lie apart, as the high ones are mostly zero."""
    planes = np.diff(codes, prepend=0).view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(planes).tobytes())


def _codes(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.int64).ravel())


def asked_of(packs: DataFrame) -> DataFrame:
    """pack, stratum, shard, codes: the distinct codes of each pack in order, a blob for each shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pack, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows = []
                for s, (codes, _) in _distinct(_unpacked(blob.as_py())).items():
                    shard = codes % SHARDS
                    rows += [(pack, s, k, _squeezed(codes[shard == k])) for k in np.unique(shard).tolist()]
                if rows:
                    types = (pa.int64(), pa.int32(), pa.int32(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(c, y) for c, y in zip(zip(*rows, strict=True), types, strict=True)], names=["pack", "stratum", "shard", "codes"])

    return packs.mapInArrow(run, "pack bigint, stratum int, shard int, codes binary")


def distinct_codes(asked: DataFrame) -> DataFrame:
    """stratum, code of all packs; a task brings what its rows of a shard have in common together before it is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                codes = _codes(blob.as_py())
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(codes), s, dtype=np.int32)), pa.array(codes)], names=["stratum", "code"])

    return asked.select("stratum", "codes").mapInArrow(run, "stratum int, code bigint").distinct()


def _last(code, symbols: int):
    """The code of the last symbols of a code."""
    return F.col(code).bitwiseAND(F.lit((1 << BITS * symbols) - 1))


def train(counts: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """For each order from 1: (stratum, code, p) with p the discounted share, and (stratum, ctx, total, gamma).

    The highest order counts occurrences, lower ones the distinct one-longer grams that end in a gram.  Discounts
    are those of modified Kneser-Ney from the counts of counts of each stratum and order.
    """
    held = durable(counts.groupBy("stratum", "code").agg(F.sum("n").alias("c")), "counts")
    out = []
    for order in range(ORDER, 0, -1):
        freq = held.groupBy("stratum").agg(*(F.count_if(F.col("c") == k).alias(f"n{k}") for k in (1, 2, 3, 4)))
        y = F.when(F.col("n1") + 2 * F.col("n2") > 0, F.col("n1") / F.greatest(F.col("n1") + 2 * F.col("n2"), F.lit(1))).otherwise(0.5)
        ratio = lambda k: F.col(f"n{k + 1}") / F.greatest(F.col(f"n{k}"), F.lit(1))
        bound = lambda d, k: F.least(F.greatest(d, F.lit(0.05)), F.lit(float(k)) - 0.05)
        discounts = freq.select("stratum", *(bound(F.lit(float(k)) - (k + 1) * y * ratio(k), k).alias(f"d{k}") for k in (1, 2, 3)))
        rows = held.join(F.broadcast(discounts), "stratum")  # a row for each stratum
        d = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
        rows = rows.select("stratum", "code", "c", d.alias("d"), F.shiftright("code", BITS).alias("ctx"))
        ctx = durable(rows.groupBy("stratum", "ctx").agg(F.sum("c").alias("total"), F.sum("d").alias("free")).select("stratum", "ctx", F.col("total").cast("double").alias("total"), (F.col("free") / F.col("total")).alias("gamma")), f"context{order}")
        share = durable(rows.join(ctx, ["stratum", "ctx"]).select("stratum", "code", ((F.col("c") - F.col("d")) / F.col("total")).alias("p")), f"order{order}")
        out.append((share, ctx))
        if order > 1:
            held = durable(held.groupBy("stratum", _last("code", order - 1).alias("code")).agg(F.count("*").alias("c")), "continuations")
    return out[::-1]


def gram_probabilities(asked: DataFrame, model: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """stratum, code, logp for each row of asked (stratum, code; distinct): interpolated from order 1 up."""
    wanted = [asked]
    for order in range(ORDER - 1, 0, -1):
        wanted.append(durable(wanted[-1].select("stratum", _last("code", order).alias("code")).distinct(), "asked"))
    sizes = model[0][0].groupBy("stratum").agg((1.0 / (F.count("*") + 1)).alias("q"))
    low = wanted[-1].join(F.broadcast(sizes), "stratum", "left").select("stratum", "code", F.coalesce("q", F.lit(1e-4)).alias("q"))
    for order, (share, ctx) in enumerate(model, 1):
        rows = wanted[ORDER - order]
        if order > 1:
            rows = rows.select("stratum", "code", _last("code", order - 1).alias("tail"))
            rows = rows.join(low.select("stratum", F.col("code").alias("tail"), "q"), ["stratum", "tail"])
        else:
            rows = low
        rows = rows.join(share, ["stratum", "code"], "left")
        rows = rows.withColumn("ctx", F.shiftright("code", BITS)).join(ctx.select("stratum", "ctx", "gamma"), ["stratum", "ctx"], "left")
        p = F.coalesce("p", F.lit(0.0)) + F.coalesce("gamma", F.lit(1.0)) * F.col("q")
        low = durable(rows.select("stratum", "code", p.alias("q")), f"p{order}")
    return low.select("stratum", "code", F.ln("q").alias("logp"))


def _answered(known: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
    """pack, stratum, shard, values of each blob of codes of a shard, from the shard's code and logp."""
    known = known.sort_values("code")
    codes, logp = known["code"].to_numpy(), known["logp"].to_numpy()
    values = [logp[np.searchsorted(codes, _codes(blob))].astype(np.float32).tobytes() for blob in asked["codes"]]
    return pd.DataFrame({"pack": asked["pack"], "stratum": asked["stratum"], "shard": asked["shard"], "values": values})


def _scored(pack: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
    """row, id, stratum, n_chars, logp, cut of the pieces of one pack."""
    docs = _unpacked(pack["blob"].iloc[0])
    told = {(s, k): np.frombuffer(v, dtype=np.float32) for s, k, v in zip(answers["stratum"], answers["shard"], answers["values"], strict=True)}
    known = {}
    for s, (codes, _) in _distinct(docs).items():
        shard, value = codes % SHARDS, np.empty(len(codes))
        for k in np.unique(shard).tolist():
            value[shard == k] = told[s, k]
        known[s] = codes, value
    total = np.zeros(docs.num_rows)
    for a, b, s, code, ends in _slices(docs):
        codes, value = known[s]
        sums = np.cumsum(np.r_[0.0, value[np.searchsorted(codes, code)]]) if len(code) else np.zeros(1)
        total[a:b] = np.diff(sums[np.r_[0, ends]])
    n = pa.compute.utf8_length(docs["t"]).cast(pa.int64())
    out = pa.table({"row": docs["row"], "id": docs["id"], "stratum": docs["s"], "n_chars": n, "logp": pa.array(total), "cut": docs["cut"]})
    return out.to_pandas(types_mapper=pd.ArrowDtype)


def _scores(packs: DataFrame, packs_at: str, model: list[tuple[DataFrame, DataFrame]], id_type: str, before: int) -> DataFrame:
    """row, id, stratum, n_chars, logp, cut of all pieces, written; what the model wrote since before goes on the way."""
    asked = durable(asked_of(packs), "asked", "uncompressed")
    asked_at = last_written()
    known = durable(gram_probabilities(durable(distinct_codes(asked), "distinct"), model), "known")
    # the model is not read again: what is left are the packs, their codes and the probabilities
    release(packs.sparkSession, before, (packs_at, asked_at, last_written()))
    # a shard is answered in as many tasks as it has thousands of packs, each with the shard's probabilities
    salts = 1 + packs.count() // TOGETHER
    keys = ["stratum", "shard", "salt"]
    lists = known.withColumn("shard", F.pmod("code", F.lit(SHARDS)).cast("int")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    asking = asked.withColumn("salt", F.pmod("pack", F.lit(salts)).cast("int"))
    answers = lists.groupBy(*keys).cogroup(asking.groupBy(*keys)).applyInPandas(_answered, "pack bigint, stratum int, shard int, values binary")
    scored = packs.groupBy("pack").cogroup(answers.groupBy("pack")).applyInPandas(_scored, f"row bigint, id {id_type}, stratum int, n_chars bigint, logp double, cut boolean")
    return durable(scored, "scored")


def perplexities(df: DataFrame, trusted: DataFrame, strata: Sequence[str] = STRATA) -> DataFrame:
    """id, stratum, n_chars, perplexity for each row of df; df and trusted have columns id, s, t.

    Perplexity is by character.  That of a text without characters is null.  Log probabilities travel as 32-bit floats.
    """
    spark, before = df.sparkSession, written()
    model = train(gram_counts(trusted, strata))
    # in buckets of their number, so that the texts are not shuffled to meet their answers
    packs, table = bucketed(packed(df, strata), "pack", shuffle_width(spark))
    try:
        scored = _scores(packs, last_written(), model, df.schema["id"].dataType.simpleString(), before)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    release(spark, before, (last_written(),))
    long = scored.where("cut").groupBy("row", "id", "stratum").agg(F.sum("n_chars").alias("n_chars"), F.sum("logp").alias("logp"))
    every = scored.where(~F.col("cut")).drop("cut").unionByName(long)
    ppl = F.when(F.col("n_chars") > 0, F.exp(-F.col("logp") / F.col("n_chars")))
    return every.select("id", "stratum", "n_chars", ppl.alias("perplexity"))


def classify(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", label_col: str = "quality", strata: Sequence[str] = STRATA, quantile: float = QUANTILE) -> DataFrame:
    """One row per row: id, n_chars, perplexity, threshold, kept.

    The model is trained on labelled good documents, a language apart from the others; thresholds are quantiles
    of the perplexities of labelled good documents that it has not seen.  Languages outside the
    named ones (and null) share a model.  A document without characters has no perplexity and is not kept; where a
    language has no trusted text there is no threshold and documents are kept.  Repeated rows are scored alike; an
    empty table gives an empty result.
    """
    src = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{lang_col}`").cast("string").alias("s"), F.col(f"`{text_col}`").cast("string").alias("t"))
    good = labels.where(F.col(f"`{label_col}`") == 1).select(F.col(f"`{id_col}`").alias("id")).distinct()
    unseen = F.pmod(F.xxhash64(F.lit(3), "id"), F.lit(HOLDOUT)) == 0
    # a sorted join at every size: which documents are trusted grows with the corpus, so it is never broadcast
    trusted = src.join(good.where(~unseen).hint("merge"), "id", "left_semi")
    # written, so that the shuffle of all texts goes before the model is counted
    trusted = durable(trusted, "trusted", "zstd")
    free_shuffles(df.sparkSession)
    scored = perplexities(src, trusted, strata)
    held = scored.join(good.where(unseen), "id", "left_semi").where("perplexity is not null")
    bounds = held.groupBy("stratum").agg(F.percentile_approx("perplexity", quantile, 100_000).alias("threshold"))
    bounds = F.broadcast(bounds)  # a row for each stratum
    told = scored.join(bounds, "stratum", "left")
    kept = F.coalesce(F.col("perplexity") <= F.col("threshold"), F.col("perplexity").isNotNull())
    return told.select(F.col("id").alias(id_col), "n_chars", F.round("perplexity", 4).alias("perplexity"), "threshold", kept.alias("kept"))
