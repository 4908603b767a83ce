"""SimHash near-dedup by bit-sliced comparison.

Fingerprints are cut into segments; two that differ in few bits agree in all segments but few, so they meet in one
of the tables keyed by the other segments.  In a table's bucket the free bits are stored as vertical bit planes,
distances to many members are counted at once in carry-save bit counters, and a block is left as soon as all its
members exceed the radius.  Buckets hand on a tree of links, not their pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import durable, last_written, release, written
from .components import components

SEED = 42
#: Segments of 64 bits; with radius r a table keys all but r of them, so a bucket has at most 2^(8 r) members.
SEGMENTS = 8
#: Buckets up to this size are compared pair by pair across buckets; words of a block of queries; text bytes at once.
SMALL, BLOCK_WORDS, SLICE_BYTES = 8, 1 << 20, 2 << 20


def fingerprints(texts: list[str | None], shingle: int) -> np.ndarray:
    """64-bit SimHash of each text: bit i is 1 if set in over half of the hashes of its shingles, repeats included."""
    hashes: list[int] = []
    counts = np.zeros(len(texts), dtype=np.int64)
    h = xxhash.xxh64_intdigest
    for k, t in enumerate(texts):
        words = t.encode("utf-8", "surrogatepass").lower().split() if t else ()  # bytes: only A-Z and ASCII white space
        n = len(words)
        if n <= shingle:
            own = [h(b" ".join(words), SEED)] if n else []
        else:
            joined = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=n) + 1) - 1
            starts = [0, *(ends[: n - shingle] + 1).tolist()]
            own = [h(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :].tolist(), strict=True)]
        hashes += own
        counts[k] = len(own)
    out = np.zeros(len(texts), dtype=np.uint64)
    full = np.flatnonzero(counts)
    if len(full):
        first = (np.cumsum(counts) - counts)[full]
        raw = np.array(hashes, dtype=np.uint64)
        weight = np.uint64(1)
        for byte in range(8):
            bits = np.unpackbits((raw >> np.uint64(8 * byte)).astype(np.uint8)[:, None], axis=1, bitorder="little")
            ones = np.add.reduceat(bits, first, axis=0, dtype=np.int32)
            over = (2 * ones > counts[full][:, None]).astype(np.uint64)
            for i in range(8):
                out[full] |= over[:, i] * (weight << np.uint64(8 * byte + i))
    return out


def with_fingerprint(df: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """id, fp (the fingerprint as a signed long) for each row."""
    src = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.cumsum([len(t or "") for t in batch.column(1).to_pylist()]) // SLICE_BYTES
            edges = [0, *(np.flatnonzero(np.diff(sizes)) + 1).tolist(), batch.num_rows] if batch.num_rows else []
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                fp = fingerprints(batch.column(1).slice(a, b - a).to_pylist(), shingle).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(fp)], names=["id", "fp"])

    return src.mapInArrow(run, f"id {df.schema[id_col].dataType.simpleString()}, fp bigint")


def tables(radius: int, segments: int = SEGMENTS) -> list[tuple[int, list[int]]]:
    """(mask of the key's bits, free bits) of each table: every choice of radius segments to leave free."""
    edges = [round(64 * i / segments) for i in range(segments + 1)]
    out = []
    for free in combinations(range(segments), radius):
        bits = [b for s in free for b in range(edges[s], edges[s + 1])]
        mask = (1 << 64) - 1 - sum(1 << b for b in bits)
        out.append((mask, bits))
    return out


class _Counters:
    """Saturating carry-save counters: after add(), over() has a bit for each count above radius."""

    def __init__(self, shape: tuple[int, ...], radius: int):
        self.levels = [np.zeros(shape, dtype=np.uint64) for _ in range((radius + 1).bit_length())]
        self.spill = np.zeros(shape, dtype=np.uint64)
        self.radius = radius

    def add(self, plane: np.ndarray) -> None:
        carry = plane
        for i, level in enumerate(self.levels):
            self.levels[i], carry = level ^ carry, level & carry
        self.spill |= carry

    def over(self) -> np.ndarray:
        out = self.spill.copy()
        equal = np.full(out.shape, np.uint64(0xFFFFFFFFFFFFFFFF))
        for i in range(len(self.levels) - 1, -1, -1):
            if not self.radius >> i & 1:
                out |= equal & self.levels[i]
                equal &= ~self.levels[i]
            else:
                equal &= self.levels[i]
        return out


def planes_of(values: np.ndarray, bits: list[int]) -> np.ndarray:
    """A row for each bit: that bit of 64 values in each word.  The rest of the last word is zero."""
    words = -(-len(values) // 64)
    out = np.zeros((len(bits), words * 8), dtype=np.uint8)
    for row, b in enumerate(bits):
        packed = np.packbits((values >> np.uint64(b) & np.uint64(1)).astype(np.uint8), bitorder="little")
        out[row, : len(packed)] = packed
    return out.view(np.uint64)


def within(xors: np.ndarray, bits: list[int], radius: int) -> np.ndarray:
    """Which of the xors of two fingerprints have at most radius of bits set."""
    planes = planes_of(xors, bits)
    counters = _Counters(planes.shape[1:], radius)
    for k, plane in enumerate(planes):
        counters.add(plane)
        if k % 4 == 3 and bool((counters.over() == np.uint64(0xFFFFFFFFFFFFFFFF)).all()):
            break
    return np.unpackbits((~counters.over()).view(np.uint8), bitorder="little")[: len(xors)].astype(bool)


def _reached(planes: np.ndarray, queries: np.ndarray, bits: list[int], radius: int) -> np.ndarray:
    """A bit for each member of a bucket that one of the queries has within radius."""
    out = np.zeros(planes.shape[1], dtype=np.uint64)
    step = max(1, BLOCK_WORDS // max(1, planes.shape[1]))
    for at in range(0, len(queries), step):
        block = queries[at : at + step]
        counters = _Counters((len(block), planes.shape[1]), radius)
        for k, (plane, b) in enumerate(zip(planes, bits, strict=True)):
            flip = np.uint64(0) - (block >> np.uint64(b) & np.uint64(1))
            counters.add(plane[None, :] ^ flip[:, None])
            if k % 4 == 3 and bool((counters.over() == np.uint64(0xFFFFFFFFFFFFFFFF)).all()):
                break
        out |= np.bitwise_or.reduce(~counters.over(), axis=0)
    return out


def bucket_links(values: np.ndarray, bits: list[int], radius: int) -> list[tuple[int, int]]:
    """(member, smallest member of its component) within one bucket of distinct fingerprints, as places."""
    n, planes = len(values), planes_of(values, bits)
    open_, links = np.ones(n, dtype=bool), []
    for start in range(n):
        if not open_[start]:
            continue
        open_[start] = False
        front = np.array([start])
        while len(front):
            near = np.unpackbits(_reached(planes, values[front], bits, radius).view(np.uint8), bitorder="little")[:n].astype(bool)
            front = np.flatnonzero(near & open_)
            open_[front] = False
            links += [(int(i), start) for i in front]
    return links


def _links(batch_t: np.ndarray, batch_fp: np.ndarray, edges: np.ndarray, radius: int, layout: list) -> list[np.ndarray]:
    """Links within the buckets that begin at edges[:-1]."""
    sizes = np.diff(edges)
    out = []
    small = np.flatnonzero((sizes > 1) & (sizes <= SMALL))
    for t in np.unique(batch_t[edges[small]]).tolist():
        own = small[batch_t[edges[small]] == t]
        for d in range(1, SMALL):
            buckets = own[sizes[own] > d]
            if not len(buckets):
                break
            reach = sizes[buckets] - d
            left = np.arange(reach.sum()) + np.repeat(edges[buckets] - (np.cumsum(reach) - reach), reach)
            a, b = batch_fp[left], batch_fp[left + d]
            ok = within(a ^ b, layout[t][1], radius)
            out.append(np.stack([a[ok], b[ok]]))
    for k in np.flatnonzero(sizes > SMALL).tolist():
        values = batch_fp[edges[k] : edges[k + 1]]
        found = bucket_links(values, layout[int(batch_t[edges[k]])][1], radius)
        if found:
            i, j = np.array(found).T
            out.append(np.stack([values[i], values[j]]))
    return out


def links(fps: DataFrame, radius: int) -> DataFrame:
    """a, b: links that connect all of fps (a column fp of distinct longs) that lie within radius, and no others."""
    layout = tables(radius)
    signed = [m - (1 << 64) if m >> 63 else m for m, _ in layout]
    keys = F.array(*(F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for t, m in enumerate(signed)))
    rows = fps.select("fp", F.explode(keys).alias("k")).select("k.t", "k.key", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def emit(t, key, fp, last):
            change = np.flatnonzero((t[1:] != t[:-1]) | (key[1:] != key[:-1])) + 1
            edges = np.r_[0, change, len(t)] if last else np.r_[0, change]
            found = _links(t, fp.view(np.uint64), edges, radius, layout) if len(edges) > 1 else []
            pairs = np.concatenate(found, axis=1).view(np.int64) if found else np.zeros((2, 0), dtype=np.int64)
            return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"]), int(edges[-1])

        for batch in batches:
            cols = [np.concatenate([h, c.to_numpy()]) if len(held) else c.to_numpy() for h, c in zip(held or [None] * 3, batch.columns, strict=True)]
            if len(cols[0]) < 2:
                held = cols
                continue
            out, done = emit(*cols, last=False)
            held = [c[done:] for c in cols]
            yield out
        if held and len(held[0]):
            yield emit(*held, last=True)[0]

    dealt = rows.repartition("t", "key").sortWithinPartitions("t", "key")
    return dealt.mapInArrow(run, "a bigint, b bigint")


def near_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 2) -> DataFrame:
    """One row per row: id, fingerprint (16 hex digits), component_id (smallest id reachable over links).

    Null and empty texts and texts without a word have fingerprint zero and link like others; texts shorter than a
    shingle are one shingle.  Only distinct fingerprints are compared; copies join them by membership, so groups of
    copies cost nothing.  A null id is never a component's id unless all its ids are null.  Repeated rows stay; an
    empty table gives an empty result; other columns are ignored.
    """
    docs = durable(with_fingerprint(df, id_col, text_col, shingle), "fingerprints")
    docs_at, since = last_written(), written() - 1
    fps = durable(docs.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    roots = components(links(fps.select("fp"), radius))
    member = durable(fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root")), "members")
    named = durable(member.groupBy("root").agg(F.min("least").alias("component_id")), "named")
    told = durable(member.join(named, "root").select("fp", "component_id"), "components")
    release(df.sparkSession, since, (docs_at, last_written()))
    return docs.join(told, "fp").select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
