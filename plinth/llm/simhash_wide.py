"""SimHash near-dedup at a similarity: wide fingerprints, compared bit-sliced among documents that share a shingle.

A radius for similarity 0.8 is too large for tables over all choices of segments, so documents meet by least hashes:
of SEEDS independent orders of their shingles, two documents of similarity s have a common first shingle in one at
least with probability 1 - (1 - s)^SEEDS, 0.9999974 at 0.8.  Where documents meet, distances are counted over
vertical bit planes as in simhash.py.

A shingle that very many documents share makes a heavy bucket.  Its members meet in blocks first, each document in
one.  Those that are not linked yet meet again by a second least hash: members of the largest group of such a finer
bucket are dealt out over blocks, the others go to each of them, and buckets of one group fall away.  So a large
group of near copies costs a few copies of each document, a common passage is told apart by the second hash, no task
holds more than two blocks, and every pair of a bucket that shares a second least hash is compared.  A pair of
similarity 0.8 shares two of the eight with probability 0.99992.

Fingerprints only find candidates: their radius is loose, and within each component of loose links the sets of
shingles are compared themselves, so links are exactly those of Jaccard similarity and no loose tree hides one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import durable, last_written, release, written
from .components import components
from .simhash import SEED, SLICE_BYTES, _Counters

WORDS, SEEDS = 16, 8
BITS = 64 * WORDS
#: Documents of a bucket above which it is heavy, and of a block; FIRST seeds of a bucket are searched one by one.
LIMIT, FIRST = 1 << 13, 24
#: Buckets up to this size are compared pair by pair, many buckets at once; pairs of one go.
SMALL, PAIRS = 48, 1 << 13
#: Shingles of a loose component above which it is heavy, and of a block.
BLOCK = 1 << 18
#: Rows with texts or sets that a worker holds as Python objects at once.
FEW = 256
_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_SPREAD = np.array([sum((b >> i & 1) << (8 * i) for i in range(8)) for b in range(256)], dtype=np.uint64)


def radius_for(similarity: float, slack: float = 0.25) -> int:
    """Expected distance at a Jaccard similarity slack below the one asked for.

    At 0.8 this is 255 bits: 8 deviations above the mean of long texts, and 5 above that of sets of 4 and 5, whose
    bits differ most often (3 in 16).
    """
    s = similarity - slack
    return round(BITS * math.acos(2 * s / (1 + s)) / math.pi)


def _hash(h: np.ndarray, k: int) -> np.ndarray:
    x = (h ^ np.uint64((k + 1) * 0xD1B54A32D192ED03 & (1 << 64) - 1)) * _STEP
    x ^= x >> np.uint64(32)
    x *= _MIX
    x ^= x >> np.uint64(29)
    return x


def shingle_set(text: str | None, shingle: int) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes; none without words."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else ()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    h = xxhash.xxh64_intdigest
    own = {h(b" ".join(words[i : i + shingle]), SEED) for i in range(max(1, len(words) - shingle + 1))}
    return np.sort(np.fromiter(own, dtype=np.uint64, count=len(own)))


def _whole(own: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(own.tobytes())


def wide_fingerprints(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(n, WORDS) fingerprints over the shingles of each set and (n, SEEDS) least hashes; zeros for empty sets."""
    hashes = [s for s in sets if len(s)]
    counts = np.array([len(s) for s in sets], dtype=np.int64)
    prints, least = np.zeros((len(sets), WORDS), dtype=np.uint64), np.zeros((len(sets), SEEDS), dtype=np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return prints, least
    raw = np.concatenate(hashes)
    sizes = counts[full]
    first = np.cumsum(sizes) - sizes
    for k in range(SEEDS):
        least[full, k] = np.minimum.reduceat(_hash(raw, 1000 + k), first)
    # counts of up to 255 hashes fit eight to a word; larger documents are added up in parts
    parts = -(-sizes // 255)
    owner = np.repeat(np.arange(len(full)), parts)
    inner = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
    begin = first[owner] + 255 * inner
    joint = np.cumsum(parts) - parts
    for w in range(WORDS):
        word = _hash(raw, w)
        for byte in range(8):
            lanes = np.add.reduceat(_SPREAD[(word >> np.uint64(8 * byte) & np.uint64(255)).astype(np.int64)], begin)
            ones = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8), joint, axis=0, dtype=np.int32)
            bits = np.packbits(2 * ones > sizes[:, None], axis=1, bitorder="little")[:, 0].astype(np.uint64)
            prints[full, w] |= bits << np.uint64(8 * byte)
    return prints, least


def _planes(values: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(values.view(np.uint8).reshape(len(values), -1), axis=1, bitorder="little").T
    packed = np.packbits(bits, axis=1, bitorder="little")
    out = np.zeros((bits.shape[0], -(-len(values) // 64) * 8), dtype=np.uint8)
    out[:, : packed.shape[1]] = packed
    return out.view(np.uint64)


def _hits(planes: np.ndarray, queries: np.ndarray, n: int, radius: int) -> np.ndarray:
    """(queries, n) booleans: within radius."""
    counters = _Counters((len(queries), planes.shape[1]), radius)
    for k, plane in enumerate(planes):
        flip = np.uint64(0) - (queries[:, k // 64] >> np.uint64(k % 64) & np.uint64(1))
        counters.add(plane[None, :] ^ flip[:, None])
        if k % 64 == 63 and k > radius and bool((counters.over() == np.uint64(0xFFFFFFFFFFFFFFFF)).all()):
            break
    near = (~counters.over()).view(np.uint8)
    return np.unpackbits(near, axis=1, bitorder="little")[:, :n].astype(bool)


def bucket_groups(values: np.ndarray, radius: int) -> np.ndarray:
    """For each member of a bucket the first member of its component."""
    n = len(values)
    label = np.arange(n)
    open_ = np.arange(n)
    # the large components are taken out whole, each member asked once for what is still outside
    for turn in range(min(FIRST, n)):
        if len(open_) < 2:
            break
        seed = open_[(turn * 7919) % len(open_)]
        front, group = np.array([seed]), [np.array([seed])]
        open_ = open_[open_ != seed]
        while len(front) and len(open_):
            planes = _planes(values[open_])
            step = max(1, (1 << 18) // planes.shape[1])
            near = np.zeros(len(open_), dtype=bool)
            for a in range(0, len(front), step):
                near |= _hits(planes, values[front[a : a + step]], len(open_), radius).any(axis=0)
                if near.all():
                    break
            front, open_ = open_[near], open_[~near]
            group.append(front)
        members = np.concatenate(group)
        label[members] = members.min()
    # what is left is compared in blocks, all with all
    if len(open_) > 1:
        planes, own = _planes(values[open_]), np.arange(len(open_))
        step = max(1, (1 << 18) // planes.shape[1])
        for a in range(0, len(open_), step):
            near = _hits(planes, values[open_[a : a + step]], len(open_), radius)
            for i in np.flatnonzero(near.sum(axis=1) > 1).tolist():
                found = np.unique(own[near[i]])
                if len(found) > 1:
                    own[np.isin(own, found)] = found[0]
        label[open_] = open_[own]
    return label


def _bucket_links(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """a, b of rows (key, rep, print) that come sorted by key."""

    def links(key, rep, prints, last):
        edges = np.r_[0, np.flatnonzero(key[1:] != key[:-1]) + 1, *([len(key)] if last else [])].astype(np.int64)
        sizes = np.diff(edges)
        out = [np.zeros((2, 0), dtype=np.int64)]
        small = np.flatnonzero((sizes > 1) & (sizes <= SMALL))
        left, right = [], []
        held_pairs = 0

        def compare() -> None:
            i, j = np.concatenate(left), np.concatenate(right)
            ok = _pairs_within(prints[i] ^ prints[j], radius)
            out.append(_forest(i[ok], j[ok], rep))

        for k in small.tolist():
            a, b = np.triu_indices(int(sizes[k]), 1)
            left.append(a + edges[k]), right.append(b + edges[k])
            held_pairs += len(a)
            if held_pairs >= PAIRS:
                compare()
                left, right, held_pairs = [], [], 0
        if held_pairs:
            compare()
        for k in np.flatnonzero(sizes > SMALL).tolist():
            own = slice(edges[k], edges[k + 1])
            label = bucket_groups(prints[own], radius)
            moved = np.flatnonzero(label != np.arange(len(label)))
            out.append(np.stack([rep[own][moved], rep[own][label[moved]]]))
        pairs = np.concatenate(out, axis=1)
        return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"]), int(edges[-1])

    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(0).to_numpy(), batch.column(1).to_numpy(), np.frombuffer(b"".join(batch.column(2).to_pylist()), dtype=np.uint64).reshape(-1, WORDS)]
        cols = [np.concatenate([h, c]) for h, c in zip(held, cols, strict=True)] if held else cols
        out, done = links(*cols, last=False)
        held = [c[done:] for c in cols]
        yield out
    if held and len(held[0]):
        yield links(*held, last=True)[0]


def _forest(i: np.ndarray, j: np.ndarray, rep: np.ndarray) -> np.ndarray:
    """Of linked places those links alone that join two trees."""
    top: dict[int, int] = {}
    kept = []
    for a, b in zip(i.tolist(), j.tolist(), strict=True):
        x, y = a, b
        while x in top:
            x = top[x]
        while y in top:
            y = top[y]
        if x != y:
            top[max(x, y)] = min(x, y)
            kept.append((a, b))
    return rep[np.array(kept, dtype=np.int64).reshape(-1, 2)].T


def _pairs_within(xors: np.ndarray, radius: int) -> np.ndarray:
    planes = _planes(xors)
    counters = _Counters((planes.shape[1],), radius)
    for k, plane in enumerate(planes):
        counters.add(plane)
        if k % 64 == 63 and k > radius and bool((counters.over() == np.uint64(0xFFFFFFFFFFFFFFFF)).all()):
            break
    return np.unpackbits((~counters.over()).view(np.uint8), bitorder="little")[: len(xors)].astype(bool)


def exact_groups(sets: list[np.ndarray], similarity: float) -> np.ndarray:
    """For each set of distinct hashes, none empty, the first member of its component at that Jaccard similarity.

    Each member is asked once for what is still outside of its component, among sets of a fitting size.
    """
    order = np.argsort([len(s) for s in sets], kind="stable")
    n = np.array([len(sets[i]) for i in order], dtype=np.int64)
    codes = np.unique(np.concatenate([sets[i] for i in order]), return_inverse=True)[1].ravel()
    starts = np.r_[0, np.cumsum(n)]
    label, outside, present = np.arange(len(sets)), np.ones(len(sets), dtype=bool), np.zeros(int(codes.max()) + 1, dtype=bool)
    live, held, edges = np.arange(len(sets)), codes, starts  # the sets to ask, smallest first
    for seed in range(len(sets)):
        if not outside[seed]:
            continue
        outside[seed] = False
        group, at = [seed], 0
        while at < len(group):
            one = group[at]
            at += 1
            a, b = np.searchsorted(n[live], [math.floor(similarity * n[one]), math.ceil(n[one] / similarity) + 1])
            if a == b:
                continue
            own = codes[starts[one] : starts[one + 1]]
            present[own] = True
            common = np.add.reduceat(present[held[edges[a] : edges[b]]], edges[a:b] - edges[a], dtype=np.int64)
            present[own] = False
            found = live[a:b][(common / (n[live[a:b]] + n[one] - common) >= similarity) & outside[live[a:b]]]
            outside[found] = False
            group += found.tolist()
            left = outside[live]
            if 2 * int(left.sum()) < len(live):
                held = held[np.repeat(left, n[live])]
                live = live[left]
                edges = np.r_[0, np.cumsum(n[live])]
        label[order[group]] = order[group].min()
    return label


def _exact_links(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """a, b of rows (key, rep, shingles) that come sorted by key: a tree of exact links for each key."""

    def links(reps: list[int], sets: list[np.ndarray]) -> pa.RecordBatch:
        label, rep = exact_groups(sets, similarity), np.array(reps, dtype=np.int64)
        moved = np.flatnonzero(label != np.arange(len(label)))
        return pa.RecordBatch.from_arrays([pa.array(rep[moved]), pa.array(rep[label[moved]])], names=["a", "b"])

    key, reps, sets = None, [], []
    for batch in (b.slice(a, FEW) for b in batches for a in range(0, b.num_rows, FEW)):
        for k, rep, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if k != key:
                if len(reps) > 1:
                    yield links(reps, sets)
                key, reps, sets = k, [], []
            reps.append(rep), sets.append(np.frombuffer(raw, dtype=np.uint64))
    if len(reps) > 1:
        yield links(reps, sets)


def first_meeting(rows: DataFrame, limit: int) -> tuple[DataFrame, DataFrame | None]:
    """rows (key, rep, w, ...) with keys above limit of w cut into blocks, and the rows of these heavy keys, if any."""
    heavy = durable(rows.groupBy("key").agg(F.ceil(F.sum("w") / limit).cast("int").alias("blocks")).where("blocks > 1"), "heavy")
    if heavy.isEmpty():
        return rows, None
    hot = rows.join(heavy, "key")
    dealt = hot.withColumn("key", F.xxhash64("key", F.pmod(F.xxhash64("rep"), F.col("blocks"))))
    return rows.join(heavy, "key", "left_anti").unionByName(dealt.drop("blocks")), hot.drop("blocks")


def second_meeting(hot: DataFrame, roots: DataFrame, limit: int) -> DataFrame:
    """key, rep: keys under which all pairs of hot (key, used, least, rep, w) meet that are in different groups.

    roots (node, root) are the groups so far.  Pairs must share a least hash of an order that is not in used.
    """
    named = hot.join(roots.withColumnRenamed("node", "rep"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    finer = named.select("key", "used", "rep", "root", "w", F.posexplode("least").alias("k", "m")).where(~F.array_contains("used", F.col("k")))
    finer = durable(finer.select(F.xxhash64("key", "k", "m").alias("key"), "rep", "root", "w"), "finer")
    shares = finer.groupBy("key", "root").agg(F.sum("w").alias("w"))
    largest = shares.groupBy("key").agg(F.count("*").alias("groups"), F.sum("w").alias("all"), F.max(F.struct("w", "root")).alias("top")).where("groups > 1")
    blocks = lambda w: F.ceil(w / limit).cast("int")
    largest = largest.select("key", F.col("top.root").alias("main"), blocks(F.col("top.w")).alias("m"), blocks(F.col("all") - F.col("top.w")).alias("o"))
    is_main = F.col("root") == F.col("main")
    cut = finer.join(durable(largest, "largest"), "key").withColumn("mine", F.pmod(F.xxhash64("rep"), F.when(is_main, F.col("m")).otherwise(F.col("o"))).cast("int"))
    to = lambda n, body: F.transform(F.sequence(F.lit(0), F.col(n) - 1), body)
    with_main = lambda i, j: F.xxhash64("key", F.lit(0), i, j)
    others = F.transform(F.filter(F.sequence(F.lit(0), F.col("o") - 1), lambda i: i != F.col("mine")), lambda i: F.xxhash64("key", F.lit(1), F.least(i, "mine"), F.greatest(i, "mine")))
    keys = F.when(is_main, to("o", lambda j: with_main(F.col("mine"), j))).otherwise(F.concat(to("m", lambda i: with_main(i, F.col("mine"))), others))
    return cut.select(F.explode(keys).alias("key"), "rep")


def _named(reps: DataFrame, twice: DataFrame) -> DataFrame:
    other = reps.join(twice, "first", "left_semi").withColumn("rep", F.xxhash64("whole"))
    return durable(reps.join(twice, "first", "left_anti").withColumn("rep", F.col("first")).unionByName(other), "reps")


def _groups(df: DataFrame, id_col: str, text_col: str, shingle: int, similarity: float) -> DataFrame:
    """id, th (hash of the text), component_id for each row with an id."""
    text = F.col(f"`{text_col}`").cast("string")
    src = df.where(F.col(f"`{id_col}`").isNotNull()).select(F.col(f"`{id_col}`").cast("long").alias("id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("th"), text.alias("t"))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.cumsum([len(t or "") for t in batch.column(2).to_pylist()]) // SLICE_BYTES
            edges = [0, *(np.flatnonzero(np.diff(sizes)) + 1).tolist(), batch.num_rows] if batch.num_rows else []
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                part = batch.slice(a, b - a)
                sets = [shingle_set(t, shingle) for t in part.column(2).to_pylist()]
                prints, least = wide_fingerprints(sets)
                flat = least.view(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, flat.size + 1, SEEDS, dtype=np.int32)), pa.array(flat.ravel()))
                own = [pa.array([_whole(s) for s in sets], pa.binary()), pa.array([len(s) for s in sets], pa.int32())]
                yield pa.RecordBatch.from_arrays([*part.columns[:2], *own, pa.array([p.tobytes() for p in prints], pa.binary()), lists], names=["id", "th", "whole", "size", "print", "least"])

    docs = durable(src.mapInArrow(sketch, "id bigint, th bigint, whole binary, size int, print binary, least array<bigint>"), "sketches")
    docs_at, since = last_written(), written() - 1
    # documents with one set of shingles, by its 128-bit hash, stand for each other
    reps = durable(docs.groupBy("whole", "size", "print", "least").agg(F.min("id").alias("first")), "reps")
    # an id that repeats with another text is no name for either
    twice = durable(reps.groupBy("first").agg(F.count("*").alias("n")).where("n > 1").select("first"), "repeated_ids")
    reps = reps.withColumn("rep", F.col("first")) if twice.isEmpty() else _named(reps, twice)
    met = reps.select("rep", "print", "least", F.posexplode("least").alias("k", "m")).select(F.xxhash64("k", "m").alias("key"), F.array("k").alias("used"), "least", "rep", F.lit(1).alias("w"), "print")
    radius = radius_for(similarity)

    def near(rows: DataFrame) -> DataFrame:
        dealt = rows.select("key", "rep", "print").repartition("key").sortWithinPartitions("key")
        return dealt.mapInArrow(lambda batches: _bucket_links(batches, radius), "a bigint, b bigint")

    rows, hot = first_meeting(met, LIMIT)
    links = durable(near(rows), "near")
    if hot is not None:
        again = second_meeting(hot.drop("print"), components(links), LIMIT)
        links = links.unionByName(near(again.join(reps.select("rep", "print"), "rep")))
    loose = durable(components(links).withColumnRenamed("node", "rep"), "loose")

    members = durable(reps.select("rep", "first", "whole", F.col("size").alias("w"), "least").join(loose, "rep"), "members")
    rows, hot = first_meeting(members.select(F.col("root").alias("key"), F.array().cast("array<int>").alias("used"), "least", "rep", "w", "first", "whole"), BLOCK)

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(a, FEW) for b in batches for a in range(0, b.num_rows, FEW)):
            sets = [shingle_set(t, shingle) for t in batch.column(3).to_pylist()]
            own = pa.array([_whole(s) == w for s, w in zip(sets, batch.column(2).to_pylist(), strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array([s.tobytes() for s in sets], pa.binary())], names=["key", "rep", "shingles"]).filter(own)

    # a sorted join at every size: how many documents are alike grows with the corpus
    asked = src.join(rows.select(F.col("first").alias("id"), "key", "rep", "whole").hint("merge"), "id").select("key", "rep", "whole", "t")
    sets = durable(asked.mapInArrow(shingles, "key bigint, rep bigint, shingles binary"), "sets")

    def alike(rows: DataFrame) -> DataFrame:
        dealt = rows.select("key", "rep", "shingles").repartition("key").sortWithinPartitions("key")
        return dealt.mapInArrow(lambda batches: _exact_links(batches, similarity), "a bigint, b bigint")

    links = durable(alike(sets), "alike")
    if hot is not None:
        again = second_meeting(hot.drop("first", "whole"), components(links), BLOCK)
        links = links.unionByName(alike(again.join(sets.select("rep", "shingles").dropDuplicates(["rep"]), "rep")))
    roots = durable(components(links), "roots")
    member = durable(reps.join(roots.withColumnRenamed("node", "rep"), "rep", "left").select("whole", "first", F.coalesce("root", "rep").alias("root")), "members")
    named = durable(member.groupBy("root").agg(F.min("first").alias("component_id")), "named")
    told = durable(member.join(named, "root").select("whole", "component_id"), "components")
    release(df.sparkSession, since, (docs_at, last_written()))
    return docs.join(told, "whole").select("id", "th", "component_id")


def similar_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """id, component_id for each row with an id: the smallest id of the documents linked by Jaccard similarity of their shingles.

    A-Z is lowered, words are split at ASCII white space; texts without words are alike.  Equal sets of shingles are
    compared once.  Ids are integers.  Rows without an id are left out; rows that repeat an id are told apart by
    their texts; an empty table gives an empty result.
    """
    return _groups(df, id_col, text_col, shingle, similarity).select(F.col("id").alias(id_col), "component_id")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """The rows of df whose id is the smallest of their group, and rows without an id.

    A row is known by its id and its text, so a row that repeats an id with another text is judged by its own; rows
    that repeat both stay or go together.
    """
    groups = _groups(df, id_col, text_col, shingle, similarity)
    gone = durable(groups.where("id <> component_id").select(F.col("id").alias("__i"), F.col("th").alias("__h")).distinct(), "copies")
    th = F.xxhash64(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
    return df.join(gone, (F.col(f"`{id_col}`") == F.col("__i")) & (th == F.col("__h")), "left_anti")
