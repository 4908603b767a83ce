"""Suffix-array dedup: bytes of passages that a document with a smaller id has too.

A passage of LENGTH bytes is found where both its copies were cut out of their documents: around anchors, the least
hashed ANCHOR-byte strings of every window of LENGTH bytes, which depend on the window's content alone.  Anchors
meet by their hash.  Surroundings that are equal as a whole need no comparison; of the others one representative
each goes into shards whose Burrows-Wheeler transforms are merged by interleave refinement (bwt.py), and the
intervals with a common prefix of LENGTH bytes are the repeated passages.
"""

from __future__ import annotations

from collections.abc import Iterator

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, functions as F

from .bwt import ShardBwt, repeated
from ..operators.relational import numbered
from .common import durable, free_shuffles, last_written, release, shuffle_width, written

LENGTH, ANCHOR = 50, 20
AROUND = LENGTH - ANCHOR
#: Bytes of text hashed at once, anchors sent together, windows of a very long text, input bytes for a partition.
SLICE, FLUSH, PIECE, PARTITION = 1 << 20, 1 << 20, 1 << 22, 16 << 20
#: Of the anchors one in RATE, by place, is counted to find the hot ones: a quarter of a mean bucket or more, and HOT_LEAST
#: at least.  At most HOT_MOST anchors can be that hot by the bound that is taken, so eight MB are broadcast.
RATE, HOT_LEAST, HOT_MOST = 16, 1 << 10, 1 << 20
#: Bits of a document's number that tell rows of one id apart, where ids repeat.
ROWS = 28
#: Mark of a record in its length: its anchor is hot.
_HOT = 128
#: Bytes of a shard of surroundings.
SHARD = 1 << 18
_P1, _P2, _P3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
#: Anchor's hash, hash of its surroundings, document, begin and length of the surroundings.
RECORD = np.dtype([("h", "<u8"), ("s", "<u8"), ("doc", "<i8"), ("pos", "<i4"), ("len", "u1")])


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * _P1
    x ^= x >> np.uint64(29)
    x *= _P3
    x ^= x >> np.uint64(32)
    return x


def _words(raw: bytes) -> np.ndarray:
    """The 8 bytes from every place on, as numbers; zeros follow the end."""
    n = len(raw)
    padded = raw + bytes(LENGTH * 2 + 16)
    out = np.empty(n + LENGTH * 2, dtype=np.uint64)
    for o in range(8):
        part = np.frombuffer(padded, dtype="<u8", offset=o, count=(len(padded) - o) // 8)
        room = len(out[o::8])
        out[o::8] = part[:room]
    return out


class _Slice:
    """Texts laid end to end: hashes of all ANCHOR-byte strings, anchors, surroundings."""

    def __init__(self, parts: list[tuple[int, int, bytes]]):
        """parts: document, place of the part in it, bytes."""
        self.doc, self.at = (np.array([p[k] for p in parts], dtype=np.int64) for k in range(2))
        self.raw = b"".join(p[2] for p in parts)
        self.size = np.array([len(p[2]) for p in parts], dtype=np.int64)
        self.begin = np.cumsum(self.size) - self.size
        self.w = _words(self.raw)
        n = len(self.raw)
        w = self.w
        h = _mix(w[:n] * _P1)
        h ^= w[8 : n + 8]
        h = _mix(h * _P2)
        h ^= w[ANCHOR - 8 : n + ANCHOR - 8]
        self.h = _mix(h * _P3)

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of the leftmost least hash of every window within a text, and the first and last window of each."""
        n = len(self.raw)
        bits = np.uint64(max(n.bit_length(), 1))
        key = (self.h >> bits << bits) | np.arange(n, dtype=np.uint64)
        width, least = 1, key
        while width * 2 <= AROUND + 1:
            least = np.minimum(least[:-width], least[width:]) if len(least) > width else least[:0]
            width *= 2
        rest = AROUND + 1 - width
        if rest:
            least = np.minimum(least[:-rest], least[rest:]) if len(least) > rest else least[:0]
        inside = np.zeros(n + 1, dtype=np.int32)
        full = self.size >= LENGTH
        np.add.at(inside, self.begin[full], 1)
        np.add.at(inside, (self.begin + self.size - LENGTH + 1)[full], -1)
        ok = np.flatnonzero(np.cumsum(inside)[: len(least)] > 0)
        if not len(ok):
            return (np.zeros(0, np.int64),) * 3
        place = (least[ok] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        first = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (ok[1:] != ok[:-1] + 1)])
        return place[first], ok[first], ok[np.r_[first[1:], len(ok)] - 1]

    def records(self, places: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        part = np.searchsorted(self.begin, places, "right") - 1
        length = last - first + LENGTH
        out = np.empty(len(places), dtype=RECORD)
        out["h"], out["doc"], out["pos"], out["len"] = self.h[places], self.doc[part], first - self.begin[part] + self.at[part], length
        s = _mix(((length << 8) | (places - first)).astype(np.uint64) * _P2)
        for k in range(0, LENGTH - 8, 8):
            s = _mix((s ^ self.w[first + k]) * _P1)
        for k in range(8, LENGTH + AROUND - (LENGTH - 8) // 8 * 8 + 8, 8):
            s = _mix((s ^ self.w[first + length - k]) * _P1)
        out["s"] = s
        return out


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[_Slice]:
    parts, held = [], 0
    for batch in batches:
        for doc, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            raw = t.as_buffer().to_pybytes() if t.is_valid else b""
            if len(raw) < LENGTH:
                continue
            for a in range(0, max(1, len(raw) - LENGTH + 1), PIECE):
                cut = raw[a : a + PIECE + LENGTH - 1] if len(raw) > PIECE else raw  # each window is in one piece
                parts.append((doc, a, cut))
                held += len(cut)
                if held >= SLICE:
                    yield _Slice(parts)
                    parts, held = [], 0
    if parts:
        yield _Slice(parts)


def _deal(records: np.ndarray, buckets: int, hot: np.ndarray) -> pa.RecordBatch:
    """Records under their anchor's bucket; those of hot anchors by document under as many buckets beyond."""
    bucket = (records["h"] % np.uint64(buckets)).astype(np.int64)
    if len(hot):
        common = np.isin(records["h"], hot)
        bucket[common] = buckets + (_mix(records["doc"][common].view(np.uint64) * _P1) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    ends = np.flatnonzero(np.r_[np.diff(bucket[order]) != 0, True]) + 1
    first = np.r_[0, ends[:-1]]
    rows = records[order]
    return pa.RecordBatch.from_arrays([pa.array(bucket[order][first].astype(np.int32)), pa.array([rows[a:b].tobytes() for a, b in zip(first, ends, strict=True)], pa.binary())], names=["bucket", "blob"])


def _grouped(batches: Iterator[pa.RecordBatch], dtype: np.dtype) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket and its records, one after the other; buckets come in order."""
    name, held = None, []
    for batch in batches:
        for bucket, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if bucket != name and held:
                yield name, np.concatenate(held)
                held = []
            name = bucket
            held.append(np.frombuffer(blob.as_buffer(), dtype=dtype))
    if held:
        yield name, np.concatenate(held)


def _spans(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Each document's spans, merged where they touch."""
    if not len(doc):
        return
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    edge = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    for a, b in zip(edge.tolist(), [*edge[1:].tolist(), len(doc)], strict=True):
        yield int(doc[a]), merge_spans(start[a:b], end[a:b]).astype("<i4").tobytes()


def merge_spans(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Rows (start, end) of the union; spans that touch become one.  start ascends."""
    if not len(start):
        return np.zeros((0, 2), dtype=np.int64)
    reach = np.maximum.accumulate(end)
    new = np.r_[True, start[1:] > reach[:-1]]
    first = np.flatnonzero(new)
    return np.stack([start[first], reach[np.r_[first[1:] - 1, len(start) - 1]]], axis=1)


def _meet(records: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """Spans of anchors whose surroundings an earlier document has as a whole, and the representatives to compare."""
    order = np.argsort(records["h"])
    records = records[order]
    h = records["h"]
    first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
    count = np.diff(np.r_[first, len(h)])
    several = np.minimum.reduceat(records["doc"], first) != np.maximum.reduceat(records["doc"], first)
    records = records[np.repeat(several, count)]
    if not len(records):
        return records, records
    records = records[np.lexsort((records["doc"], records["s"], records["h"]))]
    h, s, doc = records["h"], records["s"], records["doc"]
    new_class = np.r_[True, (h[1:] != h[:-1]) | (s[1:] != s[:-1])]
    first = np.flatnonzero(new_class)
    least = np.repeat(doc[first], np.diff(np.r_[first, len(h)]))
    later = doc >> shift > least >> shift
    group = np.cumsum(np.r_[True, h[1:] != h[:-1]]) - 1
    classes = np.bincount(group[first])
    mixed = classes[group] > 1
    return records[later], records[mixed & ~later]


def _settle(records: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """Of hot records those whose surroundings an earlier document has among them, and the others."""
    records = records[np.lexsort((records["doc"], records["s"], records["h"]))]
    h, s, doc = records["h"], records["s"], records["doc"]
    first = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (s[1:] != s[:-1])])
    later = doc >> shift > np.repeat(doc[first], np.diff(np.r_[first, len(h)])) >> shift
    return records[later], records[~later]


def _by_document(kind: int, records: np.ndarray) -> list[tuple[int, int, bytes]]:
    records = records[np.argsort(records["doc"], kind="stable")]
    edges = [*np.flatnonzero(np.r_[True, records["doc"][1:] != records["doc"][:-1]]).tolist(), len(records)] if len(records) else []
    return [(kind, int(records["doc"][a]), records[a:b].tobytes()) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def _compare(bucket: list[tuple[int, int, bytes]], shift: int) -> tuple[np.ndarray, np.ndarray]:
    """doc, start of the windows of representatives (doc, pos, bytes) that an earlier document has."""
    shards, owner, held, size = [], [], [], 0
    doc = np.array([b[0] for b in bucket], dtype=np.int64)
    start = np.array([b[1] for b in bucket], dtype=np.int64)

    def close() -> None:
        if held:
            lengths = np.array([len(bucket[i][2]) for i in held], dtype=np.int64)
            data = np.frombuffer(b"".join(bucket[i][2] for i in held) + b"\0", dtype=np.uint8)
            shards.append(ShardBwt.of(data, np.cumsum(lengths) - lengths, lengths))
            owner.append(doc[held])

    for i, b in enumerate(bucket):
        held.append(i)
        size += len(b[2])
        if size >= SHARD:
            close()
            held, size = [], 0
    close()
    block, string, offset = repeated(shards, owner, LENGTH)
    if not len(block):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
    least = np.repeat(np.minimum.reduceat(doc[string], first), np.diff(np.r_[first, len(block)]))
    later = doc[string] >> shift > least >> shift
    return doc[string][later], (start[string] + offset)[later]


def _partitions(df: DataFrame) -> int:
    """The session's shuffle partitions, or more where the files that df is read from are large."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    known = sum(x for x in sizes if x < 1 << 60)  # rows that are not from files have no size
    return max(shuffle_width(df.sparkSession), min(known // PARTITION, 1_000_000))


def hot_anchors(src: DataFrame, buckets: int, hot: int | None = None) -> np.ndarray:
    """Sorted hashes of the anchors that are too common for a bucket.

    One anchor in RATE is counted.  Taken are those counted half as often as an anchor of the least hot size is on
    average, so one of that size (1,024 at least, 64 counted) is missed with a chance of 1e-5 at most, and costs a
    task a little more, never a result.
    """

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def count() -> pa.RecordBatch:
            h, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], names=["h", "n"])

        held, size = [], 0
        for part in _slices(batches):
            places = part.anchors()[0]
            own = np.searchsorted(part.begin, places, "right") - 1
            chance = _mix(_mix(part.doc[own].view(np.uint64) * _P2) ^ (places - part.begin[own] + part.at[own]).astype(np.uint64))
            held.append(part.h[places[chance % np.uint64(RATE) == 0]])
            size += len(held[-1])
            if size >= FLUSH:
                yield count()
                held, size = [], 0
        if held:
            yield count()

    seen = durable(src.mapInArrow(sample, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n")), "sampled")
    total = RATE * (seen.agg(F.sum("n")).first()[0] or 0)
    least = max(HOT_LEAST, total // buckets // 4, 2 * total // HOT_MOST) if hot is None else hot
    often = seen.where(F.col("n") >= max(1, least // (2 * RATE))).select("h").toArrow()
    return np.sort(often["h"].to_numpy().view(np.uint64))


def spans(src: DataFrame, shift: int = 0, hot: int | None = None) -> DataFrame:
    """doc, blob: spans to remove, in any number of rows a document.  src: doc (long), t (string).

    Documents are earlier than others by doc >> shift.  hot: occurrences of an anchor above which it is hot.
    """
    spark = src.sparkSession
    partitions = _partitions(src)
    buckets = partitions * 4
    since = written()
    hot_set = hot_anchors(src, buckets, hot)
    known = spark.sparkContext.broadcast(hot_set)  # HOT_MOST anchors at most

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for part in _slices(batches):
            held.append(part.records(*part.anchors()))
            size += len(held[-1])
            if size >= FLUSH:
                yield _deal(np.concatenate(held), buckets, known.value)
                held, size = [], 0
        if size:
            yield _deal(np.concatenate(held), buckets, known.value)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, records in _grouped(batches, RECORD):
            late, ask = (_meet if bucket < buckets else _settle)(records, shift)
            start = late["pos"].astype(np.int64)
            out = [(0, d, b) for d, b in _spans(late["doc"], start, start + late["len"])] + _by_document(1 if bucket < buckets else 2, ask)
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], pa.binary())], names=["kind", "doc", "blob"])

    dealt = src.mapInArrow(deal, "bucket int, blob binary").repartition(partitions, "bucket").sortWithinPartitions("bucket")
    met = durable(dealt.mapInArrow(meet, "kind int, doc bigint, blob binary"), "met")
    del dealt
    free_shuffles(spark)
    parts, asked = [met.where("kind = 0").select("doc", "blob")], met.where("kind = 1").select("doc", "blob")
    if len(hot_set):
        late, ask = _hot_classes(met.where("kind = 2").select("blob"), shift)
        parts.append(late)
        asked = asked.unionByName(ask)

    # the surroundings of representatives, cut out of their texts
    asked = asked.groupBy("doc").agg(F.collect_list("blob").alias("asked"))  # of one document: bounded by its text
    rows = src.join(asked, "doc").select("doc", "t", "asked")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, t, blobs in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                raw = t.as_buffer().to_pybytes() if t.is_valid else b""
                for h, _, _, start, length in np.concatenate([np.frombuffer(b, dtype=RECORD) for b in blobs]).tolist():
                    if length & _HOT:  # window by window
                        out += [(-1, doc, a, hashlib.md5(raw[a : a + LENGTH]).digest()) for a in range(start, start + (length ^ _HOT) - LENGTH + 1)]
                    else:
                        out.append((h % buckets, doc, start, raw[start : start + length]))
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate((pa.int32(), pa.int64(), pa.int32(), pa.binary()))], names=["bucket", "doc", "pos", "cut"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, held = None, []

        def told():
            doc, start = _compare(held, shift)
            return _packed(doc, start, LENGTH)

        for batch in batches:
            for bucket, *rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket != name and held:
                    yield told()
                    held = []
                name = bucket
                held.append(tuple(rest))
        if held:
            yield told()

    cuts = rows.mapInArrow(cut, "bucket int, doc bigint, pos int, cut binary")
    cuts = durable(cuts, "cuts") if len(hot_set) else cuts
    dealt = cuts.where("bucket >= 0").repartition(partitions, "bucket").sortWithinPartitions("bucket")
    parts.append(durable(dealt.mapInArrow(compare, "doc bigint, blob binary"), "compared"))
    del dealt
    if len(hot_set):
        parts.append(_hot_windows(cuts.where("bucket < 0").select("doc", "pos", F.col("cut").alias("w")), shift))
    out = durable(_union(parts), "spans")
    release(spark, since, (last_written(),))
    free_shuffles(spark)
    return out


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _packed(doc: np.ndarray, start: np.ndarray, length: np.ndarray | int) -> pa.RecordBatch:
    out = list(_spans(doc, start, start + length))
    return pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.binary())], names=["doc", "blob"])


def _hot_classes(blobs: DataFrame, shift: int) -> tuple[DataFrame, DataFrame]:
    """Of hot records: spans of those whose surroundings an earlier document has, and marked representatives of the others.

    The least document of equal surroundings is a grouped minimum, so no task gathers what a hot anchor has.
    """

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            r = np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype=RECORD)
            cols = [r["h"].view(np.int64), r["s"].view(np.int64), r["doc"], r["pos"], r["len"].astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in cols], names=["h", "s", "doc", "pos", "len"])

    rows = durable(blobs.mapInArrow(unpack, "h bigint, s bigint, doc bigint, pos int, len int"), "hot")
    classes = durable(rows.groupBy("h", "s").agg(F.min("doc").alias("least")), "classes")
    # a row for each hot anchor, HOT_MOST at most: joined without dealing what one anchor has to one task
    several = F.broadcast(classes.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"))
    told = rows.join(classes, ["h", "s"]).withColumn("late", F.shiftright("doc", shift) > F.shiftright("least", shift))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, pos, length = (batch.column(k).to_numpy().astype(np.int64) for k in range(3))
            yield _packed(doc, pos, length)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            r = np.zeros(batch.num_rows, dtype=RECORD)
            r["doc"], r["pos"], r["len"] = (batch.column(k).to_numpy() for k in range(3))
            r["len"] |= _HOT
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.tobytes() for x in r], pa.binary())], names=["doc", "blob"])

    late = told.where("late").select("doc", "pos", "len").mapInArrow(pack, "doc bigint, blob binary")
    ask = told.where("NOT late").join(several, "h", "left_semi").select("doc", "pos", "len").mapInArrow(mark, "doc bigint, blob binary")
    return late, ask


def _hot_windows(rows: DataFrame, shift: int) -> DataFrame:
    """Windows (doc, pos, w: hash) against the least document that has each: minima combine map-side."""
    least = durable(rows.groupBy("w").agg(F.min("doc").alias("least")), "least")
    late = rows.join(least, "w").where(F.shiftright("doc", shift) > F.shiftright("least", shift)).select("doc", "pos")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _packed(batch.column(0).to_numpy(), batch.column(1).to_numpy().astype(np.int64), LENGTH)

    return late.mapInArrow(pack, "doc bigint, blob binary")


def _told_apart(src: DataFrame) -> tuple[DataFrame, int]:
    """src (id, t) with doc, and the shift that orders doc.  Usually doc is the id.

    Where ids are null or repeat with other texts, rows get a number for their id's order and one for the text.
    """
    keyed = src.withColumn("__h", F.xxhash64(F.coalesce("t", F.lit(""))))
    rows = durable(keyed.select("id", "__h").distinct(), "rows")
    if rows.groupBy("id").agg(F.count("*").alias("n")).where("n > 1 OR id IS NULL").isEmpty():
        return src.withColumn("doc", F.col("id")), 0
    placed = numbered(rows, ["id", "__h"], "n")
    placed = durable(placed, "placed")
    first = durable(placed.groupBy(F.col("id").alias("__id")).agg(F.min("n").alias("first"), F.count("*").alias("texts")), "first")
    last = first.agg(F.max("first").alias("first"), F.max("texts").alias("texts")).first()
    if last["texts"] > 1 << ROWS or last["first"] >= 1 << (63 - ROWS):
        raise ValueError(f"an id has more than {1 << ROWS} texts, or there are more than {1 << (63 - ROWS)} rows")
    first = first.drop("texts")
    doc = F.shiftleft(F.col("first"), ROWS) + (F.col("n") - F.col("first"))
    named = durable(placed.join(first, F.col("id").eqNullSafe(F.col("__id"))).select("__id", F.col("__h").alias("__k"), doc.alias("doc")), "named")
    out = keyed.join(named, F.col("id").eqNullSafe(F.col("__id")) & (F.col("__h") == F.col("__k"))).select("id", "t", "doc")
    return durable(out, "told_apart"), ROWS


def dedup_passages(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int | None = None) -> DataFrame:
    """One row per row: id, n_bytes, spans (array of start and end, in bytes), kept (the remaining bytes).

    Every byte is removed that a string of 50 bytes covers which also starts in a row with a smaller id; strings
    are those of the input and never cross documents.  Ids are integers; rows that repeat an id do not count as
    earlier than each other, and each is cut by its own text; a null id is later than any other and null ids are no
    earlier than each other.  A null text has no bytes, texts under 50 bytes
    stay whole; an empty table gives an empty result; other columns are ignored.
    """
    kind = df.schema[id_col].dataType.simpleString()
    src = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("t"))
    src, shift = _told_apart(src)
    cuts = spans(src.select("doc", "t"), shift, hot).groupBy("doc").agg(F.collect_list("blob").alias("blobs"))  # of one document
    rows = src.join(cuts, "doc", "left").select("id", "t", "blobs")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, gone, size = [], [], []
            for t, blobs in zip(batch.column(1), batch.column(2).to_pylist(), strict=True):
                raw = t.as_buffer().to_pybytes() if t.is_valid else b""
                size.append(len(raw))
                if not blobs:
                    kept.append(raw), gone.append([])
                    continue
                pairs = np.concatenate([np.frombuffer(b, dtype="<i4").reshape(-1, 2) for b in blobs]).astype(np.int64)
                pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
                own = merge_spans(pairs[:, 0], pairs[:, 1]).tolist()
                gone.append([{"start": a, "end": b} for a, b in own])
                edges = [0, *(x for ab in own for x in ab), len(raw)]
                kept.append(b"".join(raw[edges[i] : edges[i + 1]] for i in range(0, len(edges), 2)))
            span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size, pa.int64()), pa.array(gone, span), pa.array(kept, pa.binary())], names=["id", "n_bytes", "spans", "kept"])

    out = rows.mapInArrow(remove, "id bigint, n_bytes bigint, spans array<struct<start:int,end:int>>, kept binary")
    return out.select(F.col("id").cast(kind).alias(id_col), "n_bytes", "spans", "kept")
