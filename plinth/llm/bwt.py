"""Burrows-Wheeler transforms of shards of strings, merged by iterative interleave refinement."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Symbols in one number.
PACK = 7


@dataclass
class ShardBwt:
    """The transform of a collection of strings, each with an end of its own that is below all bytes.

    head[i]: the first PACK symbols of suffix i, packed.  symbol[i]: the byte before suffix i in suffix order, or -1 at a string's begin.  back[i]: the place of the
    suffix that begins with that byte.  string, offset: which suffix it is.
    """

    symbol: np.ndarray
    back: np.ndarray
    string: np.ndarray
    offset: np.ndarray
    head: np.ndarray
    left: np.ndarray

    @classmethod
    def of(cls, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> ShardBwt:
        """Strings data[starts[i] : starts[i] + lengths[i]].  Suffixes are sorted by doubling, in this shard alone."""
        sizes = lengths + 1
        ends = np.cumsum(sizes)
        n = int(ends[-1]) if len(ends) else 0
        begin = ends - sizes
        string = np.repeat(np.arange(len(lengths)), sizes)
        offset = np.arange(n) - np.repeat(begin, sizes)
        value = np.full(n, -1, dtype=np.int64)
        inside = np.flatnonzero(offset < np.repeat(lengths, sizes))
        value[inside] = data[starts[string[inside]] + offset[inside]]
        left = np.repeat(lengths, sizes) - offset  # bytes up to the string's end
        # the first PACK symbols as one number; an end is 0 and bytes follow it
        digit = np.concatenate([value + 1, np.zeros(PACK, dtype=np.int64)])
        key = np.zeros(n, dtype=np.int64)
        for k in range(PACK):
            key = (key << 9) | np.where(left > k, digit[k : n + k], 0)
        order = np.argsort(key, kind="stable")
        # of suffixes that end within the number the one of the earlier string is less: they stay in order
        new = np.r_[True, (key[order][1:] != key[order][:-1]) | (left[order][1:] < PACK)] if n else np.zeros(0, dtype=bool)
        rank, step = np.empty(n, dtype=np.int64), PACK
        rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1] if n else 0
        while True:
            count = np.diff(np.r_[np.flatnonzero(new), n])
            tied = order[np.repeat(count > 1, count)] if n else order
            if not len(tied):
                break
            old, second = rank[tied], rank[tied + step]
            again = np.lexsort((second, old))
            tied, old, second = tied[again], old[again], second[again]
            changed = np.r_[True, (old[1:] != old[:-1]) | (second[1:] != second[:-1])]
            start = np.flatnonzero(np.r_[True, old[1:] != old[:-1]])
            inner = np.arange(len(tied)) - np.repeat(start, np.diff(np.r_[start, len(tied)]))
            place = old + inner
            rank[tied] = place[np.flatnonzero(changed)[np.cumsum(changed) - 1]]
            order[place] = tied
            new[place] = changed
            step *= 2
        before = order - 1
        symbol = np.where(offset[order] > 0, value[before], -1).astype(np.int16)
        back = np.where(offset[order] > 0, rank[before], -1)
        return cls(symbol, back, string[order], offset[order], key[order], left[order])


def repeated(shards: list[ShardBwt], owner: list[np.ndarray], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(block, shard-and-string number, offset) of all suffixes whose first depth bytes occur in two owners or more.

    owner[s][i] is the owner of string i of shard s.  The first PACK bytes interleave the shards by their packed
    value.  A round extends every prefix by one byte to the left: the transforms are read in the present interleave,
    distributed stably by byte, and a block ends where the byte or the block before differs.  So after k rounds a
    block is an interval whose common prefix is PACK + k bytes, without suffixes being compared again.  Rows that
    would run past their string's begin, and blocks of one owner, cannot matter later and are left out.
    """
    if not shards:
        return (np.zeros(0, np.int64),) * 3
    rounds = max(depth - PACK, 0)
    base = np.cumsum([0, *(len(s.symbol) for s in shards)])
    symbol = np.concatenate([s.symbol for s in shards])
    back = np.concatenate([s.back + b for s, b in zip(shards, base, strict=False)])
    names = np.cumsum([0, *(len(o) for o in owner)])
    string = np.concatenate([s.string + k for s, k in zip(shards, names, strict=False)])
    offset = np.concatenate([s.offset for s in shards])
    head, left = (np.concatenate([getattr(s, f) for s in shards]) for f in ("head", "left"))
    owners = np.concatenate(owner)
    row = np.flatnonzero((offset >= rounds) & (left >= min(depth, PACK)))
    first_bytes = head[row] >> (9 * (PACK - min(depth, PACK)))
    order = np.argsort(first_bytes, kind="stable")
    row, first_bytes = row[order], first_bytes[order]
    row, block = _live(row, np.r_[True, first_bytes[1:] != first_bytes[:-1]], owners, string)
    for _ in range(rounds):
        if not len(row):
            break
        c = symbol[row].astype(np.uint8)
        order = np.argsort(c, kind="stable")
        row, block, c = back[row[order]], block[order], c[order]
        row, block = _live(row, np.r_[True, (c[1:] != c[:-1]) | (block[1:] != block[:-1])], owners, string)
    return block, string[row], offset[row]


def _live(row: np.ndarray, new: np.ndarray, owners: np.ndarray, string: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of blocks with two owners or more, and their blocks.  new: where a block begins."""
    if not len(row):
        return row, row
    first = np.flatnonzero(new)
    own = owners[string[row]]
    live = np.minimum.reduceat(own, first) != np.maximum.reduceat(own, first)
    count = np.diff(np.r_[first, len(row)])
    keep = np.repeat(live, count)
    return row[keep], np.repeat(np.arange(len(first)), count)[keep]
