from __future__ import annotations

import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from plinth.llm.exact_dedup import chunks, exact_groups

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[(r[1] or "").translate(LOW)].append(r[0])
    out = []
    for r in rows:
        t = (r[1] or "").translate(LOW)
        ids = [i for i in groups[t] if i is not None]
        keep = max(ids) if ids else None
        out.append((r[0], keep, len(groups[t]), r[0] == keep, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_against_plain_groups(awkward, rows):
    assert sorted(map(tuple, exact_groups(awkward).collect()), key=repr) == expected(rows)


def test_colliding_hashes_are_told_apart(awkward, rows):
    got = exact_groups(awkward, hash_of=lambda c: F.pmod(F.xxhash64(c), F.lit(3)))
    assert sorted(map(tuple, got.collect()), key=repr) == expected(rows)


def test_chunks_make_up_the_text(awkward):
    t = F.coalesce("text", F.lit(""))
    assert awkward.where(F.array_join(chunks(t), "") != t).count() == 0
    assert awkward.select(F.max(F.size(chunks(t)))).first()[0] > 10


def test_empty(nothing):
    assert exact_groups(nothing).count() == 0
