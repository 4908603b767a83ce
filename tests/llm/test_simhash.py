from __future__ import annotations

import re

import numpy as np
import xxhash
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from plinth.llm.components import components
from plinth.llm.simhash import bucket_links, fingerprints, near_groups, tables, within
from plinth.llm import simhash_wide
from plinth.llm.simhash_wide import bucket_groups, keep_one, radius_for, similar_groups

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_print(t, k=3):
    w = WORD.findall((t or "").translate(LOW))
    s = [" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def roots(n, near):
    up = list(range(n))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(n):
        for j in range(i):
            if near(i, j):
                a, b = top(i), top(j)
                up[max(a, b)] = min(a, b)
    return [top(i) for i in range(n)]


def test_fingerprints(rows):
    texts = [r[1] for r in rows]
    assert fingerprints(texts, 3).tolist() == [plain_print(t) for t in texts]


@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=200), st.integers(0, 9))
@settings(max_examples=50, deadline=None)
def test_bit_sliced_distance(values, radius):
    x = np.array(values, dtype=np.uint64)
    assert within(x, list(range(64)), radius).tolist() == [v.bit_count() <= radius for v in values]


def test_every_close_pair_shares_a_table():
    rng = np.random.default_rng(1)
    for _ in range(300):
        a = int(rng.integers(0, 2**63))
        b = a ^ sum(1 << int(i) for i in rng.choice(64, 2, replace=False))
        assert any(a & m == b & m for m, _ in tables(2))


def test_buckets():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**63, 4)
    v = np.unique(np.array([int(base[i % 4]) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 4), replace=False)) for i in range(200)], dtype=np.uint64))
    got = list(range(len(v)))
    for i, j in bucket_links(v, list(range(64)), 2):
        got[i] = j
    assert got == roots(len(v), lambda i, j: (int(v[i]) ^ int(v[j])).bit_count() <= 2)
    wide = np.stack([v, v], axis=1)
    assert bucket_groups(wide, 4).tolist() == roots(len(v), lambda i, j: 2 * (int(v[i]) ^ int(v[j])).bit_count() <= 4)


def test_groups_against_brute_force(awkward, nothing, rows):
    got = sorted(((r["doc_id"], int(r["fingerprint"], 16), r["component_id"]) for r in near_groups(awkward).collect()), key=repr)
    prints = [plain_print(r[1]) for r in rows]
    top = roots(len(rows), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 2)
    least = {}
    for i, t in enumerate(top):
        if rows[i][0] is not None:
            least[t] = min(least.get(t, rows[i][0]), rows[i][0])
    assert got == sorted(((r[0], prints[i], least.get(top[i])) for i, r in enumerate(rows)), key=repr)
    assert near_groups(nothing).count() == 0


def test_components(spark):
    rng = np.random.default_rng(3)
    pairs = [(int(a), int(b)) for a, b in rng.integers(-50, 150, (120, 2))] + [(500 + i, 501 + i) for i in range(40)] + [(900, 900 + i) for i in range(1, 60)]
    up = {}

    def top(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        x, y = top(a), top(b)
        up[max(x, y)] = min(x, y)
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {x: top(x) for x in linked}


def test_similar_documents_keep_one(spark, awkward, nothing):
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(5000)]
    rows = []
    for d in range(60):
        t = list(rng.choice(words, 200))
        rows.append((d, " ".join(t)))
        if d % 3 == 0:
            t[50] = "changed"
            rows.append((1000 + d, " ".join(t)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"] for r in keep_one(df).collect()} == set(range(60))
    assert radius_for(0.8) > radius_for(0.9)
    told = {r["doc_id"]: r["component_id"] for r in similar_groups(awkward).collect()}
    assert told[4] == 4 and told[2] == told[3] == told[1] == 1 and told[7] == 7
    assert keep_one(awkward).columns == awkward.columns and keep_one(nothing).count() == 0


def near_pairs(spark):
    """Texts of 100 shingles in pairs of Jaccard 0.770 (not alike), 0.802 (alike), 0.786 (not), short ones of exactly 0.8."""
    rows, want, n = [], set(), 0
    for k in range(160):
        size = 100 if k % 4 < 3 else 4
        own = [f"a{k}x{i}" for i in range(size + 4)]
        cut = (13, 11, 12, 0)[k % 4]  # changed words at the end change as many shingles
        other = own[: len(own) - cut] + [f"b{k}x{i}" for i in range(cut)] if cut else [*own, "one"]
        rows += [(n, " ".join(own)), (n + 1, " ".join(other))]
        want |= {n} if k % 4 in (1, 3) else {n, n + 1}
        n += 2
    return spark.createDataFrame(rows, "doc_id long, text string"), want


def test_links_are_exact(spark, monkeypatch):
    df, want = near_pairs(spark)
    assert {r["doc_id"] for r in keep_one(df).collect()} == want
    # one loose component with an exact link inside: the loose tree must neither link nor hide; also block by block
    words = [f"w{i}" for i in range(104)]
    steps = [" ".join(f"v{i}" if i < 14 * k else w for i, w in enumerate(words)) for k in range(6)]
    chain = spark.createDataFrame([*enumerate(steps), (6, steps[0] + " tail"), (7, steps[5] + " tail")], "doc_id long, text string")
    for block in (simhash_wide.BLOCK, 300):
        monkeypatch.setattr(simhash_wide, "BLOCK", block)
        told = {r["doc_id"]: r["component_id"] for r in similar_groups(chain).collect()}
        assert told == {0: 0, 1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 0, 7: 5}


def groups(spark, texts):
    """component of each text by brute force, and by similar_groups()."""
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [{tuple(w[i : i + 5]) for w in [t.split()] for i in range(max(1, len(w) - 4))} for t in texts]
    want = roots(len(texts), lambda i, j: len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]))
    return want, [r["component_id"] for r in sorted(similar_groups(df).collect(), key=lambda r: r["doc_id"])]


def test_common_passage(spark, monkeypatch):
    """A passage in most documents makes large buckets: none stays above two blocks, and no link is lost."""
    rng = np.random.default_rng(8)
    passage = " ".join(f"p{i}" for i in range(80))
    texts = []
    for i in range(240):
        own = [f"d{i}x{j}" for j in range(20)]
        texts.append(f"{passage} {' '.join(own)}")
        if i % 4 == 0:
            texts.append(f"{passage} {' '.join(own)} more {'words' if i % 8 else 'here'}")
    texts = [texts[i] for i in rng.permutation(len(texts))]
    sizes = []
    monkeypatch.setattr(simhash_wide, "LIMIT", 40)
    monkeypatch.setattr(simhash_wide, "BLOCK", 4000)
    plain = simhash_wide.first_meeting, simhash_wide.second_meeting

    def biggest(rows, weight):
        return rows.groupBy("key").agg(F.sum(weight).alias("w")).agg(F.max("w")).first()[0] or 0

    def first(rows, limit):
        out, hot = plain[0](rows, limit)
        assert hot is not None and biggest(rows, "w") > 3 * limit
        sizes.append(biggest(out, "w") / limit)
        return out, hot

    def second(hot, roots, limit):
        out = plain[1](hot, roots, limit)
        sizes.append(biggest(out.join(hot.select("rep", "w").distinct(), "rep"), "w") / limit)
        return out

    monkeypatch.setattr(simhash_wide, "first_meeting", first)
    monkeypatch.setattr(simhash_wide, "second_meeting", second)
    want, got = groups(spark, texts)
    assert got == want and len(set(want)) == 240
    # one block each, then two, which hashing fills unevenly
    assert len(sizes) == 4 and max(sizes[0], sizes[2]) <= 2 and max(sizes[1], sizes[3]) <= 3


def test_large_group_of_near_copies(spark, monkeypatch):
    """All links of a group that is many blocks large, with documents of other groups between them; few copies travel."""
    rng = np.random.default_rng(9)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for i in range(300):
        own = list(base)
        for j in rng.choice(120, int(rng.integers(0, 3)), replace=False):
            own[j] = f"x{i}y{j}"
        if i % 10 == 0:
            own[40:80] = [f"z{i}y{j}" for j in range(40)]
        texts.append(" ".join(own))
    monkeypatch.setattr(simhash_wide, "LIMIT", 30)
    monkeypatch.setattr(simhash_wide, "BLOCK", 3000)
    want, got = groups(spark, texts)
    assert got == want and 30 < len(set(want)) < 200 and max(want.count(x) for x in set(want)) > 150


def test_repeated_ids_are_told_apart(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    df = spark.createDataFrame([(1, a), (2, a + " tail"), (2, b), (3, b + " end"), (2, b), (None, a), (4, c)], "doc_id long, text string")
    assert sorted((r["doc_id"] or 0, r["text"]) for r in keep_one(df).collect()) == sorted([(1, a), (2, b), (2, b), (0, a), (4, c)])


def test_exact_groups_against_brute_force():
    rng = np.random.default_rng(6)
    base = [rng.choice(60, 30, replace=False) for _ in range(5)]
    sets = [np.unique(np.r_[rng.choice(base[i % 5], 25, replace=False), rng.integers(0, 60, i % 4)]).astype(np.uint64) for i in range(150)]
    plain = [set(s.tolist()) for s in sets]
    want = roots(len(sets), lambda i, j: len(plain[i] & plain[j]) >= 0.8 * len(plain[i] | plain[j]))
    assert simhash_wide.exact_groups(sets, 0.8).tolist() == want
    assert 5 < len(set(want)) < 150
