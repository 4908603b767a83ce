from __future__ import annotations

import re
from collections import defaultdict

import pytest

from plinth.llm.line_dedup import dedup_lines

WORD = re.compile(r"[^\x20\x09-\x0D]")


def plain(rows, least):
    sites, first = defaultdict(set), {}
    for i, t, s in rows:
        for x in (t or "").split("\n"):
            if WORD.search(x):
                sites[x].add(s or "")
                if i is not None:
                    first[x] = min(first.get(x, i), i)
    out = []
    for i, t, _ in rows:
        lines = [] if t is None else t.split("\n")
        left = [x for x in lines if not (len(sites.get(x, ())) >= least and first.get(x) != i)]
        out.append((i, None if t is None else "\n".join(left), len(lines), len(lines) - len(left)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least", [1, 2, 3])
def test_against_plain(awkward, rows, least):
    got = sorted(((r["doc_id"], r["text"], r["n_lines"], r["n_removed"]) for r in dedup_lines(awkward, least).collect()), key=repr)
    assert got == plain([(r[0], r[1], r[3]) for r in rows], least)


def test_spread_near_and_far_from_the_threshold(spark):
    rows = [(s * 1000 + k, f"own {s} {k}\n" + "\n".join(f"line {n}" for n in range(1, 60) if s < n), f"site{s}") for s in range(60) for k in range(2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for least in (5, 20):
        got = sorted(((r["doc_id"], r["text"], r["n_lines"], r["n_removed"]) for r in dedup_lines(df, least).collect()), key=repr)
        assert got == plain(rows, least)


def test_columns_and_empty(awkward, nothing):
    assert dedup_lines(awkward, 3).columns == [*awkward.columns, "n_lines", "n_removed"]
    assert dedup_lines(nothing, 3).count() == 0
