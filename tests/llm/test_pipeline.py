from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pytest
import sentencepiece

import __spark_entry__ as entry
import corpus_pipeline
from plinth.llm import mixing
from plinth.llm.queries import MIN_SITES, MIX_WEIGHTS, OP5_SQL, oracle_sql, queries, tokenizer_path

from ..conftest import DATA
from ..oracle import duck, same
from .test_line_dedup import plain as plain_lines
from .test_simhash import roots

SF, MORE = f"{DATA}/sf0.001", f"{DATA}/sf0.01"


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_against_oracle(spark, name):
    same(spark, duck(SF), queries()[name], oracle_sql()[name], SF)


def test_registered():
    names = entry.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names


def near_components(texts):
    """For each text the first one of its component at five-word Jaccard similarity 0.8."""
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", t.translate({c: c + 32 for c in range(65, 91)}))
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))))
    return roots(len(texts), lambda i, j: 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]))


def copies_of(u, rate):
    """Inverse of the Poisson distribution."""
    k, term = 0, math.exp(-rate)
    total = term
    while total <= u:
        k += 1
        term *= rate / k
        total += term
    return k


def plain_pipeline(sf):
    con = duck(sf)
    docs = con.execute(f"SELECT doc_id, text, source FROM documents JOIN ({OP5_SQL}) USING (doc_id) WHERE kept ORDER BY doc_id").fetchall()
    cut = {i: t for i, t, _, _ in plain_lines(docs, MIN_SITES)}
    docs = [(i, cut[i], s) for i, _, s in docs]
    first = near_components([t for _, t, _ in docs])
    docs = [d for k, d in enumerate(docs) if first[k] == k]
    size = Counter()
    for _, t, s in docs:
        size[s] += len(t.encode())
    named = {s for s in size if s in MIX_WEIGHTS}
    rate = {s: MIX_WEIGHTS[s] / sum(MIX_WEIGHTS[x] for x in named) * sum(size[x] for x in named) / size[s] for s in named}
    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path())
    out = Counter()
    for i, t, s in docs:
        u = int(hashlib.md5(f"{mixing.SEED}:{i}".encode()).hexdigest()[:13], 16) / 2**52
        ids = model.encode(t)
        back = model.decode(ids)
        out[(i, s, len(ids), tuple(ids), hashlib.sha256(back.encode()).hexdigest())] += copies_of(u, rate.get(s, 1.0))
    return +out


@pytest.mark.parametrize("sf", [SF, MORE])
def test_run_against_plain_stages(spark, sf):
    got = Counter((r["doc_id"], r["source"], r["n_tokens"], tuple(r["ids"]), r["decoded_sha256"]) for r in corpus_pipeline.run(spark, sf).collect())
    want = plain_pipeline(sf)
    assert got == want and len(want) > 100


def test_stages_take_awkward_rows(spark, awkward, nothing):
    """Nulls, repeated ids, extra columns and empty tables go through every stage; rows that one keeps reach the next."""
    for df, some in ((awkward, True), (nothing, False)):
        state = df
        for _, stage in corpus_pipeline.STAGES[:-1]:
            state = spark.createDataFrame(stage(spark, state, SF).collect(), df.schema)
            assert state.columns == df.columns and bool(state.count()) == some
        last = corpus_pipeline.STAGES[-1][1](spark, state, SF)
        assert last.columns == ["doc_id", "source", "n_tokens", "ids", "decoded_sha256"] and last.count() == state.count()
    # texts that only later stages meet: empty and null ones, very long words, repeated rows
    for _, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, awkward, SF).count() > 0
    encoded = corpus_pipeline.STAGES[-1][1](spark, awkward, SF).collect()
    assert len(encoded) == awkward.count() and {r["n_tokens"] for r in encoded if r["doc_id"] in (1, 2)} == {0}
