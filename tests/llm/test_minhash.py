from __future__ import annotations

import random

import numpy as np
import pytest
from edge_texts import EDGE
from pyspark.sql import functions as F

from schemaflow.llm import minhash
from schemaflow.llm.common import table
from schemaflow.llm.components import components


def shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) >= 5:
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
    return {tuple(words)} if words else set()


def roots(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return [find(i) for i in range(n)]


def brute(texts):
    """doc_id, size and component of each row, ids ascending and unique."""
    sets = [shingles(t) for _, t in texts]
    pairs = [
        (i, j)
        for i in range(len(sets))
        for j in range(i)
        if sets[i] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])
    ]
    return sorted((texts[i][0], len(sets[i]), texts[r][0]) for i, r in enumerate(roots(len(sets), pairs)))


def found(docs):
    rows = minhash.near_groups(docs).collect()
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in rows)


def family(r, words, n, most):
    """Copies with up to ``most`` words replaced, so chains of links and pairs just below the limit."""
    base = [r.choice(words) for _ in range(140)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(r.randint(0, most)):
            copy[r.randrange(len(copy))] = r.choice(words)
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("large", [64, 3])
def test_families_of_near_copies(spark, documents, monkeypatch, large):
    monkeypatch.setattr(minhash, "LARGE_BUCKET", large)
    r = random.Random(5)
    words = ["".join(r.choice("abcdefgh") for _ in range(4)) for _ in range(500)]
    texts = family(r, words, 130, 7) + family(r, words, 40, 3)
    texts += [" ".join(r.choice(words) for _ in range(r.randint(3, 200))) for _ in range(60)]
    texts += [texts[3].upper(), texts[3], " \n" + texts[200]]
    rows = list(enumerate(texts))
    assert found(documents(rows)) == brute(rows)


def test_table(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    assert found(docs) == brute(rows)


def test_edges(spark, documents):
    rows = minhash.near_groups(documents(EDGE)).collect()
    assert len(rows) == len(EDGE)
    same = [r for r in rows if r.n_shingles == 3]
    assert len(same) == 4 and {r.component_id for r in same} == {5} and sum(r.first for r in same) == 1
    assert all(r.component_id == r.doc_id and r.first for r in rows if r.doc_id in (1, 2, 3))
    assert minhash.near_groups(documents([])).collect() == []
    kept = minhash.keep_first(documents(EDGE))
    assert kept.columns == documents([]).columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(ids) == [1, 2, 3, 4, 5, 7, 8, 9]


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 1000).astype(np.uint64)
    b = np.concatenate([a[:920], rng.integers(0, 2**63, 80).astype(np.uint64)])
    keys = minhash.band_keys([np.unique(a), np.unique(b), np.unique(a)], minhash.shifted_permutation())
    assert (keys[0] == keys[2]).all()
    assert 3 <= (keys[0] == keys[1]).sum() < minhash.BANDS


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    r = random.Random(seed)
    n = 150
    pairs = [(r.randrange(n), r.randrange(n)) for _ in range(90)] if seed else [(i, i + 1) for i in range(n - 1)]
    rows = components(spark.createDataFrame(pairs, "a long, b long")).collect()
    want = roots(n, pairs)
    named = {x for a, b in pairs if a != b for x in (a, b)}
    assert {x.node: x.label for x in rows} == {x: want[x] for x in named} and len(rows) == len(named)


def test_columns_of_any_name_stay(spark, documents):
    docs = documents([(i, "one text of a few words here") for i in range(3)] + [(9, None)])
    names = ("__n", "__row", "__high", "__low", "__bands", "row", "n", "bands", "doc", "first", "p")
    for name in names:
        docs = docs.withColumn(name, F.lit(name))
    kept = minhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, 9]
    assert all(r[name] == name for r in kept.collect() for name in names)
