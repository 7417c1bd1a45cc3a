"""The pipeline's near-duplicate stage at its own limit of 0.80, and bands that follow the limit."""

from __future__ import annotations

import random

import corpus_pipeline
import numpy as np
from test_minhash import roots, shingles

from schemaflow.llm import minhash


def brute(texts, percent):
    """Index of the first text of each one's group."""
    sets = [shingles(t) for t in texts]
    pairs = [
        (i, j)
        for i in range(len(sets))
        for j in range(i)
        if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
    ]
    return roots(len(sets), pairs)


def planted(r, words, changes):
    """A text of ``words`` words and a copy with so many words, more than four apart, changed."""
    text = [f"w{r.randrange(10**9)}" for _ in range(words)]
    copy = list(text)
    for k in range(changes):
        copy[5 + k * ((words - 10) // changes)] = f"v{r.randrange(10**9)}"
    return " ".join(text), " ".join(copy)


def test_the_stage_links_from_080(spark, documents):
    r = random.Random(8)
    texts, between = [], 0
    for words, changes, n in ((200, 4, 25), (100, 2, 25), (49, 1, 10), (200, 5, 10), (200, 3, 10)):
        for _ in range(n):
            pair = planted(r, words, changes)
            a, b = map(shingles, pair)
            between += 80 * len(a | b) <= 100 * len(a & b) < 85 * len(a | b)
            texts += pair
    assert between == 60
    kept = corpus_pipeline.near_duplicates(spark, documents(list(enumerate(texts))), "").collect()
    want = {i for i, first in enumerate(brute(texts, 80)) if i == first}
    assert sorted(x.doc_id for x in kept) == sorted(want)
    assert len(want) == len(texts) - 70


def test_bands_follow_the_limit():
    assert minhash.band_count(85) == 28 and minhash.band_count(80) == 44 and minhash.band_count(100) == 1
    for percent in (80, 85, 95):
        assert (1 - (percent / 100) ** minhash.ROWS) ** minhash.band_count(percent) <= 2e-6
    sets = [np.arange(1, 50, dtype=np.uint64)]
    assert minhash.band_keys(sets, minhash.shifted_permutation(44)).shape == (1, 44)
