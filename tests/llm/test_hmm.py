from __future__ import annotations

import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from edge_texts import EDGE
from pyspark.sql import functions as F

from schemaflow.llm import hmm
from schemaflow.llm.common import held_out, table


def random_model(rng, states, classes):
    def rows(*shape):
        x = rng.uniform(0.1, 1, shape)
        return x / x.sum(axis=-1, keepdims=True)

    return hmm.Model(rows(states), rows(states, states), rows(states, classes).T.copy())


def paths(model, chain):
    """Every state path with its probability."""
    for path in itertools.product(range(len(model.start)), repeat=len(chain)):
        p = model.start[path[0]] * model.emit[chain[0], path[0]]
        for i in range(1, len(chain)):
            p *= model.move[path[i - 1], path[i]] * model.emit[chain[i], path[i]]
        yield path, p


CHAINS = [np.array(c) for c in ([0, 1, 2, 0, 3], [3, 3, 1], [2, 0, 1], [1])]


def test_likelihood_is_the_sum_over_all_paths():
    model = random_model(np.random.default_rng(1), 3, 4)
    want = [math.log10(sum(p for _, p in paths(model, c))) for c in CHAINS]
    assert np.allclose(model.forward(CHAINS), want)


def test_expected_counts_are_those_of_all_paths():
    model = random_model(np.random.default_rng(2), 3, 4)
    start, move, emit = np.zeros(3), np.zeros((3, 3)), np.zeros((4, 3))
    model.expect(CHAINS, start, move, emit)
    move *= model.move
    want_start, want_move, want_emit = np.zeros(3), np.zeros((3, 3)), np.zeros((4, 3))
    for chain in CHAINS:
        total = sum(p for _, p in paths(model, chain))
        for path, p in paths(model, chain):
            want_start[path[0]] += p / total
            for i, s in enumerate(path):
                want_emit[chain[i], s] += p / total
                if i:
                    want_move[path[i - 1], s] += p / total
    assert np.allclose(start, want_start) and np.allclose(move, want_move) and np.allclose(emit, want_emit)


@pytest.mark.parametrize("tokens", [1, 7, 50])
def test_long_chains_are_not_cut(monkeypatch, tokens):
    """Stretches of few steps give the counts of one stretch."""
    rng = np.random.default_rng(3)
    model = random_model(rng, 3, 5)
    chains = [rng.integers(0, 5, n) for n in (60, 60, 41, 9, 1)]

    def counts():
        out = np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3))
        model.expect(chains, *out)
        return out

    whole = counts()
    assert np.isclose(whole[2].sum(), sum(map(len, chains))) and np.isclose((whole[1] * model.move).sum(), sum(len(c) - 1 for c in chains))
    monkeypatch.setattr(hmm, "BLOCK_TOKENS", tokens)
    for a, b in zip(whole, counts()):
        assert np.allclose(a, b)


def test_long_words_stay_out_of_the_head(spark, documents):
    docs = documents([(1, "data:" + "x" * 500), (2, "data:" + "x" * 500 + " short short"), (3, "short")])
    counts = hmm.word_counts(docs.select(F.col("text").cast("binary").alias("text")))
    alphabet = hmm.make_alphabet(counts, 3, 10, 4)
    assert set(alphabet.head) == {b"short"} and alphabet.tokens == 8 and alphabet.types == 3


def base_scores(texts, is_held):
    words = [(t or "").encode().lower().split() for t in texts]
    counts = Counter(w for ws, h in zip(words, is_held) if not h for w in ws)
    ends = sum(not h for h in is_held)
    total, types = sum(counts.values()) + ends, len(counts) + (ends > 0)
    for ws in words:
        c = [*(counts[w] for w in ws), ends]
        yield len(c), sum(x > 0 for x in c), total, sum(math.log10((x + 1) / (total + types + 1)) for x in c)


@pytest.mark.parametrize("head", [64_000, 40])
def test_base_and_model(spark, head):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = docs.select("doc_id", "text").collect()
    held = [zlib.crc32(str(r.doc_id).encode()) % 7 == 2 for r in rows]
    want = dict(zip((r.doc_id for r in rows), base_scores([r.text for r in rows], held)))
    found = hmm.score(docs, held_out("doc_id", 7, 2), head_words=head, tail_classes=16, passes=2).collect()
    assert {r.doc_id: r.held_out for r in found} == {r.doc_id: h for r, h in zip(rows, held)}
    for r in found:
        n, known, total, base = want[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
    apart = [r for r in found if r.held_out]
    assert head == 40 or sum(r.score for r in apart) > sum(r.base_score for r in apart)


def test_words_of_a_class_add_up_to_its_share(spark, documents):
    texts = [(i, t) for i, t in enumerate(["aa bb cc aa", "aa dd ee", "bb ff", "aa"])]
    docs = documents(texts)
    counts = hmm.word_counts(docs.select(F.col("text").cast("binary").alias("text")))
    alphabet = hmm.make_alphabet(counts, 4, 2, 1)
    assert set(alphabet.head) == {b"aa", b"bb"} and alphabet.tokens == 14 and alphabet.types == 7
    rare = {r.word: r.c for r in counts.collect() if bytes(r.word) not in alphabet.head}
    share = alphabet.tail_counts[0] + alphabet.tail_words[0] + 1
    assert sum(c + 1 for c in rare.values()) + 1 == share


def test_edges(spark, documents):
    rows = hmm.score(documents(EDGE), held_out("doc_id", 7, 2), states=2, passes=1).collect()
    assert len(rows) == len(EDGE) and all(np.isfinite(r.score) and r.score <= 0 for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (1, 2, 3)} == {1}
    assert hmm.score(documents([]), held_out("doc_id", 7, 2)).collect() == []
    alone = hmm.score(documents([(1, "a b")]), F.lit(True)).first()
    assert (alone.n_known, alone.train_tokens, alone.base_score) == (0, 0, 0.0)
