from __future__ import annotations

import itertools
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from edge_texts import EDGE
from oracle import compare, connect

from schemaflow.llm import spelling


def brute_words(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 6:
                n[run] += 1
    return {w: c for w, c in n.items() if c >= 5}


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) < len(b):
        a, b = b, a
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def brute(vocabulary, times=5):
    out, forms = {}, {}
    for w, n in vocabulary.items():
        near = [x for x in vocabulary if x != w and is_near(w, x)]
        best = min(near, key=lambda x: (-vocabulary[x], x), default=None)
        forms[w] = best if best is not None and vocabulary[best] >= times * n else None
        out[w] = (n, len(near))
    rows = set()
    for w, (n, n_near) in out.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        rows.add((w, forms[w], root, n, n_near, None if forms[w] is None else vocabulary[forms[w]]))
    return rows


def found(frame, *args):
    rows = [tuple(r) for r in spelling.variants(frame, *args).select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(set(rows)) == len(rows)
    return set(rows)


@pytest.mark.parametrize("most", [20_000, 3])
def test_random_vocabulary(spark, most):
    """Few letters, so that runs of one letter, ambiguous deletions and chains are common."""
    rng = np.random.default_rng(8)
    vocabulary = {}
    while len(vocabulary) < 600:
        word = "".join(rng.choice(list("abé"), rng.integers(6, 10)))
        vocabulary[word] = int(5 ** rng.integers(1, 7)) + int(rng.integers(0, 3))
    vocabulary |= {"a" * n: n * n * n for n in range(6, 40)}
    frame = spark.createDataFrame(list(vocabulary.items()), "word string, n long")
    want = brute(vocabulary)
    assert found(frame, 5, most) == want
    assert any(root != form for _, form, root, *_ in want if form)


def test_every_pair_once(spark):
    words = ["".join(w) for w in itertools.product("ab", repeat=6)] + ["".join(w) for w in itertools.product("ab", repeat=7)]
    frame = spark.createDataFrame([(w, 5) for w in words], "word string, n long")
    for most in (20_000, 1):
        got = [frozenset((r.a, r.b)) for r in spelling.near_pairs(frame, most).collect()]
        assert len(set(got)) == len(got)
        assert set(got) == {frozenset(p) for p in itertools.combinations(words, 2) if is_near(*p)}


def test_long_words(spark):
    words = {"x" * 30_000: 50, "x" * 30_001: 5, "y" + "x" * 29_999: 6, "x" * 30_000 + "z": 7, "q" * 4000: 9}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    assert found(frame) == brute(words)


def test_pieces_end_between_runs(monkeypatch):
    rng = np.random.default_rng(6)
    text = "".join(rng.choice(list("abÉé 1"), 5000))
    whole = spelling.words("7", text, 1)
    for piece in (1, 7, 64):
        monkeypatch.setattr(spelling, "PIECE", piece)
        assert "".join(spelling.pieces(text)) == text
        assert spelling.words("7", text, 1) == whole


def test_vocabulary(spark, documents):
    rng = np.random.default_rng(3)
    stems = ["Letter", "LETTERS", "lettér", "Ãnother", "another", "short", "×÷×÷×÷", "word" * 9]
    rows = list(EDGE) + [(int(i), " ".join(rng.choice(stems, 60)) + "-tail9tailed") for i in range(60)]
    got = {r.word: r.n for r in spelling.vocabulary(documents(rows)).collect()}
    assert got == brute_words(rows)
    assert "Ãnother" in got and "another" in got and len(got) == 8


def test_edges(spark, documents):
    empty = spelling.vocabulary(documents([]))
    assert empty.collect() == [] and found(empty) == set()
    assert found(spelling.vocabulary(documents([(1, None), (None, ""), (2, "abcdef " * 4)]))) == set()
    alone = spelling.vocabulary(documents([(None, "abcdef " * 5), (None, "abcdef")]))
    assert found(alone) == {("abcdef", None, "abcdef", 6, 0, None)}
    with pytest.raises(ValueError):
        spelling.variants(empty, 1)


def test_minimal_acceptor():
    acceptor = spelling.Acceptor(sorted({"car", "cars", "bar", "bars", "cat"}))
    rights = Counter()

    def language(state):
        own = {""} if acceptor.final[state] else set()
        for symbol, to in acceptor.arcs[state].items():
            own |= {symbol + rest for rest in language(to)}
        return frozenset(own)

    for state in range(len(acceptor.arcs)):
        rights[language(state)] += 1
    assert set(rights.values()) == {1} and language(acceptor.start) == {"car", "cars", "bar", "bars", "cat"}


def test_sql(spark):
    sf = "/root/testdata/sf0.001"
    assert compare(spark, connect(sf), spelling.op11_spelling, spelling.ORACLE, sf) > 0
