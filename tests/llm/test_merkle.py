from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pytest
from edge_texts import EDGE
from oracle import compare, connect

from schemaflow.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, at long, digest string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, more=0):
    doc_id, text, lang, source, n_chars = row[:5]
    values = (doc_id, source, lang, n_chars if n_chars is None else n_chars + more, text)
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    """All levels, the lowest first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([H(*last[i : i + 2]) for i in range(0, len(last), 2)])
    return levels


def path(levels, at):
    out = []
    for level in levels[:-1]:
        other = at ^ 1
        out.append((at & 1, level[other] if other < len(level) else ""))
        at >>= 1
    return out


def brute(rows):
    by_lang = {}
    for row in rows:
        by_lang.setdefault(row[2], []).append(row)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = []
    for lang in langs:
        by_lang[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees.append(tree([leaf(r) for r in by_lang[lang]]))
    top = tree([t[-1][0] for t in trees])
    out = []
    for part, lang in enumerate(langs):
        for at, row in enumerate(by_lang[lang]):
            steps = path(trees[part], at) + path(top, part)
            crc = zlib.crc32(b"" if row[0] is None else str(row[0]).encode())
            node = leaf(row, 1 if crc % 7 == 0 else 0)
            for right, other in steps:
                node = H(other, node) if right else H(node, other)
            proof = H(*(other for _, other in steps))
            root = top[-1][0]
            out.append((row[0], leaf(row), trees[part][-1][0], root, proof, node, node == root))
    return sorted(out, key=repr)


NAMES = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def found(spark, monkeypatch, rows, height):
    frame = spark.createDataFrame([(*r, "k", 5, "d") for r in rows], SCHEMA)
    monkeypatch.setattr(merkle, "table", lambda *_: frame)
    monkeypatch.setattr(merkle.dataset_manifest, "__defaults__", (height,))
    return sorted((tuple(r) for r in merkle.op13_merkle(spark, "").select(*NAMES).collect()), key=repr)


@pytest.mark.parametrize("height,sizes", [(2, {"en": 37, None: 1, "de": 16, "é": 4}), (3, {"en": 9}), (12, {"a": 2, "b": 3})])
def test_trees(spark, monkeypatch, height, sizes):
    rng = np.random.default_rng(1)
    rows = []
    for lang, n in sizes.items():
        rows += [(int(i), f"text é {i}", lang, None if i % 5 == 0 else "s", int(i) if i % 4 else None)
                 for i in rng.choice(1000, n, replace=False)]
    rng.shuffle(rows)
    rows = [(None if r[0] is None else int(r[0]), *r[1:4], None if r[4] is None else int(r[4])) for r in rows]
    want = brute(rows)
    assert found(spark, monkeypatch, rows, height) == want
    if len(rows) > 10:
        assert {w[-1] for w in want} == {True, False}


def test_edges(spark, monkeypatch):
    rows = [(i, t, lang, "s", n) for i, t in EDGE for lang, n in (("en", 1), (None, None))]
    rows += [rows[0]] * 9 + [(8, "x", "en", None, 2**63 - 1)]
    assert found(spark, monkeypatch, rows[:-1], 2) == brute(rows[:-1])
    assert len(found(spark, monkeypatch, rows, 2)) == len(rows)
    assert found(spark, monkeypatch, [], 12) == []
    (only,) = found(spark, monkeypatch, [(1, "a", "en", "s", 1)], 12)
    assert only[1] == only[2] == only[3] and only[4] == H()


@pytest.mark.parametrize("count", [1, 2, 3, 5, 8, 13, 64])
def test_positions_in_the_log(count):
    leaves = [H(str(i)) for i in range(count)]
    top = merkle.top_height(count)
    levels, log = tree(leaves), merkle.postorder(leaves, top)
    assert len(log) == sum(map(len, levels)) and log[-1] == levels[-1][0]
    for height, level in enumerate(levels):
        last = np.minimum((np.arange(len(level)) + 1) << height, count) - 1
        assert [log[p] for p in merkle.positions(last, height)] == level


def test_changed_siblings_change_the_root():
    leaves = [H(str(i)) for i in range(6)]
    levels = tree(leaves)
    steps = path(levels, 5)
    sides = "".join("N" if not other else "L" if right else "R" for right, other in steps)
    siblings = "".join(other for _, other in steps)
    assert merkle.folded(leaves[5], siblings, sides) == levels[-1][0]
    assert merkle.folded(leaves[4], siblings, sides) != levels[-1][0]
    assert merkle.folded(leaves[5], H() + siblings[64:], sides) != levels[-1][0]


def test_sql(spark):
    sf = "/root/testdata/sf0.001"
    assert compare(spark, connect(sf), merkle.op13_merkle, merkle.ORACLE, sf) > 0
