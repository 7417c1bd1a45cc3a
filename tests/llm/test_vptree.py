from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from schemaflow.llm import vptree
from schemaflow.llm.common import table

SCHEMA = "vec_id long, embedding array<float>, label int, v string, row int, cell string"


def usable(rows):
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            yield i, [float(np.float32(x)) for x in v]


def product(a, b):
    total = 0.0
    for x, y in zip(a, b):
        total += x * y
    return total


def brute(rows, k):
    good, out = list(usable(rows)), []
    for at, (query, a) in enumerate(good):
        if query % 3 == 0:
            scores = sorted((-product(a, b), i) for j, (i, b) in enumerate(good) if j != at)
            out += [(query, rank + 1, i, -s) for rank, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def search(spark, rows, k=5, factor=1.0):
    frame = spark.createDataFrame([(i, v, 0, "x", 1, "c") for i, v in rows], SCHEMA)
    result = vptree.nearest(frame, F.col("vec_id") % 3 == 0, k, factor)
    return sorted(tuple(r) for r in result.select("query_id", "rank", "vec_id", "score").collect())


@pytest.fixture
def small(monkeypatch):
    for name, value in (("SHARD_ROWS", 40), ("QUERY_ROWS", 20), ("LEAF_ROWS", 8), ("SAMPLE_ROWS", 64), ("PAIRS", 50)):
        monkeypatch.setattr(vptree, name, value)


@pytest.mark.parametrize("kind", ["spread", "clustered", "one_hot"])
def test_factor_one_is_exact(spark, small, kind):
    rng = np.random.default_rng(5)
    if kind == "one_hot":
        base = np.eye(12)[rng.integers(0, 12, 300)] * rng.choice([1.0, 2.0], (300, 1))
    else:
        base = rng.normal(size=(300, 12)) * rng.uniform(0.1, 3, (300, 1))
        if kind == "clustered":
            base = rng.normal(size=(10, 12))[rng.integers(0, 10, 300)] * 5 + base * 0.05
    base[100:220] = base[100]
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(base)]
    assert search(spark, rows) == brute(rows, 5)


def test_edges(spark, small):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (3, None), (6, [nan, 1.0]), (9, [inf, 0.0]), (12, [None, 1.0]), (None, [5.0, 5.0]),
            (15, [1.0, 2.0]), (15, [1.0, 2.0]), (18, []), (21, [4.0]), (1, [-0.001, 0.0]), (2, [0.0, -0.0]),
            (24, [-0.0, 2.0]), (4, [0.0, 2.0]), (5, [1e30, -1e30])]
    assert search(spark, rows) == brute(rows, 5)
    assert search(spark, []) == []
    assert search(spark, [(3, [0.0])]) == []
    assert search(spark, [(3, [1.0])]) == []
    assert search(spark, [(1, [1.0]), (2, [2.0])]) == []
    assert search(spark, [(0, [1.0]), (2, [2.0])], factor=None) == [(0, 1, 2, 2.0)]


def test_every_row_is_indexed(spark, small):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=6).astype(np.float32).tolist()) for i in range(500)]
    frame = spark.createDataFrame([(i, v, 0, "x", 1, "c") for i, v in rows], SCHEMA)
    index = vptree.build(frame, 3)
    shards = [vptree.Shard.unpacked(r.tree) for r in index.shards.collect()]
    assert sorted(i for s in shards for i in s.ids) == list(range(500)) and len(shards) > 5
    assert index.sizes.count() > 1


def test_recall_of_the_query(spark):
    """Against brute force on whole tables; ids of equal score do not occur here."""
    sf = "/root/testdata/sf0.1"
    vectors = table(spark, sf, "embeddings").collect()
    ids = np.array([r.vec_id for r in vectors])
    x = np.array([r.embedding for r in vectors], dtype=np.float64)
    got = vptree.op12_vptree(spark, sf).collect()
    queries = ids[ids % 20 == 0]
    assert len(got) == 20 * len(queries) and [f.name for f in vptree.op12_vptree(spark, sf).schema][:4] == [
        "query_id", "rank", "vec_id", "score"
    ]
    found = {q: {r.vec_id for r in got if r.query_id == q} for q in queries}
    share = []
    for q in queries:
        scores = x @ x[ids == q][0]
        scores[ids == q] = -np.inf
        share.append(len(found[q] & set(ids[np.argsort(-scores)[:20]])) / 20)
    assert np.mean(share) >= 0.9
    by_id = dict(zip(ids, x))
    for r in got:
        assert r.score == product(by_id[r.query_id], by_id[r.vec_id])


def test_smaller_factors_look_at_less():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(4000, 3))
    ids = np.arange(4000)
    longest = np.sqrt((x**2).sum(axis=1)).max()
    shard = vptree.Shard(ids, ids, x, longest, 5)
    seen = []
    for factor in (0.2, 0.6, 1.0):
        n = 50
        run = vptree.Search(ids[:n], ids[:n], ids[:n], x[:n], np.full(n, np.inf), np.full(n, factor), longest, 5)
        run.run(shard)
        seen.append(run.evaluated)
    assert seen[0] < seen[1] < seen[2] < 50 * 4000
