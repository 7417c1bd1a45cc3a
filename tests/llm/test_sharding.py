from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from edge_texts import EDGE

from schemaflow.llm import sharding


def check(rows, texts, shards):
    assert len(rows) == len(texts)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(0 <= r.shard < shards for r in rows)


def test_equal_texts_share_a_shard_and_sizes_are_near_equal(spark, documents):
    r = random.Random(1)
    pool = ["".join(r.choice("abc é") for _ in range(r.randint(0, 300))) for _ in range(400)]
    texts = [(i, r.choice(pool)) for i in range(2000)]
    rows = sharding.shard(documents(texts), shards=8).collect()
    check(rows, texts, 8)
    text = dict(texts)
    place = defaultdict(set)
    size = Counter()
    for row in rows:
        body = text[row.doc_id].encode()
        assert (row.size, row.text_crc32) == (len(body) + 1, zlib.crc32(body))
        place[body].add(row.shard)
        size[row.shard] += row.size
    assert all(len(p) == 1 for p in place.values())
    biggest = max(Counter(t for _, t in texts)[t] * (len(t.encode()) + 1) for t in pool)
    assert max(size.values()) <= sum(size.values()) / 8 + biggest


def test_a_hot_group_gets_a_shard_of_its_own(spark, documents):
    texts = [(i, "same text") for i in range(600)] + [(i, f"text {i}") for i in range(600, 1200)]
    rows = sharding.shard(documents(texts), shards=4).collect()
    check(rows, texts, 4)
    hot = {r.shard for r in rows if r.doc_id < 600}
    assert len(hot) == 1 and not any(r.shard in hot for r in rows if r.doc_id >= 600)
    rest = Counter()
    for r in rows:
        if r.doc_id >= 600:
            rest[r.shard] += r.size
    assert max(rest.values()) - min(rest.values()) <= 40


def brute_capacity(sizes, shards):
    def fits(c):
        used, left = 1, c
        for s in sizes:
            if s > c:
                return False
            if s > left:
                used, left = used + 1, c
            left -= s
        return used <= shards

    c = 1
    while not fits(c):
        c += 1
    return c


@pytest.mark.parametrize("seed", range(4))
def test_cuts_reach_the_smallest_capacity(spark, monkeypatch, seed):
    monkeypatch.setattr(sharding, "FIRST_BITS", 2)
    monkeypatch.setattr(sharding, "NEXT_BITS", 1)
    r = random.Random(seed)
    keys = sorted(r.sample(range(2**62), 60))
    sizes = [r.choice([1, 2, 5, 30]) for _ in keys]
    groups = spark.createDataFrame(list(zip(keys, sizes)), "key long, size long")
    cuts = sharding.find_cuts(groups, 5)
    part = np.searchsorted(cuts, keys, "left")
    sums = [sum(s for s, p in zip(sizes, part) if p == k) for k in range(len(cuts) + 1)]
    assert len(sums) <= 5 and max(sums) == brute_capacity(sizes, 5)


def test_edges(spark, documents):
    rows = sharding.shard(documents(EDGE), shards=8).collect()
    check(rows, EDGE, 8)
    assert {r.size for r in rows if r.doc_id in (1, 2)} == {1}
    assert sharding.shard(documents([])).collect() == []


def test_written_shards_hold_the_rows_of_theirs(spark, documents, tmp_path):
    docs = documents([*EDGE, *((i, f"text number {i} " * (i % 7)) for i in range(20, 200))])
    path = str(tmp_path / "shards")
    sharding.write_shards(docs, path, shards=4)
    back = spark.read.parquet(path)
    assert sorted(back.columns) == sorted(docs.columns) and back.count() == docs.count()
    want = sorted((r.doc_id or -1, r.size, r.shard) for r in sharding.shard(docs, shards=4).collect())
    assert sorted((r.doc_id or -1, len((r.text or "").encode()) + 1, r.shard) for r in back.collect()) == want
