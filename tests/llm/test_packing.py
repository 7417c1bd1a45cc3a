from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from edge_texts import EDGE
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from schemaflow.llm import packing
from schemaflow.llm.common import table
from schemaflow.llm.tokens import document_ids

SF = "/root/testdata/sf0.001"


def check_layout(rows, capacity):
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held)


def expected_pieces(ids, capacity):
    first = len(ids) % capacity or capacity
    cuts = [0, *range(first, len(ids) + 1, capacity)] if len(ids) > capacity else [0, len(ids)]
    return [(k, a, b - a, ids[a:b]) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]


def compare(docs, texts):
    tokenizer = Tokenizer.from_file(packing.VOCABULARY)
    want = Counter()
    for i, t in texts:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [packing.END_ID]
        for k, start, length, part in expected_pieces(ids, 1024):
            want[i, k, start, length, zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    rows = packing.pack(packing.digests(packing.pieces(docs))).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    return check_layout(rows, 1024), sum(r.length for r in rows)


def test_pieces_and_layout_of_the_table(spark):
    docs = table(spark, SF, "documents")
    used, tokens = compare(docs, [(r.doc_id, r.text) for r in docs.collect()])
    assert used <= -(-tokens // 1024) * 1.02 + 1


def test_edges(spark, documents):
    compare(documents(EDGE), EDGE)
    assert packing.pack(packing.digests(packing.pieces(documents([])))).collect() == []


def best_fill(counts, room):
    reach = {0}
    for length, n in enumerate(counts):
        for _ in range(n):
            reach |= {s + length for s in reach if s + length <= room}
    return max(reach)


@pytest.mark.parametrize("seed", range(20))
def test_a_bin_is_as_full_as_can_be(seed):
    r = random.Random(seed)
    counts = np.array([0, *(r.choice([0, 0, 1, 3]) for _ in range(25))])
    found = packing.fullest(counts, 31)
    assert sum(found) == best_fill(counts.tolist(), 31)
    assert all(n <= counts[length] for length, n in Counter(found).items())


@pytest.mark.parametrize("seed", range(5))
def test_the_plan_places_every_rank_once(seed):
    r = random.Random(seed)
    lengths = {r.randint(1, 64): r.randint(1, 50) for _ in range(20)}
    plan = packing.make_plan(lengths, 64)
    length = np.repeat(list(lengths), list(lengths.values()))
    rank = np.concatenate([np.arange(n) for n in lengths.values()])
    sequence, offset = plan.place(length, rank)
    seen = set()
    for s, o, n in zip(sequence.tolist(), offset.tolist(), length.tolist()):
        cells = {(s, o + k) for k in range(n)}
        assert o + n <= 64 and not cells & seen
        seen |= cells
    assert set(sequence.tolist()) == set(range(plan.sequences))


def test_the_fast_encoder_agrees_with_the_tokenizer():
    encode = document_ids(packing.VOCABULARY, packing.RANKS)
    tokenizer = Tokenizer.from_file(packing.VOCABULARY)
    r = random.Random(4)
    for _ in range(800):
        text = "".join(r.choice("abcé ñ'\n\t1<|>\xa0 日\x85Ā¿’") for _ in range(r.randint(0, 60)))
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encode(text.encode()), "<u4").tolist() == want, text


def test_columns_of_any_name_stay(spark, documents):
    rows = packing.pieces(documents([(i, "some words " * i) for i in range(20)]))
    for name in ("offset", "sequence_id", "row", "rank", "bucket", "doc", "at", "before", "__row"):
        rows = rows.withColumn(name, F.lit("own"))
    packed = packing.pack(rows)
    assert sorted(packed.columns) == sorted(rows.columns)
    for r in packed.collect():
        assert r["row"] == r["rank"] == r["bucket"] == r["doc"] == r["at"] == r["before"] == r["__row"] == "own"
        assert isinstance(r.offset, int) and isinstance(r.sequence_id, int) and len(r.ids) == 4 * r.length
    check_layout(packed.collect(), 1024)
