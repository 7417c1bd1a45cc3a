from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from edge_texts import EDGE

from schemaflow.llm import bpe
from schemaflow.llm.common import table


@pytest.fixture(scope="module")
def library():
    own = bpe.codec(bpe.RANKS)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})


def test_random_texts(library):
    own = bpe.codec(bpe.RANKS)
    r = random.Random(3)
    for _ in range(3000):
        text = "".join(r.choice("aaabé ñ\n'日\U0001f3891") for _ in range(r.randint(0, 60)))
        packed = own.encode(text)
        assert np.frombuffer(packed, "<u4").tolist() == library.encode_ordinary(text)
        assert own.decode(packed) == text.encode()


@pytest.mark.parametrize("text", ["a" * 40_000, "ab" * 30_000, "日本" * 20_000, " " * 30_000 + "x"])
def test_very_long_pre_tokens(library, text):
    assert np.frombuffer(bpe.codec(bpe.RANKS).encode(text), "<u4").tolist() == library.encode_ordinary(text)


def test_the_memo_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_ENTRIES", 3)
    own = bpe.Codec(bpe.codec(bpe.RANKS).ranks)
    text = "some words and some other words and more of them, some twice"
    for _ in range(3):
        assert np.frombuffer(own.encode(text), "<u4").tolist() == library.encode_ordinary(text)


def test_documents_and_edges(spark, documents, library):
    rows = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text").collect()
    texts = [*EDGE, *((r.doc_id, r.text) for r in rows)]
    found = bpe.encode_documents(documents(texts)).collect()
    want = sorted((str(i), np.array(library.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for i, t in texts)
    assert sorted((str(r.doc_id), bytes(r.ids), bytes(r.decoded)) for r in found) == want
    assert all(r.n_tokens == len(r.ids) // 4 for r in found)
    assert bpe.encode_documents(documents([])).collect() == []


def test_query(spark, library):
    sf = "/root/testdata/sf0.001"
    text = {r.doc_id: r.text or "" for r in table(spark, sf, "documents").collect()}
    for r in bpe.op5_bpe(spark, sf).collect():
        ids = np.array(library.encode_ordinary(text[r.doc_id]), "<u4")
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()
