"""Byte-level BPE by ranks, with a queue of merge ranks under a hierarchical bitmap; and its inverse.

A pre-token's bytes form a linked list. Every adjacent pair that the vocabulary knows waits in the bucket of its rank, as the
position of its left part. Two levels of bitmaps tell which buckets hold anything: one bit per rank in words of 256, one
bit per word above them. Find-first-set on both gives the next rank, the smallest position of its bucket the next merge.
An entry is stale, and skipped, when the pair at its position no longer has the bucket's rank; the
loop ends with the last pair that is not. A pre-token of n bytes takes
O(n log n), so one of many megabytes is no special case.
"""

from __future__ import annotations

from functools import lru_cache
from heapq import heappop, heappush
from struct import pack

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from schemaflow.llm.common import structs, table, utf8
from schemaflow.llm.tokens import read_ranks

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
# The memo of short pre-tokens keeps those of the last one or two generations of so many; it never changes a result.
MEMO_ENTRIES = 500_000
MEMO_CHARS = 48
BITS = [1 << i for i in range(4096)]


class Codec(dict):
    """Ranks of a vocabulary; as a mapping, a bounded memo from pre-tokens to packed ids."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = public_tokenizers.PATTERN):
        super().__init__()
        self.ranks = ranks
        self.older: dict[str, bytes] = {}
        self.words = (max(ranks.values(), default=0) >> 8) + 1
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.split = regex.compile(pattern).findall

    def __missing__(self, piece: str) -> bytes:
        packed = self.older.get(piece)
        if packed is None:
            ids = self.merge(piece.encode())
            packed = pack(f"<{len(ids)}I", *ids) if len(ids) < 64 else np.array(ids, dtype="<u4").tobytes()
        if len(piece) <= MEMO_CHARS:
            if len(self) >= MEMO_ENTRIES:
                self.older = dict(self)
                self.clear()
            self[piece] = packed
        return packed

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        rank_of = self.ranks.get
        whole = rank_of(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        end = list(range(1, n + 1))  # of the part that starts at a position: the start of the next part
        before = list(range(-1, n - 1))
        # The rank of the pair whose left part starts at a position, -1 for none.
        waiting = [rank_of(piece[i : i + 2], -1) for i in range(n)]
        waiting[-1] = -1
        buckets: dict[int, list[int]] = {}
        words = [0] * self.words
        top = live = 0
        for i, rank in enumerate(waiting):
            if rank >= 0:
                live += 1
                if rank in buckets:
                    buckets[rank].append(i)
                else:
                    buckets[rank] = [i]
                    words[rank >> 8] |= BITS[rank & 255]
                    top |= BITS[rank >> 8]
        while live:
            high = (top & -top).bit_length() - 1
            word = words[high]
            lowest = word & -word
            rank = high << 8 | lowest.bit_length() - 1
            bucket = buckets[rank]
            if len(bucket) > 1:
                i = heappop(bucket)
            else:
                i = bucket[0]
                del buckets[rank]
                words[high] = word = word ^ lowest
                if not word:
                    top &= top - 1
            if waiting[i] != rank:
                continue
            middle = end[i]
            end[i] = stop = end[middle]
            live -= 1 if waiting[middle] < 0 else 2
            waiting[middle] = -1
            if stop < n:
                before[stop] = i
                waiting[i] = new = rank_of(piece[i : end[stop]], -1)
                if new >= 0:
                    live += 1
                    if new in buckets:
                        heappush(buckets[new], i)
                    else:
                        buckets[new] = [i]
                        words[new >> 8] |= BITS[new & 255]
                        top |= BITS[new >> 8]
            else:
                waiting[i] = -1
            left = before[i]
            if left >= 0:
                if waiting[left] >= 0:
                    live -= 1
                waiting[left] = new = rank_of(piece[left:stop], -1)
                if new >= 0:
                    live += 1
                    if new in buckets:
                        heappush(buckets[new], left)
                    else:
                        buckets[new] = [left]
                        words[new >> 8] |= BITS[new & 255]
                        top |= BITS[new >> 8]
        ids, i = [], 0
        while i < n:
            stop = end[i]
            ids.append(self.ranks[piece[i:stop]])
            i = stop
        return ids

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.__getitem__, self.split(text)))

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(packed, "<u4").tolist()))


@lru_cache(maxsize=2)
def codec(ranks: str) -> Codec:
    return Codec(read_ranks(ranks))


def encoded(text: Column, ranks: str = RANKS) -> Column:
    """Packed ids of a binary column of UTF-8 text, computed once per row."""

    @F.arrow_udf("binary")
    def encode(texts: pa.Array) -> pa.Array:
        own = codec(ranks)
        return pa.array([own.encode(t.as_py().decode()) for t in texts], pa.binary())

    return encode.asNondeterministic()(text)


def decoded(packed: Column, ranks: str = RANKS) -> Column:
    """UTF-8 bytes of packed ids, computed once per row."""

    @F.arrow_udf("binary")
    def decode(rows: pa.Array) -> pa.Array:
        own = codec(ranks)
        return pa.array([own.decode(r.as_py()) for r in rows], pa.binary())

    return decode.asNondeterministic()(packed)


def round_trip(text: Column, ranks: str = RANKS) -> Column:
    """struct<ids, decoded>: packed ids of a binary column of UTF-8 text and the bytes that those ids stand for."""

    @F.arrow_udf("struct<ids: binary, decoded: binary>")
    def both(texts: pa.Array) -> pa.Array:
        own = codec(ranks)
        ids = [own.encode(t.as_py().decode()) for t in texts]
        return structs({"ids": ids, "decoded": map(own.decode, ids)}, {"ids": pa.binary(), "decoded": pa.binary()})

    return both.asNondeterministic()(text)


def encode_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", ranks: str = RANKS) -> DataFrame:
    """doc_id, n_tokens, ids (packed) and decoded (bytes, from the ids) of every row.

    Null text counts as empty and has no ids. Ids may be null or repeat; other columns are not read. No rows give no rows.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), round_trip(utf8(text), ranks).alias("r"))
    n_tokens = (F.octet_length("r.ids") / 4).cast("long")
    return rows.select("doc_id", n_tokens.alias("n_tokens"), F.col("r.ids").alias("ids"), "r.decoded")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
