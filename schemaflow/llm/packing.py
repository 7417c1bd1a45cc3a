"""Best-fit packing of token sequences by minimum bin slack.

A document becomes pieces of at most ``capacity`` tokens. Only the count of pieces of each length decides how bins are filled,
so the plan is made on a histogram of at most ``capacity`` numbers: the longest length left opens a bin, a bitset
subset-sum over the other lengths finds the fullest combination that fits, and that combination is removed as often as the
counts allow. Each piece then finds its bin by its rank among the pieces of its length.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from schemaflow.llm.common import nested, stored, table, utf8
from schemaflow.llm.tokens import document_ids

CAPACITY = 1024
END_ID = 2
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def fullest(counts: np.ndarray, room: int) -> list[int]:
    """The lengths, longest first, of a fullest combination of at most ``room``; ``counts[l]`` pieces have length l."""
    mask = (1 << (room + 1)) - 1
    reach, taken = 1, []
    for length in (np.flatnonzero(counts[1 : room + 1])[::-1] + 1).tolist():
        for _ in range(min(int(counts[length]), room // length)):
            grown = (reach | reach << length) & mask
            if grown == reach:
                break
            taken.append((length, reach))
            reach = grown
        if reach >> room & 1:
            break
    at, chosen = reach.bit_length() - 1, []
    for length, before in reversed(taken):
        if not before >> at & 1:
            chosen.append(length)
            at -= length
    return chosen[::-1]


@dataclass
class Plan:
    """Runs of ranks: the r-th piece of a length lies in the run with the greatest start at or below r."""

    key: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int

    BITS = 44

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        wanted = (length << self.BITS) + rank
        run = np.searchsorted(self.key, wanted, "right") - 1
        return self.sequence[run] + (wanted - self.key[run]), self.offset[run]


def make_plan(lengths: dict[int, int], capacity: int) -> Plan:
    """Bins for so many pieces of each length."""
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in lengths.items():
        counts[length] = n
    used = np.zeros_like(counts)
    runs, sequences = [], 0
    for longest in range(capacity, 0, -1):
        while counts[longest]:
            counts[longest] -= 1
            combination = [longest, *fullest(counts, capacity - longest)]
            counts[longest] += 1
            need = {length: combination.count(length) for length in combination}
            times = min(int(counts[length]) // n for length, n in need.items())
            offset = 0
            for length in combination:
                runs.append(((length << Plan.BITS) + int(used[length]), sequences, offset))
                used[length] += times
                counts[length] -= times
                offset += length
            sequences += times
    key, sequence, offset = (np.array(c, dtype=np.int64) for c in (zip(*sorted(runs)) if runs else ([], [], [])))
    return Plan(key, sequence, offset, sequences)


def pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
           end_id: int = END_ID, vocabulary: str = VOCABULARY, ranks: str = RANKS) -> DataFrame:
    """doc_id, piece, start, length and ids (little-endian unsigned 32-bit) of the pieces of every row.

    The ids of a text, then ``end_id``. Where they exceed ``capacity`` the last pieces are full and the first takes the
    rest. Null text counts as empty: one piece with the end only. Ids may be null or repeat; other columns are not read.
    """
    source = docs.select(F.col(doc_id).alias("doc_id"), utf8(text).alias("text"))
    fields = [
        source.schema["doc_id"],
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ]
    return source.mapInArrow(cutter(capacity, end_id, vocabulary, ranks), T.StructType(fields))


def cutter(capacity: int, end_id: int, vocabulary: str, ranks: str) -> Callable:
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = document_ids(vocabulary, ranks)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                row, piece, start, length, ids = [], [], [], [], []
                for i, text in enumerate(part.column(1)):
                    data = encode(text.as_py()) + end
                    n = len(data) // 4
                    first = n % capacity or capacity
                    for k, begin in enumerate([0, *range(first, n, capacity)]):
                        stop = begin + capacity if k else first
                        row.append(i)
                        piece.append(k)
                        start.append(begin)
                        length.append(stop - begin)
                        ids.append(data[4 * begin : 4 * stop])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(row, pa.int32())),
                        pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()),
                        pa.array(ids, pa.binary()),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids"],
                )

    return run


def pack(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The rows with sequence_id and offset added; ``length`` (1 to ``capacity``) is the only column that is read.

    Full pieces are sequences of their own. The others are ranked within their length: by scan task first, so that a length
    of very many pieces is ranked in many tasks. Equal rows each get a place. Input columns called sequence_id and offset are
    replaced, all others stay, whatever their names. No rows give no rows.
    """
    spark = rows.sparkSession
    rows = rows.drop("sequence_id", "offset")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    numbered = rows.select(
        nested(rows),
        F.col("length").alias("length"),
        F.monotonically_increasing_id().alias("row"),
        F.pmod(F.spark_partition_id(), F.lit(buckets)).alias("bucket"),
    )
    held = stored(numbered, "pack-pieces")
    short = held.filter(F.col("length") < capacity)
    counts = short.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    found = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()
    plan = make_plan({r["length"]: r["n"] for r in found}, capacity)
    own = Window.partitionBy("length", "bucket").orderBy("row")
    ranked = short.withColumn("rank", F.row_number().over(own) - 1).join(offsets, ["length", "bucket"])

    @F.arrow_udf("struct<sequence_id: long, offset: long>")
    def place(length: pa.Array, rank: pa.Array) -> pa.Array:
        sequence, offset = plan.place(length.to_numpy(), rank.to_numpy())
        return pa.StructArray.from_arrays([pa.array(sequence), pa.array(offset)], names=["sequence_id", "offset"])

    placed = ranked.withColumn("at", place("length", F.col("before") + F.col("rank"))).select("doc.*", "at.*")
    full = held.filter(F.col("length") == capacity).select(
        "doc.*", (F.lit(plan.sequences) + F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return placed.unionByName(full)


def digests(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack(pieces(table(spark, sf_dir, "documents")))
    digest = F.crc32("ids").alias("ids_crc32")
    return packed.select("doc_id", "piece", "start", "length", digest, "sequence_id", "offset")
