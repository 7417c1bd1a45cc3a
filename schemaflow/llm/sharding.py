"""Shards of near-equal bytes: minimax contiguous partition over ordered groups of equal texts.

Groups of equal texts are atoms; they are ordered by a 63-bit hash of the text (two texts of one hash form one atom, which
only joins them). A group larger than an even share of what is left gets a shard of its own. The others are cut, in order,
at the smallest capacity for which a greedy check needs no more shards than there are.

The search never sees all groups. It works on a histogram of hash ranges whose size is bounded. A capacity is checked twice:
once as if a range could be cut anywhere, once as if it could not be cut. Those two answers enclose the true one, and only
ranges in which a cut can still fall are divided again, by one aggregation over the stored groups, until they are single
groups. The driver holds 2^12 ranges, and 2^8 more for each range divided.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from schemaflow.llm.common import stored, table

FIRST_BITS = 12
NEXT_BITS = 8
KEY_BITS = 63


@dataclass
class Ranges:
    """Consecutive hash ranges: first and last group's hash, bytes, and groups in each."""

    low: np.ndarray
    high: np.ndarray
    size: np.ndarray
    groups: np.ndarray

    @property
    def ends(self) -> np.ndarray:
        return np.cumsum(self.size)

    @classmethod
    def of(cls, rows) -> Ranges:
        rows = sorted((r["low"], r["high"], r["size"], r["groups"]) for r in rows)
        return cls(*(np.array(c, dtype=np.int64) for c in (zip(*rows) if rows else ([], [], [], []))))

    def replaced(self, chosen: np.ndarray, finer: Ranges) -> Ranges:
        both = [np.concatenate([getattr(self, f)[~chosen], getattr(finer, f)]) for f in ("low", "high", "size", "groups")]
        order = np.argsort(both[0], kind="stable")
        return Ranges(*(c[order] for c in both))


def greedy(ranges: Ranges, ends: np.ndarray, capacity: int, shards: int, divisible: bool) -> list[int]:
    """Bytes before each cut when every shard takes as much as fits; ``divisible`` ranges of several groups may be cut."""
    at, cuts = 0, []
    for _ in range(shards):
        whole = int(np.searchsorted(ends, at + capacity, "right"))
        if divisible and whole < len(ends) and ranges.groups[whole] > 1:
            at += capacity
        elif whole:
            at = max(at, int(ends[whole - 1]))
        cuts.append(at)
    return cuts


def smallest(ranges: Ranges, shards: int, divisible: bool, low: int, high: int) -> int:
    """The smallest capacity in [low, high] with which the greedy check covers everything; ``high`` must."""
    ends = ranges.ends
    total = int(ends[-1])
    while low < high:
        middle = (low + high) // 2
        if greedy(ranges, ends, middle, shards, divisible)[-1] >= total:
            high = middle
        else:
            low = middle + 1
    return low


def find_cuts(groups: DataFrame, shards: int) -> list[int]:
    """The hash of the last group of every shard but the last used one.

    ``groups``: key long (0 to 2^63 - 1) and size long, one row per group.
    """
    ranges = histogram(groups, [(0, 2**KEY_BITS - 1)], FIRST_BITS)
    if not len(ranges.size):
        return []
    total = int(ranges.ends[-1])
    low = -(-total // shards)
    while True:
        low = smallest(ranges, shards, True, low, total)
        high = smallest(ranges, shards, False, low, total)
        ends = ranges.ends
        starts = ends - ranges.size
        chosen = np.zeros(len(ends), dtype=bool)
        pairs = zip(greedy(ranges, ends, low, shards, False), greedy(ranges, ends, high, shards, True))
        for first, last in pairs:
            chosen |= (starts < last) & (ends > first)
        chosen &= ranges.groups > 1
        if not chosen.any():
            break
        spans = list(zip(ranges.low[chosen].tolist(), ranges.high[chosen].tolist()))
        ranges = ranges.replaced(chosen, histogram(groups, spans, NEXT_BITS))
    cuts = greedy(ranges, ranges.ends, high, shards, False)
    return [int(ranges.high[np.searchsorted(ranges.ends, c, "left")]) for c in cuts if 0 < c < total]


def histogram(groups: DataFrame, spans: list[tuple[int, int]], bits: int) -> Ranges:
    """Bytes and groups of at most 2^bits equal parts of each span."""
    part = F.lit(None).cast("long")
    for i, (first, last) in enumerate(spans):
        width = ((last - first) >> bits) + 1
        inside = F.lit(i * 2**bits) + F.expr(f"(key - {first}L) div {width}L")
        part = F.when(F.col("key").between(first, last), inside).otherwise(part)
    found = (
        groups.select("key", "size", part.alias("part"))
        .filter(F.col("part").isNotNull())
        .groupBy("part")
        .agg(
            F.min("key").alias("low"),
            F.max("key").alias("high"),
            F.sum("size").alias("size"),
            F.count(F.lit(1)).alias("groups"),
        )
    )
    return Ranges.of(found.collect())


def lone_groups(groups: DataFrame, shards: int) -> list[int]:
    """Hashes of the groups that are larger than an even share of what is left for the shards left."""
    total = groups.agg(F.sum("size")).first()[0] or 0
    lone = []
    for row in groups.orderBy(F.desc("size"), "key").limit(shards - 1).collect():
        if row["size"] * (shards - len(lone)) <= total:
            break
        lone.append(row["key"])
        total -= row["size"]
    return lone


def shard_of(key: Column, lone: list[int], cuts: list[int]) -> Column:
    place = F.lit(len(lone) + len(cuts))
    for i in reversed(range(len(cuts))):
        place = F.when(key <= cuts[i], len(lone) + i).otherwise(place)
    for i, group in enumerate(lone):
        place = F.when(key == group, i).otherwise(place)
    return place.cast("int")


def key_of(body: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(body), 1)


def bounds(rows: DataFrame, shards: int) -> tuple[list[int], list[int]]:
    """Groups with a shard of their own, and the cuts between the others, from rows (key, size)."""
    groups = stored(rows.groupBy("key").agg(F.sum("size").alias("size")), "shard-groups")
    lone = lone_groups(groups, shards)
    rest = groups.filter(~F.col("key").isin(lone)) if lone else groups
    return lone, find_cuts(rest, shards - len(lone))


def shard(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shards: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row.

    Null text counts as empty. Equal texts share a shard, so one larger than an even share makes its shard larger. Null or
    repeated ids and repeated rows each keep a slot of their own; other columns are not read. An empty table gives none.
    Slots are counted per scan task and shifted by the rows of earlier tasks, so no shard is sorted in one place.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = stored(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            (F.octet_length(body) + 1).cast("long").alias("size"),
            F.crc32(body.cast("binary")).alias("text_crc32"),
            key_of(body).alias("key"),
            F.spark_partition_id().alias("part"),
        ),
        "shard-rows",
    )
    placed = rows.withColumn("shard", shard_of(F.col("key"), *bounds(rows, shards)))
    counts = placed.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    within = Window.partitionBy("shard", "part").orderBy("doc_id", "text_crc32", "size")
    numbered = placed.withColumn("rank", F.row_number().over(within) - 1)
    return numbered.join(offsets, ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("offset") + F.col("rank")).alias("slot")
    )


def write_shards(docs: DataFrame, path: str, text: str = "text", shards: int = 8) -> None:
    """The rows of ``docs`` with all their columns as Parquet below ``path/shard=<n>``, in the shards that :func:`shard` gives.

    A row's shard follows from its text alone, so once the cuts are known the texts are written where they were read, without a
    shuffle. Null texts count as empty; an input column called shard is replaced. No rows write no files.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    size = (F.octet_length(body) + 1).cast("long").alias("size")
    lone, cuts = bounds(docs.select(key_of(body).alias("key"), size), shards)
    docs.withColumn("shard", shard_of(key_of(body), lone, cuts)).write.partitionBy("shard").parquet(path)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard(table(spark, sf_dir, "documents"), shards=8)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
