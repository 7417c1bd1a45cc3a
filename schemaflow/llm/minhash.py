"""Near-duplicate groups by circulant MinHash, banding and exact Jaccard verification.

One permutation scatters the shingles of a text over 2^18 places. A second one, shifted circularly by k places, gives
coordinate k of the signature as its least value over those places, so two permutations give all coordinates. Six
coordinates form a band; a signature has as many bands as two sets at the limit need to share none with probability 2e-6 only:
28 for similarity 0.85, 44 for 0.80.

Texts of equal sets are one class, and only classes are compared. Classes of equal band keys form buckets. Every link is
confirmed on full sets, in two steps that never emit all pairs of a bucket:

1. each class against the centre of each of its buckets (the class with the fewest rare shingles);
2. in buckets whose classes are not yet one component, the classes outside the largest component of the bucket against those
   of other components, as far as bounds allow a link: from the sizes, and in large buckets from the shingles that very few
   classes of the large buckets hold. The holders of such a rare shingle are compared among themselves, at most four of them;
   all other pairs cannot share any rare shingle.

A pair left out lies in one component already or cannot reach the limit, so components are those of all links between
bucket mates.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from schemaflow.llm.common import nested, stored, structs, table, utf8
from schemaflow.llm.components import components
from schemaflow.llm.shingles import Shingler, common, mixed

ROWS = 6
# How often two sets exactly at the limit may share no band.
MISSED = 2e-6
PLACES_BITS = 18
SCATTER = np.uint64(0xD6E8FEB86659FD93)
ROW_FACTORS = mixed(np.arange(1, ROWS + 1, dtype=np.uint64)) | np.uint64(1)
BLOCK_SHINGLES = 1 << 16
COUNTED_SHINGLES = 1 << 21
# A shingle of so few classes gives its pairs of holders itself.
RARE = 4
# Buckets of more classes than this get the bound from shingles of their own; the result does not depend on it.
LARGE_BUCKET = 64


def band_count(percent: int) -> int:
    """The fewest bands with which sets of this similarity share none with a probability of at most ``MISSED``."""
    agree = (percent / 100) ** ROWS
    return math.ceil(math.log(MISSED) / math.log1p(-agree)) if agree < 1 else 1


BANDS = band_count(85)


def shifted_permutation(n_bands: int = BANDS) -> np.ndarray:
    """The second permutation, continued around the circle by as many places as there are shifts."""
    once = np.random.default_rng(20).permutation(1 << PLACES_BITS).astype(np.uint32)
    return np.concatenate([once, once[: n_bands * ROWS]])


def band_keys(sets: list[np.ndarray], permutation: np.ndarray) -> np.ndarray:
    """One row of 64-bit band keys for each set, none of them empty; the permutation has a shift for each coordinate."""
    shifts = len(permutation) - (1 << PLACES_BITS)
    terms = mixed(np.arange(100, 100 + shifts // ROWS, dtype=np.uint64))
    places = ((np.concatenate(sets) * SCATTER) >> np.uint64(64 - PLACES_BITS)).astype(np.intp)
    starts = np.cumsum([0, *map(len, sets)])[:-1]
    signature = np.empty((shifts, len(sets)), dtype=np.uint64)
    for shift in range(shifts):
        signature[shift] = np.minimum.reduceat(permutation[shift:].take(places), starts)
    bands = signature.T.reshape(len(sets), -1, ROWS)
    return mixed((bands * ROW_FACTORS).sum(axis=2, dtype=np.uint64) + terms).view(np.int64)


def signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def profile(text: Column, n_bands: int) -> Column:
    """struct<n, high, low, bands>: shingles, a 128-bit digest of their set, and band keys (none for an empty set)."""

    @F.arrow_udf("struct<n: long, high: long, low: long, bands: array<long>>")
    def run(texts: pa.Array) -> pa.Array:
        shingler, permutation = Shingler(), shifted_permutation(n_bands)
        n, high, low, bands = [], [], [], []
        block, waiting = [], 0

        def flush():
            keys = iter(band_keys(block, permutation)) if block else iter(())
            bands.extend(next(keys) if size else np.zeros(0, np.int64) for size in n[len(bands) :])
            block.clear()

        for text in texts:
            found = shingler.hashes(text.as_py())
            digest = xxhash.xxh3_128_intdigest(found.tobytes())
            n.append(len(found))
            high.append(signed(digest >> 64))
            low.append(signed(digest & (2**64 - 1)))
            if len(found):
                block.append(found)
                waiting += len(found)
            if waiting >= BLOCK_SHINGLES:
                flush()
                waiting = 0
        flush()
        kinds = {"n": pa.int64(), "high": pa.int64(), "low": pa.int64(), "bands": pa.list_(pa.int64())}
        return structs({"n": n, "high": high, "low": low, "bands": bands}, kinds)

    return run.asNondeterministic()(text)


def rare_shingles(texts: DataFrame) -> DataFrame:
    """row, shingle and n of every shingle that at most ``RARE`` of these texts (row, text) hold: one row for each holder.

    Each task counts the holders of its shingles before they are dealt out: one with more holders than that travels once.
    """

    def holders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        rows, sets, size = [], [], 0

        def counted() -> pa.RecordBatch:
            owner = np.repeat(np.array(rows, dtype=np.int64), list(map(len, sets)))
            flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            found, first, place, n = np.unique(flat, return_index=True, return_inverse=True, return_counts=True)
            few = n[place] <= RARE
            many = n > RARE
            columns = [
                pa.array(np.concatenate([owner[few], owner[first[many]]])),
                pa.array(np.concatenate([flat[few], found[many]]).view(np.int64)),
                pa.array(np.concatenate([np.ones(few.sum(), np.int64), n[many]])),
            ]
            rows.clear()
            sets.clear()
            return pa.RecordBatch.from_arrays(columns, names=["row", "shingle", "n"])

        for batch in batches:
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows.append(row)
                sets.append(shingler.hashes(text.as_py()))
                size += len(sets[-1])
                if size >= COUNTED_SHINGLES:
                    yield counted()
                    size = 0
        yield counted()

    held = stored(texts.mapInArrow(holders, "row long, shingle long, n long"), "near-holders")
    few = held.groupBy("shingle").agg(F.sum("n").alias("n")).filter(F.col("n") <= RARE)
    return stored(held.select("row", "shingle").join(few, "shingle"), "near-rare")


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets overlap by at least ``percent`` of their union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        last, left = None, None
        for batch in batches:
            a, b, found = batch.column(0).to_pylist(), batch.column(1).to_pylist(), []
            for i, (first, second) in enumerate(zip(batch.column(2), batch.column(3))):
                if a[i] != last:
                    last, left = a[i], shingler.hashes(first.as_py())
                right = shingler.hashes(second.as_py())
                both = common(left, right)
                if 100 * both >= percent * (len(left) + len(right) - both):
                    found.append(i)
            yield pa.RecordBatch.from_arrays(
                [pa.array([a[i] for i in found], pa.int64()), pa.array([b[i] for i in found], pa.int64())],
                names=["a", "b"],
            )

    first = texts.select(F.col("row").alias("a"), F.col("text").alias("first"))
    second = texts.select(F.col("row").alias("b"), F.col("text").alias("second"))
    both = pairs.join(second, "b").join(first, "a").select("a", "b", "first", "second")
    return stored(both.mapInArrow(run, "a long, b long"), "near-links")


def possible(small: Column, large: Column, left: Column, right: Column, percent: int) -> Column:
    """Whether sets of these sizes, of which so many shingles at most can be shared, may overlap enough."""
    shared = F.least(left, right)
    return (100 * F.least(small, large) >= percent * F.greatest(small, large)) & (
        100 * shared >= percent * (small + large - shared)
    )


def class_labels(rows: DataFrame, percent: int) -> DataFrame:
    """node and label of every class that is linked with another; ``rows``: row, n, bands and text, one per class."""
    keyed = rows.filter("n > 0").select("row", "n", F.posexplode("bands").alias("band", "key"))
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    mates = stored(keyed.join(sizes, "key"), "near-buckets")
    texts = stored(
        rows.select("row", "text").join(mates.select("row").distinct(), "row", "left_semi"), "near-texts"
    )
    large = mates.filter(F.col("m") > LARGE_BUCKET).select("row").distinct()
    rare = rare_shingles(texts.join(large, "row", "left_semi"))
    own = rare.groupBy("row").agg(F.count(F.lit(1)).alias("own"))
    mates = stored(
        mates.join(own, "row", "left").select(
            "key",
            "band",
            "row",
            "n",
            F.when(F.col("m") > LARGE_BUCKET, F.coalesce("own", F.lit(0))).otherwise(0).alias("own"),
        ),
        "near-mates",
    )
    best = F.struct("own", F.xxhash64("row", "key").alias("draw"), "row", "n")
    centers = stored(mates.groupBy("key").agg(F.min(best).alias("c")).select("key", "c.row", "c.n"), "near-centers")
    c = centers.select("key", F.col("row").alias("a"), F.col("n").alias("n_a"))
    stars = mates.join(c, "key").filter(
        (F.col("row") != F.col("a")) & possible(F.col("n_a"), F.col("n"), F.col("n_a"), F.col("n"), percent)
    )
    links = confirmed(stars.select("a", F.col("row").alias("b")).distinct(), texts, percent)
    labels = components(links)
    pairs = remaining(mates, rows.select("row", "bands"), centers, labels, percent)
    more = confirmed(pairs.unionByName(rare_pairs(rare, labels)).distinct(), texts, percent)
    return components(links.unionByName(more))


def rare_pairs(rare: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs of holders of a rare shingle that are not in one component yet; a shingle has at most RARE holders."""
    shared = rare.filter("n > 1").select("shingle", "row")
    known = shared.join(labels.select(F.col("node").alias("row"), "label"), "row", "left")
    known = known.withColumn("label", F.coalesce("label", "row"))
    left = known.select("shingle", F.col("row").alias("a"), F.col("label").alias("label_a"))
    pairs = left.join(known, "shingle").filter((F.col("a") < F.col("row")) & (F.col("label_a") != F.col("label")))
    return pairs.select("a", F.col("row").alias("b")).distinct()


def remaining(mates: DataFrame, keys: DataFrame, centers: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Bucket mates of different components that no bound excludes and that were not compared as centre and mate.

    ``keys``: row and all its band keys. A pair comes from the first bucket that both are in, so once.
    """
    known = mates.join(labels.select(F.col("node").alias("row"), "label"), "row", "left")
    known = known.withColumn("label", F.coalesce("label", "row"))
    parts = known.groupBy("key", "label").agg(F.count(F.lit(1)).alias("size"))
    main = (
        parts.groupBy("key")
        .agg(F.max(F.struct("size", "label")).alias("most"), F.count(F.lit(1)).alias("parts"))
        .filter("parts > 1")
        .select("key", F.col("most.label").alias("main"))
    )
    rest = known.join(main, "key").join(
        centers.select("key", F.col("row").alias("center")), "key"
    ).filter(F.col("row") != F.col("center"))
    held = stored(
        rest.join(keys, "row").select(
            "key", "band", "row", "n", (F.col("n") - F.col("own")).alias("open"), "label", "main", "bands"
        ),
        "near-rest",
    )
    # Alone against the best imaginable mate: a subset of it that holds all it can share.
    held = held.filter(100 * F.col("open") >= percent * F.col("n"))
    names = {"row": "a", "n": "n_a", "open": "open_a", "label": "label_a", "bands": "bands_a"}
    left = held.filter("label <> main").select("key", *(F.col(k).alias(v) for k, v in names.items()))
    earlier = F.zip_with(
        F.slice("bands_a", 1, F.col("band")), F.slice("bands", F.lit(1), F.col("band")), lambda x, y: x == y
    )
    pairs = left.join(held, "key").filter(
        (F.col("label") != F.col("label_a"))
        & ((F.col("label") == F.col("main")) | (F.col("a") < F.col("row")))
        & possible(F.col("n_a"), F.col("n"), F.col("open_a"), F.col("open"), percent)
        & ~F.exists(earlier, lambda same: same)
    )
    return pairs.select(F.least("a", "row").alias("a"), F.greatest("a", "row").alias("b")).distinct()


def profiled(docs: DataFrame, text: str, percent: int) -> DataFrame:
    """The rows of ``docs`` stored as one struct, with a number and the profile of their text."""
    found = docs.select(nested(docs), profile(utf8(text), band_count(percent)).alias("p"))
    found = found.withColumn("row", F.monotonically_increasing_id())
    names = ("n", "high", "low", "bands")
    return stored(found.select("doc", "row", *(F.col(f"p.{n}").alias(n) for n in names)), "near-rows")


def grouped(rows: DataFrame, doc_id: str, text: str, percent: int) -> DataFrame:
    """row, doc_id, n_shingles, component_id and first of every profiled row."""
    own = F.col(f"doc.`{doc_id}`").alias("doc_id")
    rows = rows.select("row", own, "n", "high", "low", "bands", utf8(f"doc.`{text}`").alias("text"))
    filled = rows.filter("n > 0")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    classes = stored(
        filled.groupBy("high", "low").agg(F.min("row").alias("node"), F.min(order).alias("least")), "near-classes"
    )
    heads = filled.join(classes.select(F.col("node").alias("row")), "row", "left_semi")
    labels = stored(class_labels(heads.select("row", "n", "bands", "text"), percent), "near-labels")
    named = classes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = named.groupBy("label").agg(F.min("least").alias("least"))
    members = named.drop("least").join(least, "label").select("high", "low", "least")
    together = filled.join(members, ["high", "low"]).select(
        "row",
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.col("least.doc_id").alias("component_id"),
        (F.col("row") == F.col("least.row")).alias("first"),
    )
    alone = rows.filter("n = 0").select(
        "row", "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(True).alias("first")
    )
    return together.unionByName(alone)


def near_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = 85) -> DataFrame:
    """row, doc_id, n_shingles, component_id and first (one row of each component) of every row.

    A null or empty text, or one without words, has no shingles and is linked with nothing: its component is itself. Equal
    sets are linked. Null ids come last in a component's order and repeated ids are rows like any other; of equal ids the
    row read first is ``first``. Other columns are not read. No rows give no rows.
    """
    return grouped(profiled(docs.select(doc_id, text), text, percent), doc_id, text, percent)


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = 85) -> DataFrame:
    """One row of each near-duplicate group, with all its columns, whatever their names: the one of the smallest id.

    Null and empty texts and those without words are groups of their own and stay. Null ids come last, and of equal ids the row read
    first stays, so of repeated rows one does. No rows give no rows.
    """
    rows = profiled(docs, text, percent)
    first = grouped(rows, doc_id, text, percent).filter("first").select("row")
    return rows.join(first, "row", "left_semi").select("doc.*")


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_groups(table(spark, sf_dir, "documents"), percent=85)
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    return groups.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
    lambda x: x <> '') AS words
  FROM documents
), sets AS (
  SELECT doc_id, CASE
    WHEN len(words) >= 5 THEN list_distinct(list_transform(range(1, len(words) - 3),
      lambda i: array_to_string(list_slice(words, i, i + 4), ' ')))
    WHEN len(words) > 0 THEN [array_to_string(words, ' ')]
    ELSE [] END AS shingles
  FROM w
), sizes AS (
  SELECT doc_id, len(shingles) AS n FROM sets
), flat AS (
  SELECT doc_id, unnest(shingles) AS shingle FROM sets
), overlap AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM flat a JOIN flat b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT o.a, o.b FROM overlap o JOIN sizes x ON x.doc_id = o.a JOIN sizes y ON y.doc_id = o.b
  WHERE 100 * o.c >= 85 * (x.n + y.n - o.c)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM sizes
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), least AS (
  SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sizes JOIN least USING (doc_id)
"""
