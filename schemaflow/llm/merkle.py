"""Merkle dataset manifest: an append log in postorder, written by aligned builders, and proofs read from it by position.

The rows of a key, in order, are the leaves of a binary tree; a last node without a partner is hashed alone. Builders take
aligned runs of ``2 ** HEIGHT`` leaves and write their nodes as these complete: each leaf, then every parent that it closes.
The roots of the runs are the leaves of the next level of the log, until one run is left. Within a run a node of
height h whose last leaf is k stands at 2k - popcount(k) + h: in front of leaf k lie k leaves and, since every left subtree of
height h holds 2 ** (h + 1) - 1 nodes, k - popcount(k) complete parents. A proof finds all siblings by that formula, so
nothing searches the log and no builder sees more than one run.
"""

from __future__ import annotations

import functools
import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from schemaflow.llm.common import stored, table

HEIGHT = 12
DIGEST = 32
ROOT_KEY = "root"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
LOG = "key string, block long, height int, count int, nodes binary, subroot binary"
PATH = "sides string, siblings string, subroot string"


def part(value: Column) -> Column:
    """A value as the input of a digest: its bytes behind their number, null as a dash."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    """Lowercase hex sha256 of the values in order."""
    return F.sha2(F.concat(*(part(v) for v in values)), 256)


def digest(data: str) -> str:
    return hashlib.sha256(data.encode()).hexdigest()


def top_height(count: int) -> int:
    """Levels above the leaves of a tree of so many."""
    return max(0, count - 1).bit_length()


def postorder(leaves: list[str], top: int) -> list[str]:
    """Digests of the nodes over a run of leaves in the order in which they complete, up to height ``top``."""
    log: list[str] = []
    waiting: list[tuple[int, str]] = []

    def close(height: int, node: str) -> None:
        log.append(node)
        waiting.append((height, node))

    for leaf in leaves:
        close(0, leaf)
        while len(waiting) > 1 and waiting[-1][0] == waiting[-2][0]:
            height, right = waiting.pop()
            close(height + 1, digest(waiting.pop()[1] + right))
    while waiting and waiting[-1][0] < top:
        height, last = waiting.pop()
        left = waiting.pop()[1] if waiting and waiting[-1][0] == height else ""
        close(height + 1, digest(left + last))
    return log


def positions(last_leaf: np.ndarray, height: int) -> np.ndarray:
    """Where nodes of a height stand in the log of their run, by their last leaf."""
    return 2 * last_leaf - np.bitwise_count(last_leaf.astype(np.uint64)).astype(np.int64) + height


def siblings(leaves: np.ndarray, count: int, top: int) -> tuple[np.ndarray, np.ndarray]:
    """For each leaf and height below ``top``: the sibling's position, and its side: L, R or N for none."""
    at = np.zeros((len(leaves), top), dtype=np.int64)
    sides = np.full((len(leaves), top), ord("N"), dtype=np.uint8)
    for height in range(top):
        other = (leaves >> height) ^ 1
        there = (other << height) < count
        last = np.minimum((other + 1) << height, count) - 1
        at[:, height] = np.where(there, positions(np.where(there, last, 0), height), -1)
        sides[:, height] = np.where(there, np.where(other & 1, ord("R"), ord("L")), ord("N"))
    return at, sides


def folded(leaf: str, sibling: str, sides: str) -> str:
    """The root that a leaf and its siblings, from the lowest to the highest, give."""
    at = 0
    for side in sides:
        other = sibling[at : at + 2 * DIGEST] if side != "N" else ""
        at += len(other)
        leaf = digest(other + leaf if side == "L" else leaf + other)
    return leaf


def fold(leaf: Column, sibling: Column, sides: Column) -> Column:
    """Root by :func:`folded` of every row; null where any part is null."""

    @F.arrow_udf("string")
    def run(leaf: pa.Array, sibling: pa.Array, sides: pa.Array) -> pa.Array:
        rows = zip(leaf.to_pylist(), sibling.to_pylist(), sides.to_pylist())
        return pa.array([None if None in row else folded(*row) for row in rows], pa.string())

    return run(leaf, sibling, sides)


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with their number ``at`` within their ``key``, from 0, in the order of the named columns.

    A range partitioning sorts everything; the numbers of a partition start at the count of the key's rows in earlier ones.
    """
    ranged = rows.repartitionByRange("key", *order).sortWithinPartitions("key", *order)
    ranged = stored(ranged.withColumn("row_at", F.monotonically_increasing_id()), "merkle-sorted")
    ranged = ranged.withColumn("slice", F.shiftright("row_at", 33))
    counts = ranged.groupBy("key", "slice").agg(F.min("row_at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("key", "slice", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    numbered = ranged.join(starts, ["key", "slice"])
    return numbered.select(*rows.columns, (F.col("start") + F.col("row_at") - F.col("first")).alias("at"))


def builder(height: int):
    def build(run: pa.Table) -> pa.Table:
        """One aligned run of leaves as a segment of the log."""
        run = run.sort_by("at")
        block, count = run.column("at")[0].as_py() >> height, run.num_rows
        # Only the first run can be the whole key; a later or a full one goes up to where runs meet.
        top = height if block else top_height(count)
        nodes = postorder([d.hex() for d in run.column("digest").to_pylist()], top)
        return pa.table(
            {
                "key": run.column("key").slice(0, 1),
                "block": pa.array([block]),
                "height": pa.array([top], pa.int32()),
                "count": pa.array([count], pa.int32()),
                "nodes": pa.array([bytes.fromhex("".join(nodes))]),
                "subroot": pa.array([bytes.fromhex(nodes[-1])]),
            }
        )

    return build


def prover(height: int):
    def prove(leaves: pa.Table, segment: pa.Table) -> pa.Table:
        """The leaves of a run with the siblings inside the run, and then those above it; none without a segment."""
        leaves = leaves.slice(0, leaves.num_rows if segment.num_rows else 0).drop_columns("run")
        sides, paths, root = [], [], None
        if leaves.num_rows:
            own = segment.to_pylist()[0]
            root, width = own["root"], 2 * DIGEST
            at, marks = siblings(leaves.column("at").to_numpy() & ((1 << height) - 1), own["count"], own["height"])
            nodes = own["nodes"].hex()
            for places, side in zip(at.tolist(), marks):
                inside = [nodes[p * width : (p + 1) * width] for p in places if p >= 0]
                paths.append("".join(inside) + own["above_siblings"])
                sides.append(side.tobytes().decode() + own["above_sides"])
        for name, column in (("sides", sides), ("siblings", paths), ("subroot", [root] * leaves.num_rows)):
            leaves = leaves.append_column(name, pa.array(column, pa.string()))
        return leaves

    return prove


@dataclass
class Manifest:
    """The log: one table of segments for each level, lowest first, and the root of every key.

    ``levels``: key, block (number of the run), height, count (leaves of the run), nodes (digests of 32 bytes in postorder)
    and subroot (the last of them). ``roots``: key, digest, level (where the key's last run lies).
    """

    levels: list[DataFrame]
    roots: DataFrame
    height: int


def append_log(leaves: DataFrame, height: int = HEIGHT) -> Manifest:
    """The log over rows of key, at (from 0 without gaps in each key) and digest (binary); other columns are not read.

    A level is one shuffle of digests into runs of equal size, so a key with most of the rows is spread over all tasks; the
    next level has 2 ** height times fewer rows. No rows give no segments and no roots.
    """
    levels, roots = [], []
    rows = leaves.select("key", "at", "digest")
    while True:
        runs = rows.groupBy("key", F.shiftright("at", height).alias("run"))
        segments = stored(runs.applyInArrow(builder(height), LOG), "merkle-log")
        ends = segments.groupBy("key").agg(F.count(F.lit(1)).alias("runs"), F.max("subroot").alias("digest"))
        roots.append(ends.filter("runs = 1").select("key", "digest", F.lit(len(levels)).alias("level")))
        levels.append(segments)
        more = ends.filter("runs > 1").select("key")
        rest = segments.select("key", F.col("block").alias("at"), F.col("subroot").alias("digest"))
        rows = rest.join(more, "key", "left_semi")
        if rows.isEmpty():
            return Manifest(levels, functools.reduce(DataFrame.unionByName, roots), height)


def proofs(manifest: Manifest, leaves: DataFrame, above: DataFrame | None = None) -> DataFrame:
    """``leaves`` (with key and at) and, for each row, sides, siblings and subroot; columns of these names must not be there.

    ``siblings``: the hex digests of the siblings from the lowest height to the highest, concatenated; ``sides``: L, R or N
    (no sibling) of each height; ``subroot``: the root of the key. ``above``, if given: key, above_sides, above_siblings that
    continue the paths of a key beyond its root. Paths run down the levels of the log; each step brings one run's
    segment to the rows of that run. No rows give no rows.
    """
    roots = manifest.roots.select("key", "level", F.lower(F.hex("digest")).alias("root"))
    if above is None:
        roots = roots.withColumns({"above_sides": F.lit(""), "above_siblings": F.lit("")})
    else:
        roots = roots.join(above.select("key", "above_sides", "above_siblings"), "key")
    names = ("key", "block", "root", "above_sides", "above_siblings")
    lower = None
    for level in reversed(range(len(manifest.levels))):
        paths = roots.filter(F.col("level") == level).withColumn("block", F.lit(0).cast("long")).select(*names)
        segments = manifest.levels[level].join(paths if lower is None else paths.unionByName(lower), ["key", "block"])
        rows = manifest.levels[level - 1].select("key", F.col("block").alias("at")) if level else leaves
        rows = rows.withColumn("run", F.shiftright("at", manifest.height))
        schema = ", ".join([*(f"`{n}` {t}" for n, t in rows.drop("run").dtypes), PATH])
        found = (
            rows.groupBy("key", "run")
            .cogroup(segments.drop("subroot").groupBy("key", "block"))
            .applyInArrow(prover(manifest.height), schema)
        )
        if level:
            renamed = {"at": "block", "subroot": "root", "sides": "above_sides", "siblings": "above_siblings"}
            lower = stored(found.withColumnsRenamed(renamed).select(*names), "merkle-paths")
    return found


def ordered_key(column: Column) -> Column:
    """A text that is never null and sorts like the column, null first."""
    return F.coalesce(F.concat(F.lit("1"), column.cast("string")), F.lit("0"))


def document_leaves(docs: DataFrame) -> DataFrame:
    """key, doc_id, digest (binary) and tampered (hex) of every row; the latter, where 7 divides crc32(doc_id), with n_chars + 1.

    Null fields enter as null, also the id: its crc32 is that of the empty text. A greatest long plus 1 counts as null.
    """
    own = leaf_digest(*(F.col(name) for name in FIELDS))
    more = leaf_digest(*(F.try_add("n_chars", F.lit(1)) if name == "n_chars" else F.col(name) for name in FIELDS))
    crc = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    return docs.select(
        ordered_key(F.col("lang")).alias("key"),
        "doc_id",
        F.unhex(own).alias("digest"),
        F.when(crc % 7 == 0, more).alias("tampered"),
        F.monotonically_increasing_id().alias("tie"),
    )


@dataclass
class Dataset:
    """``leaves``: key, doc_id, digest, tampered, at; ``log`` over the languages' rows; ``tops``: part (language), digest, at
    and the ``top_log`` over them; its one root is the root of all rows."""

    leaves: DataFrame
    log: Manifest
    tops: DataFrame
    top_log: Manifest


def dataset_manifest(docs: DataFrame, height: int = HEIGHT) -> Dataset:
    """The manifest of a table with the columns of ``documents``.

    Rows of a language ascend by id, null ids first, equal ids by digest; equal rows are leaves of their own. A null language
    is a language, before all others. Other columns are not read. No rows give empty tables and no root.
    """
    rows = stored(document_leaves(docs), "merkle-leaves")
    leaves = stored(placed(rows, ["doc_id", "digest", "tie"]).drop("tie"), "merkle-placed")
    log = append_log(leaves, height)
    parts = log.roots.select(F.lit(ROOT_KEY).alias("key"), F.col("key").alias("part"), "digest")
    tops = stored(placed(parts, ["part"]), "merkle-subroots")
    return Dataset(leaves, log, tops, append_log(tops, height))


def dataset_proofs(dataset: Dataset) -> DataFrame:
    """The leaves with sides, siblings (up to the root of all), subroot and root."""
    upper = proofs(dataset.top_log, dataset.tops.select("key", "at", "part"))
    upper = upper.select(
        F.col("part").alias("key"),
        F.col("sides").alias("above_sides"),
        F.col("siblings").alias("above_siblings"),
    )
    root = dataset.top_log.roots.select(F.lower(F.hex("digest")).alias("root"))
    return proofs(dataset.log, dataset.leaves, upper).join(F.broadcast(root))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dataset_proofs(dataset_manifest(table(spark, sf_dir, "documents")))
    leaf = F.lower(F.hex("digest"))
    shown = found.select(
        "doc_id",
        leaf.alias("leaf"),
        "subroot",
        "root",
        F.sha2("siblings", 256).alias("proof_sha256"),
        fold(F.coalesce("tampered", leaf), F.col("siblings"), F.col("sides")).alias("folded_root"),
        F.length("sides").alias("n_heights"),
    )
    return shown.withColumn("verified", F.col("folded_root") == F.col("root"))


# crc32 has no function in this SQL: the bits of the id, lowest first, are folded one by one.
ORACLE = """
WITH RECURSIVE doc AS (
  SELECT row_number() OVER () AS r, doc_id, lang, n_chars,
         CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id END ||
         CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END ||
         CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END AS front,
         CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END AS back,
         list_reduce(
           list_prepend(4294967295::BIGINT, flatten(list_transform(
             string_split(coalesce(CAST(doc_id AS VARCHAR), ''), ''),
             lambda c: list_transform(range(8), lambda b: (ord(c) >> b) & 1)))),
           lambda a, b: xor(a >> 1, CASE WHEN (xor(a, b) & 1) = 1 THEN 3988292384 ELSE 0 END)) AS crc
  FROM documents
), leaf AS (
  SELECT r, doc_id, lang,
         sha256(front || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars END || back) AS d,
         sha256(front || CASE WHEN n_chars IS NULL THEN '-'
                ELSE strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1) END || back) AS d1,
         xor(crc, 4294967295) % 7 = 0 AS tampered
  FROM doc
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, d) - 1 AS pos,
         dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS part, count(*) OVER (PARTITION BY lang) AS n
  FROM leaf
), node AS (
  SELECT part, 0 AS h, pos AS i, d, n FROM numbered
  UNION ALL
  SELECT part, h + 1, i // 2, sha256(string_agg(d, '' ORDER BY i)), (n + 1) // 2 FROM node WHERE n > 1 GROUP BY part, h, i // 2, n
), top AS (
  SELECT 0 AS h, part AS i, d, (SELECT count(DISTINCT part) FROM numbered) AS n FROM node WHERE n = 1
  UNION ALL
  SELECT h + 1, i // 2, sha256(string_agg(d, '' ORDER BY i)), (n + 1) // 2 FROM top WHERE n > 1 GROUP BY h, i // 2, n
), path AS (
  SELECT x.r, g.h AS h, g.i AS i, b.d AS sibling
  FROM numbered x JOIN node g ON g.n > 1 AND g.part = x.part AND g.i = x.pos >> g.h
  LEFT JOIN node b ON b.part = g.part AND b.h = g.h AND b.i = xor(g.i, 1)
  UNION ALL
  SELECT x.r, 1000 + g.h, g.i, b.d
  FROM numbered x JOIN top g ON g.n > 1 AND g.i = x.part >> g.h
  LEFT JOIN top b ON b.h = g.h AND b.i = xor(g.i, 1)
), proof AS (
  SELECT r, list({'i': i, 's': sibling} ORDER BY h) AS steps, coalesce(string_agg(sibling, '' ORDER BY h), '') AS siblings
  FROM path GROUP BY r
), fold AS (
  SELECT x.r, 1 AS k, CASE WHEN x.tampered THEN x.d1 ELSE x.d END AS d, p.steps
  FROM numbered x LEFT JOIN proof p USING (r)
  UNION ALL
  SELECT r, k + 1, sha256(CASE WHEN steps[k].i % 2 = 1 THEN steps[k].s || d ELSE d || coalesce(steps[k].s, '') END), steps
  FROM fold WHERE k <= len(steps)
)
SELECT x.doc_id, x.d AS leaf, sub.d AS subroot, top.d AS root, sha256(coalesce(p.siblings, '')) AS proof_sha256,
       f.d AS folded_root, CAST(coalesce(len(p.steps), 0) AS INTEGER) AS n_heights, f.d = top.d AS verified
FROM numbered x
LEFT JOIN proof p USING (r)
JOIN node sub ON sub.part = x.part AND sub.n = 1
JOIN top ON top.n = 1
JOIN fold f ON f.r = x.r AND f.k = coalesce(len(p.steps), 0) + 1
"""
