"""Approximate nearest neighbours by inner product: vantage-point trees per shard, pruning relaxed by a factor.

Vectors divided by the greatest length M, with one more coordinate sqrt(1 - |x|^2), lie on the unit sphere, queries of unit
length get a zero there: the greatest inner product is then the least Euclidean distance, a metric. A small vantage-point
tree over a bounded sample routes every vector to a cell; cells of many vectors are dealt over several shards, and each
shard holds a vantage-point tree of its own vectors. A query first searches the shards of its own cell. With the distance
of the k-th hit found there it walks the small tree again and is sent only to cells that may hold a nearer vector.

Pruning skips a subtree if the triangle inequality puts all of it at least ``factor`` times the k-th distance away. Factor
one skips only what cannot be among the results; a smaller one skips more and may lose some. How much it loses depends on the
vectors, so the factor is measured: a bounded sample of the queries is searched with all FACTORS at once, and the smallest
one whose results hold the wanted share of those of factor one serves for the rest.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from schemaflow.llm.common import stored, table

SAMPLE_ROWS = 4096
CELLS = 256
SHARD_ROWS = 32768
QUERY_ROWS = 4096
LEAF_ROWS = 256
FACTORS = (0.05, 0.08, 0.1, 0.12, 0.15, 0.18, 0.22, 0.27, 0.35, 0.5, 1.0)
TUNING_QUERIES = 256
RECALL = 0.96
LEAST_SHARE = 1 / 16
PAIRS = 100_000
# Distances come from inner products, whose rounding errors grow under the square root.
SLACK = 1e-6
INDEX = "cell int, shard int, tree binary"
HITS = "query long, query_id long, vec_id long, score double"
HIT_TYPES = pa.schema(
    [("query", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]
)


def matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Rows of doubles, each filled with zeros up to ``width``."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    sizes = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(vectors), width))
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def on_sphere(x: np.ndarray, longest: float) -> np.ndarray:
    x = x / longest
    return np.column_stack([x, np.sqrt(np.maximum(0.0, 1.0 - (x**2).sum(axis=1)))])


def as_queries(q: np.ndarray) -> np.ndarray:
    most = np.abs(q).max(axis=1, keepdims=True)
    q = q / most
    q = q / np.sqrt((q**2).sum(axis=1, keepdims=True))
    return np.column_stack([q, np.zeros(len(q))])


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Between points of the unit sphere."""
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (a @ b.T)))


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of paired rows in double precision, summed from the first coordinate on whatever the block."""
    products = np.ascontiguousarray((a * b).T)
    total = np.zeros(len(a))
    for row in products:
        total += row
    return total


@dataclass
class Tree:
    """Inner nodes with a vantage point, the split radius and two children (a leaf as ``~number``); leaves as row ranges."""

    points: np.ndarray
    radii: np.ndarray
    children: np.ndarray
    starts: np.ndarray

    @property
    def root(self) -> int:
        return 0 if len(self.radii) else ~0


def vantage(points: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Of a few of the points the one from which the distances to a sample differ most."""
    tried = points[rng.choice(len(points), min(8, len(points)), replace=False)]
    seen = points[rng.choice(len(points), min(256, len(points)), replace=False)]
    return tried[np.argmax(distances(tried, seen).std(axis=1))]


def grow(points: np.ndarray, leaf_rows: int, most_leaves: int | None = None) -> tuple[Tree, np.ndarray]:
    """A tree over the points and their order by leaf.

    Splits go at the median distance; points at that distance stay inside. A set that would lose less than LEAST_SHARE, as
    where nearly all distances are equal, is a leaf whatever its size. The largest leaves are split first.
    """
    rng = np.random.default_rng(len(points))
    nodes: list[tuple[np.ndarray, float]] = []
    children: list[list[int]] = []
    leaves: list[np.ndarray] = [np.arange(len(points))]
    links: list[tuple[int, int] | None] = [None]
    whole: set[int] = set()
    while most_leaves is None or len(leaves) < most_leaves:
        at = max((i for i in range(len(leaves)) if i not in whole), key=lambda i: len(leaves[i]), default=None)
        if at is None or len(leaves[at]) <= leaf_rows:
            break
        rows = leaves[at]
        point = vantage(points[rows], rng)
        far = distances(points[rows], point[None])[:, 0]
        radius = float(np.median(far))
        inside = far <= radius
        if inside.all():
            inside = far < radius
            radius = float(far[inside].max()) if inside.any() else radius
        if min(inside.sum(), (~inside).sum()) < LEAST_SHARE * len(rows):
            whole.add(at)
            continue
        node, link = len(nodes), links[at]
        nodes.append((point, radius))
        children.append([~at, ~len(leaves)])
        if link:
            children[link[0]][link[1]] = node
        links[at] = (node, 0)
        links.append((node, 1))
        leaves[at] = rows[inside]
        leaves.append(rows[~inside])
    width = points.shape[1]
    tree = Tree(
        np.array([p for p, _ in nodes]).reshape(-1, width),
        np.array([r for _, r in nodes]),
        np.array(children, dtype=np.int64).reshape(-1, 2),
        np.concatenate([[0], np.cumsum([len(x) for x in leaves])]),
    )
    return tree, np.concatenate(leaves)


def route(tree: Tree, points: np.ndarray) -> np.ndarray:
    """The leaf of every point."""
    out = np.zeros(len(points), dtype=np.int64)
    work = [(tree.root, np.arange(len(points)))]
    while work:
        node, rows = work.pop()
        if node < 0:
            out[rows] = ~node
        elif len(rows):
            inside = distances(points[rows], tree.points[node][None])[:, 0] <= tree.radii[node]
            work += [(tree.children[node, 0], rows[inside]), (tree.children[node, 1], rows[~inside])]
    return out


def reachable(tree: Tree, queries: np.ndarray, kth: np.ndarray, factor: np.ndarray) -> list[list[int]]:
    """For each query the leaves that pruning by its k-th distance leaves."""
    out: list[list[int]] = [[] for _ in queries]
    work = [(tree.root, np.arange(len(queries)))]
    while work:
        node, rows = work.pop()
        if node < 0:
            for row in rows:
                out[row].append(~node)
        elif len(rows):
            beyond = distances(queries[rows], tree.points[node][None])[:, 0] - tree.radii[node]
            most = factor[rows] * kth[rows] + SLACK
            work += [(tree.children[node, 0], rows[beyond < most]), (tree.children[node, 1], rows[-beyond < most])]
    return out


class Shard:
    """Distinct vectors of a shard in a tree, each with the smallest ids that hold it."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, vectors: np.ndarray, longest: float, k: int):
        order = np.lexsort((rows, ids))
        ids, rows, vectors = ids[order], rows[order], vectors[order] + 0.0
        # A query skips one row at most, so of equal vectors the k + 1 of the smallest ids are all that can be returned.
        _, first, same = np.unique(vectors, axis=0, return_index=True, return_inverse=True)
        same = same.ravel()
        by = np.argsort(same, kind="stable")
        within = np.arange(len(by)) - np.searchsorted(same[by], same[by])
        by = by[within <= k]
        self.tree, leaf_order = grow(on_sphere(vectors[first], longest), LEAF_ROWS)
        place = np.empty(len(first), dtype=np.int64)
        place[leaf_order] = np.arange(len(first))
        by = by[np.argsort(place[same[by]], kind="stable")]
        self.vectors = vectors[first][leaf_order]
        self.points = on_sphere(self.vectors, longest)
        self.ids, self.rows = ids[by], rows[by]
        self.from_ = np.searchsorted(place[same[by]], np.arange(len(first) + 1))

    PARTS = ("vectors", "points", "ids", "rows", "from_")

    def packed(self) -> bytes:
        parts = [getattr(self, n) for n in self.PARTS]
        parts += [self.tree.points, self.tree.radii, self.tree.children, self.tree.starts]
        columns = [pa.array([p.tobytes() for p in parts], pa.binary()), pa.array([p.dtype.str for p in parts])]
        columns.append(pa.array([list(p.shape) for p in parts], pa.list_(pa.int64())))
        batch = pa.RecordBatch.from_arrays(columns, names=["data", "kind", "shape"])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema) as out:
            out.write_batch(batch)
        return sink.getvalue().to_pybytes()

    @classmethod
    def unpacked(cls, data: bytes) -> Shard:
        self = cls.__new__(cls)
        parts = [
            np.frombuffer(r["data"], r["kind"]).reshape(r["shape"])
            for r in pa.ipc.open_stream(data).read_all().to_pylist()
        ]
        for name, part in zip(cls.PARTS, parts):
            setattr(self, name, part)
        self.tree = Tree(*parts[len(cls.PARTS) :])
        return self


class Search:
    """The best k of each of a block of queries.

    ``rows``: of the vectors themselves, to be skipped; ``kth``: distances at which queries start, infinite for none; ``factor``:
    one for each query.
    """

    def __init__(self, names, ids, rows, vectors, kth, factor, longest: float, k: int):
        self.names, self.ids, self.rows, self.vectors = names, ids, rows, vectors
        self.points = as_queries(vectors) if len(vectors) else np.zeros((0, vectors.shape[1] + 1))
        self.norms = np.sqrt((vectors**2).sum(axis=1))
        self.kth, self.k, self.factor, self.longest = kth.copy(), k, factor, longest
        self.hits = {"q": np.zeros(0, np.int64), "id": np.zeros(0, np.int64), "score": np.zeros(0)}
        self.evaluated = 0

    def run(self, shard: Shard) -> None:
        if len(self.ids) and len(shard.ids):
            self.visit(shard, shard.tree.root, np.arange(len(self.ids)))

    def visit(self, shard: Shard, node: int, active: np.ndarray) -> None:
        """The nearer child first, the other if pruning leaves it."""
        if not len(active):
            return
        if node < 0:
            self.leaf(shard, ~node, active)
            return
        tree = shard.tree
        inside, outside = tree.children[node]
        beyond = distances(self.points[active], tree.points[node][None])[:, 0] - tree.radii[node]
        near = beyond <= 0
        self.visit(shard, inside, active[near])
        self.visit(shard, outside, self.left(active, -beyond, near | (beyond > 0)))
        self.visit(shard, inside, self.left(active, beyond, ~near))

    def left(self, active: np.ndarray, least: np.ndarray, among: np.ndarray) -> np.ndarray:
        """Those queries whose k-th distance, relaxed, still reaches a subtree at distance ``least`` or more."""
        return active[among & (least < self.factor[active] * self.kth[active] + SLACK)]

    def leaf(self, shard: Shard, leaf: int, active: np.ndarray) -> None:
        lo, hi = shard.tree.starts[leaf : leaf + 2]
        self.evaluated += len(active) * int(hi - lo)
        for at in range(lo, hi, LEAF_ROWS):
            self.offer(shard, at, min(at + LEAF_ROWS, hi), active)

    def offer(self, shard: Shard, lo: int, hi: int, active: np.ndarray) -> None:
        """Distinct vectors ``lo`` to ``hi``: those that may be among the best are scored, for all their ids."""
        far = distances(self.points[active], shard.points[lo:hi])
        most = self.kth[active]
        if hi - lo > self.k + 1:
            # One of them may be the query's own row.
            most = np.minimum(most, np.partition(far, self.k, axis=1)[:, self.k])
        q, c = np.nonzero(far <= most[:, None] + SLACK)
        if not len(q):
            return
        q, c = active[q], c + lo
        score = np.concatenate(
            [
                inner(self.vectors[q[i : i + PAIRS]], shard.vectors[c[i : i + PAIRS]])
                for i in range(0, len(q), PAIRS)
            ]
        )
        copies = shard.from_[c + 1] - shard.from_[c]
        at = np.repeat(shard.from_[c], copies) + np.arange(copies.sum()) - np.repeat(np.cumsum(copies) - copies, copies)
        q, score = np.repeat(q, copies), np.repeat(score, copies)
        other = shard.rows[at] != self.rows[q]
        self.merge(q[other], shard.ids[at[other]], score[other])

    def merge(self, q: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        """Best k of old and new hits of the queries that have new ones; their k-th distances follow."""
        touched = np.zeros(len(self.ids), dtype=bool)
        touched[q] = True
        old = touched[self.hits["q"]]
        q = np.concatenate([self.hits["q"][old], q])
        ids = np.concatenate([self.hits["id"][old], ids])
        score = np.concatenate([self.hits["score"][old], score])
        order = np.lexsort((ids, -score, q))
        q, ids, score = q[order], ids[order], score[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        keep = rank < self.k
        last = rank == self.k - 1
        cosine = score[last] / (self.norms[q[last]] * self.longest)
        self.kth[q[last]] = np.fmin(self.kth[q[last]], np.sqrt(np.maximum(0.0, 2.0 - 2.0 * cosine)))
        for name, new in (("q", q), ("id", ids), ("score", score)):
            self.hits[name] = np.concatenate([self.hits[name][~old], new[keep]])

    def found(self) -> pa.Table:
        q = self.hits["q"]
        return pa.table([self.names[q], self.ids[q], self.hits["id"], self.hits["score"]], schema=HIT_TYPES)


@dataclass
class Index:
    """``shards``: cell, shard, tree; ``sizes``: cell, shards; ``vectors``: vec_id, row, v, cell of every usable row."""

    shards: DataFrame
    sizes: DataFrame
    vectors: DataFrame
    top: Tree
    width: int
    longest: float
    k: int


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """vec_id and v of rows that take part, -0 as 0."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = ~F.coalesce(bad, F.lit(False)) & F.exists("v", lambda x: x != 0)
    return rows.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.coalesce(good, F.lit(False)))


def build(vectors: DataFrame, k: int, vec_id: str = "vec_id", embedding: str = "embedding") -> Index | None:
    """The index of all usable rows for searches of up to ``k`` results; none without usable rows.

    Vectors that are null, all zero or hold null or non-finite components, and rows without an id, take no part; shorter
    vectors are filled with zeros. The routing tree is fitted on the SAMPLE_ROWS vectors of least hash; every row is indexed.
    Rows of a cell are dealt over its shards by row, so copies of one vector spread.
    """
    rows = usable(vectors, vec_id, embedding).withColumn("row", F.monotonically_increasing_id())
    rows = stored(rows, "vptree-vectors")
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    n, width, longest = rows.agg(F.count(F.lit(1)), F.max(F.size("v")), F.sqrt(F.max(square))).first()
    if not n:
        return None
    sample = rows.orderBy(F.xxhash64("v"), "row").limit(SAMPLE_ROWS).select("v").toArrow()
    points = on_sphere(matrix(sample.column("v"), width), longest)
    cells = max(1, min(CELLS, n // SHARD_ROWS))
    top = grow(np.unique(points, axis=0), 1, cells)[0]

    @F.arrow_udf("int")
    def cell(v: pa.Array) -> pa.Array:
        return pa.array(route(top, on_sphere(matrix(v, width), longest)), pa.int32())

    dealt = stored(rows.withColumn("cell", cell("v")), "vptree-cells")
    sizes = dealt.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / SHARD_ROWS).cast("int").alias("shards"))
    sizes = stored(sizes, "vptree-sizes")

    def grown(key: tuple, group: pa.Table) -> pa.Table:
        ids, places = group.column("vec_id").to_numpy(), group.column("row").to_numpy()
        shard = Shard(ids, places, matrix(group.column("v"), width), longest, k)
        cell_of, number = (x.as_py() for x in key)
        columns = [pa.array([cell_of], pa.int32()), pa.array([number], pa.int32()), pa.array([shard.packed()])]
        return pa.table(columns, names=["cell", "shard", "tree"])

    shard_of = F.pmod(F.xxhash64("row"), F.col("shards")).cast("int").alias("shard")
    # At most CELLS rows on the small side.
    numbered = dealt.join(F.broadcast(sizes), "cell").select("cell", shard_of, "vec_id", "row", "v")
    shards = stored(numbered.groupBy("cell", "shard").applyInArrow(grown, INDEX), "vptree-shards")
    return Index(shards, sizes, dealt, top, width, longest, k)


QUERY = ("query", "vec_id", "row", "v", "cell", "factor")


def visits(index: Index, queries: DataFrame, k: int) -> DataFrame:
    """Hits of queries (QUERY and kth) in all shards of their cells: up to ``k`` a shard, none beyond ``kth``."""
    width, longest = index.width, index.longest

    def search(block: pa.Table, shard: pa.Table) -> pa.Table:
        if not block.num_rows or not shard.num_rows:
            return HIT_TYPES.empty_table()
        names, ids, rows, kth, factor = (
            block.column(n).to_numpy() for n in ("query", "vec_id", "row", "kth", "factor")
        )
        run = Search(names, ids, rows, matrix(block.column("v"), width), kth, factor, longest, k)
        run.run(Shard.unpacked(shard.column("tree")[0].as_py()))
        return run.found()

    queries = stored(queries.select(*QUERY, "kth"), "vptree-queries")
    counts = queries.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / QUERY_ROWS).cast("int").alias("blocks"))
    # At most CELLS rows on the small sides.
    sizes = F.broadcast(index.sizes.join(F.broadcast(counts), "cell"))
    shards = F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard")
    block = F.pmod(F.xxhash64("query"), F.col("blocks")).cast("int").alias("block")
    left = queries.join(sizes, "cell").select(*QUERY, shards, block, "kth")
    blocks = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    right = index.shards.join(sizes.drop("shards"), "cell").select("cell", "shard", blocks, "tree")
    key = ("cell", "shard", "block")
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(search, HITS)


def ranked(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def found(index: Index, queries: DataFrame, k: int) -> DataFrame:
    """query, query_id, vec_id, score and rank of the best ``k`` of queries (QUERY): home cells first, then what is still near."""
    width, longest, top = index.width, index.longest, index.top
    first = stored(visits(index, queries.withColumn("kth", F.lit(float("inf"))), k), "vptree-home")
    last = ranked(first, k).filter(F.col("rank") == k).select("query", "score")

    @F.arrow_udf("struct<kth: double, cells: array<int>>")
    def onward(v: pa.Array, score: pa.Array, factor: pa.Array, own: pa.Array) -> pa.Array:
        vectors = matrix(v, width)
        points = as_queries(vectors) if len(vectors) else np.zeros((0, width + 1))
        cosine = score.to_numpy(zero_copy_only=False) / (np.sqrt((vectors**2).sum(axis=1)) * longest)
        kth = np.where(np.isnan(cosine), np.inf, np.sqrt(np.maximum(0.0, 2.0 - 2.0 * cosine)))
        lists = reachable(top, points, kth, factor.to_numpy())
        lists = [[c for c in cells if c != mine] for cells, mine in zip(lists, own.to_pylist())]
        parts = [pa.array(kth, pa.float64()), pa.array(lists, pa.list_(pa.int32()))]
        return pa.StructArray.from_arrays(parts, names=["kth", "cells"])

    known = queries.join(last, "query", "left").withColumn("next", onward("v", "score", "factor", "cell"))
    far = known.select(*QUERY[:4], "factor", F.col("next.kth").alias("kth"), F.explode("next.cells").alias("cell"))
    return ranked(first.unionByName(visits(index, far, k)), k)


def tuned(index: Index, queries: DataFrame, k: int, recall: float) -> float:
    """The least of FACTORS whose results hold the share ``recall`` of the exact ones, over TUNING_QUERIES queries of least hash."""
    few = queries.orderBy(F.xxhash64("row"), "row").limit(TUNING_QUERIES)
    factors = F.array(*(F.lit(f) for f in FACTORS))
    tried = few.select("vec_id", "row", "v", "cell", F.posexplode(factors).alias("number", "factor"))
    tried = stored(tried.withColumn("query", F.shiftleft("row", 4) + F.col("number")), "vptree-tuning")
    hits = stored(found(index, tried, k), "vptree-tuning-hits").select(
        F.shiftright("query", 4).alias("row"), (F.col("query") % 16).alias("number"), "vec_id"
    )
    exact = hits.filter(F.col("number") == len(FACTORS) - 1).select("row", "vec_id").distinct()
    counts = dict(hits.join(exact, ["row", "vec_id"], "left_semi").groupBy("number").count().collect())
    most = counts.get(len(FACTORS) - 1, 0)
    return next(f for i, f in enumerate(FACTORS) if f == 1.0 or counts.get(i, 0) >= recall * most)


def search(index: Index, is_query: Column, k: int, factor: float | None = None, recall: float = RECALL) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` nearest found of every indexed row that is a query.

    ``is_query``: condition on column ``vec_id``; ``k`` up to the index's. A query skips its own row only, so repeated rows are found
    like others. Ties go to the smaller id; ``score`` is the inner product in double precision. ``factor``: 1 for exact search,
    smaller to prune more, None for the one that :func:`tuned` finds for ``recall``.
    """
    queries = index.vectors.filter(is_query).withColumn("query", F.col("row"))
    if factor is None:
        factor = tuned(index, queries, k, recall)
    hits = found(index, queries.withColumn("factor", F.lit(float(factor))), k)
    return hits.select("query_id", "rank", "vec_id", "score")


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int,
    factor: float | None = None,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """Index and search in one, see :func:`build` and :func:`search`; no usable rows give no rows. Other columns are not read."""
    index = build(vectors, k, vec_id, embedding)
    if index is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return search(index, is_query, k, factor)


def op12_vptree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)
