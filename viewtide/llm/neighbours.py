"""Approximate nearest neighbours with a vantage-point tree per shard.

Vectors are dealt to shards by hash of id and components, as many shards as the number of
rows asks for: the same rows give the same answers on any cluster. A shard's tree splits its vectors, again
and again, by distance from a vantage point into a nearer and a farther half, and keeps
the range of distances on each side. By the triangle inequality a side whose range lies
farther from the query's own distance than its worst match so far holds nothing better.
``factor`` shrinks that worst match before it is compared: smaller means fewer visits and
a chance to miss; 1 restores exact search. Distances are those of unit vectors, which
order like the cosine; scores are cosines of the given vectors in double precision.

Queries go in blocks against every shard, and each query keeps its best ``k`` of a shard. A
tree meets ``BLOCKS`` blocks at a time, so a task holds one tree and some 30,000 queries,
however many there are.
Equal vectors of a shard stand in its tree once, with their ``k + 1`` smallest ids: no
answer can need more of them, however many copies there are.

Defined results
    Vectors that are NULL, empty, zero, or hold a NULL or non-finite component take no
    part, nor do rows with a NULL id. Only vectors of equal length are compared. Ties go to the
    smaller id. Rows that repeat an id are one candidate if their vectors are equal.
    Fewer candidates than ``k``: all. Empty tables: no rows. Extra columns are not read.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewtide.llm import kernels
from viewtide.llm.tables import only, table, written

K = 5
FACTOR = 0.25
SHARD_ROWS = 8_192
BLOCK_ROWS = 1_024
BLOCKS = 32
LEAF = 64
_SLACK = 1e-9


@dataclass
class Tree:
    units: np.ndarray  # distinct unit vectors, in leaf order
    vectors: np.ndarray  # the same as given
    ids: np.ndarray  # up to k + 1 smallest ids of each; -1 fills
    used: np.ndarray  # how many of them
    nodes: list  # (begin, end, vantage, left, right, left range, right range)


def build(ids: np.ndarray, vectors: np.ndarray, k: int, seed: int = 0) -> Tree:
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], np.ascontiguousarray(vectors[order])
    rows = vectors.view(np.dtype((np.void, vectors.dtype.itemsize * vectors.shape[1]))).ravel()
    _, first, which = np.unique(rows, return_index=True, return_inverse=True)
    by = np.lexsort((ids, which))
    sorted_which, sorted_ids = which[by], ids[by]
    again = np.zeros(len(by), bool)
    again[1:] = (sorted_which[1:] == sorted_which[:-1]) & (sorted_ids[1:] == sorted_ids[:-1])
    sorted_which, sorted_ids = sorted_which[~again], sorted_ids[~again]
    rank = np.arange(len(sorted_which)) - np.searchsorted(sorted_which, sorted_which)
    own = np.full((len(first), k + 1), -1, np.int64)
    keep = rank <= k
    own[sorted_which[keep], rank[keep]] = sorted_ids[keep]
    used = np.minimum(np.bincount(sorted_which, minlength=len(first)), k + 1)
    distinct = vectors[first].astype(np.float64)
    units = distinct / np.linalg.norm(distinct, axis=1, keepdims=True)

    rng, at, nodes = np.random.default_rng(seed), np.arange(len(units)), []

    def grow(begin: int, end: int) -> int:
        me = len(nodes)
        nodes.append(None)
        if end - begin <= LEAF:
            nodes[me] = (begin, end, None, -1, -1, None, None)
            return me
        inside = at[begin:end]
        tried = units[rng.choice(inside, 4)]  # the widest spread of distances splits best
        probe = units[rng.choice(inside, min(64, len(inside)), replace=False)]
        vantage = tried[np.argmax((probe @ tried.T).std(0))]
        far = _distance(units[inside] @ vantage)
        ordered = np.argsort(far, kind="stable")
        at[begin:end], far = inside[ordered], far[ordered]
        middle = (end - begin) // 2
        left = grow(begin, begin + middle)
        right = grow(begin + middle, end)
        nodes[me] = (begin, end, vantage, left, right,
                     (far[0], far[middle - 1]), (far[middle], far[-1]))
        return me

    if len(units):
        grow(0, len(units))
    return Tree(units[at], distinct[at], own[at], used[at], nodes)


def _distance(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * cosine, 0))


def search(
    tree: Tree, query_ids: np.ndarray, queries: np.ndarray, k: int, factor: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, id, cosine) of up to ``k`` matches for each query, the best ones found."""
    queries = queries.astype(np.float64)
    units = queries / np.linalg.norm(queries, axis=1, keepdims=True)
    wide = k + 1  # the query itself may be among them
    best = np.full((len(units), wide), -np.inf)
    where = np.full((len(units), wide), -1, np.int64)
    smallest = tree.ids[:, 0] if len(tree.ids) else np.zeros(0, np.int64)

    def visit_leaf(begin: int, end: int, active: np.ndarray) -> None:
        cosine = units[active] @ tree.units[begin:end].T
        gain = cosine.max(1) >= best[active, -1] - _SLACK
        active, cosine = active[gain], cosine[gain]
        if not len(active):
            return
        value = np.hstack([best[active], cosine])
        place = np.hstack([where[active], np.broadcast_to(np.arange(begin, end), cosine.shape)])
        ties = np.where(place >= 0, smallest[place], np.iinfo(np.int64).max)
        ranked = np.lexsort((ties, -value), axis=1)[:, :wide]
        best[active] = np.take_along_axis(value, ranked, 1)
        where[active] = np.take_along_axis(place, ranked, 1)

    leaf_of = np.full(len(units), -1)

    def descend(node: int, active: np.ndarray) -> None:
        """Every query's own leaf first: it gives a worst match to prune with."""
        if not len(active):
            return
        begin, end, vantage, left, right, near, far = tree.nodes[node]
        if vantage is None:
            visit_leaf(begin, end, active)
            leaf_of[active] = node
            return
        inner = _distance(units[active] @ vantage) <= (near[1] + far[0]) / 2
        descend(left, active[inner])
        descend(right, active[~inner])

    def prune(node: int, active: np.ndarray) -> None:
        if not len(active):
            return
        begin, end, vantage, left, right, near, far = tree.nodes[node]
        if vantage is None:
            visit_leaf(begin, end, active[leaf_of[active] != node])
            return
        mine = _distance(units[active] @ vantage)
        for child, (low, high) in ((left, near), (right, far)):
            worst = _distance(best[active, -1]) * factor + _SLACK
            prune(child, active[(mine >= low - worst) & (mine <= high + worst)])

    if tree.nodes:
        everyone = np.arange(len(units))
        descend(0, everyone)
        prune(0, everyone)

    found = where >= 0
    row, slot = np.nonzero(found)
    place = where[row, slot]
    count = tree.used[place]
    row, place = np.repeat(row, count), np.repeat(place, count)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    ids = tree.ids[place, nth]
    a, b = queries[row], tree.vectors[place]
    cosine = (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))
    cosine = np.clip(cosine, -1.0, 1.0)
    other = ids != query_ids[row]
    row, ids, cosine = row[other], ids[other], cosine[other]
    ranked = np.lexsort((ids, -cosine, row))
    row, ids, cosine = row[ranked], ids[ranked], cosine[ranked]
    top = np.arange(len(row)) - np.searchsorted(row, row) < k
    return query_ids[row[top]], ids[top], cosine[top]


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding and dims of the rows that take part."""
    v = F.col("embedding")
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return only(vectors, ["vec_id", "embedding"]).where(
        F.col("vec_id").isNotNull() & (F.size(v) > 0) & sound & F.exists(v, lambda x: x != 0)
    ).withColumn("dims", F.size(v))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, dims)


def build_index(vectors: DataFrame, shards: int, k: int = K) -> DataFrame:
    """shard, dims, tree: one serialised tree per shard and vector length."""

    def grow(group: pa.Table) -> pa.Table:
        dims = group["dims"][0].as_py()
        ids = group["vec_id"].to_numpy().astype(np.int64)
        tree = build(ids, _matrix(group["embedding"], dims), k)
        return pa.table({
            "shard": pa.array([group["shard"][0].as_py()], pa.int64()),
            "dims": pa.array([dims], pa.int32()),
            "tree": pa.array([pickle.dumps(tree, protocol=5)], pa.binary()),
        })

    # Rows that repeat both id and vector are one; those that repeat the id alone part here.
    dealt = vectors.distinct().withColumn(
        "shard", F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(shards))
    )
    return dealt.groupBy("shard", "dims").applyInArrow(kernels.lean_group(grow), "shard long, dims int, tree binary")


def search_index(
    index: DataFrame, queries: DataFrame, shards: int, k: int = K, factor: float = FACTOR
) -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` nearest found for every query."""
    n = queries.count()
    blocks = max(1, -(-n // BLOCK_ROWS))
    chunks = -(-blocks // BLOCKS)
    every = lambda m: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(m - 1).cast("long")))
    block = F.pmod(F.xxhash64("vec_id", F.lit("block")), F.lit(blocks)).alias("block")
    blocked = queries.groupBy("dims", block).agg(F.collect_list(F.struct("vec_id", "embedding")).alias("queries"))
    asked = blocked.select(
        every(shards).alias("shard"), "dims", F.pmod("block", F.lit(chunks)).alias("chunk"),
        F.lit(None).cast("binary").alias("tree"), "queries",
    )
    trees = index.select(
        "shard", "dims", every(chunks).alias("chunk"), "tree",
        F.lit(None).cast(asked.schema["queries"].dataType).alias("queries"),
    )

    def find(group: pa.Table) -> pa.Table:
        got, names = [], ["query_id", "vec_id", "score"]
        tree = group["tree"].drop_null()
        if len(tree):  # else the shard has no vectors of this length
            tree, dims = pickle.loads(tree[0].as_buffer()), group["dims"][0].as_py()
            for chunk in group["queries"].drop_null().chunks:
                for block in chunk:
                    ids = block.values.field("vec_id").to_numpy().astype(np.int64)
                    got.append(search(tree, ids, _matrix(block.values.field("embedding"), dims), k, factor))
        if not got:
            return pa.table({n: pa.array([], t) for n, t in zip(names, (pa.int64(), pa.int64(), pa.float64()))})
        return pa.table({n: np.concatenate(x) for n, x in zip(names, zip(*got))})

    # Side by side and not joined: a join would bring a copy of the tree with each block.
    found = trees.unionByName(asked).groupBy("shard", "dims", "chunk").applyInArrow(
        kernels.lean_group(find), "query_id long, vec_id long, score double"
    )
    # At most k rows a query and shard come together here.
    ranked = found.distinct().groupBy("query_id").agg(
        F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("far"), "vec_id"))), 1, k).alias("top")
    )
    return ranked.select("query_id", F.posexplode("top").alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"),
        (-F.col("hit.far")).alias("score"),
    )


def nearest(
    vectors: DataFrame, asks: Column, k: int = K, factor: float = FACTOR,
    shards: int | None = None,
) -> DataFrame:
    """The ``k`` nearest other rows of every row under ``asks``."""
    ready = usable(vectors)
    if shards is None:
        shards = max(1, -(-ready.count() // SHARD_ROWS))
    index = written(build_index(ready, shards, k), "vp-trees")
    return search_index(index, ready.where(asks), shards, k, factor)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
