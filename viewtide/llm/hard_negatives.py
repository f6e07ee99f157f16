"""Hard negatives by best-first search in STR-packed R-trees.

Rows are packed by Sort-Tile-Recursive: ranked along the most varied coordinate and cut into
slabs, ranked inside of each slab along the next one and cut into shards of at most
``SHARD_ROWS``; inside a shard the same goes on, by label and then by the most varied
coordinates, down to pages of ``PAGE`` rows and nodes of ``FANOUT`` children. Each node keeps
its minimum bounding box. For an anchor, a box gives each coordinate an interval of
products, and their sums bound every inner product inside.

A search takes the node with the highest upper bound from a queue and prunes boxes that lie
outside of the window of scores or strictly below the k-th best found, and boxes whose labels
cannot serve. So it returns the exact answer. All windows of an anchor go through a shard
together: a page is read once for all of them.

Every shard meets all anchors, at most ``ANCHORS`` of them in a task; a shard's rows and a
block of anchors are all that a task holds. Only each shard's best go on, and the best of all
shards are taken by a window per anchor.

Scores are whole numbers: in floating point while they stay exact there, else in 64-bit
integers.

Defined results
    Rows with a NULL label or vector, a NULL or non-finite component, or no vec_id take no
    part, nor do those with a component beyond ``LARGEST``, whose scores would not be
    whole numbers of 64 bits. A shorter vector counts as filled up with zeros. Repeated rows
    are rows like any others: another row with the anchor's id is an other row. Ties go by
    smaller vec_id. Empty table: no rows. Extra columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from viewtide.llm import kernels
from viewtide.llm.positions import running
from viewtide.llm.tables import only, table, written

SHARD_ROWS = 8192
ANCHORS = 4096
PAGE = 256
FANOUT = 16
SCALE = 256
LARGEST = 1 << 24
# Coordinates that a shard's rows are sorted by, after their label.
SORTED_BY = 3


def usable(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, label (bigint) and vector (whole numbers) of the rows that take part."""
    whole = only(rows, ["vec_id", "embedding", "label"]).where(
        "vec_id IS NOT NULL AND embedding IS NOT NULL AND label IS NOT NULL"
    )
    plain = F.transform("embedding", lambda x: x.cast("double"))
    sound = F.forall("embedding", lambda x: F.coalesce(
        ~F.isnan(x) & (F.abs(x.cast("double")) <= LARGEST / scale), F.lit(False)
    ))
    return whole.where(sound).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"),
        F.transform(plain, lambda x: F.floor(x * scale).cast("int")).alias("vector"),
    )


# -- packing -----------------------------------------------------------------------------


def _varied(rows: DataFrame, dims: int, n: int) -> list[int]:
    """The coordinates with the largest variance, largest first."""
    at = [F.coalesce(F.get("vector", F.lit(d)), F.lit(0)).cast("double") for d in range(dims)]
    found = rows.agg(*[F.var_pop(c).alias(f"v{d}") for d, c in enumerate(at)]).first()
    return sorted(range(dims), key=lambda d: (-(found[d] or 0.0), d))[:n]


def pack(rows: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``rows`` (vec_id, label, vector) with a number of their own and their shard."""
    n, dims = rows.agg(F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    along = _varied(rows, dims, 2) if dims else []
    keys = [F.coalesce(F.get("vector", F.lit(d)), F.lit(0)) for d in along] or [F.lit(0)]
    keyed = rows.withColumns({"_one": keys[0], "_two": keys[-1]})
    shards = max(1, math.ceil(n / shard_rows))
    slabs = math.ceil(math.sqrt(shards))
    per_slab = math.ceil(shards / slabs)
    size = max(1, math.ceil(n / (slabs * per_slab)))  # equal shards
    ranked = running(keyed, [], ["_one", "vec_id"]).withColumnRenamed("_at", "row")
    slabbed = ranked.withColumn("slab", F.floor(F.col("row") / (size * per_slab)))
    tiled = running(slabbed, ["slab"], ["_two", "row"])
    shard = F.col("slab") * per_slab + F.floor(F.col("_at") / size)
    return tiled.select("row", "vec_id", "label", "vector", shard.alias("shard"))


@dataclass
class Tree:
    """Boxes level by level, leaves (pages) first; ``kids`` are ranges of the level below."""

    rows: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    kids: list[np.ndarray]


def _str_order(columns: list[np.ndarray], pages: int) -> np.ndarray:
    """Sort-Tile-Recursive: positions in packing order, a slice after another."""
    n = len(columns[0])
    if len(columns) == 1 or pages <= 1:
        return np.argsort(columns[0], kind="stable")
    slices = math.ceil(pages ** (1 / len(columns)))
    order, size = np.argsort(columns[0], kind="stable"), math.ceil(n / slices)
    parts = [order[a : a + size] for a in range(0, n, size)]
    return np.concatenate([
        p[_str_order([c[p] for c in columns[1:]], math.ceil(pages / slices))] for p in parts
    ])


def build(rows: np.ndarray, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> Tree:
    pages = math.ceil(len(ids) / PAGE)
    varied = np.argsort(-vectors.var(axis=0), kind="stable")[:SORTED_BY] if vectors.size else []
    order = _str_order([labels, *[vectors[:, d] for d in varied]], pages)
    tree = Tree(rows[order], ids[order], labels[order], vectors[order], [], [])
    starts = np.arange(0, len(ids), PAGE)
    at = lambda ufunc, a: ufunc.reduceat(a, starts, axis=0)
    level = tuple(at(f, a) for a in (tree.vectors, tree.labels) for f in (np.minimum, np.maximum))
    tree.levels.append(level)
    tree.kids.append(np.append(starts, len(ids)))
    while len(level[0]) > 1:
        starts = np.arange(0, len(level[0]), FANOUT)
        tree.kids.append(np.append(starts, len(level[0])))
        level = tuple(
            f.reduceat(a, starts, axis=0) for a, f in zip(level, (np.minimum, np.maximum) * 2)
        )
        tree.levels.append(level)
    return tree


# -- search ------------------------------------------------------------------------------


LEAST, MOST = -(2**63) + 1, 2**63 - 1


class Windows:
    """The k best of each of an anchor's windows of scores: higher first, ties by smaller id,
    then row."""

    def __init__(self, k: int, spans: Sequence[tuple[int, int]]):
        self.k = k
        self.low, self.high = np.array(spans, np.int64).reshape(-1, 2).T
        # The score that a row must reach to be among the k best.
        self.floor = self.low.copy()
        self.found: list[list[tuple[int, int, int]]] = [[] for _ in spans]

    def may_hold(self, least: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Where scores between these bounds can still matter to a window."""
        top = np.minimum(most[:, None], self.high)
        return ((top >= self.floor) & (least[:, None] <= self.high)).any(axis=1)

    def offer(self, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        ok = (scores >= self.floor[:, None]) & (scores <= self.high[:, None])
        for w in np.flatnonzero(ok.any(axis=1)).tolist():
            at = ok[w].nonzero()[0]
            if len(at) > self.k:
                # The k highest, and all that tie with the last of them.
                own = scores[at]
                at = at[own >= np.partition(own, len(at) - self.k)[len(at) - self.k]]
            more = zip((-scores[at]).tolist(), ids[at].tolist(), rows[at].tolist())
            self.found[w] = best = sorted([*self.found[w], *more])[: self.k]
            if len(best) == self.k:
                self.floor[w] = -best[-1][0]


def search(
    tree: Tree, row: int, label: int, vector: np.ndarray, windows: Windows, same: bool
) -> None:
    """Fill the windows with the best rows of the tree of the anchor's label (``same``; not
    the anchor itself) or of the other labels."""
    up, down = np.maximum(vector, 0), np.minimum(vector, 0)
    queue: list[tuple[float, int, int, float]] = []

    def push(level: int, a: int, b: int) -> None:
        low, high, first, last = (x[a:b] for x in tree.levels[level])
        most, least = high @ up + low @ down, low @ up + high @ down
        serves = (first <= label) & (label <= last) if same else (first != label) | (last != label)
        for i in np.flatnonzero(serves & windows.may_hold(least, most)).tolist():
            heapq.heappush(queue, (-most[i], level, a + i, least[i]))

    push(len(tree.levels) - 1, 0, len(tree.levels[-1][0]))
    while queue:
        most, level, node, least = heapq.heappop(queue)
        if not windows.may_hold(np.array([least]), np.array([-most]))[0]:
            continue
        a, b = int(tree.kids[level][node]), int(tree.kids[level][node + 1])
        if level:
            push(level - 1, a, b)
            continue
        ok = (tree.labels[a:b] == label) == same
        if same:
            ok &= tree.rows[a:b] != row
        windows.offer((tree.vectors[a:b] @ vector)[ok], tree.ids[a:b][ok], tree.rows[a:b][ok])


def _matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    """Vectors as rows, shorter ones filled up with zeros; floating point if exact there."""
    lists = column.combine_chunks()
    offsets = lists.offsets.to_numpy()
    sizes, flat = np.diff(offsets), lists.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
    out = np.zeros((len(lists), dims), np.int64)
    out[np.arange(dims)[None] < sizes[:, None]] = flat
    return out


def _exact(*parts: np.ndarray) -> list[np.ndarray]:
    most = max((int(np.abs(p).max(initial=0)) for p in parts), default=0)
    if parts[0].shape[1] * most * most < 2**53:
        return [p.astype(np.float64) for p in parts]
    return list(parts)


def _task(dims: int, wanted, same: bool, columns: list[str]):
    """Search a shard's tree for a block of anchors; ``wanted`` makes an anchor's windows and
    what names each of them."""

    def run(_key, shard: pa.Table, anchors: pa.Table) -> pa.Table:
        if not shard.num_rows or not anchors.num_rows:
            return pa.table({c: pa.array([], pa.int64()) for c in columns})
        vectors, asked = _exact(_matrix(shard["vector"], dims), _matrix(anchors["vector"], dims))
        tree = build(*[shard[c].to_numpy() for c in ("row", "vec_id", "label")], vectors)
        out = []
        for i, (row, label) in enumerate(zip(anchors["row"].to_pylist(), anchors["label"].to_pylist())):
            windows, tags = wanted(anchors, i)
            search(tree, row, label, asked[i], windows, same)
            for tag, found in zip(tags, windows.found):
                out += [(row, *tag, id_, other, int(-score)) for score, id_, other in found]
        return pa.table({c: pa.array([o[k] for o in out], pa.int64()) for k, c in enumerate(columns)})

    return run


def _meet(packed: DataFrame, anchors: DataFrame, task, columns: list[str], block: int) -> DataFrame:
    """Every shard with every block of anchors."""
    shards = packed.agg(F.max("shard")).first()[0]
    blocks = anchors.agg(F.count("*")).first()[0] // block
    if shards is None:
        return packed.sparkSession.createDataFrame([], ", ".join(f"{c} long" for c in columns))
    number = F.pmod(F.xxhash64("row"), F.lit(blocks + 1))
    every = F.sequence(F.lit(0).cast("bigint"), F.lit(shards).cast("bigint"))
    asked = anchors.withColumn("block", number).withColumn("shard", F.explode(every))
    held = packed.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks).cast("bigint"))))
    return held.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInArrow(
        task, ", ".join(f"{c} long" for c in columns)
    )


def positives(packed: DataFrame, asks: Column, k: int, block: int = ANCHORS) -> DataFrame:
    """row (of the anchor), vec_id, other (its row) and score of each anchor's ``k`` best
    rows of its label."""
    dims = _dims(packed)

    def wanted(_anchors, _i):
        return Windows(k, [(LEAST, MOST)]), [()]

    names = ["row", "vec_id", "other", "score"]
    found = _meet(packed, packed.where(asks), _task(dims, wanted, True, names), names, block)
    return _best(found, ["row"], k).drop("rank")


def _dims(packed: DataFrame) -> int:
    return packed.agg(F.coalesce(F.max(F.size("vector")), F.lit(0))).first()[0]


def _best(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "vec_id", "other")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def negatives(
    packed: DataFrame, chosen: DataFrame, k: int, window: tuple[int, int, int], block: int = ANCHORS
) -> DataFrame:
    """For each anchor and positive of ``chosen``: rank, vec_id and score of the ``k`` best
    rows of other labels whose score lies between window[0] and window[2] of window[1] parts
    of the positive's: row, positive, rank, vec_id, other, score."""
    dims, (least, parts, most) = _dims(packed), window
    listed = chosen.groupBy("row").agg(
        F.collect_list(F.struct(F.col("other").alias("positive"), "score")).alias("_positives")
    )
    anchors = packed.join(listed, "row").select(
        "row", "vec_id", "label", "vector",
        F.transform("_positives", lambda p: p["positive"]).alias("positives"),
        F.transform("_positives", lambda p: p["score"]).alias("scores"),
    )

    def wanted(asked: pa.Table, i: int):
        # Whole numbers between the two shares of the positives' scores.
        spans = [(-(-least * s // parts), most * s // parts) for s in asked["scores"][i].as_py()]
        return Windows(k, spans), [(p,) for p in asked["positives"][i].as_py()]

    names = ["row", "positive", "vec_id", "other", "score"]
    found = _meet(packed, written(anchors, "anchors"), _task(dims, wanted, False, names), names, block)
    return _best(found, ["row", "positive"], k)


def mine(
    rows: DataFrame, asks: Column, n_positives: int = 5, n_negatives: int = 10,
    window: tuple[int, int, int] = (30, 100, 90), shard_rows: int = SHARD_ROWS, block: int = ANCHORS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for the rows
    (vec_id, label, vector) under ``asks``."""
    packed = written(pack(written(rows, "vectors"), shard_rows), "rtree-shards")
    chosen = written(positives(packed, asks, n_positives, block), "positives")
    found = negatives(packed, chosen, n_negatives, window, block)
    near = chosen.select(
        "row", F.col("other").alias("positive"), F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    named = packed.select("row", F.col("vec_id").alias("anchor_id"))
    return found.join(near, ["row", "positive"]).join(named, "row").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = usable(table(spark, sf_dir, "embeddings"))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


ORACLE = r"""
WITH sound AS (
  SELECT row_number() OVER () AS row, vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
anchors AS (SELECT * FROM sound WHERE vec_id % 100 = 0),
pairs AS (
  SELECT a.row, a.vec_id AS anchor_id, o.row AS other, o.vec_id, a.label = o.label AS same,
         list_inner_product(a.v::DOUBLE[], o.v::DOUBLE[])::BIGINT AS score
  FROM anchors a JOIN sound o ON a.row <> o.row),
chosen AS (
  SELECT * FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id, other) <= 5)
SELECT c.anchor_id, c.vec_id AS positive_id,
       row_number() OVER (PARTITION BY c.row, c.other ORDER BY n.score DESC, n.vec_id, n.other)::INTEGER AS rank,
       n.vec_id AS negative_id, c.score AS positive_score, n.score AS negative_score
FROM chosen c JOIN pairs n ON n.row = c.row AND NOT n.same
  AND 30 * c.score <= 100 * n.score AND 100 * n.score <= 90 * c.score
QUALIFY row_number() OVER (PARTITION BY c.row, c.other ORDER BY n.score DESC, n.vec_id, n.other) <= 10
"""
