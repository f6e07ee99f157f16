"""Near-duplicates by bottom-k sketches from one hash function.

A document's set holds the hashes of its distinct word shingles; its sketch the
``SKETCH`` smallest of them. Sets that overlap by 80 % have most of their sketch values in
common, in the same order, so runs of neighbouring values agree in many places. The
inverted lists are therefore kept by runs of retained values: a list holds the documents
that share a run, not everybody with one common shingle or passage. The runs are as long as
a set allows: a fifth of the values cannot break up all runs of up to four of a set that is
its own sketch, and all runs of five of a longer one only with a probability of 3e-7.

1.  Equal sets are one class, represented by its smallest id; everything below works on
    representatives.
2.  Each list links its members to its first one, the pivot. The pairs are filtered by the
    similarity that the sketch of the union estimates, and verified on the full sets.
    Verified links form components.
3.  Two members of a list have its pivot in common. So all members of a pivot's lists are
    compared with each other, in blocks inside tasks, as far as they lie in different
    components; only links that join two components leave a task. A link between two
    documents of a list is found whoever its pivot was. A component of more than a block has
    blocks of its own, which do not meet each other.

A group of thousands of copies thus costs a star and not all its pairs; members that do not
reach the pivot travel once for each ``BLOCK_ROWS`` others of their group.

``find(exact=True)`` leaves no chance: the lists are kept by each of the smallest fifth of a
set's values, one of which two sets at 80 % must share, and there is no estimate. It is meant for
smaller corpora, since the lists of common shingles are long.

Defined results
    NULL texts and texts without words: empty set, linked with nothing, kept. Fewer words
    than a shingle: one shingle of all of them. Rows that repeat a doc_id are one document
    with as many sets. NULL doc_id: linked with nothing, component NULL, kept. Empty
    tables: no rows. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from viewtide.llm import kernels
from viewtide.llm.components import components
from viewtide.llm.tables import only, sent, table, written
from viewtide.operators.lookup import lookup

SKETCH = 96
# Run length, and the sizes of the sets that list runs of that length. Two sets of which
# one has at least 80 % of the other's size have a length in common.
RUNS = ((2, 4, 6), (3, 6, 20), (4, 16, 120), (5, 96, None))
SIMILAR = (80, 100)
# The estimate has a standard error of 0.04 at a similarity of 0.8: seven of them.
ESTIMATE = 0.5
# A block has about so many documents and shingles, whichever is reached first.
BLOCK_ROWS = 256
BLOCK_SHINGLES = 250_000
VALUES_AT_ONCE = 16_384


def shingle_sets(
    data: np.ndarray, at: np.ndarray, width: int
) -> Iterator[np.ndarray]:
    """For each document the sorted hashes of its distinct shingles."""
    starts, ends = kernels.runs(kernels.NOT_SPACE[data])
    words = kernels.Rolling(kernels.LOWER[data]).of(starts, ends)
    many = np.uint64(0x9DDFEA08EB382D69)
    rolled = words.copy()  # of the first 1, 2, ... words from each on
    cuts = np.searchsorted(starts, at)
    short: dict[int, int] = {}
    for j in range(1, width):
        for d in np.flatnonzero(np.diff(cuts) == j):
            short[int(d)] = int(rolled[cuts[d]])
        rolled[:-j] = kernels.mix(rolled[:-j] * many + words[j:])
    for d in range(len(at) - 1):
        n = cuts[d + 1] - cuts[d]
        if d in short:
            yield np.array([short[d]], np.uint64)
        elif n < width:
            yield np.zeros(0, np.uint64)
        else:
            yield np.unique(rolled[cuts[d] : cuts[d + 1] - width + 1])


def _signature(values: np.ndarray) -> bytes:
    """128 bits that tell sets apart."""
    one = np.add.reduce(kernels.mix(values))
    two = np.add.reduce(kernels.mix(values ^ np.uint64(0xA5A5A5A5A5A5A5A5)))
    return np.array([one, two], np.uint64).tobytes()


def _longs(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    flat = np.concatenate([np.zeros(0, np.uint64), *parts]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def _least_shared(values: np.ndarray) -> np.ndarray:
    """The smallest values, so many that a similar set has one of them among its own."""
    n = len(values)
    return values[: n + 1 + -n * SIMILAR[0] // SIMILAR[1]]


def sketches(docs: DataFrame, width: int, exact: bool = False) -> DataFrame:
    """doc_id, n_shingles, signature and sketch (ascending as unsigned) of every row."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, at in kernels.slices(batch.column("text")):
                sets = list(shingle_sets(data, at, width))
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id")[first:end],
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_signature(s) for s in sets], pa.binary()),
                    _longs([_least_shared(s) if exact else s[:SKETCH] for s in sets]),
                ], ["doc_id", "n_shingles", "signature", "sketch"])

    kind = dict(docs.dtypes)["doc_id"]
    return only(docs, ["doc_id", "text"]).mapInArrow(
        kernels.lean(sketch), f"doc_id {kind}, n_shingles long, signature binary, sketch array<long>"
    )


def _runs() -> Column:
    n, none = F.size("sketch"), F.array().cast("array<bigint>")

    def of(length: int, least: int, most: int | None):
        runs = F.transform(
            F.sequence(F.lit(0), n - length),
            lambda i: F.xxhash64(F.lit(length), *[F.get("sketch", i + j) for j in range(length)]),
        )
        fits = F.col("n_shingles") >= least
        return F.when(fits if most is None else fits & (F.col("n_shingles") <= most), runs).otherwise(none)

    return F.concat(*[of(*band) for band in RUNS])


def inverted_lists(nodes: DataFrame, exact: bool = False) -> DataFrame:
    """node and pivot (the first member) of all lists with more than one member, each pair
    once and without the pivots themselves."""
    keys = F.col("sketch") if exact else _runs()
    # Sets of fewer than four shingles are similar to equal ones only.
    rows = nodes.where("n_shingles >= 4").select("node", F.explode(keys).alias("run"))
    heads = rows.groupBy("run").agg(F.min("node").alias("pivot"), F.max("node").alias("_last"))
    heads = written(heads.where("pivot <> _last").select("run", "pivot"), "near-lists")
    return rows.join(sent(heads), "run").where("node <> pivot").select("pivot", "node").distinct()


def similar(x: np.ndarray, y: np.ndarray, exact: bool = False) -> bool:
    """Two full sets: by size, by the estimate from the sketch of the union, exactly."""
    small, large = sorted((len(x), len(y)))
    if SIMILAR[1] * small < SIMILAR[0] * large:
        return False
    if large > SKETCH and not exact:
        one, two = x[:SKETCH], y[:SKETCH]
        union = np.union1d(one, two)[:SKETCH]
        both = np.intersect1d(one, two, assume_unique=True)
        if np.searchsorted(both, union[-1], "right") < ESTIMATE * len(union):
            return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return SIMILAR[1] * both >= SIMILAR[0] * (len(x) + len(y) - both)


def _set(value: pa.Scalar) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), np.uint64)


def full_sets(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """node, shingle set and its size of the documents whose ids are in ``ids`` (node)."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, at in kernels.slices(batch.column("text")):
                found = [s.tobytes() for s in shingle_sets(data, at, width)]
                yield pa.RecordBatch.from_arrays([
                    batch.column("node")[first:end], pa.array(found, pa.binary()),
                    pa.array([len(s) // 8 for s in found], pa.int64()),
                ], ["node", "shingles", "n_shingles"])

    ids = sent(ids)
    chosen = only(docs, ["doc_id", "text"]).withColumnRenamed("doc_id", "node").join(
        ids, "node", "left_semi"
    )
    kind = dict(docs.dtypes)["doc_id"]
    return chosen.mapInArrow(kernels.lean(sets), f"node {kind}, shingles binary, n_shingles long")


def _links(pairs: DataFrame, sets: DataFrame, exact: bool = False) -> DataFrame:
    """Those of ``pairs`` (a, b) whose full sets are similar."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column("left"), batch.column("right"))
            keep = pa.array([similar(_set(x), _set(y), exact) for x, y in both], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in ("a", "b")], ["a", "b"])

    kind = dict(pairs.dtypes)["a"]
    sets = sets.select("node", "shingles")
    joined = pairs.join(sets.toDF("b", "right"), "b").join(sets.toDF("a", "left"), "a")
    return joined.select("a", "b", "left", "right").mapInArrow(
        kernels.lean(kept), f"a {kind}, b {kind}"
    ).distinct()


def intersections(ours: list[np.ndarray], theirs: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of one list with all of the other."""
    both = np.concatenate([*ours, *theirs])
    owner = np.repeat(np.arange(len(ours) + len(theirs)), [len(s) for s in (*ours, *theirs)])
    order = np.argsort(both, kind="stable")
    both, owner = both[order], owner[order]
    head = np.concatenate([[True], both[1:] != both[:-1]]) if len(both) else np.zeros(0, bool)
    value = np.cumsum(head) - 1
    shared = np.bincount(value)[value] > 1 if len(both) else head
    value, owner = np.unique(value[shared], return_inverse=True)[1], owner[shared]
    out = np.zeros((len(ours), len(theirs)), np.float32)
    for low in range(0, int(value.max(initial=-1)) + 1, VALUES_AT_ONCE):
        here = (value >= low) & (value < low + VALUES_AT_ONCE)
        marks = np.zeros((len(ours) + len(theirs), VALUES_AT_ONCE), np.float32)
        marks[owner[here], value[here] - low] = 1
        out += marks[: len(ours)] @ marks[len(ours) :].T
    return out.astype(np.int64)


def joining_links(
    ours: list[np.ndarray], theirs: list[np.ndarray], mine: list, other: list
) -> list[tuple[int, int]]:
    """Pairs of similar sets, only those that join components (``mine``, ``other``) which
    the pairs before them have not joined."""
    sizes = np.array([len(s) for s in ours]), np.array([len(s) for s in theirs])
    both = intersections(ours, theirs)
    union = sizes[0][:, None] + sizes[1][None] - both
    parent: dict = {}

    def root(c):
        while parent.get(c, c) != c:
            c = parent[c]
        return c

    links = []
    for i, j in np.argwhere(SIMILAR[1] * both >= SIMILAR[0] * union).tolist():
        a, b = root(mine[i]), root(other[j])
        if a != b:
            parent[b] = a
            links.append((i, j))
    return links


def _compare(group: pa.Table) -> pa.Table:
    """Links between the rows of two blocks of a pivot's group, or inside of one."""
    sets = [_set(v) for v in group["shingles"]]
    nodes, components_ = group["node"].to_pylist(), group["component"].to_pylist()
    one, two = group["low"][0].as_py(), group["high"][0].as_py()
    left = [i for i, b in enumerate(group["block"].to_pylist()) if b == one]
    right = left if one == two else sorted(set(range(len(sets))) - set(left))
    links = joining_links(
        [sets[i] for i in left], [sets[i] for i in right],
        [components_[i] for i in left], [components_[i] for i in right],
    )
    kind = group.schema.field("node").type
    return pa.table({
        "a": pa.array([nodes[left[i]] for i, _ in links], kind),
        "b": pa.array([nodes[right[j]] for _, j in links], kind),
    })


def _blocks(members: DataFrame) -> DataFrame:
    """For each pivot and component of ``members``: own (whether it has blocks to itself, or else
    shares those of all small ones), its first block, their number, and that of all the pivot's.

    Pivots whose members all lie in one component are done and left out.
    """
    parts = lambda n, shingles: F.greatest(F.ceil(n / BLOCK_ROWS), F.ceil(shingles / BLOCK_SHINGLES))
    kinds = members.groupBy("pivot", "component").agg(
        F.count("*").alias("n"), F.sum("n_shingles").alias("s"), F.lit(1).alias("one")
    ).withColumn("own", parts(F.col("n"), F.col("s")) > 1)
    # A row for each component that fills a block, and one for the small ones.
    shares = kinds.groupBy("pivot", F.when(F.col("own"), F.col("component")).alias("large")).agg(
        parts(F.sum("n"), F.sum("s")).alias("parts"), F.sum("one").alias("kinds")
    )
    group = Window.partitionBy("pivot")
    sofar = group.orderBy("large").rowsBetween(Window.unboundedPreceding, -1)
    laid = shares.withColumns({
        "first": F.coalesce(F.sum("parts").over(sofar), F.lit(0)),
        "blocks": F.sum("parts").over(group), "_kinds": F.sum("kinds").over(group),
    }).where("_kinds > 1").drop("kinds", "_kinds").withColumnRenamed("pivot", "_pivot")
    same = (F.col("pivot") == F.col("_pivot")) & F.when(F.col("own"), F.col("component")).eqNullSafe(F.col("large"))
    return kinds.join(laid, same).select("pivot", "component", "own", "first", "parts", "blocks")


def _across(groups: DataFrame, links: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between members of one group (pivot, node) that ``links`` do not yet join."""
    kind = dict(groups.dtypes)["node"]
    members = (
        groups.join(sets.select("node", "n_shingles"), "node")
        .join(components(links), "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    block = _blocks(members)
    placed = (
        members.join(block, ["pivot", "component"])
        .withColumn("block", F.col("first") + F.pmod(
            F.when(F.col("own"), F.xxhash64("node")).otherwise(F.xxhash64("component")), F.col("parts")
        ))
        .withColumn("with", F.explode(F.filter(
            F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1),
            lambda b: ~F.col("own") | (b < F.col("first")) | (b >= F.col("first") + F.col("parts")),
        )))
        .select(
            "pivot", F.least("block", "with").alias("low"), F.greatest("block", "with").alias("high"),
            "block", "node", "component",
        )
    )
    return placed.join(sets.select("node", "shingles"), "node").groupBy("pivot", "low", "high").applyInArrow(
        kernels.lean_group(_compare), f"a {kind}, b {kind}"
    )


def find(docs: DataFrame, width: int = 5, exact: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs``."""
    sketched = written(sketches(docs, width, exact), "near-sketches")
    usable = sketched.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = written(
        usable.groupBy("signature").agg(F.min("doc_id").alias("node")), "near-classes"
    )
    chosen = classes.withColumnRenamed("node", "doc_id")
    chosen = sent(chosen)
    nodes = usable.join(chosen, ["signature", "doc_id"], "left_semi").select(
        F.col("doc_id").alias("node"), "n_shingles", "sketch"
    )
    groups = written(inverted_lists(nodes, exact), "near-groups")
    ids = written(
        groups.select(F.explode(F.array("pivot", "node")).alias("node")).distinct(), "near-ids"
    )
    sets = written(full_sets(docs, ids, width), "near-sets")

    links = written(_links(groups.toDF("a", "b"), sets, exact), "near-links")
    across = _across(groups, links, sets)
    labels = components(written(links.unionByName(across), "near-links"))

    by_class = classes.join(labels, "node", "left").select(
        "signature", F.coalesce("component", "node").alias("component")
    )
    rows = sketched.withColumn("signature", F.when(
        (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("signature")
    ))
    placed = lookup(
        rows.select("doc_id", "n_shingles", "signature"), written(by_class, "near-labels"), "signature"
    )
    component = F.coalesce("component", "doc_id")
    return placed.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents"), width=2)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the smallest id, once if its row is
    repeated."""
    dropped = written(
        find(docs).where("NOT kept").select(F.col("doc_id").alias("_id")).distinct(), "near-drop"
    )
    dropped = sent(dropped)
    rows = docs.select(
        F.struct(*[F.col(f"`{n}`") for n in docs.columns]).alias("_row"),
        F.col("doc_id").alias("_id"),
    )
    kept = rows.join(dropped, "_id", "left_anti")
    again = written(
        docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 AND doc_id IS NOT NULL")
        .select(F.col("doc_id").alias("_id")),
        "near-again",
    )
    if again.isEmpty():
        return kept.select("_row.*")
    repeated = kept.join(again, "_id", "left_semi").withColumn("_text", F.col("_row.text"))
    single = repeated.groupBy("_id", "_text").agg(F.first("_row").alias("_row"))
    return kept.join(again, "_id", "left_anti").select("_row.*").unionByName(
        single.select("_row.*")
    )


ORACLE = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) < 2 THEN w
    ELSE list_distinct([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) END AS s
  FROM worded),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM shingles a JOIN shingles b
    ON a.g = b.g AND a.doc_id <> b.doc_id AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reached AS (
  SELECT doc_id, doc_id AS other FROM sets
  UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other)
SELECT s.doc_id, len(any_value(s.s))::BIGINT AS n_shingles, min(r.other) AS component_id,
       s.doc_id = min(r.other) AS kept
FROM sets s JOIN reached r USING (doc_id) GROUP BY s.doc_id
"""
