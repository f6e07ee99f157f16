"""A trie over the beginnings of conversations, aggregated by ROLLUP.

A conversation's turns become columns: a row holds ``WIDTH`` turn ids in their order, and
``ROLLUP`` over these columns aggregates every beginning of every row at once;
``grouping_id`` tells how many columns a group has left and so how deep its node lies. Longer
conversations go on in further rows of ``WIDTH`` columns, which are grouped under the node
that the block before them ended in. All blocks are aggregated by the same ROLLUP, as that
node is named by 128 bits: the exclusive-or of hashes of (position, turn) on the way to it.

A second ROLLUP of the same shape sums what lies below a node. Every node is charged to its
smallest member, so each leaf and each saved turn is counted in one row, which all nodes
above it on that row's way see.

Turn ids are 128 bits of SHA-256 over role and text, so texts are read once and not
shuffled. A hot conversation, beginning or turn is combined before it is shuffled, and what
needs an order inside a conversation or node is dealt by range (``positions.running``).

Defined results
    NULL role and NULL text are empty. Turns are ordered by number, NULL first; equal numbers
    by turn id, so by content; all stay, repeated rows too. Rows without a conv_id belong to
    no conversation and are left out. Remainders have the sign of the id. Empty texts are
    turns like any others, very long ones are only hashed. Empty table: no rows. Extra
    columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewtide.llm import kernels
from viewtide.llm.positions import running
from viewtide.llm.tables import crc_of_id, only, table, written
from viewtide.operators.lookup import lookup

WIDTH = 8
# Members of a node are written into pieces of so many ids before they are hashed.
PIECE = 4096
NO_MEMBERS = hashlib.sha256(b"").hexdigest()


def _said(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def turn_id() -> Column:
    role, text = _said("role"), _said("text")
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return F.substring(F.unhex(F.sha2(whole, 256)), 1, 16)


def ordered_turns(rows: DataFrame) -> DataFrame:
    """conv_id, pos (from 0), turn_id, chars of every turn of ``rows`` (conv_id, turn, role,
    text)."""
    narrow = only(rows, ["conv_id", "turn", "role", "text"]).where("conv_id IS NOT NULL").select(
        "conv_id", "turn", turn_id().alias("turn_id"), F.length(_said("text")).cast("bigint").alias("chars")
    )
    placed = running(narrow, ["conv_id"], [F.col("turn").asc_nulls_first(), "turn_id"])
    return placed.select("conv_id", F.col("_at").alias("pos"), "turn_id", "chars")


def turn_texts(rows: DataFrame) -> DataFrame:
    """turn_id, role, text of every distinct turn: what the nodes of the trie say."""
    said = only(rows, ["role", "text"])
    return said.select(turn_id().alias("turn_id"), _said("role").alias("role"), _said("text").alias("text")).distinct()


# -- blocks of columns -----------------------------------------------------------------


def _slots() -> list[str]:
    return [f"c{i}" for i in range(WIDTH)]


def _mark(side: int, pos: Column, turn: Column) -> Column:
    return F.xxhash64(F.lit(side), turn, pos)


def _blocks(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """A row per conversation and ``WIDTH`` turns: the turns as columns (structs of id and
    chars), and the marks of the block and of all blocks before it. A conversation without
    turns has one row without any."""
    nobody = conversations.select(
        "conv_id", F.lit(None).cast("bigint").alias("pos"),
        F.lit(None).cast("binary").alias("turn_id"), F.lit(None).cast("bigint").alias("chars"),
    )
    placed = turns.select("conv_id", "pos", "turn_id", "chars").unionByName(nobody).select(
        "conv_id", F.coalesce(F.floor(F.col("pos") / WIDTH), F.lit(0)).cast("bigint").alias("block"),
        (F.col("pos") % WIDTH).alias("slot"), "pos", F.struct("turn_id", "chars").alias("turn"),
    )
    zero = F.lit(0).cast("bigint")
    marks = [
        F.coalesce(F.bit_xor(F.when(F.col("pos").isNotNull(), _mark(s, F.col("pos"), F.col("turn.turn_id")))), zero)
        .alias(f"m{s}") for s in (1, 2)
    ]
    wide = placed.groupBy("conv_id", "block").agg(
        *[F.max(F.when(F.col("slot") == i, F.col("turn"))).alias(c) for i, c in enumerate(_slots())], *marks
    )
    return written(running(wide, ["conv_id"], ["block"], xors=["m1", "m2"]).drop("_at"), "trie-blocks")


def _rolled(blocks: DataFrame, measures: str) -> DataFrame:
    """The nodes that a ROLLUP over the columns of all blocks finds, with ``measures``:
    node, parent, depth, level, last (struct of turn_id and chars)."""
    slots = ", ".join(_slots())
    rolled = blocks.sparkSession.sql(
        f"""SELECT block, m1_before, m2_before, {slots}, grouping_id() AS outside, {measures}
        FROM {{blocks}} GROUP BY block, m1_before, m2_before, ROLLUP ({slots})""",
        blocks=blocks,
    )
    # A group has the first ``level`` columns; those behind them are its low bits.
    level = (F.lit(WIDTH) - F.bit_count("outside")).cast("int")
    last = F.get(F.array(*_slots()), level - 1)
    names = [c for c in rolled.columns if c not in {"block", "m1_before", "m2_before", "outside", *_slots()}]
    leveled = rolled.withColumns({"level": level, "last": F.when(level > 0, last)})
    # Level 0 of a further block is the node that its block before ended in, and a group
    # whose last column is empty is the end of a shorter conversation.
    kept = leveled.where(F.col("last").isNotNull() | ((F.col("level") == 0) & (F.col("block") == 0)))
    # Columns behind the level are empty in a group, so what is left is the way to the node.
    ways = {}
    for side in (1, 2):
        way = F.col(f"m{side}_before")
        for i, c in enumerate(_slots()):
            mark = _mark(side, F.col("block") * WIDTH + i, F.col(f"{c}.turn_id"))
            way = way.bitwiseXOR(F.when(F.col(c).isNotNull(), mark).otherwise(0))
        ways[f"w{side}"] = way
    placed = kept.withColumns({"depth": F.col("block") * WIDTH + F.col("level"), **ways})
    above = [
        F.col(f"w{side}").bitwiseXOR(_mark(side, F.col("depth") - 1, F.col("last.turn_id"))) for side in (1, 2)
    ]
    return placed.select(
        _name(F.col("w1"), F.col("w2")).alias("node"), F.when(F.col("level") > 0, _name(*above)).alias("parent"),
        "depth", "level", "last", *names,
    )


def _name(one: Column, two: Column) -> Column:
    return F.concat(F.lpad(F.hex(one), 16, "0"), F.lpad(F.hex(two), 16, "0"))


# -- the trie ----------------------------------------------------------------------------


def _below(blocks: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, n_leaves and saved_tokens of the whole subtree of every node."""
    block = F.floor((F.col("depth") - 1) / WIDTH).cast("bigint")
    saves = (F.col("n_convs") - 1) * F.col("chars")
    owned = nodes.where((F.col("depth") > 0) & (saves > 0)).groupBy(
        F.col("conv_id"), block.alias("block")
    ).agg(*[
        F.sum(F.when((F.col("depth") - 1) % WIDTH == i, saves).otherwise(0)).alias(f"v{i}") for i in range(WIDTH)
    ])
    leaves = nodes.join(
        nodes.where("parent IS NOT NULL").select(F.col("parent").alias("node")).distinct(), "node", "left_anti"
    ).select("conv_id", F.lit(1).cast("bigint").alias("leaf"))
    zero = F.lit(0).cast("bigint")
    valued = blocks.join(owned, ["conv_id", "block"], "left").select(
        *blocks.columns, *[F.coalesce(f"v{i}", zero).alias(f"v{i}") for i in range(WIDTH)],
    )
    whole = sum((F.col(f"v{i}") for i in range(WIDTH)), zero).alias("whole")
    summed = running(valued.select("*", whole), ["conv_id"], [F.col("block").desc()], sums=["whole"])
    flagged = lookup(summed, leaves, "conv_id")
    tails = {}
    for i in range(WIDTH):
        tails[f"t{i}"] = sum((F.col(f"v{j}") for j in range(i, WIDTH)), F.col("whole_before"))
    ready = flagged.select(
        "block", "m1_before", "m2_before", *_slots(), F.coalesce("leaf", zero).alias("leaf"),
        *[c.alias(n) for n, c in tails.items()],
    )
    sums = ", ".join(["sum(leaf) AS n_leaves", *[f"sum({n}) AS {n}" for n in tails]])
    rolled = _rolled(ready, sums)
    mine = F.get(F.array(*tails), F.greatest(F.col("level") - 1, F.lit(0)))
    return rolled.select("node", "n_leaves", mine.alias("saved_tokens"))


def _hash_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by node and piece: the hash runs on from piece to piece."""
    names, key, done = ["node", "ends_sha256"], None, []

    def out() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*done)], names)
        done.clear()
        return batch

    for batch in batches:
        for node, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
            if node != key:
                if key is not None:
                    done.append((key, state.hexdigest()))
                key, state = node, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if done:
            yield out()
    if key is not None:
        done.append((key, state.hexdigest()))
        yield out()


def _ends(blocks: DataFrame) -> DataFrame:
    """node and ends_sha256 of the nodes at which conversations end."""
    ends = blocks.groupBy("conv_id").agg(F.bit_xor("m1").alias("m1"), F.bit_xor("m2").alias("m2")).select(
        "conv_id", _name(F.col("m1"), F.col("m2")).alias("node")
    )
    placed = running(ends, ["node"], ["conv_id"])
    pieces = placed.groupBy("node", F.floor(F.col("_at") / PIECE).alias("piece")).agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ","
        ).alias("ids")
    )
    return pieces.repartition("node").sortWithinPartitions("node", "piece").mapInArrow(
        kernels.lean(_hash_members, whole=True), "node string, ends_sha256 string"
    )


def prefix_trie(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """The nodes of the trie over ``turns`` (conv_id, pos, turn_id, chars) of all
    ``conversations`` (conv_id): node, parent, turn_id, conv_id (the smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    blocks = _blocks(turns, conversations)
    measures = "min(conv_id) AS conv_id, count(*) AS n_convs"
    nodes = written(
        _rolled(blocks, measures).select(
            "node", "parent", "depth", "conv_id", "n_convs",
            F.col("last.turn_id").alias("turn_id"), F.coalesce("last.chars", F.lit(0).cast("bigint")).alias("chars"),
        ),
        "trie-nodes",
    )
    below = written(_below(blocks, nodes), "trie-below")
    ends = written(_ends(blocks), "trie-ends")
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(
        F.count("*").alias("n_children")
    )
    counted = written(nodes.join(children, "node", "left"), "trie-counted")
    parents = counted.where("n_children > 0").select(
        F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id")
    )
    return (
        lookup(counted, parents, "parent").join(below, "node", "left").join(ends, "node", "left")
        .select(
            "node", "parent", "turn_id", "conv_id", "depth", "parent_conv_id", "n_convs",
            F.coalesce("n_children", F.lit(0).cast("bigint")).alias("n_children"), "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.lit(NO_MEMBERS)).alias("ends_sha256"),
        )
    )


# -- the registered query ------------------------------------------------------------------

FAMILY = 100
HEADS = 6


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns and ids of the conversations rebuilt from ``turns``: the first h turns of the
    family's first conversation, then the own turns behind the first h."""
    h = crc_of_id("conv_id") % HEADS
    family = F.col("conv_id") - F.col("conv_id") % FAMILY
    heads = written(
        turns.where((F.col("conv_id") % FAMILY == 0) & (F.col("pos") < HEADS - 1)).withColumnRenamed("conv_id", "family"),
        "trie-heads",
    )
    # A family has at most two hundred conversations and five turns to begin with.
    have = heads.groupBy("family").agg(F.count("*").alias("have"))
    plan = written(
        turns.select("conv_id").distinct().withColumn("family", family).join(have, "family", "left")
        .select("conv_id", "family", F.least(h, F.coalesce("have", F.lit(0).cast("bigint"))).alias("taken")),
        "trie-plan",
    )
    own = lookup(turns.where(F.col("pos") >= h), plan.select("conv_id", "taken"), "conv_id").select(
        "conv_id", (F.col("pos") - h + F.col("taken")).alias("pos"), "turn_id", "chars"
    )
    lent = plan.where("taken > 0").join(heads, "family").where("pos < taken").select(*own.columns)
    return written(own.unionByName(lent), "trie-rebuilt"), plan.select("conv_id")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = written(ordered_turns(table(spark, sf_dir, "conversations")), "trie-turns")
    return prefix_trie(*rebuilt(turns)).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )


ORACLE = r"""
WITH own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS nr
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (
  SELECT DISTINCT conv_id, xor(4294967295, list_reduce(
    list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
    lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)),
      lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))) % 6 AS h
  FROM own),
sized AS (
  SELECT i.conv_id, i.h, least(i.h, (SELECT count(*) FROM own o WHERE o.conv_id = i.conv_id - i.conv_id % 100)) AS taken
  FROM ids i),
turns AS (
  SELECT s.conv_id, o.nr AS pos, o.role, o.text
  FROM sized s JOIN own o ON o.conv_id = s.conv_id - s.conv_id % 100 AND o.nr <= s.taken
  UNION ALL
  SELECT s.conv_id, o.nr - s.h + s.taken, o.role, o.text
  FROM sized s JOIN own o ON o.conv_id = s.conv_id AND o.nr > s.h),
lists AS (
  SELECT i.conv_id, coalesce(list(sha256(length(t.role) || ':' || t.role || t.text) ORDER BY t.pos)
           FILTER (WHERE t.pos IS NOT NULL), []) AS seq,
         coalesce(list(length(t.text) ORDER BY t.pos) FILTER (WHERE t.pos IS NOT NULL), []) AS chars
  FROM ids i LEFT JOIN turns t USING (conv_id) GROUP BY i.conv_id),
ways AS (
  SELECT conv_id, unnest(range(len(seq) + 1)) AS depth, seq, chars FROM lists),
members AS (
  SELECT conv_id, depth, len(seq) = depth AS stops,
         CASE WHEN depth = 0 THEN 0 ELSE chars[depth] END AS chars,
         sha256(array_to_string(list_slice(seq, 1, depth), ',') || depth) AS node,
         CASE WHEN depth > 0 THEN sha256(array_to_string(list_slice(seq, 1, depth - 1), ',') || (depth - 1)) END AS parent
  FROM ways),
nodes AS (
  SELECT node, any_value(parent) AS parent, any_value(depth) AS depth, min(conv_id) AS conv_id,
         count(*) AS n_convs, (count(*) - 1) * any_value(chars) AS saves,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE stops), '')) AS ends_sha256
  FROM members GROUP BY node),
children AS (SELECT parent AS node, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
below AS (
  SELECT up.node, count(*) FILTER (WHERE c.n IS NULL) AS n_leaves, sum(n.saves) AS saves
  FROM nodes n JOIN members m ON m.conv_id = n.conv_id AND m.depth <= n.depth
  JOIN nodes up ON up.node = m.node LEFT JOIN children c ON c.node = n.node
  GROUP BY up.node)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children,
       b.n_leaves, b.saves::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n LEFT JOIN nodes p ON p.node = n.parent LEFT JOIN children c ON c.node = n.node
JOIN below b ON b.node = n.node
"""
