"""Chat formatting with Spark expressions.

Turns are collected as structs, sorted, adjacent turns of one role merged into a block, and
the blocks concatenated:

    <s>[INST]role[/INST]text[SEP]text</s><s>[INST]...

``[SEP]`` stands where two turns of a block meet, so merging loses nothing. Inside texts
and roles a look-alike of a control string gets a backslash behind its first character, and
one that already has backslashes there gets one more; reading back takes one away. No other
character changes. The loss mask lists the code point ranges of the assistant's texts.

A conversation is formatted in parts: ``PART`` consecutive turn numbers, and no more than
``PART`` rows of them, as any number of rows may have one turn number, or none, or one
conv_id. So a conversation of any length is many rows of bounded size; the parts, numbered
from 0, are the whole one after another. A block that runs over a part's border is left open
there, and its header is repeated behind the border.

Defined results
    NULL role and NULL text count as empty; NULL turn comes first; turns with equal numbers
    are ordered by role, then text, and all stay, as do repeated rows. A role that is not
    ``assistant`` carries no loss. NULL conv_id is a conversation of its own. Empty tables
    give no rows; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewtide.llm import kernels
from viewtide.llm.positions import running
from viewtide.llm.tables import only, table, written
from viewtide.operators.lookup import lookup

PART = 256
LOSS_ROLE = "assistant"
# Control strings without their first character; each begins with < or [.
_TAILS = r"/?(?:s>|INST\]|SEP\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*" + _TAILS + ")", r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*" + _TAILS + ")", "$1$2")


def _pieces() -> Column:
    """The part as structs (text, loss): headers, texts and ends in their order."""
    n = F.size("turns")

    def piece(i: Column) -> Column:
        turn = F.get("turns", i)
        role = turn["role"]
        merges = (i > 0) & (F.get("turns", i - 1)["role"] == role)
        carries = (i == 0) & (F.col("_before") == role)
        goes_on = F.when(i < n - 1, F.get("turns", i + 1)["role"] == role).otherwise(
            F.coalesce(F.col("_after") == role, F.lit(False))
        )
        header = F.concat(F.lit("[INST]"), escape(role), F.lit("[/INST]"))
        start = (
            F.when(merges, F.lit("[SEP]"))
            .when(carries, header)
            .otherwise(F.concat(F.lit("<s>"), header))
        )
        end = F.when(goes_on, F.lit("")).otherwise(F.lit("</s>"))
        return F.struct(
            start.alias("start"), escape(turn["text"]).alias("text"), end.alias("end"),
            (role == LOSS_ROLE).alias("loss"),
        )

    return F.transform(F.sequence(F.lit(0), n - 1), piece)


def _key(*columns: str) -> Column:
    """One text for the columns, NULL apart from any value."""
    return F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in columns])


def _placed(rows: DataFrame) -> DataFrame:
    """The rows as conv_id, block, sub, turn, role, text: ``block`` is a range of turn
    numbers, ``sub`` the place in it of a row beyond the first ``PART``."""
    plain = only(rows, ["conv_id", "turn", "role", "text"]).select(
        "conv_id", F.floor(F.col("turn") / PART).cast("bigint").alias("block"), "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).withColumn("_block", _key("conv_id", "block"))
    crowded = written(
        plain.groupBy("_block").agg(F.count("*").alias("n")).where(F.col("n") > PART)
        .select("_block", F.lit(True).alias("_crowded")),
        "chat-crowded",
    )
    named = ["conv_id", "block", "turn", "role", "text"]
    usual = F.lit(0).cast("bigint").alias("sub")
    if crowded.isEmpty():
        return plain.select(*named, usual)
    told = lookup(plain, crowded, "_block")
    dealt = running(told.where("_crowded"), ["_block"], [F.col("turn").asc_nulls_first(), "role", "text"])
    sub = F.floor(F.col("_at") / PART).cast("bigint").alias("sub")
    return told.where("_crowded IS NULL").select(*named, usual).unionByName(dealt.select(*named, sub))


def format_conversations(rows: DataFrame) -> DataFrame:
    """conv_id, part, formatted, loss (array of begin and length in code points)."""
    placed = _placed(rows).withColumn("_piece", _key("conv_id", "block", "sub"))
    turn = F.struct("turn", "role", "text")
    parts = placed.groupBy("_piece").agg(
        F.first("conv_id").alias("conv_id"), F.sort_array(F.collect_list(turn)).alias("turns")
    )
    beside = parts.join(_borders(placed), "_piece")
    merged = beside.withColumn("_pieces", _pieces())
    formatted = F.array_join(
        F.transform("_pieces", lambda p: F.concat(p["start"], p["text"], p["end"])), ""
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<begin:int,length:int>>").alias("spans"))
    spans = F.aggregate(
        "_pieces", start,
        lambda acc, p: F.struct(
            (acc["at"] + F.length(p["start"]) + F.length(p["text"]) + F.length(p["end"])).alias("at"),
            F.when(
                p["loss"],
                F.concat(acc["spans"], F.array(F.struct(
                    (acc["at"] + F.length(p["start"])).alias("begin"),
                    F.length(p["text"]).alias("length"),
                ))),
            ).otherwise(acc["spans"]).alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    return merged.select("conv_id", "part", formatted.alias("formatted"), spans.alias("loss"))


def _borders(placed: DataFrame) -> DataFrame:
    """For every part its number in the conversation, the last role before it and the first
    one after it; texts are not read for that."""
    ends = placed.groupBy("_piece").agg(
        F.first("conv_id").alias("conv_id"), F.first("block").alias("block"), F.first("sub").alias("sub"),
        F.min(F.struct("turn", "role")).alias("low"), F.max(F.struct("turn", "role")).alias("high"),
    ).select("_piece", _key("conv_id").alias("_conv"), "block", "sub",
             F.col("low.role").alias("first"), F.col("high.role").alias("last"))
    numbered = written(
        running(ends, ["_conv"], [F.col("block").asc_nulls_first(), "sub"]).withColumnRenamed("_at", "part"),
        "chat-parts",
    )
    before = numbered.select("_conv", (F.col("part") + 1).alias("part"), F.col("last").alias("_before"))
    after = numbered.select("_conv", (F.col("part") - 1).alias("part"), F.col("first").alias("_after"))
    here = numbered.select("_piece", "_conv", "part")
    return here.join(before, ["_conv", "part"], "left").join(after, ["_conv", "part"], "left").select(
        "_piece", "part", "_before", "_after"
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, part, turns (structs of role and text), loss texts, formatted_chars."""
    blocks = F.slice(F.split("formatted", r"\[INST\]"), 2, 2_000_000_000)

    def turns(block: Column) -> Column:
        halves = F.split(block, r"\[/INST\]", 2)
        role = unescape(F.get(halves, F.lit(0)))
        body = F.regexp_replace(F.get(halves, F.lit(1)), r"(?:</s>)?(?:<s>)?\z", "")
        return F.transform(
            F.split(body, r"\[SEP\]"),
            lambda t: F.struct(role.alias("role"), unescape(t).alias("text")),
        )

    masked = F.transform(
        "loss", lambda s: unescape(F.substring(F.col("formatted"), s["begin"] + 1, s["length"]))
    )
    return formatted.select(
        "conv_id", "part", F.flatten(F.transform(blocks, turns)).alias("turns"),
        masked.alias("loss"), F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation and part: hashes run on from part to part, so a long
    conversation is never held whole."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    started, key, done = False, None, []

    def close() -> None:
        done.append((key, counts[0], turns.hexdigest(), counts[1], loss.hexdigest(), counts[2]))

    for batch in batches:
        kind = batch.column("conv_id").type
        for conv, n, said, masked, chars in zip(*[
            batch.column(c).to_pylist() for c in ("conv_id", "n", "said", "masked", "chars")
        ]):
            if not started or conv != key:
                if started:
                    close()
                started, key = True, conv
                turns, loss, counts = hashlib.sha256(), hashlib.sha256(), [0, 0, 0]
            turns.update(said.encode())
            loss.update(masked.encode())
            counts = [counts[0] + n, counts[1] + len(masked), counts[2] + chars]
        if done:
            columns = list(zip(*done))
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], kind), *[pa.array(c) for c in columns[1:]]], names
            )
            done.clear()
    if started:
        close()
        columns = list(zip(*done))
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], kind), *[pa.array(c) for c in columns[1:]]], names
        )


def digests(formatted: DataFrame) -> DataFrame:
    """One row per conversation, read back from the formatted parts."""
    back = read_back(formatted).select(
        "conv_id", "part", F.size("turns").cast("bigint").alias("n"),
        F.array_join(F.transform(
            "turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
        ), "").alias("said"),
        F.array_join("loss", "").alias("masked"), F.col("formatted_chars").alias("chars"),
    )
    kind = dict(formatted.dtypes)["conv_id"]
    return back.repartition("conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(
        kernels.lean(_digests, whole=True),
        f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, "
        "loss_sha256 string, formatted_chars long",
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    says = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-7, 0, "user", says), (-7, 1, "assistant", says)],
        "conv_id long, turn long, role string, text string",
    )
    rows = only(table(spark, sf_dir, "conversations"), extra.columns).unionByName(extra)
    return digests(written(format_conversations(rows), "chat"))


ORACLE = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
parts AS (
  SELECT *, (floor(turn / 256), (row_number() OVER (
           PARTITION BY conv_id, floor(turn / 256) ORDER BY turn NULLS FIRST, role, text) - 1) // 256) AS part,
         regexp_replace(role, '([<\[])(\\*/?(?:s>|INST\]|SEP\]))', '\1\\\2', 'g') AS erole,
         regexp_replace(text, '([<\[])(\\*/?(?:s>|INST\]|SEP\]))', '\1\\\2', 'g') AS etext FROM rows),
sides AS (
  SELECT *, lag(role) OVER w AS before, lag(part) OVER w AS part_before,
         lead(role) OVER w AS after
  FROM parts WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
pieces AS (
  SELECT *, CASE
      WHEN before IS DISTINCT FROM role THEN length('<s>[INST][/INST]') + length(erole)
      WHEN part_before IS DISTINCT FROM part THEN length('[INST][/INST]') + length(erole)
      ELSE length('[SEP]') END
    + length(etext) + CASE WHEN after IS NOT DISTINCT FROM role THEN 0 ELSE length('</s>') END AS chars
  FROM sides)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM pieces GROUP BY conv_id
"""
