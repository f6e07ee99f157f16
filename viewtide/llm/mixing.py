"""Mixing sources to target weights by hash-threshold histograms.

Every document has a fixed place on a 60-bit hash line. What a source contributes is a
prefix of that line, so a larger budget takes all that a smaller one took, and a rerun
takes the same. The prefix ends at a threshold found without sorting: sizes are summed by
source and hash bucket, the bucket in which the budget runs out is found from the sums,
and only that bucket is split into finer ones, until it holds one hash value. Rows at that
value are copies of one document; they are numbered, and the first of them are taken.

Only DataFrame functions run. Texts are read once; what follows works on four narrow
columns written to the shared folder.

Defined results
    NULL text, empty text or blanks only: size 0, taken 0.
    NULL source: a source of its own, after all others. NULL doc_id: an id like any other.
    The place follows from id and text. Rows equal in both share it, and if the budget runs out
    among them, as many are taken as bring their source nearest to its target.
    A source whose documents have no words: target 0. Empty table: no rows.
    Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewtide.llm.positions import running
from viewtide.llm.tables import WORD, only, table, written
from viewtide.operators.lookup import lookup

LEVEL_BITS = 12
LEVELS = 5
CYCLE = (5, 2, 1)
SHARE = (3, 2)  # the mix has 3/2 of all words
REPEATS = 2  # no source and no document counts more than twice


def place() -> Column:
    """A document's fixed place on the hash line, 0 to 2^60 - 1."""
    said = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("doc_id", "text")]
    digits = F.substring(F.md5(F.concat(said[0], F.lit(":"), F.md5(said[1]))), 1, 15)
    return F.conv(digits, 16, 10).cast("bigint")


def words() -> Column:
    """The size of a document."""
    return F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")


def _bucket(level: int) -> Column:
    """The hash down to this level: a bucket of the next level lies in one of this one."""
    return F.shiftright("place", LEVEL_BITS * (LEVELS - 1 - level))


def source_targets(
    sources: DataFrame,
    cycle: Sequence[int] = CYCLE,
    share: tuple[int, int] = SHARE,
    repeats: int = REPEATS,
) -> DataFrame:
    """``sources`` (source, source_size) with the words that the mix wants of each.

    Weights repeat along the sources in code point order. While a target exceeds
    ``repeats`` times its source, it stops there and the rest is shared anew by weight.
    """
    # Ranks without a window over all sources: partition offsets of a range-dealt sort.
    ranged = written(
        sources.repartitionByRange(F.col("source").asc_nulls_last())
        .sortWithinPartitions(F.col("source").asc_nulls_last())
        .select("*", F.monotonically_increasing_id().alias("_at")),
        "mix-sources",
    )
    part = F.shiftright("_at", 33)
    counts = {r["p"]: r["n"] for r in ranged.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect()}
    before, offsets = 0, []
    for p in sorted(counts):
        offsets += [F.lit(p).cast("bigint"), F.lit(before).cast("bigint")]
        before += counts[p]
    if not offsets:
        return ranged.drop("_at").withColumns({"weight": F.lit(1), "target": F.lit(0.0)})
    rank = F.create_map(*offsets)[part] + (F.col("_at") - F.shiftleft(part, 33))
    weights = F.array(*[F.lit(int(w)) for w in cycle])
    known = written(
        ranged.withColumn("weight", F.get(weights, (rank % len(cycle)).cast("int"))).drop("_at"),
        "mix-weights",
    )
    cap = F.col("source_size") * repeats
    total = known.agg(F.sum("source_size")).first()[0] or 0
    budget = total * share[0] / share[1]
    # Each round is one aggregate; at least one more source is full, else it is the last.
    level, full = 0.0, -1
    while True:
        stops = F.col("weight") * F.lit(level) >= cap
        row = known.agg(
            F.sum(F.when(stops, cap).otherwise(0)).alias("capped"),
            F.sum(F.when(stops, 0).otherwise(F.col("weight"))).alias("open"),
            F.sum(stops.cast("int")).alias("full"),
        ).first()
        if row["full"] == full or not row["open"]:
            break
        full, above, open_weight = row["full"], budget - row["capped"], row["open"]
        level = above / open_weight
    if full < 0:  # no source is open: nothing has words
        return known.withColumn("target", cap.cast("double"))
    share_of = F.col("weight") * F.lit(float(above)) / F.lit(float(open_weight))
    return known.withColumn("target", F.least(cap.cast("double"), share_of))


def thresholds(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """For each source: whole copies of every document, the hash below which one more copy
    is taken, and the words of it that are still wanted at that hash (``rest``).

    The sums of a level have at most 4096 rows a source; deeper levels read only the
    documents of the boundary buckets.
    """
    keyed = targets.select(
        F.coalesce(F.col("source"), F.lit("")).alias("_s"), F.col("source").isNull().alias("_n"),
        "source", "source_size", "target",
    )
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    state = written(
        keyed.withColumn("copies", F.coalesce(copies, F.lit(0)).cast("bigint"))
        .withColumn("want", F.col("target") - F.col("copies") * F.col("source_size"))
        .select("_s", "_n", "source_size", "target", "copies", "want",
                F.lit(0).cast("bigint").alias("bucket"), F.lit(0).cast("bigint").alias("before"),
                F.lit(False).alias("found")),
        "mix-level",
    )
    rows = sized.select(
        F.coalesce(F.col("source"), F.lit("")).alias("_s"), F.col("source").isNull().alias("_n"),
        "place", "size",
    )
    for level in range(LEVELS):
        finer = rows.withColumn("bucket", _bucket(level)).withColumn(
            "outer", F.shiftright("bucket", LEVEL_BITS) if level else F.lit(0).cast("bigint")
        )
        sums = finer
        if level:
            # A few documents a source are left: those of the boundary buckets.
            edge = state.where("found").select("_s", "_n", F.col("bucket").alias("outer"))
            sums = finer.join(edge, ["_s", "_n", "outer"], "left_semi")
        sums = sums.groupBy("_s", "_n", "outer", "bucket").agg(F.sum("size").alias("words"))
        # max_by over running sums needs no window: an array of at most 4096 sums a source.
        listed = sums.groupBy("_s", "_n").agg(
            F.array_sort(F.collect_list(F.struct("bucket", "words"))).alias("sums")
        )
        joined = state.join(listed, ["_s", "_n"], "left")
        start = F.struct(F.col("before").alias("sum"), F.lit(None).cast("bigint").alias("at"))
        # The first bucket that ends beyond the budget.
        walked = F.aggregate(
            "sums", start,
            lambda acc, b: F.when(
                acc["at"].isNull() & (acc["sum"] + b["words"] <= F.col("want")),
                F.struct((acc["sum"] + b["words"]).alias("sum"), acc["at"].alias("at")),
            ).when(
                acc["at"].isNull(), F.struct(acc["sum"].alias("sum"), b["bucket"].alias("at")),
            ).otherwise(acc),
        )
        here = joined.withColumn("_w", walked)
        active = (F.col("found") | F.lit(level == 0)) & F.col("sums").isNotNull()
        state = written(
            here.select(
                "_s", "_n", "source_size", "target", "copies", "want",
                F.when(active & F.col("_w.at").isNotNull(), F.col("_w.at"))
                .otherwise(F.col("bucket")).alias("bucket"),
                F.when(active, F.col("_w.sum")).otherwise(F.col("before")).alias("before"),
                F.coalesce(active & F.col("_w.at").isNotNull(), F.lit(False)).alias("found"),
            ),
            "mix-level",
        )
    # ``bucket`` is now one hash value, ``before`` the words below it. Not found: the whole
    # line fits.
    limit = F.when(F.col("found"), F.col("bucket")).otherwise(F.lit(1 << (LEVEL_BITS * LEVELS)))
    return state.select(
        F.when(~F.col("_n"), F.col("_s")).alias("source"), "source_size", "target", "copies",
        limit.alias("below"), (F.col("want") - F.col("before")).alias("rest"),
    )


def sized_documents(docs: DataFrame) -> DataFrame:
    """doc_id, source, size and place of every document; the only step that reads texts."""
    return only(docs, ["doc_id", "source", "text"]).select(
        "doc_id", F.col("source").cast("string").alias("source"), words().alias("size"),
        place().alias("place"),
    )


def mix_limits(sized: DataFrame, **plan) -> DataFrame:
    """For each source, under a NULL-free ``_key``: size, target, copies, threshold and rest."""
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    limits = written(thresholds(sized, source_targets(sources, **plan)), "mix-limits")
    return limits.select(
        _source_key().alias("_key"), "source_size", "target", "copies", "below", "rest"
    )


def _source_key() -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))


def _with_times(rows: DataFrame, limits: DataFrame, repeats: int) -> DataFrame:
    """``rows`` (with ``_key``, ``place`` and ``size``) with their source's limits and how
    often the mix has them. Rows at the threshold are counted one by one."""
    joined = lookup(rows, limits, "_key")
    edge = running(joined.where("place = below"), ["_key"], ["place"], sums=["size"])
    # One more is taken while that brings the source nearer to its target.
    nearer = 2 * F.col("size_before") + F.col("size") <= 2 * F.col("rest")
    taken = edge.withColumn("_more", nearer).select(*joined.columns, "_more").unionByName(
        joined.where("place <> below").withColumn("_more", F.col("place") < F.col("below"))
    )
    return taken.withColumn("times", F.least(F.col("copies") + F.col("_more").cast("bigint"), F.lit(repeats)))


def mix_sources(
    docs: DataFrame,
    cycle: Sequence[int] = CYCLE,
    share: tuple[int, int] = SHARE,
    repeats: int = REPEATS,
) -> DataFrame:
    """doc_id, source, size, source_size, target, times: how often the mix has each row."""
    sized = written(sized_documents(docs), "mix-sized")
    limits = mix_limits(sized, cycle=cycle, share=share, repeats=repeats)
    return _with_times(sized.withColumn("_key", _source_key()), limits, repeats).select(
        "doc_id", "source", "size", "source_size", "target", "times"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * F.col("times")).alias("taken"),
    )


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix: a row of ``docs`` for each time one is taken."""
    names = [F.col(f"`{n}`") for n in docs.columns]
    limits = mix_limits(written(sized_documents(docs), "mix-sized"))
    keyed = docs.select(
        F.struct(*names).alias("_row"), _source_key().alias("_key"), place().alias("place"),
        words().alias("size"),
    )
    chosen = _with_times(keyed, limits, REPEATS).where("times > 0")
    return (
        chosen.select("_row", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("_copy"))
        .select("_row.*")
    )


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS place,
         row_number() OVER () AS nr
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3
           WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM sized GROUP BY source),
ranked AS (
  SELECT *, sum(2 * source_size) OVER w AS capped, sum(weight) OVER w AS shut,
         row_number() OVER w AS nr
  FROM sources WINDOW w AS (ORDER BY 2.0 * source_size / weight, source NULLS LAST
                            ROWS UNBOUNDED PRECEDING)),
whole AS (SELECT sum(source_size) * 3 / 2.0 AS budget, sum(weight) AS weights FROM sources),
steps AS (
  SELECT 0 AS nr, 0::HUGEINT AS capped, 0::HUGEINT AS shut
  UNION ALL SELECT nr, capped, shut FROM ranked),
chosen AS (
  SELECT (budget - s.capped) AS above, weights - s.shut AS open
  FROM steps s, whole
  WHERE weights > s.shut AND NOT EXISTS (
    SELECT 1 FROM ranked r WHERE r.nr > s.nr
      AND r.weight * ((budget - s.capped) / (weights - s.shut)) >= 2 * r.source_size)
  ORDER BY s.nr LIMIT 1),
targets AS (
  SELECT source, source_size,
         coalesce(least(2.0::DOUBLE * source_size,
                        (SELECT weight * above::DOUBLE / open::DOUBLE FROM chosen)),
                  2.0::DOUBLE * source_size) AS target
  FROM sources),
plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS copies
  FROM targets),
prefix AS (
  SELECT nr, source, size,
         sum(size) OVER (PARTITION BY source ORDER BY place, nr ROWS UNBOUNDED PRECEDING) - size AS before
  FROM sized)
SELECT d.doc_id, d.size, p.source_size, p.target,
       (d.size * least(p.copies + CASE WHEN 2 * f.before + f.size <= 2 * (p.target - p.copies * p.source_size)
                                  THEN 1 ELSE 0 END, 2))::BIGINT AS taken
FROM sized d
JOIN plan p ON d.source IS NOT DISTINCT FROM p.source
JOIN prefix f ON f.nr = d.nr
"""
