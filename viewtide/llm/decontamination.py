"""Benchmark decontamination by spaced-seed hashing.

A seed looks at some of the words in a short window and ignores the others, so it still
hits where an ignored word was replaced. The masks are fixed for each length of item, and
they are enough: whichever words of an overlap differ, a mask fits beside them. Hashes of every window of
every document meet those of the benchmark items in one join; a hit fixes how document and
item lie against each other, and along that alignment the words themselves are compared:
an overlap counts when a window of ``WINDOW`` words (the whole item, if shorter) has at
least ``SIMILAR`` of its words equal.

Words are runs of letters and digits in lower case. Only DataFrame functions run, and
texts are never shuffled: hashes are made and looked up where a document is read, and what
travels is a row for each alignment. Items with the same words are one until the end.

Defined results
    NULL or empty texts have no words and no overlaps. Items of fewer words than the
    parameter ``least_words`` says are not looked for: 5 by default, since shorter ones stand
    in clean documents by chance; 1 looks for all, those under 5 words exactly.
    Repeated items each give rows; repeated documents each give rows (one for each doc_id
    and text). Empty tables: no rows. Extra columns are not read; NULL ids stay NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewtide.llm.tables import SENT_BYTES, only, sent, table, written
from viewtide.operators.lookup import fits_broadcast

# Offsets of the words that a mask looks at, by the number of words of the item, or of the
# window of a longer one. Found by search and proven by enumeration in the tests: of each
# way to replace as many words as SIMILAR allows, a mask laid somewhere meets none.
MASKS = {
    1: ((0,),),
    2: ((0, 1),),
    3: ((0, 1, 2),),
    4: ((0, 1, 2, 3),),
    5: ((0, 1, 2, 3), (0, 2, 3, 4), (0, 1, 3, 4), (0, 1, 2, 4)),
    6: ((0, 1, 2, 3), (0, 1, 3, 4)),
    7: ((0, 1, 2, 3, 4), (0, 1, 3, 4, 5), (0, 1, 2, 3, 5)),
    8: ((0, 1, 2, 3, 4, 5), (0, 1, 3, 4, 5, 6), (0, 1, 2, 3, 5, 6)),
    9: ((0, 1, 2, 3, 5, 6), (0, 1, 3, 4, 5, 6)),
    10: ((0, 1, 2, 4, 5), (0, 1, 3, 5, 6), (0, 1, 2, 5, 6)),
    11: ((0, 1, 2, 3, 5, 6), (0, 1, 5, 6, 7, 8), (0, 1, 3, 4, 8, 9)),
    12: ((0, 1, 2, 4, 6, 7), (0, 1, 3, 5, 6, 7), (0, 1, 2, 5, 8, 9)),
    13: ((0, 1, 2, 4, 6, 7), (0, 1, 3, 6, 7, 8)),
    14: ((0, 1, 2, 4, 7, 8), (0, 1, 3, 6, 7, 8)),
    15: ((0, 1, 2, 3, 5, 6), (0, 1, 3, 4, 5, 6), (0, 1, 2, 4, 9, 10)),
}
LEAST_WORDS = 5
WINDOW = 15
SIMILAR = 0.8


def words(name: str = "text") -> Column:
    lower = F.lower(F.coalesce(F.col(name).cast("string"), F.lit("")))
    return F.array_remove(F.split(lower, r"[^\p{L}\p{N}]+"), "")


def _seeds(df: DataFrame, masks: list[tuple[int, ...]], *keep: str) -> DataFrame:
    """A row (keep..., at, mask, seed) for every place and mask that fits into ``words``.

    The words' hashes stand beside themselves, moved by each offset in use, so a place's
    words are one row and its seeds are hashed in generated code.
    """
    hashed = df.select(
        *keep, F.transform("words", lambda w: F.xxhash64(w)).alias("_hash")
    )
    moved = [
        F.slice("_hash", o + 1, 2_000_000_000).alias(f"w{o}")
        for o in sorted({o for offsets in masks for o in offsets})
    ]
    places = hashed.select(*keep, F.posexplode(F.arrays_zip(*moved)).alias("at", "_w"))
    seeds = F.array(*[
        F.when(
            F.col(f"_w.w{offsets[-1]}").isNotNull(),
            F.xxhash64(F.lit(mask), *[F.col(f"_w.w{o}") for o in offsets]),
        )
        for mask, offsets in enumerate(masks)
    ])
    return places.select(*keep, "at", F.posexplode(seeds).alias("mask", "seed")).where(
        "seed IS NOT NULL"
    )


def benchmark_words(items: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """item_id, _item (tells the words apart), words and _length (of the window)."""
    return written(
        only(items, ["item_id", "text"]).select("item_id", words().alias("words"))
        .where(F.size("words") >= F.lit(max(least_words, 1)))
        .withColumn("_item", F.xxhash64("words"))
        .withColumn("_length", F.least(F.size("words"), F.lit(WINDOW))),
        "bench-words",
    )


def benchmark_seeds(contents: DataFrame) -> tuple[DataFrame, list[tuple[int, ...]]]:
    """Seeds of the items, and the masks in use: those of the lengths that occur."""
    # At most a row for each entry of MASKS.
    lengths = [r["_length"] for r in contents.select("_length").distinct().collect()]
    masks = sorted({m for n in lengths for m in MASKS[n]}) or [MASKS[WINDOW][0]]
    seeds = _seeds(contents, masks, "_item", "_length")
    wanted = F.lit(False)
    for n in lengths:
        own = [masks.index(m) for m in MASKS[n]]
        wanted = wanted | ((F.col("_length") == n) & F.col("mask").isin(own))
    return seeds.where(wanted).select("_item", F.col("at").alias("item_at"), "seed"), masks


def _document_key() -> list[Column]:
    """Tells rows apart without their texts; equal rows share it, and their results."""
    return [
        F.coalesce(F.col("doc_id").cast("string"), F.lit("-")).alias("_id"),
        F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("_text"),
    ]


def _found(docs: DataFrame, items: DataFrame) -> DataFrame:
    """A row for each document and ``_item`` of ``benchmark_words`` that overlap, at their best
    alignment."""
    contents = items.dropDuplicates(["_item"])
    seeds, masks = benchmark_seeds(contents)
    seeds = sent(written(seeds, "bench-seeds"))
    texts = contents.select("_item", F.col("words").alias("item_words"))

    source = only(docs, ["doc_id", "text"])
    worded = source.select(*_document_key(), words().alias("words"))
    hits = _seeds(worded, masks, "_id", "_text").join(seeds, "seed")
    alignments = written(
        hits.groupBy("_id", "_text", "_item", (F.col("at") - F.col("item_at")).alias("shift"))
        .agg(F.count("*").alias("seeds")),
        "bench-alignments",
    )
    suspects = alignments.select("_id", "_text").distinct()
    suspects = sent(suspects)
    suspected = written(
        source.select("doc_id", "text", *_document_key())
        .join(suspects, ["_id", "_text"], "left_semi")
        .dropDuplicates(["_id", "_text"])
        .select("_id", "_text", "doc_id", words().alias("words")),
        "bench-suspects",
    )
    # The measure sees text, not arrays of it.
    as_text = texts.select("_item", F.array_join("item_words", "").alias("t"))
    words_more = 24 * (texts.agg(F.sum(F.size("item_words"))).first()[0] or 0)
    if fits_broadcast(as_text, SENT_BYTES - words_more):
        texts = F.broadcast(texts)
    pairs = alignments.join(texts, "_item").join(suspected, ["_id", "_text"])
    equal = F.transform(
        F.sequence(F.lit(0), F.size("item_words") - 1),
        lambda j: F.coalesce(
            F.get("words", F.col("shift") + j) == F.get("item_words", j), F.lit(False)
        ).cast("int"),
    )
    window = F.least(F.size("item_words"), F.lit(WINDOW))
    sums = F.transform(
        F.sequence(F.lit(0), F.size("item_words") - window),
        lambda s: F.struct(
            F.aggregate(F.slice("_equal", s + 1, window), F.lit(0), lambda a, b: a + b).alias("n"),
            (-s).alias("s"),
        ),
    )
    scored = (
        pairs.withColumn("_equal", equal)
        .withColumn("_best", F.array_max(sums))
        .select(
            "_id", "_text", "doc_id", "_item", "shift",
            window.cast("bigint").alias("window_words"),
            F.col("_best.n").cast("bigint").alias("equal_words"),
            (F.col("shift") - F.col("_best.s")).cast("bigint").alias("at_word"),
        )
        .withColumn("similarity", F.col("equal_words") / F.col("window_words"))
        .where(F.col("similarity") >= SIMILAR)
    )
    best = F.max(F.struct("similarity", (-F.col("at_word")).alias("a"), "window_words", "equal_words"))
    return scored.groupBy("_id", "_text", "doc_id", "_item").agg(best.alias("b")).select(
        "_id", "_text", "doc_id", "_item", (-F.col("b.a")).alias("at_word"),
        "b.window_words", "b.equal_words", "b.similarity",
    )


def contaminated(docs: DataFrame, items: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """A row for each document and item that overlap, at their best alignment.

    doc_id, item_id, at_word (where the best window starts in the document), window_words,
    equal_words, similarity.
    """
    worded = benchmark_words(items, least_words)
    ids = sent(worded.select("_item", "item_id"))
    return _found(docs, worded).join(ids, "_item").select(
        "doc_id", "item_id", "at_word", "window_words", "equal_words", "similarity"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``docs`` without those that overlap a benchmark item."""
    items = benchmark_words(table(spark, sf_dir, "benchmark"))
    found = written(_found(docs, items).select("_id", "_text").distinct(), "bench-found")
    found = sent(found)
    names = [F.col(f"`{n}`") for n in docs.columns]
    rows = docs.select(F.struct(*names).alias("_row"), *_document_key())
    return rows.join(found, ["_id", "_text"], "left_anti").select("_row.*")


# Without seeds: words that are equal are counted by alignment, and every alignment with as many
# as the window needs is looked at, window by window.
ORACLE = r"""
WITH d AS (
  SELECT DISTINCT doc_id, text AS key,
         list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w
  FROM documents),
dk AS (SELECT row_number() OVER () AS k, * FROM d),
bl AS (
  SELECT *, least(len(w), 15) AS size FROM (
    SELECT DISTINCT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w
    FROM benchmark)
  WHERE len(w) >= 5),
dp AS (SELECT k, unnest(w) AS word, unnest(range(len(w))) AS i FROM dk),
bp AS (SELECT item_id, size, unnest(w) AS word, unnest(range(len(w))) AS j FROM bl),
al AS (
  SELECT k, item_id, i - j AS shift FROM dp JOIN bp USING (word)
  GROUP BY ALL HAVING count(*) >= ceil(0.8 * any_value(size))),
win AS (
  SELECT al.k, al.item_id, shift, bl.w AS iw, dk.w AS dw, size,
         unnest(range(len(bl.w) - size + 1)) AS s
  FROM al JOIN bl ON bl.item_id IS NOT DISTINCT FROM al.item_id JOIN dk ON dk.k = al.k),
counted AS (
  SELECT k, item_id, (shift + s)::BIGINT AS at_word, size::BIGINT AS window_words,
         list_sum([CASE WHEN shift + s + n >= 0 AND dw[shift + s + n + 1] = iw[s + n + 1] THEN 1 ELSE 0 END
                   FOR n IN range(size)])::BIGINT AS equal_words
  FROM win),
best AS (
  SELECT * FROM counted WHERE equal_words / window_words >= 0.8
  QUALIFY row_number() OVER (PARTITION BY k, item_id
                             ORDER BY equal_words / window_words DESC, at_word, equal_words DESC) = 1)
SELECT doc_id, item_id, at_word, window_words, equal_words, equal_words / window_words AS similarity
FROM best JOIN dk USING (k)
"""
