"""Removing long repeated strings by merging Burrows-Wheeler transforms of shards.

A byte goes if a string of ``LENGTH`` bytes over it also starts anywhere else. Suffixes
need not be sorted for that, only those strings, and of them only the ones that can have an
equal:

1.  *Anchors.* Of each string's 32-byte pieces the one with the smallest hash (the
    leftmost of them) is its anchor. Equal strings have equal anchors at the same place, so
    the strings of one anchor are compared among themselves. Neighbouring strings mostly
    share their anchor; together they are a *context*, up to 368 bytes with the anchor in
    columns 168 to 199.
2.  *Equal contexts* are counted. One that occurs twice is repeated from end to end, and
    stands for all its copies from here on. An anchor with one context is done.
3.  *Transforms.* The contexts of the other anchors are dealt to tasks by anchor and there
    cut into shards. A shard's transform holds, column by column, the bytes of its rows in
    the order of the columns before, read backwards: a Burrows-Wheeler transform that
    starts anew at each anchor (a positional one).
4.  *Merging.* The interleave of all shards starts shard by shard. For each column the next
    bytes are taken from the shards' transforms in the interleave's order, and the
    interleave is stably parted by them: one refinement, without looking at a suffix. Where
    neighbours of the merged order stop matching is carried along, so each column shows
    the intervals of rows that share the ``LENGTH`` bytes before it: the repeats.
    An anchor with more contexts than ``MOST_CONTEXTS`` (a passage that very many texts put
    between words of their own) would be too much for one task. Its strings are counted by
    hash instead, combined before they are shuffled: the same intervals, found by key.
5.  What was found for a context goes back to its occurrences, and each document is cut.

Only step 1 and the cutting read all texts. Texts travel for one occurrence of each
context that has to be compared, and for documents with repeats when their spans are too
many to broadcast.

Defined results
    NULL and empty texts: 0 bytes, nothing removed, the digest of nothing. Texts shorter
    than ``LENGTH`` keep all. Repeated rows are documents like others and so repeat each
    other. Runs of one byte repeat themselves. NULL ids stay NULL. Empty tables: no rows.
    Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewtide.llm import kernels
from viewtide.llm.tables import only, sent, table, written

LENGTH = 200
PIECE = 32
REACH = LENGTH - PIECE  # an anchor's column
COLUMNS = REACH + LENGTH
SHARD_ROWS = 2_048
TASK_ROWS = 8_192
# An anchor with more contexts than a task should hold has its strings counted one by one.
MOST_CONTEXTS = 100_000
# Never part of UTF-8: fills the columns that a context does not have.
_FILL = 0xFF
_FAR = np.int32(1 << 30)
# Windows are looked through in stretches of this many bytes.
STRETCH = 1 << 24


def _sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    n = len(values)
    fill = (-n) % width
    rows = np.concatenate([values, np.full(fill, np.iinfo(np.uint64).max, np.uint64)])
    rows = rows.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def contexts(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """(anchor hash, context hash, first byte, strings, copies, place of the anchor) of all
    contexts of the documents; a context that follows itself at once is one entry."""
    none = np.zeros(0, np.int64)
    starts = kernels.gather(at[:-1], np.maximum(np.diff(at) - LENGTH, 0))
    if not len(starts):
        return none.view(np.uint64), none.view(np.uint64), none, none, none, none
    rolling = kernels.Rolling(data)
    pieces = rolling.every(PIECE)
    anchor = np.empty(len(data) - LENGTH + 1, np.int64)
    low = np.uint64((1 << 28) - 1)
    for first in range(0, len(anchor), STRETCH):
        some = pieces[first : first + STRETCH + REACH]
        packed = (some & ~low) | np.arange(len(some), dtype=np.uint64)
        place = (_sliding_minimum(packed, REACH + 1) & low).astype(np.int64) + first
        anchor[first : first + len(place)] = place
    chosen = anchor[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (starts[1:] != starts[:-1] + 1)
    head = np.flatnonzero(new)
    begin = starts[head]
    strings = np.diff(np.append(head, len(starts)))
    place = chosen[head]
    anchors = pieces[place]
    wholes = rolling.of(begin, begin + strings + LENGTH - 1)
    # Runs of one context right behind itself: texts that go on repeating themselves.
    same = np.zeros(len(begin), bool)
    same[1:] = (anchors[1:] == anchors[:-1]) & (wholes[1:] == wholes[:-1]) & (
        begin[1:] == begin[:-1] + strings[:-1]
    ) & (strings[1:] == strings[:-1])
    head = np.flatnonzero(~same)
    copies = np.diff(np.append(head, len(begin)))
    return anchors[head], wholes[head], begin[head], strings[head], copies, (place - begin)[head]


def transform(rows: np.ndarray) -> np.ndarray:
    """The positional transform of a shard: for each column its bytes, in the order of the
    columns before it read backwards."""
    order = np.arange(len(rows))
    out = np.empty((rows.shape[1], len(rows)), np.uint8)
    for k in range(rows.shape[1]):
        out[k] = rows[order, k]
        order = order[np.argsort(out[k], kind="stable")]
    return out


def merge(
    shards: list[np.ndarray], begin: np.ndarray, end: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The first and the end column that repeats cover in each row, -1 without any.

    ``shards`` are transforms; ``begin`` and ``end`` say which columns each row has, rows in
    the order in which the shards hold them.
    """
    n = sum(s.shape[1] for s in shards)
    shard = np.repeat(np.arange(len(shards), dtype=np.uint16), [s.shape[1] for s in shards])
    row = np.arange(n)
    left = np.empty((n, LENGTH), np.uint8)

    def column(k: int) -> np.ndarray:
        """The bytes of column ``k`` in the merged order, each shard's read in its own."""
        out = np.empty(n, np.uint8)
        out[np.argsort(shard, kind="stable")] = np.concatenate([s[k] for s in shards])
        return out

    for k in range(LENGTH):
        symbol = column(k)
        left[row, k] = symbol
        refined = np.argsort(symbol, kind="stable")
        shard, row = shard[refined], row[refined]
    # From which column on a row matches the one before it in the merged order.
    ordered = left[row]
    equal = (ordered[1:] == ordered[:-1])[:, ::-1]
    common = np.where(equal.all(1), LENGTH, equal.argmin(1)) if n > 1 else np.zeros(0, int)
    since = np.concatenate([[_FAR], LENGTH - common]).astype(np.int32)
    since[since > REACH] = _FAR  # not even the anchor
    first, last = np.full(n, -1), np.full(n, -1)
    for k in range(LENGTH, COLUMNS + 1):
        pair = since <= k - LENGTH
        shared = pair.copy()
        shared[:-1] |= pair[1:]
        who = row[shared]
        who = who[(begin[who] <= k - LENGTH) & (k <= end[who])]
        first[who] = np.where(first[who] < 0, k - LENGTH, first[who])
        last[who] = k
        if k == COLUMNS or not (since < _FAR).any():
            break
        symbol = column(k)
        refined = np.argsort(symbol, kind="stable")
        # Rows that meet now match since the latest of what lay between them.
        block = np.cumsum(since == _FAR)
        before, after = refined[:-1], refined[1:]
        meet = (symbol[before] == symbol[after]) & (block[before] == block[after])
        then = np.full(n, _FAR, np.int32)
        if meet.any():
            span = (after - before)[meet]
            between = since[kernels.gather(before[meet] + 1, span)]
            then[1:][meet] = np.maximum.reduceat(between, np.cumsum(span) - span)
        shard, row, since = shard[refined], row[refined], then
    return first, last


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return only(docs, ["doc_id", "text"]).select(
        "doc_id", text.alias("text"),
        F.xxhash64(text).alias("text_key"), F.xxhash64("doc_id").alias("id_key"),
    )


def _all_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = [batch.column(c).to_numpy() for c in ("text_key", "id_key")]
        for first, end, data, at in kernels.slices(batch.column("text")):
            anchor, whole, begin, strings, copies, place = contexts(data, at)
            document = np.searchsorted(at, begin, "right") - 1
            yield pa.RecordBatch.from_arrays([
                pa.array(anchor.view(np.int64)), pa.array(whole.view(np.int64)),
                pa.array(keys[0][first + document]), pa.array(keys[1][first + document]),
                pa.array((begin - at[document]).astype(np.int32)), pa.array(strings.astype(np.int32)),
                pa.array(copies.astype(np.int32)), pa.array(place.astype(np.int32)),
            ], ["anchor", "whole", "text_key", "id_key", "begin", "strings", "copies", "place"])


_CONTEXT = ("anchor long, whole long, text_key long, id_key long, begin int, strings int, "
            "copies int, place int")


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted contexts of each text; of equal rows in a task the first is cut."""
    done: set[tuple[int, int]] = set()
    for batch in batches:
        data, at = kernels.text_bytes(batch.column("text"))
        data = memoryview(data)
        keys = zip(*(batch.column(c).to_pylist() for c in ("text_key", "id_key")))
        for i, (key, wanted) in enumerate(zip(keys, batch.column("wanted"))):
            if key in done:
                continue
            done.add(key)
            rows = wanted.values
            begin, strings = (rows.field(c).to_numpy() for c in ("begin", "strings"))
            pieces = [
                data[at[i] + b : at[i] + b + s + LENGTH - 1].tobytes()
                for b, s in zip(begin.tolist(), strings.tolist())
            ]
            yield pa.RecordBatch.from_arrays([
                rows.field("anchor"), rows.field("whole"), rows.field("place"),
                pa.array(pieces, pa.binary()),
            ], ["anchor", "whole", "place", "bytes"])


def _compare(group: pa.Table) -> pa.Table:
    """Covered bytes of the contexts of some anchors, as offsets in each context."""
    # Equal rows of several tasks have brought the same contexts.
    contexts_ = np.stack([group[c].to_numpy() for c in ("anchor", "whole")])
    group = group.take(np.sort(np.unique(contexts_, axis=1, return_index=True)[1]))
    anchor, whole = (group[c].to_numpy() for c in ("anchor", "whole"))
    begin = REACH - group["place"].to_numpy().astype(np.int64)
    data, at = kernels.text_bytes(group["bytes"])
    lengths = np.diff(at)
    rows = np.full((len(anchor), COLUMNS), _FILL, np.uint8)
    rows[np.repeat(np.arange(len(anchor)), lengths), kernels.gather(begin, lengths)] = data
    shards = [transform(rows[i : i + SHARD_ROWS]) for i in range(0, len(rows), SHARD_ROWS)]
    first, last = merge(shards, begin, begin + lengths)
    hit = first >= 0
    return pa.table({
        "anchor": anchor[hit], "whole": whole[hit],
        "low": (first - begin)[hit].astype(np.int32), "high": (last - begin)[hit].astype(np.int32),
    })


def _strings_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for every string of the contexts: where it starts in its context, its hash."""
    for batch in batches:
        for first, end, data, at in kernels.slices(batch.column("bytes")):
            strings = np.maximum(np.diff(at) - LENGTH, 0)
            begin = kernels.gather(at[:-1], strings)
            owner = first + np.repeat(np.arange(end - first), strings)
            hashes = kernels.Rolling(data).of(begin, begin + LENGTH)
            yield pa.RecordBatch.from_arrays([
                batch.column("anchor").take(pa.array(owner)),
                batch.column("whole").take(pa.array(owner)),
                pa.array((begin - at[owner - first]).astype(np.int32)),
                pa.array(hashes.view(np.int64)),
            ], ["anchor", "whole", "low", "string"])


def _count_strings(cut: DataFrame) -> DataFrame:
    """What ``_compare`` finds, by counting each string of each context."""
    every = written(cut.select("anchor", "whole", "bytes").mapInArrow(
        kernels.lean(_strings_of), "anchor long, whole long, low int, string long"), "repeat-strings")
    twice = every.groupBy("anchor", "string").agg(F.count("*").alias("n")).where("n > 1")
    # All strings of a context share its anchor, so those between two repeats are covered.
    return every.join(twice, ["anchor", "string"]).groupBy("anchor", "whole").agg(
        F.min("low").alias("low"), (F.max("low") + LENGTH).alias("high")
    )


def repeated_contexts(docs: DataFrame, every: DataFrame) -> DataFrame:
    """anchor, whole, low and high (bytes covered) of the contexts with repeats; high is
    NULL where the whole context is one."""
    spot = F.struct("text_key", "id_key", "begin", "strings", "place")
    counted = (
        every.groupBy("anchor", "whole")
        .agg(F.sum("copies").alias("times"), F.min(spot).alias("spot"))
    )
    kinds = counted.groupBy("anchor").agg(F.count("*").alias("kinds"), F.sum("times").alias("all"))
    several = kinds.where("`all` > 1")
    known = written(counted.join(several, "anchor"), "repeat-known")
    whole = known.where("times > 1").select(
        "anchor", "whole", F.lit(0).alias("low"), F.lit(None).cast("int").alias("high")
    )
    compared, crowded = (
        known.where("kinds > 1").where(F.col("kinds") <= MOST_CONTEXTS),
        known.where(F.col("kinds") > MOST_CONTEXTS),
    )
    buckets = max(1, -(-compared.count() // TASK_ROWS))
    found = (
        _bytes_of(docs, compared).withColumn("bucket", F.pmod("anchor", F.lit(buckets)))
        .groupBy("bucket").applyInArrow(kernels.lean_group(_compare), "anchor long, whole long, low int, high int")
    )
    if not crowded.isEmpty():
        found = found.unionByName(_count_strings(_bytes_of(docs, crowded)))
    once = known.where("times = 1").select("anchor", "whole")
    return whole.unionByName(found.join(once, ["anchor", "whole"], "left_semi"))


def _bytes_of(docs: DataFrame, contexts_: DataFrame) -> DataFrame:
    """anchor, whole, place and bytes of the contexts, each cut from its one spot."""
    wanted = contexts_.select("spot.*", "anchor", "whole").groupBy("text_key", "id_key").agg(
        F.collect_list(F.struct("anchor", "whole", "place", "begin", "strings")).alias("wanted")
    )
    wanted = written(wanted, "repeat-wanted")
    n = wanted.agg(F.sum(F.size("wanted"))).first()[0] or 0
    wanted = sent(wanted, 40 * n)  # its arrays hold n spots
    return _keyed(docs).join(wanted, ["text_key", "id_key"]).select("text_key", "id_key", "text", "wanted").mapInArrow(
        kernels.lean(_cut_out), "anchor long, whole long, place int, bytes binary"
    )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What stays of each text, as its digest."""
    for batch in batches:
        data, at = kernels.text_bytes(batch.column("text"))
        view, removed, spans, digests = memoryview(data), [], [], []
        covered = batch.column("spans")
        for i in range(batch.num_rows):
            begin, end = int(at[i]), int(at[i + 1])
            digest, gone, runs, done = hashlib.sha256(), 0, 0, begin
            if covered[i].is_valid:
                pairs = np.frombuffer(covered[i].as_buffer(), np.int32).reshape(-1, 2)
                for low, high in pairs.tolist():
                    digest.update(view[done : begin + low])
                    gone, runs, done = gone + high - low, runs + 1, begin + high
            digest.update(view[done:end])
            removed.append(gone), spans.append(runs), digests.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), pa.array(np.diff(at)), pa.array(removed, pa.int64()),
            pa.array(spans, pa.int64()), pa.array(digests, pa.string()),
        ], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _union(group: pa.Table) -> pa.Table:
    """Maximal runs of covered bytes of one text."""
    low, high = (group[c].to_numpy().astype(np.int64) for c in ("low", "high"))
    order = np.argsort(low, kind="stable")
    low, reach = low[order], np.maximum.accumulate(high[order])
    new = np.ones(len(low), bool)
    new[1:] = low[1:] > reach[:-1]
    ends = reach[np.append(np.flatnonzero(new)[1:] - 1, len(low) - 1)]
    runs = np.stack([low[new], ends], 1).astype(np.int32)
    return pa.table({
        "text_key": group["text_key"][:1], "spans": pa.array([runs.tobytes()], pa.binary()),
    })


def repeated_spans(docs: DataFrame) -> DataFrame:
    """text_key and spans (int32 pairs: first byte, end) of the texts with repeats."""
    every = written(_keyed(docs).select("text", "text_key", "id_key").mapInArrow(
        kernels.lean(_all_contexts), _CONTEXT), "repeat-contexts")
    repeats = written(repeated_contexts(docs, every), "repeat-found")
    repeats = sent(repeats)
    end = F.coalesce(
        F.col("begin") + F.col("high"),
        F.col("begin") + F.col("strings") * F.col("copies") + (LENGTH - 1),
    )
    placed = every.join(repeats, ["anchor", "whole"]).select(
        "text_key", (F.col("begin") + F.col("low")).alias("low"), end.alias("high")
    ).distinct()
    return placed.groupBy("text_key").applyInArrow(kernels.lean_group(_union), "text_key long, spans binary")


def remove_repeats(docs: DataFrame) -> DataFrame:
    spans = written(repeated_spans(docs), "repeat-spans")
    spans = sent(spans)
    kind = dict(docs.dtypes)["doc_id"]
    joined = _keyed(docs).join(spans, "text_key", "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(
        kernels.lean(_cut), f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH coded AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n
  FROM documents),
places AS (
  SELECT doc_id, i, md5_number(substr(h, (2 * i + 1)::BIGINT, 400)) AS s
  FROM (SELECT doc_id, h, unnest(range(n - 199)) AS i FROM coded WHERE n >= 200)),
twice AS (SELECT s FROM places GROUP BY s HAVING count(*) > 1),
hits AS (
  SELECT doc_id, i, i > coalesce(lag(i) OVER w + 200, -1) AS new
  FROM places SEMI JOIN twice USING (s) WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
islands AS (
  SELECT doc_id, i, sum(new::INT) OVER (PARTITION BY doc_id ORDER BY i) AS nr FROM hits),
spans AS (SELECT doc_id, min(i) AS low, max(i) + 200 AS high FROM islands GROUP BY doc_id, nr),
gaps AS (
  SELECT s.doc_id, s.low,
         substr(h, (2 * coalesce(lag(high) OVER w, 0) + 1)::BIGINT,
                (2 * (low - coalesce(lag(high) OVER w, 0)))::BIGINT) AS kept
  FROM spans s JOIN coded USING (doc_id) WINDOW w AS (PARTITION BY s.doc_id ORDER BY s.low)),
cut AS (
  SELECT doc_id, string_agg(kept, '' ORDER BY low) AS kept FROM gaps GROUP BY doc_id),
total AS (
  SELECT doc_id, sum(high - low) AS removed, count(*) AS n_spans, max(high) AS stop
  FROM spans GROUP BY doc_id)
SELECT c.doc_id, c.n::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(h, (2 * coalesce(stop, 0) + 1)::BIGINT))) AS kept_sha256
FROM coded c LEFT JOIN cut USING (doc_id) LEFT JOIN total USING (doc_id)
"""
