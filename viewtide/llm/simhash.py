"""SimHash near-duplicates by exact comparison of tiles of fingerprints.

A document's fingerprint takes, bit by bit, the majority of the hashes of its word shingles.
Documents link when their fingerprints differ in at most ``RADIUS`` bits.

1.  Equal fingerprints are one class; everything below works on distinct fingerprints.
2.  The ``PARTS`` equal stretches of a fingerprint's bits have a population count each. All
    fingerprints with the same counts form a cell, cut into tiles of at most ``TILE``. A
    differing bit moves one count by one, so two cells whose counts lie further apart than
    the radius (as a sum of absolute differences) hold no link and their tiles never meet;
    the sum of the counts being the whole population count, this skips all that it skips.
3.  Any two tiles that are left are compared whole, by exclusive-or and bit counts in numpy.
    A pair of tiles yields only the links that join what its earlier links have not: at
    most one a fingerprint, so a group of near copies never becomes all its pairs.
4.  The links' connected components are joined back to the classes and documents.

Tiles are of one size whatever a cell holds, so a crowded cell is many tiles.

Defined results
    NULL text and text without words: fingerprint zero, linked like any other. Fewer words
    than a shingle: one shingle of all of them. Texts of any length are hashed in stretches.
    Repeated rows stay and share a component. A row without a doc_id has a fingerprint and
    links others; a component without any id has a NULL one. Empty table: no rows. Extra
    columns are not read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewtide.llm import kernels
from viewtide.llm.components import components
from viewtide.llm.positions import running
from viewtide.llm.tables import only, table, written
from viewtide.operators.lookup import lookup

SHINGLE = 3
SEED = 42
RADIUS = 2
PARTS = 4
TILE = 2048
STRETCH = 1_000_000
# Pairs compared at once inside of a task.
PAIRS_AT_ONCE = 1 << 20


def _word_lists(text: np.ndarray) -> Iterator[list[bytes]]:
    """The lower-cased words of a text in stretches that end between words."""
    at, n = 0, len(text)
    while at < n:
        end = min(at + STRETCH, n)
        while end < n:
            gaps = np.flatnonzero(~kernels.NOT_SPACE[text[end : end + STRETCH]])
            if len(gaps):
                end += int(gaps[0])
                break
            end = min(end + STRETCH, n)
        # Without an encoding, lower and split know only ASCII letters and white space.
        yield text[at:end].tobytes().lower().split()
        at = end


def _hashes(words: list[bytes], width: int) -> np.ndarray:
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist())
    return np.array([digest(line[a:b], SEED) for a, b in spans], np.uint64)


def fingerprint(text: np.ndarray, width: int = SHINGLE) -> int:
    """The fingerprint of UTF-8 bytes, as a signed number of 64 bits."""
    ones, total, rest = np.zeros(64, np.int64), 0, []
    for words in _word_lists(text):
        words = rest + words
        if len(words) < width:
            rest = words
            continue
        rest = words[len(words) - width + 1 :]
        found = _hashes(words, width)
        ones += np.unpackbits(found.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        total += len(found)
    if not total:
        if not rest:
            return 0
        whole = _hashes(rest, len(rest))
        return int(whole.view(np.int64)[0])
    return int(np.packbits(2 * ones > total).view(">u8").astype(np.uint64).view(np.int64)[0])


def fingerprints(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """doc_id and fingerprint (bigint) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = kernels.text_bytes(batch.column("text"))
            prints = [fingerprint(data[a:b], width) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(prints, pa.int64())], ["doc_id", "fingerprint"]
            )

    kind = dict(docs.dtypes)["doc_id"]
    return only(docs, ["doc_id", "text"]).mapInArrow(kernels.lean(run), f"doc_id {kind}, fingerprint long")


# -- tiles -----------------------------------------------------------------------------

# A part's count takes so many bits of a cell's number, and one more than it can need.
CELL_BITS = 8


def _cell(parts: int) -> Column:
    """The population counts of the parts in one number."""
    width, cell = 64 // parts, F.lit(0).cast("bigint")
    for i in range(parts):
        bits = F.shiftrightunsigned("fingerprint", i * width)
        if width < 64:
            bits = bits.bitwiseAND(F.lit((1 << width) - 1))
        cell = cell + F.shiftleft(F.bit_count(bits).cast("bigint"), CELL_BITS * i)
    return cell


def _steps(parts: int, radius: int) -> list[int]:
    """From a cell's number to those of the cells near it, one way of each two. A count
    below zero or above its most gives a number that no cell has."""
    steps = [
        sum(d << CELL_BITS * i for i, d in enumerate(move))
        for move in itertools.product(range(-radius, radius + 1), repeat=parts)
        if sum(map(abs, move)) <= radius
    ]
    return sorted(s for s in steps if s >= 0)


def joining_links(ours: np.ndarray, theirs: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Positions of fingerprints within the radius of each other; only the pairs that join
    what the pairs before them have not joined. ``theirs`` may be ``ours``."""
    same = ours is theirs
    n = len(ours)
    label = np.arange(n if same else n + len(theirs))
    right = label if same else label[n:]
    step, links = max(1, PAIRS_AT_ONCE // max(1, len(theirs))), []
    for low in range(0, n, step):
        near = np.bitwise_count(ours[low : low + step, None] ^ theirs[None]) <= radius
        if same:
            near &= np.arange(len(theirs))[None] > np.arange(low, low + len(near))[:, None]
        for row in np.flatnonzero(near.any(axis=1)).tolist():
            i = low + row
            at = np.flatnonzero(near[row])
            at = at[right[at] != label[i]]
            if not len(at):
                continue
            others, first = np.unique(right[at], return_index=True)
            links += [(i, int(j)) for j in at[first]]
            label[np.isin(label, others)] = label[i]
    return links


def _compare(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = []
            for name in ("ours", "theirs"):
                lists = batch.column(name)
                flat = lists.values.to_numpy(zero_copy_only=False)
                # Bits are counted of numbers without a sign.
                sides.append((flat.view(np.uint64), lists.offsets.to_numpy()))
            same, a, b = batch.column("same").to_pylist(), [], []
            (x, xs), (y, ys) = sides
            for k, alike in enumerate(same):
                ours = x[xs[k] : xs[k + 1]]
                theirs = ours if alike else y[ys[k] : ys[k + 1]]
                for i, j in joining_links(ours, theirs, radius):
                    a.append(ours[i])
                    b.append(theirs[j])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (a, b)], ["a", "b"]
            )

    return run


def links(prints: DataFrame, radius: int = RADIUS, parts: int = PARTS, tile: int = TILE) -> DataFrame:
    """Links (a, b) that connect all distinct ``fingerprint``s within the radius."""
    celled = prints.select("fingerprint", _cell(parts).alias("cell"))
    placed = running(celled, ["cell"], ["fingerprint"])
    tiles = written(
        placed.groupBy("cell", F.floor(F.col("_at") / tile).alias("tile"))
        .agg(F.collect_list("fingerprint").alias("prints")),
        "simhash-tiles",
    )
    steps = F.array(*[F.lit(s).cast("bigint") for s in _steps(parts, radius)])
    ours = tiles.select("cell", "tile", F.explode(steps).alias("step")).select(
        "cell", "tile", "step", (F.col("cell") + F.col("step")).alias("other_cell")
    )
    others = tiles.select(F.col("cell").alias("other_cell"), F.col("tile").alias("other_tile"))
    near = ours.join(others, "other_cell").where("step <> 0 OR tile <= other_tile")
    met = near.join(tiles.withColumnRenamed("prints", "ours"), ["cell", "tile"]).join(
        tiles.toDF("other_cell", "other_tile", "theirs"), ["other_cell", "other_tile"]
    )
    return met.select(
        "ours", "theirs", ((F.col("step") == 0) & (F.col("tile") == F.col("other_tile"))).alias("same")
    ).mapInArrow(kernels.lean(_compare(radius)), "a long, b long")


def find(
    docs: DataFrame, width: int = SHINGLE, radius: int = RADIUS, parts: int = PARTS, tile: int = TILE
) -> DataFrame:
    """doc_id, fingerprint (bigint) and component_id of every row of ``docs``."""
    printed = written(fingerprints(docs, width), "simhash-prints")
    classes = written(printed.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "simhash-classes")
    joined = components(written(links(classes, radius, parts, tile), "simhash-links"))
    placed = written(
        classes.join(joined.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
        .withColumn("component", F.coalesce("component", "fingerprint")),
        "simhash-placed",
    )
    named = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    labels = written(lookup(placed, named, "component").select("fingerprint", "component_id"), "simhash-labels")
    return lookup(printed, labels, "fingerprint").select("doc_id", "fingerprint", "component_id")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint")
    return find(table(spark, sf_dir, "documents")).select("doc_id", text, "component_id")
