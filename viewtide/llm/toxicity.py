"""Toxicity by multiple-instance learning.

Only documents are labelled, but what offends is a sentence. Each sentence gets a score
from its words and the byte sequences inside them; a document is toxic if any of its
sentences is, so its probability is the noisy-or of theirs. Fitting the document labels
through the noisy-or teaches the sentence scores, which then show where the offence is.

Two bounded steps fit the model on at most ``SAMPLE_ROWS`` labelled documents (in
expectation; drawn by hash of the id, half of them toxic if there are so many, and where ids
have many rows, by hash of the text as well; copies count once): tasks count
in how many toxic and other documents each hashed feature occurs, and the few thousand that
lean to toxic documents enter the noisy-or fit. Every document is then scored whole.

Defined results
    NULL or empty texts have no sentences: score 0. Without a toxic or without a clean
    training document the score is 0 throughout. NULL labels are not learned from; a
    document with several labels counts once for each. Repeated rows score alike, empty
    tables give no rows, extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewtide.llm import kernels
from viewtide.llm.tables import crc_of_id, only, sent, table, written

FEATURE_BITS = 20
GRAMS = (4, 6)  # widths in bytes of the sequences inside words
SAMPLE_ROWS = 12_000
SELECTED = 4_000
# A selected feature occurs in at least 2 % of the toxic documents of the sample, within
# these bounds: in a small one, four is often chance.
LEAST_DOCUMENTS = (4, 6)
STEPS = 400
SPARSITY = 2e-5

_END = np.zeros(256, bool)
_END[[10, 33, 46, 63]] = True  # line break ! . ?


def features(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(byte position, feature) of all words and of all grams inside words."""
    lower = kernels.LOWER[data]
    rolling = kernels.Rolling(lower)
    inside = kernels.ALNUM[lower]
    outside = np.zeros(len(data) + 1, np.int32)
    np.cumsum(~inside, out=outside[1:])
    shift = np.uint64(64 - FEATURE_BITS)
    starts, ends = kernels.runs(inside)
    places, found = [starts], [rolling.of(starts, ends) ^ np.uint64(0x5555555555555555)]
    for width in GRAMS:
        if len(data) < width:
            continue
        own = np.flatnonzero(outside[width:] == outside[:-width])
        places.append(own)
        found.append(rolling.of(own, own + width))
    return np.concatenate(places), (np.concatenate(found) >> shift).astype(np.int64)


def sentences(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends of all pieces between sentence marks, and how many in each document have words."""
    ends = np.flatnonzero(_END[data])
    starts, _ = kernels.runs(kernels.ALNUM[data])
    spoken = np.unique(np.searchsorted(ends, starts))
    return ends, kernels.per_document(ends[spoken] if len(spoken) else spoken, at)


@dataclass
class Model:
    weights: np.ndarray  # by feature, 0 for those not selected
    bias: float

    def sentence_scores(
        self, data: np.ndarray, ends: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Pieces with selected features and the log-odds of their being toxic."""
        place, feature = features(data)
        hit = self.weights[feature] != 0
        piece = np.searchsorted(ends, place[hit])
        pairs = np.unique(piece.astype(np.int64) << FEATURE_BITS | feature[hit])
        piece, feature = pairs >> FEATURE_BITS, pairs & ((1 << FEATURE_BITS) - 1)
        which, back = np.unique(piece, return_inverse=True)
        odds = np.bincount(back, self.weights[feature], len(which)) + self.bias
        return which, odds

    def document_scores(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        ends, spoken = sentences(data, at)
        which, odds = self.sentence_scores(data, ends)
        document = np.searchsorted(at, ends[which], "right") - 1
        n = len(at) - 1
        hot = np.bincount(document, np.logaddexp(0, odds), n)
        quiet = spoken - np.bincount(document, minlength=n)
        return -np.expm1(-(hot + np.maximum(quiet, 0) * np.logaddexp(0, self.bias)))


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: in how many toxic and other documents each feature occurs."""
    counts = np.zeros((2, 1 << FEATURE_BITS), np.int64)
    for batch in batches:
        toxic = batch.column("toxic").to_numpy(zero_copy_only=False)
        for first, end, data, at in kernels.slices(batch.column("text")):
            place, feature = features(data)
            document = np.searchsorted(at, place, "right") - 1
            pairs = np.unique(document.astype(np.int64) << FEATURE_BITS | feature)
            document, feature = pairs >> FEATURE_BITS, pairs & ((1 << FEATURE_BITS) - 1)
            label = toxic[first:end][document]
            for kind in (0, 1):
                counts[kind] += np.bincount(feature[label == kind], minlength=1 << FEATURE_BITS)
    for some in np.array_split(np.flatnonzero(counts.any(0)), 16):
        yield pa.RecordBatch.from_arrays(
            [pa.array(some), pa.array(counts[1, some]), pa.array(counts[0, some])],
            ["feature", "toxic", "other"],
        )


def _bags(selected: np.ndarray):
    """Per document its number of sentences and its (sentence, feature) pairs."""

    def bag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probe = Model(selected, 0.0)
        for batch in batches:
            for first, end, data, at in kernels.slices(batch.column("text")):
                ends, spoken = sentences(data, at)
                place, feature = features(data)
                hit = probe.weights[feature] != 0
                pairs = np.unique(
                    np.searchsorted(ends, place[hit]).astype(np.int64) << FEATURE_BITS
                    | feature[hit]
                )
                document = np.searchsorted(at, ends[pairs >> FEATURE_BITS], "right") - 1
                cut = np.searchsorted(document, np.arange(end - first + 1))
                yield pa.RecordBatch.from_arrays([
                    batch.column("toxic")[first:end].cast(pa.int32()),
                    pa.array(spoken.astype(np.int64)),
                    pa.array([pairs[a:b].tobytes() for a, b in zip(cut, cut[1:])], pa.binary()),
                ], ["toxic", "spoken", "pairs"])

    return bag


def fit(
    labels: np.ndarray, importance: np.ndarray, spoken: np.ndarray,
    piece_document: np.ndarray, pair_piece: np.ndarray, pair_feature: np.ndarray, n: int,
) -> tuple[np.ndarray, float]:
    """Weights and bias that make the noisy-or of the sentences fit the labels."""
    importance = importance / importance.sum()
    hot = np.bincount(piece_document, minlength=len(labels))
    quiet = np.maximum(spoken - hot, 0)
    weights, bias = np.zeros(n), -6.0
    moments = np.zeros((2, n + 1))
    for step in range(1, STEPS + 1):
        odds = np.bincount(pair_piece, weights[pair_feature], len(piece_document)) + bias
        total = np.bincount(piece_document, np.logaddexp(0, odds), len(labels))
        total = np.maximum(total + quiet * np.logaddexp(0, bias), 1e-9)
        # Loss of a toxic document -log(1 - exp(-total)), of another one total.
        slope = importance * np.where(labels == 1, -1 / np.expm1(np.minimum(total, 50)), 1)
        per_piece = slope[piece_document] / (1 + np.exp(-odds))
        gradient = np.empty(n + 1)
        gradient[:n] = np.bincount(pair_feature, per_piece[pair_piece], n)
        gradient[n] = per_piece.sum() + (slope * quiet).sum() / (1 + np.exp(-bias))
        moments[0] += 0.1 * (gradient - moments[0])
        moments[1] += 0.01 * (gradient**2 - moments[1])
        move = 0.1 * moments[0] / (1 - 0.9**step) / (np.sqrt(moments[1] / (1 - 0.99**step)) + 1e-8)
        weights = np.maximum(weights - move[:n] - 0.1 * SPARSITY, 0)  # evidence only adds
        bias = float(np.clip(bias - move[n], -14, -2))
    return weights, bias


def train(docs: DataFrame, labels: DataFrame, learn: Column) -> Model | None:
    """A model from a bounded sample of the labelled documents under ``learn``."""
    marked = only(labels, ["doc_id", "toxic"]).where("toxic IN (0, 1)").where(learn)
    sizes = {r["toxic"]: r["n"] for r in marked.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return None
    share = {k: min(1.0, SAMPLE_ROWS / 2 / n) for k, n in sizes.items()}
    line = F.pmod(F.xxhash64(F.lit("toxicity sample"), "doc_id"), F.lit(1_000_000)) / 1_000_000
    chosen = marked.where(line < F.when(F.col("toxic") == 1, share[1]).otherwise(share[0])).distinct()
    drawn = (
        only(docs, ["doc_id", "text"]).where("text IS NOT NULL")
        .join(sent(chosen), "doc_id")
        .select("text", F.col("toxic").cast("int").alias("toxic"), F.xxhash64("doc_id", "text").alias("_key"))
    )
    rows = drawn.agg(F.count_distinct("_key", "toxic")).first()[0]
    if rows > SAMPLE_ROWS * 5 // 4:
        # Ids with many texts: these are drawn from as well.
        drawn = drawn.where(F.pmod("_key", F.lit(1_000_000)) < int(1_000_000 * SAMPLE_ROWS / rows))
    sample = written(
        drawn.groupBy("_key", "toxic").agg(F.min("text").alias("text")).select("text", "toxic"), "toxic-sample"
    )
    counted = sample.mapInArrow(kernels.lean(_document_frequencies, whole=True), "feature long, toxic long, other long")
    summed = counted.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    # Smoothed log-ratio of the rates, times the toxic documents that show it.
    taken = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    rate = {k: max(1.0, float(taken.get(k, 0))) for k in sizes}
    lean = F.log(((F.col("toxic") + 0.5) / rate[1]) / ((F.col("other") + 0.5) / rate[0]))
    least = min(max(LEAST_DOCUMENTS[0], round(rate[1] / 50)), LEAST_DOCUMENTS[1])
    top = (
        summed.where(F.col("toxic") >= least).withColumn("lean", lean)
        .where("lean > 1").orderBy(F.desc(F.col("lean") * F.col("toxic")), "feature")
        .limit(SELECTED)
    )
    kept = np.array(sorted(r["feature"] for r in top.collect()), np.int64)
    weights = np.zeros(1 << FEATURE_BITS, np.float32)
    if not len(kept):
        return Model(weights, -14.0)
    weights[kept] = 1
    rows = sorted(map(tuple, sample.mapInArrow(
        kernels.lean(_bags(weights)), "toxic int, spoken long, pairs binary").collect()))
    piece_document, pair_piece, pair_feature, pieces = [], [], [], 0
    for i, (_, _, packed) in enumerate(rows):
        pairs = np.frombuffer(packed, np.int64)
        which, back = np.unique(pairs >> FEATURE_BITS, return_inverse=True)
        piece_document.append(np.full(len(which), i))
        pair_piece.append(back + pieces)
        pair_feature.append(np.searchsorted(kept, pairs & ((1 << FEATURE_BITS) - 1)))
        pieces += len(which)
    toxic = np.array([r[0] for r in rows])
    importance = np.where(toxic == 1, 1 / share[1], 1 / share[0])
    learned, bias = fit(
        toxic, importance, np.array([r[1] for r in rows]),
        np.concatenate(piece_document), np.concatenate(pair_piece),
        np.concatenate(pair_feature), len(kept),
    )
    weights[kept] = learned
    return Model(weights, bias)


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id and score of every document."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, at in kernels.slices(batch.column("text")):
                p = np.zeros(end - first) if model is None else model.document_scores(data, at)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[first:end], pa.array(p)], ["doc_id", "score"]
                )

    kind = dict(docs.dtypes)["doc_id"]
    return only(docs, ["doc_id", "text"]).mapInArrow(kernels.lean(scored), f"doc_id {kind}, score double")


def locate(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The offending sentences: doc_id, byte range in the text, sentence, score."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, at in kernels.slices(batch.column("text")):
                ends, _ = sentences(data, at)
                which, odds = model.sentence_scores(data, ends)
                p = 1 / (1 + np.exp(-odds))
                which, p = which[p >= least], p[p >= least]
                stop = ends[which] + (data[ends[which]] != 10)
                begin = np.where(which > 0, ends[which - 1] + 1, 0)
                document = np.searchsorted(at, ends[which], "right") - 1
                texts = [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(begin, stop)]
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id")[first:end].take(pa.array(document)),
                    pa.array(begin - at[document]), pa.array(stop - at[document]),
                    pa.array(texts, pa.string()), pa.array(p),
                ], ["doc_id", "begin", "stop", "sentence", "score"])

    kind = dict(docs.dtypes)["doc_id"]
    return only(docs, ["doc_id", "text"]).mapInArrow(
        kernels.lean(found), f"doc_id {kind}, begin long, stop long, sentence string, score double"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = crc_of_id() % 5 == 0
    return score(docs, train(docs, labels, ~held_out)).select(
        "doc_id", held_out.alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
