"""Language identification with error-correcting output codes.

Every language has a codeword of +1 and -1. One binary classifier for each bit looks at a
document's byte trigrams and says how much it leans to +1; the language is the one whose
codeword costs least under the logistic loss, each bit weighted by how well it did on its
training documents. With up to six languages the code is exhaustive (every way to part
them once); beyond that, seeded random codewords far from each other.

The classifiers are fitted on a sample bounded by ``SAMPLE_ROWS`` (in expectation), drawn by
hash of id and text to about as many documents of each language, copies counted once, so
that no id, however many rows have it, goes in or out as one; every document is then scored whole.

Defined results
    NULL text or a text without any letter: ``und``, score 0. No labelled document: all
    ``und``. One language only: that one. NULL lang is not learned from. Repeated rows
    score alike, ties go to the language first in code point order, empty tables give no
    rows, extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewtide.llm import kernels
from viewtide.llm.tables import crc_of_id, only, table, written
from viewtide.operators.lookup import lookup

DIMS = 4096
SAMPLE_ROWS = 3000
STEPS = 120
# The two best codewords are nearly as likely: the language is called ambiguous.
AMBIGUOUS = 0.05

_FOLD = kernels.LOWER.copy()
_FOLD[:128][~((kernels.LOWER[:128] >= 97) & (kernels.LOWER[:128] <= 122))] = 32
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[65:91] = _ASCII_LETTER[97:123] = True


def trigrams(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Unit vectors of the square roots of hashed trigram counts, a row per document."""
    n = len(at) - 1
    folded = _FOLD[data].astype(np.uint32)
    pairs = (folded[:-1] << np.uint32(8)) | folded[1:]
    grams = (pairs[:-1] << np.uint32(8)) | folded[2:]
    bucket = (grams * np.uint32(2654435761)) >> np.uint32(20)
    document = np.repeat(np.arange(n, dtype=np.int64), np.diff(at))[: len(grams)]
    use = grams != 0x202020
    ends = at[1:] - 1  # a trigram that looks past a document's line break is nobody's
    use[ends[ends < len(use)]] = False
    use[ends[(ends > 0) & (ends <= len(use))] - 1] = False
    counts = np.bincount(document[use] * DIMS + bucket[use], minlength=n * DIMS)
    rows = np.sqrt(counts.reshape(n, DIMS).astype(np.float32))
    norm = np.sqrt((rows * rows).sum(1, keepdims=True))
    return rows / np.maximum(norm, 1e-9)


def codewords(n: int) -> np.ndarray:
    """A row of +1 and -1 for each of ``n`` classes."""
    if n < 2:
        return np.ones((n, 1), np.float32)
    if n <= 6:  # exhaustive: the first class is always +1
        bits = np.arange(1, 2 ** (n - 1))
        rest = ((bits[:, None] >> np.arange(n - 1)) & 1).T
        return np.vstack([np.ones(len(bits)), 1 - 2 * rest]).astype(np.float32)
    width, best, most = math.ceil(12 * math.log2(n)), None, -1
    for seed in range(32):
        code = np.random.default_rng(seed).choice([-1.0, 1.0], (n, width)).astype(np.float32)
        apart = ((width - code @ code.T) / 2 + np.eye(n) * width).min()
        if apart > most:
            best, most = code, apart
    return best


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray

    def decode(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best class, its probability and the lead over the second, for each row."""
        leaning = rows @ self.weights + self.bias
        cost = np.logaddexp(0, -leaning[:, None, :] * self.code[None]) @ self.trust
        p = np.exp(cost.min(1, keepdims=True) - cost)
        p /= p.sum(1, keepdims=True)
        best = cost.argmin(1)
        ranked = np.sort(p, 1)
        lead = ranked[:, -1] - (ranked[:, -2] if p.shape[1] > 1 else 0)
        return best, p[np.arange(len(best)), best], lead


def fit(rows: np.ndarray, classes: np.ndarray, languages: list[str]) -> Model:
    """Logistic bit classifiers; each language weighs the same whatever its share."""
    code = codewords(len(languages))
    weights, bias = np.zeros((DIMS, code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    share = 1.0 / np.bincount(classes, minlength=len(languages))[classes]
    share = (share / share.sum()).astype(np.float32)[:, None]
    target = code[classes]
    state = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(bias), np.zeros_like(bias)]
    for step in range(1, STEPS + 1):
        pull = -target / (1 + np.exp(np.clip(target * (rows @ weights + bias), -30, 30))) * share
        for i, (value, slope) in enumerate(((weights, rows.T @ pull + 1e-6 * weights), (bias, pull.sum(0)))):
            first, second = state[2 * i], state[2 * i + 1]
            first += 0.1 * (slope - first)
            second += 0.01 * (slope * slope - second)
            size = np.sqrt(second / (1 - 0.99**step)) + 1e-8
            value -= 0.3 * first / (1 - 0.9**step) / size
    right = ((rows @ weights + bias) * target > 0) * share
    trust = np.clip(2 * right.sum(0) - 1, 0.05, 1)
    return Model(languages, code, weights, bias, (trust / trust.mean()).astype(np.float32))


def training_sample(docs: DataFrame, learn: Column, rows: int = SAMPLE_ROWS) -> DataFrame:
    """text and lang of about ``rows`` different documents in all, as many of each language."""
    labelled = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull()).withColumn(
        "_key", F.xxhash64(F.lit("language sample"), "doc_id", "text")
    )
    counts = written(labelled.groupBy("lang").agg(F.count("*").alias("_n")), "language-counts")
    languages = counts.count()
    if not languages:
        return labelled.select("text", "lang")
    each = max(1, rows // languages)
    line = F.pmod("_key", F.lit(1_000_000)) / 1_000_000
    drawn = lookup(labelled, counts, "lang").where(line < F.lit(each) / F.col("_n"))
    # Copies are combined before the shuffle.
    return drawn.groupBy("lang", "_key").agg(F.min("text").alias("text")).select("text", "lang")


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, end, data, at in kernels.slices(batch.column("text")):
            rows = trigrams(data, at)
            used = [np.flatnonzero(r) for r in rows]
            yield pa.RecordBatch.from_arrays([
                batch.column("lang")[first:end].cast(pa.string()),
                pa.array([u.astype(np.uint16).tobytes() for u in used], pa.binary()),
                pa.array([r[u].tobytes() for r, u in zip(rows, used)], pa.binary()),
            ], ["lang", "places", "amounts"])


def train(docs: DataFrame, learn: Column, rows: int = SAMPLE_ROWS) -> Model | None:
    """A model from a bounded sample of the documents under ``learn``; None without any."""
    known = only(docs, ["doc_id", "text", "lang"])
    sample = training_sample(known, learn, rows)
    got = sorted(map(tuple, sample.mapInArrow(kernels.lean(_sparse), "lang string, places binary, amounts binary").collect()))
    if not got:
        return None
    languages = sorted({r[0] for r in got})
    dense = np.zeros((len(got), DIMS), np.float32)
    for row, (_, places, amounts) in zip(dense, got):
        row[np.frombuffer(places, np.uint16)] = np.frombuffer(amounts, np.float32)
    classes = np.array([languages.index(r[0]) for r in got])
    return fit(dense, classes, languages)


def _has_letter(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    seen = np.add.reduceat(_ASCII_LETTER[data], at[:-1]) > 0
    for i in np.flatnonzero(~seen):
        text = data[at[i] : at[i + 1]].tobytes().decode("utf-8", "replace")
        seen[i] = any(map(str.isalpha, text))
    return seen


def identify(docs: DataFrame, model: Model | None, *keep: str) -> DataFrame:
    """``keep`` columns, lang_pred, score (0 to 1) and ambiguous for every document."""
    names = list(keep)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*names).schema.fields]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, at in kernels.slices(batch.column("_text")):
                n = end - first
                language, p, lead = ["und"] * n, np.zeros(n), np.ones(n)
                if model is not None:
                    letters = _has_letter(data, at)
                    best, p, lead = model.decode(trigrams(data, at))
                    language = [model.languages[b] if s else "und" for b, s in zip(best, letters)]
                    p, lead = np.where(letters, p, 0), np.where(letters, lead, 1)
                kept = [batch.column(i)[first:end] for i in range(len(names))]
                yield pa.RecordBatch.from_arrays([
                    *kept, pa.array(language, pa.string()), pa.array(p.astype(np.float64)),
                    pa.array(lead < AMBIGUOUS),
                ], [*names, "lang_pred", "score", "ambiguous"])

    source = docs.select(*names, F.col("text").cast("string").alias("_text"))
    return source.mapInArrow(
        kernels.lean(score), ", ".join([*fields, "lang_pred string, score double, ambiguous boolean"])
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_of_id() % 4 == 2
    found = identify(docs, train(docs, ~held_out), "doc_id")
    return found.withColumn("held_out", held_out).select(
        "doc_id", "held_out", "lang_pred", "score", "ambiguous"
    )


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``docs`` without those of no language (``und``)."""
    model = train(docs, crc_of_id() % 4 != 2)
    names = docs.columns
    plain = docs.select(*[F.col(f"`{n}`").alias(f"c{i}") for i, n in enumerate(names)],
                        F.col("text"))
    found = identify(plain, model, *[f"c{i}" for i in range(len(names))])
    return found.where("lang_pred <> 'und'").select(
        *[F.col(f"c{i}").alias(n) for i, n in enumerate(names)]
    )
