"""License scans with a positional rare-token index.

The index files the words of each template, highest IDF first (counted over all documents),
under the templates and positions at which they stand. A file's highest-IDF licence words are
looked up there: each posting says where the template would begin, and postings that agree on
a beginning are intersected, by counting them. The commonest words of a template, together
fewer positions than its key phrase has, are not looked up: a beginning with more words in
place than the key phrase alone has at least ``POSTINGS`` of the others. The mandatory key phrase
is verified around each such beginning, and where it stands at its own place in the template,
which needs no posting. There all words are compared: the share of the template's words found
in their places is the score. Hence no place of a key phrase escapes and no beginning with a
better share, however many notices a file holds. Four phrases are also labelled wherever
they stand, with or without a template.

Defined results
    NULL or empty texts: no words, no places, no labels, score 0. Words never join across
    documents. Labels are distinct, sorted and comma-joined, so ties cannot show. Repeated
    rows give the same; empty tables no rows; extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewtide.llm import kernels
from viewtide.llm.license_texts import BASE, TEMPLATES
from viewtide.llm.tables import only, table

# A candidate has this many different words of its template in their places.
AGREE = 2
# Postings of rare words that must agree on a beginning.
POSTINGS = 2
# A key phrase may stand so many words before a template's beginning.
BEFORE = 2
# Words compared at a time.
COMPARED = 4_000_000


# Label, mandatory key phrase, which stands in the text that follows: all in plain words.
Template = tuple[str, str, str]


def words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the words, A-Z in lower case."""
    starts, ends = kernels.runs(kernels.ALNUM[data])
    return starts, kernels.Rolling(kernels.LOWER[data]).of(starts, ends)


def _hashes(phrase: str) -> np.ndarray:
    return words(np.frombuffer(phrase.encode(), np.uint8))[1]


def places(hashes: np.ndarray, document: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """Word indexes at which the words of the phrase stand one after another."""
    found = np.flatnonzero(hashes == phrase[0])
    found = found[found + len(phrase) <= len(hashes)]
    for i in range(1, len(phrase)):
        found = found[hashes[found + i] == phrase[i]]
    return found[document[found] == document[found + len(phrase) - 1]]


class Index:
    """Postings of the rare words of templates; ``idf`` by word of the vocabulary."""

    def __init__(self, templates: Sequence[Template] = TEMPLATES, idf: np.ndarray | None = None) -> None:
        self.templates = [_hashes(text) for _, _, text in templates]
        self.keys = [_hashes(key) for _, key, _ in templates]
        self.vocabulary = np.unique(np.concatenate(self.templates + self.keys))
        self.idf = np.zeros(len(self.vocabulary)) if idf is None else idf
        self.postings = [self._rare(text, len(key)) for text, key in zip(self.templates, self.keys)]
        # Where in each key phrase its rarest word stands, and where the phrase in the template.
        self.rarest = [
            int(np.argmax(self.idf[np.searchsorted(self.vocabulary, key)])) for key in self.keys
        ]
        self.key_at = [
            int(places(text, np.zeros(len(text), int), key)[0])
            for text, key in zip(self.templates, self.keys)
        ]

    def _rare(self, text: np.ndarray, key_words: int) -> list[tuple[int, int]]:
        """(word, position) of the template's words, highest IDF first, without the last few
        positions: as many as the key phrase has and ``POSTINGS`` cannot miss."""
        entry = np.searchsorted(self.vocabulary, text)
        order = np.lexsort((entry, -self.idf[entry]))
        looked_up = len(text) - max(key_words + 1 - POSTINGS, 0)
        return [(int(entry[j]), int(j)) for j in order[:looked_up]]

    def known(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indexes of the words that are in the vocabulary, and where in it."""
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        hit = np.flatnonzero(self.vocabulary[at] == hashes)
        return hit, at[hit]

    def verified(
        self, hashes: np.ndarray, document: np.ndarray
    ) -> Iterator[tuple[int, int, float]]:
        """(document, template, largest share of its words in place) of the templates that
        stand."""
        hit, entry = self.known(hashes)
        order = np.argsort(entry, kind="stable")
        cut = np.searchsorted(entry[order], np.arange(len(self.vocabulary) + 1))
        hit = hit[order]
        for t, text in enumerate(self.templates):
            stands = self._phrases(t, hashes, document, hit, cut)
            if len(stands):
                spots = self._beginnings(t, stands, document, hit, cut)
                best = _shares(text, spots, hashes, document)
                for d in np.flatnonzero(best).tolist():
                    yield d, t, float(best[d])

    def _phrases(self, t: int, hashes: np.ndarray, document: np.ndarray, hit: np.ndarray, cut: np.ndarray) -> np.ndarray:
        """Word indexes at which the key phrase stands, ascending."""
        key, rarest = self.keys[t], self.rarest[t]
        word = int(np.searchsorted(self.vocabulary, key[rarest]))
        found = hit[cut[word] : cut[word + 1]] - rarest
        found = found[(found >= 0) & (found + len(key) <= len(hashes))]
        for i in range(len(key)):
            found = found[hashes[found + i] == key[i]]
        return found[document[found] == document[found + len(key) - 1]]

    def _beginnings(self, t: int, stands: np.ndarray, document: np.ndarray, hit: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(document, beginning) with a key phrase around it where rare words agree, or the
        phrase stands at its own place; each once."""
        length = len(self.templates[t])
        # One number for both; beginnings may lie outside of the document.
        size = len(document) + 2 * (length + BEFORE)
        phrase = document[stands] * size + stands
        begins = [phrase - self.key_at[t]]
        having = np.zeros(int(document[-1]) + 1, bool)
        having[document[stands]] = True
        votes = []
        for word, j in self.postings[t]:
            place = hit[cut[word] : cut[word + 1]]
            place = place[having[document[place]]]
            begin = document[place] * size + place - j
            next_phrase = np.searchsorted(phrase, begin - BEFORE)
            near = phrase[np.minimum(next_phrase, len(phrase) - 1)]
            votes.append(begin[(near >= begin - BEFORE) & (near < begin + length)])
        begin, n = np.unique(np.concatenate(votes), return_counts=True)
        begins.append(begin[n >= POSTINGS])
        code = np.unique(np.concatenate(begins)) + length
        return code // size, code % size - length


def _shares(text: np.ndarray, spots: tuple[np.ndarray, np.ndarray], hashes: np.ndarray, document: np.ndarray) -> np.ndarray:
    """The largest share of the template's words in place, by document."""
    # The columns of equal words side by side, to count different ones.
    order = np.argsort(text, kind="stable")
    cut = np.flatnonzero(np.diff(text[order], prepend=text[order][0] - np.uint64(1)))
    best = np.zeros(int(document[-1]) + 1)
    for some in np.array_split(np.stack(spots), 1 + len(spots[0]) * len(text) // COMPARED, axis=1):
        owner, start = some
        at = start[:, None] + order
        inside = (at >= 0) & (at < len(hashes))
        at = np.clip(at, 0, len(hashes) - 1)
        same = inside & (document[at] == owner[:, None]) & (hashes[at] == text[order])
        agree = np.logical_or.reduceat(same, cut, axis=1).sum(1) >= AGREE
        np.maximum.at(best, owner[agree], same[agree].sum(1) / len(text))
    return best


def document_frequencies(docs: DataFrame, templates: Sequence[Template] = TEMPLATES) -> np.ndarray:
    """IDF of the template words over all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, n = Index(templates), 0
        size = len(index.vocabulary)
        total = np.zeros(size, np.int64)
        for batch in batches:
            n += batch.num_rows
            for _, _, data, at in kernels.slices(batch.column("text")):
                starts, hashes = words(data)
                hit, entry = index.known(hashes)
                document = np.searchsorted(at, starts[hit], "right") - 1
                total += np.bincount(np.unique(document * size + entry) % size, minlength=size)
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1, *range(size)]), pa.array([n, *total.tolist()])], ["word", "documents"]
        )

    counted = only(docs, ["text"]).mapInArrow(kernels.lean(count, whole=True), "word long, documents long")
    rows = {r["word"]: r["n"] for r in counted.groupBy("word").agg(F.sum("documents").alias("n")).collect()}
    total = rows.pop(-1, 0)
    size = len(Index(templates).vocabulary)
    return np.array([math.log((total + 1) / (rows.get(i, 0) + 0.5)) for i in range(size)])


def scan(docs: DataFrame, templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """A row for every document: the columns of the contract's ``op10`` query."""
    idf = document_frequencies(docs, templates)
    kind = dict(docs.dtypes)["doc_id"]

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(templates, idf)
        base = [(_hashes(phrase), label) for phrase, label in BASE.items()]
        for batch in batches:
            for first, end, data, at in kernels.slices(batch.column("text")):
                n = end - first
                starts, hashes = words(data)
                begin = np.searchsorted(starts, at)
                document = np.repeat(np.arange(n), np.diff(begin))
                labels, more = [set() for _ in range(n)], [set() for _ in range(n)]
                score, spots = np.zeros(n), []
                for phrase, label in base:
                    found = places(hashes, document, phrase)
                    spots.append(found)
                    for d in np.unique(document[found]):
                        labels[d].add(label)
                spots = np.sort(np.concatenate(spots))
                owner = document[spots]
                for d, t, share in index.verified(hashes, document):
                    more[d].add(templates[t][0])
                    score[d] = max(score[d], share)
                cut = np.searchsorted(owner, np.arange(n + 1))
                have = np.diff(cut) > 0
                low, high = np.zeros(n, np.int64), np.zeros(n, np.int64)
                low[have] = spots[cut[:-1][have]] - begin[:-1][have]
                high[have] = spots[cut[1:][have] - 1] - begin[:-1][have]
                score = np.where(have, np.maximum(score, 0.5), score)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id")[first:end],
                    pa.array(np.diff(begin)), pa.array(np.diff(cut)),
                    pa.array(low, mask=~have), pa.array(high, mask=~have),
                    pa.array([",".join(sorted(x)) for x in labels], pa.string()),
                    pa.array([",".join(sorted(x | y)) for x, y in zip(labels, more)], pa.string()),
                    pa.array(score),
                ], ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])

    return only(docs, ["doc_id", "text"]).mapInArrow(
        kernels.lean(scanned),
        f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, "
        "base_labels string, labels string, score double",
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
