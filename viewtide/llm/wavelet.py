"""Token ids in compressed files: a wavelet matrix for each shard.

A shard holds the ids of consecutive documents as bit planes, highest bit first; behind
each plane the ids are parted stably into those with a 0 and those with a 1 there. Counts
of ones before every 512th bit make rank and select short, so one file answers what the id
at a place is, how often an id occurs before it, and where its n-th occurrence is, without
being unpacked to ids.

File layout (little-endian): ``WVM1``, documents, ids and planes as uint64, then one
zstandard frame with the document ids (int64), a byte for each saying whether it is not
NULL, the ids in each document (int64), and for each plane its number of zeros (uint64) and
its packed bits. The rank directory is counted when the file is opened.

The files are written and read by Spark as one binary column, so they can lie wherever
Spark can write.

Defined results
    NULL and empty texts have only their end id. Documents go in ascending doc_id, NULL
    first, rows that repeat an id by a hash of their text. Empty tables: no files, no rows. Extra columns
    are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewtide.llm import kernels
from viewtide.llm.tables import only, table, written
from viewtide.llm.tokens import encoder

MAGIC = b"WVM1"
SHARD_IDS = 1_000_000
SLICE_CHARS = 300_000
BLOCK = 512


def pack(ids: np.ndarray, documents: list[int | None], counts: np.ndarray) -> bytes:
    """One file of the ids of ``documents``, ``counts`` each."""
    planes = max(1, int(ids.max(initial=0)).bit_length())
    rest = ids.astype(np.uint16 if planes <= 16 else np.uint32)
    body = [
        np.array([d or 0 for d in documents], np.int64).tobytes(),
        np.array([d is not None for d in documents], np.uint8).tobytes(),
        np.asarray(counts, np.int64).tobytes(),
    ]
    for plane in range(planes - 1, -1, -1):
        ones = (rest >> rest.dtype.type(plane)) & rest.dtype.type(1) != 0
        zeros = np.compress(~ones, rest)
        body += [struct.pack("<Q", len(zeros)), np.packbits(ones, bitorder="little").tobytes()]
        rest = np.concatenate([zeros, np.compress(ones, rest)])
    head = MAGIC + struct.pack("<QQQ", len(documents), len(ids), planes)
    return head + zstandard.ZstdCompressor(level=1).compress(b"".join(body))


class WaveletMatrix:
    """The ids of one file."""

    def __init__(self, data: bytes | memoryview) -> None:
        data = memoryview(data)
        if bytes(data[:4]) != MAGIC:
            raise ValueError("not a token file")
        n, self.size, self.planes = struct.unpack("<QQQ", data[4:28])
        body = memoryview(zstandard.ZstdDecompressor().decompress(data[28:]))
        known = np.frombuffer(body, np.uint8, n, 8 * n)
        self.documents = [
            d if k else None for d, k in zip(np.frombuffer(body, np.int64, n).tolist(), known)
        ]
        self.counts = np.frombuffer(body, np.int64, n, 9 * n) if n else np.zeros(0, np.int64)
        at, width = 17 * n, -(-self.size // 8)
        self.zeros, self.packed = [], []
        for _ in range(self.planes):
            self.zeros.append(struct.unpack_from("<Q", body, at)[0])
            self.packed.append(np.frombuffer(body, np.uint8, width, at + 8))
            at += 8 + width
        self._ranks: list[np.ndarray] | None = None

    def _bits(self, plane: int) -> np.ndarray:
        return np.unpackbits(self.packed[plane], count=self.size, bitorder="little").view(bool)

    def _rank(self, plane: int, at: int) -> int:
        """Ones before ``at``."""
        if self._ranks is None:
            step = BLOCK // 8
            self._ranks = []
            for bits in self.packed:
                per = np.add.reduceat(np.bitwise_count(bits), np.arange(0, len(bits), step), dtype=np.int64) if len(bits) else np.zeros(0, np.int64)
                self._ranks.append(np.concatenate([[0], np.cumsum(per)]))
        block = at // BLOCK
        bits = np.unpackbits(
            self.packed[plane][block * BLOCK // 8 : -(-at // 8)], bitorder="little"
        )
        return int(self._ranks[plane][block]) + int(bits[: at - block * BLOCK].sum())

    def access(self, at: int) -> int:
        """The id at place ``at``."""
        if not 0 <= at < self.size:
            raise IndexError(at)
        value = 0
        for plane in range(self.planes):
            bit = self.packed[plane][at // 8] >> (at % 8) & 1
            value = value << 1 | int(bit)
            ones = self._rank(plane, at)
            at = self.zeros[plane] + ones if bit else at - ones
        return value

    def count(self, value: int, before: int | None = None) -> int:
        """How often ``value`` occurs before a place (in all)."""
        if value >> self.planes:
            return 0
        low, high = 0, self.size if before is None else min(before, self.size)
        for plane in range(self.planes):
            ones = self._rank(plane, low), self._rank(plane, high)
            if value >> (self.planes - 1 - plane) & 1:
                low, high = self.zeros[plane] + ones[0], self.zeros[plane] + ones[1]
            else:
                low, high = low - ones[0], high - ones[1]
        return high - low

    def occurrence(self, value: int, nth: int) -> int:
        """The place of the ``nth`` occurrence (from 0) of ``value``."""
        if not 0 <= nth < self.count(value):
            raise IndexError(nth)
        at = 0
        for plane in range(self.planes):  # where the run of ``value`` begins at the end
            ones = self._rank(plane, at)
            at = self.zeros[plane] + ones if value >> (self.planes - 1 - plane) & 1 else at - ones
        at += nth
        for plane in range(self.planes - 1, -1, -1):
            one = bool(value >> (self.planes - 1 - plane) & 1)
            at = self._select(plane, one, at - self.zeros[plane] if one else at)
        return at

    def _select(self, plane: int, one: bool, nth: int) -> int:
        self._rank(plane, 0)
        ranks = self._ranks[plane]
        if not one:
            ranks = np.arange(len(ranks)) * BLOCK - ranks
        block = int(np.searchsorted(ranks, nth, "right")) - 1
        bits = np.unpackbits(
            self.packed[plane][block * BLOCK // 8 : (block + 1) * BLOCK // 8], bitorder="little"
        )
        return block * BLOCK + int(np.flatnonzero(bits == one)[nth - int(ranks[block])])

    def ids(self) -> np.ndarray:
        """All ids in their order, put together from the last plane upwards."""
        kind = np.uint16 if self.planes <= 16 else np.uint32
        below = np.zeros(self.size, kind)
        for plane in range(self.planes - 1, -1, -1):
            ones, zeros = self._bits(plane), self.zeros[plane]
            here = np.empty(self.size, kind)
            here[np.flatnonzero(~ones)] = below[:zeros]
            here[np.flatnonzero(ones)] = below[zeros:] | kind(1 << (self.planes - 1 - plane))
            below = here
        return below.astype(np.uint32)


def write_files(docs: DataFrame, tokenizer: str, end: int = 0) -> DataFrame:
    """part, file, start (ids before it in its part), n_ids, content: a row per file.

    Parts are ranges of doc_id in ascending order, files ascending within them. A file is
    closed after the document that brings it to ``SHARD_IDS`` ids.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part = encoder(tokenizer, end), TaskContext.get().partitionId()
        ids, counts, documents, file, start = [], [], [], 0, 0

        def close() -> pa.RecordBatch:
            nonlocal file, start
            flat = np.concatenate(ids)
            row = pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([file], pa.int32()),
                pa.array([start], pa.int64()), pa.array([len(flat)], pa.int64()),
                pa.array([pack(flat, documents, np.concatenate(counts))], pa.binary()),
            ], ["part", "file", "start", "n_ids", "content"])
            file, start = file + 1, start + len(flat)
            ids.clear(), counts.clear(), documents.clear()
            return row

        for batch in batches:
            names, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            first = 0
            while first < len(names):
                some, size = [], 0
                while first + len(some) < len(names) and size < SLICE_CHARS:
                    some.append(texts[first + len(some)].as_py() or "")
                    size += len(some[-1])
                found, each = coder.encode(some)
                ids.append(found), counts.append(each)
                documents += names[first : first + len(some)]
                first += len(some)
                if sum(map(len, ids)) >= SHARD_IDS:
                    yield close()
            del batch, texts  # before the next one is read
        if documents:
            yield close()

    # The text's hash lets the ranges part rows that share an id, such as NULL.
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("text")]
    rows = only(docs, ["doc_id", "text"]).repartitionByRange(*order[:2])
    return rows.sortWithinPartitions(*order).mapInArrow(
        kernels.lean(encode, whole=True), "part int, file int, start long, n_ids long, content binary"
    )


def part_starts(files: DataFrame) -> dict[int, int]:
    """Ids before each part: one number per part goes through the driver."""
    totals = {r["part"]: r["n"] for r in files.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()}
    before, starts = 0, {}
    for part in sorted(totals):
        starts[part] = before
        before += totals[part]
    return starts


def read_documents(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and crc32 of the ids of every document in the files."""
    starts = part_starts(files)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                held = WaveletMatrix(batch.column("content")[i].as_buffer())
                ids = held.ids().astype("<u4").tobytes()
                stop = np.cumsum(held.counts)
                begin = stop - held.counts
                offset = starts[batch.column("part")[i].as_py()] + batch.column("start")[i].as_py()
                sums = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(begin.tolist(), stop.tolist())]
                yield pa.RecordBatch.from_arrays([
                    pa.array(held.documents, pa.int64()), pa.array(begin + offset),
                    pa.array(held.counts), pa.array(sums, pa.int64()),
                ], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return files.select("part", "start", "content").mapInArrow(
        kernels.lean(decode), "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(spark, table(spark, sf_dir, "documents"), sf_dir)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return read_documents(written(write_files(docs, tokenizer_path()), "token-files"))
