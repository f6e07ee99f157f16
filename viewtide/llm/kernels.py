"""Vectorised numpy kernels over the UTF-8 bytes of Arrow text columns.

All of them work on a *slice*: the bytes of some whole documents, a line break after each,
with the offsets at which each document starts. A slice holds a MB, or one longer document, so
memory follows the longest text and not the partition.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1_000_000
RELEASE_EVERY = 16

try:
    _libc = ctypes.CDLL("libc.so.6")
    _libc.malloc_trim
except (OSError, AttributeError):  # another C library: nothing to give back by hand
    _libc = None

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_LETTERS = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# Word characters under the two definitions that the contracts use.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _release() -> None:
    """Give freed memory back to the system."""
    if _libc is not None:
        _libc.malloc_trim(0)


def lean(run: Callable, whole: bool = False) -> Callable:
    """``run`` over Arrow batches in a worker that stays small.

    Workers serve many tasks; what allocators keep of one task's arrays would lie beside
    the executor's heap for all later ones. A batch is let go before the next one is read;
    with ``whole``, ``run`` gets all of them at once and sees to that itself.
    """

    def runner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_memory_pool(pa.system_memory_pool())
        n = 0
        for some in [batches] if whole else _one_by_one(batches):
            for out in run(some):
                yield out
                n += 1
                if n % RELEASE_EVERY == 0:
                    _release()
            del some
        _release()

    return runner


def _one_by_one(batches: Iterator[pa.RecordBatch]) -> Iterator[Iterator[pa.RecordBatch]]:
    for batch in batches:
        one = iter([batch])
        del batch
        yield one
        del one


def lean_group(run: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """The same for a function of one group."""

    def runner(group: pa.Table) -> pa.Table:
        pa.set_memory_pool(pa.system_memory_pool())
        out = run(group)
        if group.nbytes > SLICE_BYTES:
            _release()
        return out

    return runner


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; NULL counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    wide = column.cast(pa.large_binary())
    _, offsets, data = wide.buffers()
    at = np.frombuffer(offsets, np.int64)[wide.offset : wide.offset + len(wide) + 1]
    if data is None or not len(wide):
        return np.zeros(0, np.uint8), np.zeros(len(wide) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def slices(
    column: pa.Array, limit: int = SLICE_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first document, end document, bytes, offsets) of consecutive whole documents.

    A line break follows each document, so that nothing found by looking at neighbouring
    bytes reaches into the next one. It belongs to the document as its last byte.
    """
    data, at = text_bytes(column)
    first, n = 0, len(at) - 1
    while first < n:
        end = max(first + 1, int(np.searchsorted(at, at[first] + limit, "right")) - 1)
        end = min(end, first + limit // 64 + 1)  # many empty texts
        shifted = at[first : end + 1] - at[first] + np.arange(end - first + 1)
        out = np.full(int(shifted[-1]), 10, np.uint8)
        for i in range(end - first):
            out[shifted[i] : shifted[i + 1] - 1] = data[at[first + i] : at[first + i + 1]]
        yield first, end, out, shifted
        first = end


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose every output bit depends on all input bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(which: str, n: int) -> np.ndarray:
    if len(_powers[which]) < n:
        step = np.full(max(n, SLICE_BYTES + 1), _BASE if which == "up" else _BASE_INVERSE)
        step[0] = 1
        _powers[which] = np.multiply.accumulate(step)
    return _powers[which][:n]


class Rolling:
    """Hashes of any substrings of the bytes, each from two prefix sums."""

    def __init__(self, data: np.ndarray) -> None:
        self._sum(_LETTERS[data])

    def _sum(self, letters: np.ndarray) -> None:
        self.sums = np.zeros(len(letters) + 1, np.uint64)
        np.cumsum(letters * _power("up", len(letters)), out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        width = (ends - starts).astype(np.uint64)
        raw = (self.sums[ends] - self.sums[starts]) * _power("down", len(self.sums))[starts]
        return mix(raw + width * np.uint64(0xD6E8FEB86659FD93))

    def every(self, width: int) -> np.ndarray:
        """Hashes of the substrings of one width at each start."""
        raw = (self.sums[width:] - self.sums[:-width]) * _power(
            "down", len(self.sums) - width
        )
        return mix(raw + np.uint64(width * 0xD6E8FEB86659FD93 % 2**64))


class CodeHash(Rolling):
    """The same over code points."""

    def __init__(self, codes: np.ndarray) -> None:
        self._sum((codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F))


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True."""
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
    return edges[::2], edges[1::2]


def per_document(positions: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many of the ascending positions lie in each document."""
    return np.diff(np.searchsorted(positions, at))


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of all ranges one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    skip = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - skip, lengths)
