"""Vectorised text kernels shared by the operators: word bounds, word hashes, k-gram hashes.

Everything works on the UTF-8 bytes of a whole Arrow string column at once, so a word costs a few
numpy passes and no Python object. Words never cross a document: a document's end closes its word.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Multipliers of the polynomial hashes (any odd 64-bit numbers) and their mixer.
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xD6E8FEB86659FD93
OTHER_BASE = 0xA0761D6478BD642F
MIX_1, MIX_2 = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB

#: Bytes of text that one pass takes; a longer document is taken alone.
SLICE_BYTES = 1_000_000


def byte_table(separators: bytes) -> np.ndarray:
    """table[b] is True where byte b belongs to a word."""
    table = np.ones(256, dtype=bool)
    table[np.frombuffer(separators, dtype=np.uint8)] = False
    return table


#: Words [^\x20\x09-\x0D]+ : anything but ASCII white space.
SPACED = byte_table(bytes([0x20, *range(0x09, 0x0E)]))
#: Words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z: digits, letters, anything beyond ASCII.
ALNUM = byte_table(bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))



#: Caches that live as long as a worker runs tasks of one operator.
_kept: dict = {"owner": "", "caches": []}


def enter(owner: str) -> None:
    """A task of this operator begins: what another one's tasks kept in this worker is of no use to it."""
    if _kept["owner"] != owner:
        for cache in _kept["caches"]:
            cache.clear()
        _kept["owner"] = owner
        give_back()


def give_back() -> None:
    """Return freed memory to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library than glibc
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, giving back what it has freed when its task ends: workers stay, and several share an executor."""
    owner = f"{run.__module__}.{run.__qualname__}"

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter(owner)
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidied


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20



def lowered(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z lower-cased."""
    return _LOWER[data]


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}
_kept["caches"].append(_powers)


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n, kept between calls."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        up = np.full(size, base, dtype=np.uint64)
        down = np.full(size, pow(base, -1, 1 << 64), dtype=np.uint64)
        up[0] = down[0] = 1
        have = (np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64))
        if size <= 4 * SLICE_BYTES:  # a giant document's table is not kept
            _powers[base] = have
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """Spread a 64-bit hash over all its bits (a bijection)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(MIX_1)
    h ^= h >> np.uint64(27)
    h *= np.uint64(MIX_2)
    h ^= h >> np.uint64(31)
    return h


class Words:
    """Word bounds of a run of documents.

    data: the bytes (lower-cased when asked); starts, ends: of each word in data;
    first[d]: number of words before document d, so document d has words first[d] to first[d + 1].
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, table: np.ndarray, lower: bool):
        self.data = _LOWER[data] if lower else data
        is_word = table[data]
        before = np.zeros(len(data) + 1, dtype=bool)
        before[1:] = is_word
        after = before[1:].copy()
        after[:-1] = is_word[1:]
        if len(data):
            after[-1] = False
        before = before[:-1]
        inner = offsets[(offsets > 0) & (offsets < len(data))]
        before[inner] = False
        after[inner - 1] = False
        self.starts = np.flatnonzero(is_word & ~before)
        self.ends = np.flatnonzero(is_word & ~after) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.doc = None

    def __len__(self) -> int:
        return len(self.starts)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        """The document of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def hashes(self, base: int = BYTE_BASE) -> np.ndarray:
        """A 64-bit hash of each word's bytes; another base gives another hash."""
        out, i = np.empty(len(self.starts), dtype=np.uint64), 0
        while i < len(out):  # runs of words of SLICE_BYTES, for a giant document's powers and sums would weigh 40 bytes a byte
            begin = int(self.starts[i])
            j = max(i + 1, int(np.searchsorted(self.ends, begin + SLICE_BYTES, side="right")))
            data = self.data[begin : self.ends[j - 1]]
            up, down = powers(base, len(data))
            sums = np.zeros(len(data) + 1, dtype=np.uint64)
            np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
            starts, ends = self.starts[i:j] - begin, self.ends[i:j] - begin
            out[i:j] = mix((sums[ends] - sums[starts]) * down[starts])
            i = j
        return out

    def text(self, i: int, j: int) -> bytes:
        """Words i to j (not included), joined by one space."""
        return b" ".join(self.data[a:b].tobytes() for a, b in zip(self.starts[i:j].tolist(), self.ends[i:j].tolist(), strict=True))


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k neighbouring words; those that cross a document are the caller's to drop."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    if k <= 4:
        out = hashes[k - 1 :].copy()
        for j in range(k - 2, -1, -1):
            out *= np.uint64(WORD_BASE)
            out += hashes[j : j + n]
        return mix(out)
    up, down = powers(WORD_BASE, len(hashes))
    sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes * up[: len(hashes)], out=sums[1:])
    return mix((sums[k:] - sums[:n]) * down[:n])


def window_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """For each i the position of the smallest of values[i : i + width], the first one of equals."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    best, at, have = values, np.arange(len(values)), 1
    while have < width:
        step = min(have, width - have)
        left, right = best[:-step], best[step:]
        take = right < left
        best = np.where(take, right, left)
        at = np.where(take, at[step:], at[:-step])
        have += step
    return at


def inside(first: np.ndarray, size: int, n: int) -> np.ndarray:
    """Of n runs of `size` words, by the first word: True where the run lies in one document."""
    ok = np.zeros(n + 1, dtype=np.int32)
    counts = np.diff(first)
    has = counts >= size
    np.add.at(ok, first[:-1][has], 1)
    np.add.at(ok, (first[1:] - size + 1)[has], -1)
    return np.cumsum(ok[:-1]) > 0


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (from 0) of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, dtype=np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of whole documents of about `most` bytes."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1)
        j = min(j, n)
        yield i, j
        i = j


def word_runs(column: pa.Array, table: np.ndarray, lower: bool) -> Iterator[tuple[int, int, Words]]:
    """Words of documents i to j of the column, run by run."""
    data, offsets = utf8(column)
    for i, j in slices(offsets):
        yield i, j, Words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], table, lower)


def nested(flat: pa.Array, counts: np.ndarray) -> pa.Array:
    """A list column whose rows have so many of the flat values."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), flat)


def gathered(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The rows in batches of `size` bytes or a little more: the JVM sends small ones, for its buffers stay with it."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        waiting.append(batch)
        if sum(b.nbytes for b in waiting) >= size:
            yield pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
            waiting = []
    if any(b.num_rows for b in waiting):
        yield pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]


def parts(batch: pa.RecordBatch, size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batch's rows in batches of about `size` bytes."""
    step = max(1, batch.num_rows * size // max(1, batch.nbytes))
    for k in range(0, batch.num_rows, step):
        yield batch.slice(k, step)
