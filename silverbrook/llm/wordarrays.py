"""Word arrays: whole Arrow text columns as numpy arrays of word bounds and hashes.

The operators of this subpackage that need words work on slices of an Arrow batch, never on single rows: one pass over
the bytes of a slice finds every word ``[^\\x20\\x09-\\x0D]+`` of every text in it, and prefix sums give each word a
64-bit hash.  A slice is cut at ``SLICE_BYTES`` of text, so that memory in a task is bounded by the largest single
text, not by the partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20
#: Bytes that are hashed at once.
HASH_BYTES = 1 << 19

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_VALUES = np.random.Generator(np.random.PCG64(0x5EED)).integers(1, 2**63, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_MOD = 1 << 64
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int, base: int = _BASE) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of an odd base modulo 2**64, and of its inverse; kept between calls up to a few slices."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, HASH_BYTES * 2)
        out = []
        for b in (base, pow(base, -1, _MOD)):
            step = np.full(size, b, np.uint64)
            step[0] = 1
            out.append(np.cumprod(step, dtype=np.uint64))
        have = (out[0], out[1])
        if size <= HASH_BYTES * 4:
            _powers[base] = have
    return have[0][:n], have[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64's constants)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of whole rows with at most ``limit`` bytes of text, or a single row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, start = np.cumsum(size), 0
        while start < batch.num_rows:
            base = int(ends[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def whole_runs(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Cut batches whose rows stand together by a column of numbers so that no run of equal ones is parted."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        value = batch.column(column).to_numpy()
        if held and held[-1].column(column)[-1].as_py() != value[0]:
            yield _joined(held)
            held = []
        other = np.flatnonzero(value != value[-1])
        last = int(other[-1]) + 1 if len(other) else 0
        if last:
            yield _joined([*held, batch.slice(0, last)])
            held = []
        held.append(batch.slice(last))
    if held:
        yield _joined(held)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.concat_batches(parts)


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets): the UTF-8 of a string column, or the bytes of a binary one, end to end; null counts as empty."""
    column = pc.fill_null(column, pa.scalar(b"" if pa.types.is_binary(column.type) else "", column.type)) if column.null_count else column
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        kind = np.int32
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8)[offsets[0] : offsets[-1]] if buffers[2] is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


class Words:
    """All words of a slice of texts, in order.

    ``start``/``end``: byte bounds in ``data``; ``first``: index of each text's first word, with one more entry at the
    end, so text ``d`` owns the words ``first[d]:first[d + 1]``.
    """

    def __init__(self, column: pa.Array, lower: bool = False):
        data, offsets = raw(column)
        if lower:
            data = _LOWER[data]
        self.data, self.offsets = data, offsets
        word = ~_SPACE[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        before = np.zeros(len(data), bool)
        before[1:] = word[:-1]
        self.start = np.flatnonzero(word & (~before | edge[:-1]))
        after = np.zeros(len(data), bool)
        after[:-1] = word[1:]
        self.end = np.flatnonzero(word & (~after | edge[1:])) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.word = word

    def __len__(self) -> int:
        return len(self.start)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, base: int = _BASE) -> np.ndarray:
        """A 64-bit hash of each word's bytes; another odd base gives another hash."""
        out, i = np.empty(len(self.start), np.uint64), 0
        while i < len(out):  # blocks of whole words, for the memory's sake
            j = max(i + 1, int(np.searchsorted(self.start, self.start[i] + HASH_BYTES)))
            a, b = self.start[i], self.end[j - 1]
            up, down = powers(b - a, base)
            value = _BYTE_VALUES[self.data[a:b]]
            value *= up
            total = np.cumsum(value, dtype=np.uint64)
            start = self.start[i:j] - a
            part = total[self.end[i:j] - 1 - a] - total[start]
            part += value[start]
            part *= down[start]
            out[i:j] = mix(part)
            i = j
        return out

    def canonical(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bytes, start, end): the words with one space after each."""
        begins = np.zeros(len(self.data), bool)
        begins[self.start] = True
        kind = np.int32 if len(self.data) + len(self.start) < 1 << 31 else np.int64
        place = np.cumsum(begins, dtype=kind)[self.word]  # the words up to each byte of a word
        place += np.arange(-1, len(place) - 1, dtype=kind)
        out = np.full(len(place) + len(self.start), 0x20, np.uint8)
        out[place] = self.data[self.word]
        end = np.cumsum(self.end - self.start + 1) - 1
        return out, end - (self.end - self.start), end


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """The hash of each run of ``k`` words, by the index of its first word; it doesn't heed the bounds of texts."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out *= np.uint64(0xD1342543DE82EF95)
        out += hashes[j : j + n]
    return mix(out)


def inside(first: np.ndarray, k: int, n: int) -> np.ndarray:
    """For each of the ``n`` words but the last ``k - 1``: whether the run of ``k`` words from it stays in one text."""
    ok = np.ones(max(n - k + 1, 0), bool)
    for j in range(1, k):
        at = first[1:-1] - j
        at = at[(at >= 0) & (at < len(ok))]
        ok[at] = False
    return ok
