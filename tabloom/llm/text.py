"""Whole texts of Arrow batches as flat byte arrays: words, hashes and code points without a Python loop over words."""

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

PIECE = 1_000_000        # bytes of text looked at together, whose tables of powers have 2**20 numbers; a longer text is a piece of its own
BASE = np.uint64(0x9E3779B97F4A7C15)


def byte_class(outside) -> np.ndarray:
    """A table of 256 flags: bytes that belong to a word."""
    inside = np.ones(256, bool)
    inside[list(outside)] = False
    return inside


# Words of the contracts, judged by bytes: every byte of a longer UTF-8 sequence belongs to a word.
SPACED = byte_class([0x20, *range(0x09, 0x0E)])
LETTERED = byte_class([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32


def pieces(batch: pa.RecordBatch, column="text", size=PIECE) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``size`` bytes of text, whole rows each."""
    _, offsets = flat(batch.column(batch.schema.get_field_index(column)))
    first = 0
    while first < batch.num_rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        yield batch.slice(first, last - first)
        first = last


def flat(texts: pa.Array):
    """(bytes, offsets) of a string array; a null is empty. The bytes are shared with Arrow, not copied."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


class Words:
    """Words of a piece: byte ranges [start, end) in ``data``, in order, with the row each belongs to."""

    def __init__(self, texts: pa.Array, inside: np.ndarray, lower=True):
        data, self.offsets = flat(texts)
        self.data = LOWER[data] if lower else data
        mask = np.concatenate([[False], inside[self.data], [False]])
        begin, stop = mask[1:-1] & ~mask[:-2], mask[1:-1] & ~mask[2:]
        edges = self.offsets[1:-1][(self.offsets[1:-1] > 0) & (self.offsets[1:-1] < len(data))]
        begin[edges] |= mask[1:-1][edges]
        stop[edges - 1] |= mask[1:-1][edges - 1]
        self.start, self.end = np.flatnonzero(begin), np.flatnonzero(stop) + 1
        self.bounds = np.searchsorted(self.start, self.offsets)      # words of row i: bounds[i] to bounds[i + 1]
        self.counts = np.diff(self.bounds)

    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self) -> np.ndarray:
        return range_hash(prefix_hash(self.data), self.start, self.end)

    def distinct(self):
        """(texts of the distinct words as bytes, number of each word's text)."""
        hashes = self.hashes()
        _, first, codes = np.unique(hashes, return_index=True, return_inverse=True)
        data = self.data.tobytes()
        return [data[a:b] for a, b in zip(self.start[first].tolist(), self.end[first].tolist())], codes


@lru_cache(2)
def powers(size: int, inverse: bool) -> np.ndarray:
    base = np.uint64(pow(int(BASE), -1, 1 << 64)) if inverse else BASE
    table = np.full(size, base, np.uint64)
    table[0] = 1
    return np.multiply.accumulate(table)


def power_table(n: int, inverse=False) -> np.ndarray:
    size = 1 << max(16, int(n).bit_length())
    return powers(size, inverse)[:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Sums of the polynomial hash modulo 2**64 over all prefixes."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power_table(len(data)), out=out[1:])
    return out


def range_hash(prefix: np.ndarray, start, end) -> np.ndarray:
    """64-bit hashes of the byte ranges, equal for equal bytes wherever they stand."""
    inverse = power_table(len(prefix), inverse=True)
    return mix((prefix[end] - prefix[start]) * inverse[start] + np.asarray(end - start).astype(np.uint64) * BASE)


def mix(x: np.ndarray) -> np.ndarray:
    """A finalizer that spreads all bits (the public splitmix64 constants)."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def runs(values: np.ndarray):
    """Starts and lengths of runs of equal neighbours."""
    if not len(values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    return starts, np.diff(np.concatenate([starts, [len(values)]]))


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All members of the ranges [start, start + length), one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.repeat(starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
    return np.arange(total) + shift
