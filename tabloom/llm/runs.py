"""Periodic runs of words, found by the branching-tandem test over an enhanced suffix array.

The documents of a piece share one suffix array, in which the words of different documents are different symbols, so that every
LCP interval lies within a document. For each interval, the suffixes i of all its children but the largest look up
whether the suffixes at i + depth and i - depth are in the interval too, by their places in the inverse suffix array. If one is, and the words
behind the two copies differ, a square ends there that cannot be turned to the right. It is rotated to the left as far as it goes, which gives
a maximal run; squares of one run found under several periods are merged under the smallest. Intervals are pairs of places in arrays, and there
are no tree nodes.

Defined results: a null, empty or blank text has no words and no run; documents with equal or null keys are documents of their own; other
columns are kept, and one named as the result is replaced; an empty table gives no rows. Runs never cross documents. A text is ordered as a
whole, with about 300 bytes of memory a word for it; short texts are taken together in pieces of ``PIECE_BYTES``.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tabloom.llm.annotate import annotate
from tabloom.llm.text import SPACED, Words, flat, spread

PIECE_BYTES = 1 << 20
SHORTEST = 12
FIELDS = "n_words long, runs array<struct<start:long,length:long,period:long>>, runs_sha256 string, collapsed_sha256 string"
RUNS = to_arrow_type(T.ArrayType(T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")])))


class SuffixArray:
    """Order, places and common prefixes of all suffixes of a sequence of symbols.

    ``ranks[k]`` numbers the stretches of 2**k symbols: two positions have the same number if and only if these are
    equal. Every document ends with a symbol of its own, so equal stretches never reach beyond a document.
    """

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        order = np.argsort(symbols).astype(np.int32)
        self.parted = np.full(n + 1, -1, np.int8)         # the level that told the places t - 1 and t apart
        self.ranks = []
        rank, tied = self.group(symbols[order], order, np.arange(n, dtype=np.int32), np.empty(n, np.int32))
        while len(tied):                                  # places in the order that are not settled yet
            width = 1 << (len(self.ranks) - 1)
            some = order[tied]
            key = rank[some].astype(np.int64) * n + rank[np.minimum(some + width, n - 1)]
            by = np.argsort(key)
            order[tied] = some[by]
            rank, tied = self.group(key[by], some[by], tied, rank.copy())
        self.order, self.place = order, rank
        self.lcp = self.common_prefixes()

    def group(self, keys, positions, places, rank):
        """Numbers equal keys by the first place of their group; returns the numbers and the places of groups of two or more."""
        new = np.ones(len(keys), bool)
        new[1:] = keys[1:] != keys[:-1]
        first = np.flatnonzero(new)
        heads = places[first]
        self.parted[heads[self.parted[heads] < 0]] = len(self.ranks)
        rank[positions] = np.repeat(heads, np.diff(np.append(first, len(keys))))
        self.ranks.append(rank)
        return rank, places[~(new & np.append(new[1:], True))]

    def common_prefixes(self) -> np.ndarray:
        """lcp[t]: common symbols of the suffixes at the places t - 1 and t; lcp[0] and lcp[n] are 0."""
        lcp = np.zeros(len(self.order) + 1, np.int32)
        for k in range(len(self.ranks) - 2, -1, -1):
            t = np.flatnonzero(self.parted > k)           # these share 2**k symbols at least; places told apart earlier have no more to add
            a, b = self.order[t - 1] + lcp[t], self.order[t] + lcp[t]
            lcp[t] += np.where(self.ranks[k][a] == self.ranks[k][b], 1 << k, 0).astype(np.int32)
        return lcp

    def common_before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols before the positions are equal."""
        a, b = a.copy(), b.copy()
        begin = a.copy()
        for k in range(len(self.ranks) - 1, -1, -1):
            width = 1 << k
            inside = np.minimum(a, b) >= width
            rank = self.ranks[k]
            step = np.where(inside & (rank[np.maximum(a - width, 0)] == rank[np.maximum(b - width, 0)]), width, 0).astype(a.dtype)
            a -= step
            b -= step
        return begin - a

    def intervals(self):
        """(place, first, end): for every place t with lcp[t] > 0, the interval [first, end) of depth lcp[t] that it divides."""
        t = np.flatnonzero(self.lcp).astype(np.int32)
        minima = [self.lcp]                               # minima[k][i]: the least lcp of the 2**k places from i on
        while len(minima[-1]) > (1 << len(minima)) and minima[-1].any():
            half = 1 << (len(minima) - 1)
            minima.append(np.minimum(minima[-1][:-half], minima[-1][half:]))
        depth, first, end = self.lcp[t], t.copy(), t + 1
        for k in range(len(minima) - 1, -1, -1):
            width, low = 1 << k, minima[k]
            before = first - width
            first = np.where((before >= 0) & (low[np.maximum(before, 0)] >= depth), before, first)
            after = np.minimum(end, len(low) - 1)
            end = np.where((end < len(low)) & (low[after] >= depth), end + width, end)
        return t, first - 1, end


def smaller_children(suffixes: SuffixArray):
    """(place, first, end, depth): every suffix of every child but the largest of every LCP interval, with the interval."""
    t, first, end = suffixes.intervals()
    depth = suffixes.lcp[t]
    by = np.lexsort((t, depth, first))                    # the dividing places of an interval, one after the other
    t, first, end, depth = t[by], first[by], end[by], depth[by]
    opens = np.ones(len(t), bool)
    opens[1:] = (first[1:] != first[:-1]) | (depth[1:] != depth[:-1])
    closes = np.append(opens[1:], True)[:len(t)]
    begin = np.concatenate([np.where(opens, first, np.append(0, t)[:-1]), t[closes]])       # a child before each place, and the last one
    stop = np.concatenate([t, end[closes]])
    number = np.cumsum(opens) - 1
    owner = np.concatenate([number, number[closes]])
    size = stop - begin
    by = np.lexsort((-size, owner))
    kept = by[1:][owner[by][1:] == owner[by][:-1]]        # all but the first, which is the largest
    lengths = size[kept].astype(np.int64)
    heads = np.flatnonzero(opens)[owner[kept]]
    return (spread(begin[kept].astype(np.int64), lengths), *[np.repeat(x[heads], lengths) for x in (first, end, depth)])


def branching_squares(suffixes: SuffixArray, symbols: np.ndarray):
    """(position, period): squares that cannot be turned to the right, each period an interval's depth."""
    place, first, end, depth = smaller_children(suffixes)
    at = suffixes.order[place].astype(np.int64)
    found = []
    for near, far, other in ((at, at + depth, at + depth), (at - depth, at, at - depth)):
        there = suffixes.place[np.clip(other, 0, len(symbols) - 1)]
        hit = np.flatnonzero((other >= 0) & (other < len(symbols)) & (there >= first) & (there < end))
        hit = hit[symbols[far[hit]] != symbols[far[hit] + depth[hit]]]
        found.append((near[hit], depth[hit].astype(np.int64)))
    return tuple(np.concatenate(x) for x in zip(*found))


def maximal_runs(symbols: np.ndarray, shortest=SHORTEST):
    """(start, length, period) of all runs, by start, then period. ``symbols`` ends with a symbol that it holds once."""
    suffixes = SuffixArray(symbols)
    position, period = branching_squares(suffixes, symbols)
    reach = position + 2 * period
    start = position - suffixes.common_before(position, position + period)
    long = reach - start >= shortest
    start, reach, period = start[long], reach[long], period[long]
    by = np.lexsort((period, reach, start))
    start, reach, period = start[by], reach[by], period[by]
    least = np.ones(len(by), bool)
    least[1:] = (start[1:] != start[:-1]) | (reach[1:] != reach[:-1])
    start, length, period = start[least], (reach - start)[least], period[least]
    by = np.lexsort((period, start))
    return start[by], length[by], period[by]


class WordList:
    """The words of a piece in a row: their bytes without gaps, and equal numbers for equal words."""

    def __init__(self, texts: pa.Array):
        words = Words(texts, SPACED, lower=False)
        self.counts = words.counts.astype(np.int64)
        sizes = words.end - words.start
        self.data = words.data[spread(words.start, sizes)]
        self.offsets = np.concatenate([[0], np.cumsum(sizes)])
        found = pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(self.offsets.astype(np.int64)), pa.py_buffer(self.data)])
        self.codes = found.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64) if len(sizes) else np.zeros(0, np.int64)

    def joined(self, chosen: np.ndarray):
        """(bytes of the chosen words with a space after each, bytes of each word with its space)."""
        sizes = self.offsets[chosen + 1] - self.offsets[chosen] + 1
        out = np.append(self.data, np.uint8(0))[spread(self.offsets[chosen], sizes)]
        out[np.cumsum(sizes) - 1] = 0x20
        return out, sizes


def document_symbols(codes: np.ndarray, counts: np.ndarray):
    """(symbols, row of each symbol): words of a document numbered apart from all others, and an end symbol after each document."""
    row = np.repeat(np.arange(len(counts)), counts + 1)
    ends = np.cumsum(counts + 1) - 1
    symbols = np.empty(len(row), np.int64)
    inner = np.ones(len(row), bool)
    inner[ends] = False
    symbols[inner] = codes + 1
    symbols[~inner] = 0
    return row * (int(codes.max(initial=0)) + 2) + symbols, row


def runs_of_piece(texts: pa.Array, shortest: int):
    """The fields of ``FIELDS`` for the documents of a piece."""
    words = WordList(texts)
    counts = words.counts
    symbols, row = document_symbols(words.codes, counts)
    start, length, period = maximal_runs(symbols, shortest)
    begin = np.concatenate([[0], np.cumsum(counts + 1)])[:-1]
    change = np.zeros(len(symbols) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    kept = np.cumsum(change)[:-1] == 0
    kept[begin + counts] = False                          # the end symbols
    left = np.add.reduceat(kept.astype(np.int64), begin)
    chosen = np.flatnonzero(np.delete(kept, begin + counts))
    text, sizes = words.joined(chosen)
    upto = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(left)])].tolist()
    collapsed = [hashlib.sha256(text[a:max(a, b - 1)]).hexdigest() for a, b in zip(upto, upto[1:])]
    edges = np.searchsorted(row[start], np.arange(len(counts) + 1))
    start = start - begin[row[start]]
    lines = [f"{s},{n},{p}\n" for s, n, p in zip(start.tolist(), length.tolist(), period.tolist())]
    listed = [hashlib.sha256("".join(lines[a:b]).encode()).hexdigest() for a, b in zip(edges.tolist(), edges[1:].tolist())]
    found = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)], fields=list(RUNS.value_type))
    return [pa.array(counts), pa.ListArray.from_arrays(pa.array(edges, pa.int32()), found).cast(RUNS), pa.array(listed), pa.array(collapsed)]


def find_runs(docs: DataFrame, text="text", into="periodic", keep=None, shortest=SHORTEST, piece_bytes=PIECE_BYTES) -> DataFrame:
    """The documents with a struct ``into``: n_words, runs (start, length, period) by start, then period, and two digests.

    A run is a stretch of at least ``shortest`` words, and two periods, that no neighbouring word extends. ``runs_sha256`` is of the lines
    ``start,length,period``; ``collapsed_sha256`` of the words, joined by a space, that are not behind the first period of any run.
    """

    def work(texts):
        parts = [runs_of_piece(some, shortest) for some in slices(texts, piece_bytes)]
        return [pa.chunked_array(column).combine_chunks() for column in zip(*parts)]

    return annotate(docs, lambda: work, FIELDS, into, text, keep)


def slices(texts: pa.Array, size: int):
    """Whole texts, about ``size`` bytes at a time."""
    _, offsets = flat(texts)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        yield texts.slice(first, last - first)
        first = last
