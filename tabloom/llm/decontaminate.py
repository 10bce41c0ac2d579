"""Benchmark decontamination with an FM-index per shard of the documents.

Test texts become windows of ``width`` consecutive words (a shorter text is one window). Every task reduces its documents
to the words that occur in test texts, keeps the stretches that are long enough for a window, and indexes them: a suffix
order, the symbols before each suffix in a wavelet matrix, and sampled suffix positions. Backward search finds the windows,
the samples locate them, and overlapping occurrences merge into spans. Documents never move; only the windows are sent to
all tasks, in parts of at most ``part_bytes`` of test text, with a pass over the documents for each part.

Defined results: null and empty texts have no words and are not contaminated; test items without words have no window;
a null item id counts as the empty id, and rows with the same id are one item; without items nothing is hit; repeated
documents are judged row by row; other columns pass through, and one named like the new struct is replaced. Words are
compared by 64-bit hashes.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.annotate import annotate
from tabloom.llm.fm_index import FMIndex
from tabloom.llm.rows import column
from tabloom.llm.text import LETTERED, Words, flat, pieces, runs, spread
from tabloom.session import materialize

FIELDS = "n_words long, n_hit long, n_items long, items array<string>, items_sha256 string, contaminated boolean, spans array<struct<start:int,end:int>>"
PART_BYTES = 32 << 20    # test text whose windows are sent to every task at once


class Windows:
    """Distinct windows of test items as symbol matrices by length, and the items of each."""

    def __init__(self, ids: list, texts: list, width: int):
        words = Words(pa.array(texts, pa.large_string()), LETTERED)
        self.alphabet, symbols = np.unique(words.hashes(), return_inverse=True)
        self.items = sorted({i or "" for i in ids})
        number = {name: k for k, name in enumerate(self.items)}
        owners = {}
        for item, first, last in zip(ids, words.bounds[:-1].tolist(), words.bounds[1:].tolist()):
            for start in range(first, max(first, last - width) + 1) if last > first else ():
                owners.setdefault(tuple(symbols[start:min(start + width, last)] + 1), set()).add(number[item or ""])
        lengths = sorted({len(w) for w in owners})
        self.matrices = {n: np.array([w for w in owners if len(w) == n], np.int64) for n in lengths}
        self.owners = {n: [np.array(sorted(o)) for w, o in owners.items() if len(w) == n] for n in lengths}

    def hits(self, texts: pa.Array):
        """(words per text, flags of all words, text and item numbers of the hits, without repeats)."""
        counts, sequence, places, n_words = [], [], [], 0
        for piece in pieces(pa.RecordBatch.from_arrays([texts], ["text"])):
            words = Words(piece.column(0), LETTERED)
            hashes = words.hashes()
            found = np.minimum(np.searchsorted(self.alphabet, hashes), max(0, len(self.alphabet) - 1))
            symbols = np.where(self.alphabet[found] == hashes, found + 1, 0) if len(self.alphabet) else np.zeros(len(hashes), np.int64)
            where = self.stretches(symbols, words.row())     # of a piece only what can hold a window is kept
            sequence.append(np.where(where >= 0, symbols[where], 0) if len(where) else where)
            places.append(np.where(where >= 0, where + n_words, -1))
            counts.append(words.counts)
            n_words += len(symbols)
        counts, sequence, where = np.concatenate(counts), np.concatenate(sequence), np.concatenate(places)
        bounds = np.concatenate([[0], np.cumsum(counts)])
        marks = np.zeros(n_words + 1, np.int32)
        pairs = np.zeros((0, 2), np.int64)
        if len(where):
            index = FMIndex(sequence)
            for n, matrix in self.matrices.items():
                low, high = index.search(matrix)
                each = high - low
                at = where[index.locate(spread(low, each))]
                np.add.at(marks, at, 1)
                np.add.at(marks, at + n, -1)
                window = np.unique(np.repeat(np.arange(len(matrix)), each) + len(matrix) * (np.searchsorted(bounds, at, "right") - 1))
                sizes = np.array([len(self.owners[n][w]) for w in window % len(matrix)], np.int64)
                items = np.concatenate([self.owners[n][w] for w in window % len(matrix)] or [np.zeros(0, np.int64)])
                pairs = np.concatenate([pairs, np.stack([np.repeat(window // len(matrix), sizes), items], 1).astype(np.int64)])
        return counts, np.cumsum(marks[:-1], dtype=np.int32) > 0, np.unique(pairs, axis=0)

    def stretches(self, symbols, rows) -> np.ndarray:
        """Word numbers of the stretches of test words that can hold a window, each followed by -1."""
        if not self.matrices:
            return np.zeros(0, np.int64)
        starts, lengths = runs(np.where(symbols > 0, rows, -1 - np.arange(len(symbols))))
        fits = (symbols[starts] > 0) & (lengths >= min(self.matrices))
        starts, lengths = starts[fits], lengths[fits]
        where = spread(starts, lengths + 1)
        where[np.cumsum(lengths + 1) - 1] = -1
        return where


def judged(texts: pa.Array, parts: list):
    """Fields of the struct for a batch of texts; ``parts`` are broadcasts of windows, of which one is held at a time."""
    hit, names = False, None
    for part in parts:
        windows = part.value
        counts, part_hit, pairs = windows.hits(texts)
        hit = part_hit | hit
        names = [set() for _ in counts] if names is None else names
        for row, item in pairs.tolist():
            names[row].add(windows.items[item])
        if len(parts) > 1:
            del windows, part._value      # read again from the executor's disk for the next batch
    bounds = np.concatenate([[0], np.cumsum(counts)])
    total = np.concatenate([[0], np.cumsum(hit)])
    n_hit = total[bounds[1:]] - total[bounds[:-1]]
    spans = [[] for _ in counts]
    for row in np.flatnonzero(n_hit).tolist():
        spans[row] = merged_spans(texts.slice(row, 1), hit[bounds[row]:bounds[row + 1]])
    items = [sorted(n) for n in names]
    digests = [hashlib.sha256(",".join(i).encode()).hexdigest() for i in items]
    return counts, n_hit, [len(i) for i in items], items, digests, (n_hit > 0) & (20 * n_hit >= counts), spans


def merged_spans(text: pa.Array, hit: np.ndarray) -> list:
    """Code point ranges from the first to the last word of each run of hit words."""
    words = Words(text, LETTERED)
    data, _ = flat(text)
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    starts, lengths = runs(hit)
    on = hit[starts]
    first, last = starts[on], (starts + lengths)[on] - 1
    return [{"start": a, "end": b} for a, b in zip(points[words.start[first]].tolist(), points[words.end[last]].tolist())]


def mark_contaminated(docs: DataFrame, benchmark: DataFrame, text="text", item="item_id", item_text="text", width=13,
                      into="overlap", keep=None, part_bytes=PART_BYTES) -> DataFrame:
    """``docs`` with a struct ``into``: n_words, n_hit, n_items, items, items_sha256, contaminated, spans.

    Spans are code point ranges. A document is contaminated if at least one in twenty of its words is hit.
    """
    spark = docs.sparkSession
    tests = benchmark.select(column(benchmark, item).cast("string").alias("id"), column(benchmark, item_text).cast("string").alias("text"))
    size = tests.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = -(-size // part_bytes) or 1
    if parts > 1:
        tests = materialize(tests.withColumn("part", F.pmod(F.xxhash64("id", "text"), F.lit(parts))), "tests")
    else:
        tests = tests.withColumn("part", F.lit(0))
    sent = []
    for part in range(parts):
        rows = tests.filter(F.col("part") == part).select("id", "text").collect()
        sent.append(spark.sparkContext.broadcast(Windows([r["id"] for r in rows], [r["text"] for r in rows], width)))
    return annotate(docs, lambda: lambda texts: judged(texts, sent), FIELDS, into, text, keep)


SQL = r"""
WITH items AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS phrase
  FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS i FROM items WHERE len(w) > 0)),
words AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
found AS (
  SELECT row, i, p.n, item
  FROM (SELECT row, n, i, array_to_string(w[i:i + n - 1], ' ') AS phrase
        FROM (SELECT row, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM words, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)) p
  JOIN windows v ON p.n = v.n AND p.phrase = v.phrase),
hit AS (SELECT row, count(DISTINCT j) AS n_hit FROM (SELECT row, unnest(range(i, i + n)) AS j FROM found) GROUP BY row),
named AS (SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT row, item FROM found) GROUP BY row)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM words LEFT JOIN hit USING (row) LEFT JOIN named USING (row)
"""
