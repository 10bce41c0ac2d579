"""A quality classifier by votes of the nearest labelled texts in a latent-semantic space.

A text's features are its hashed pairs of neighbouring bytes, as damped counts weighted by rarity. The directions of greatest spread among at most
``sample`` labelled rows (a bounded sample, in md5 order of the key) span the space. These rows' vectors and labels are
sent to all tasks; every whole text is compared with all of them by blocked cosine products, exactly, and its ``neighbours`` nearest vote
with their similarity, raised to ``power``.

Defined results: null and empty texts have no features, and the score of a text that resembles nothing is the share of label 1;
without labelled rows it is 0.5; rows with a null label teach nothing; ties in similarity go to the earlier sample row;
repeated rows are judged alike; other columns pass through, and one named like the new struct is replaced.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.annotate import annotate
from tabloom.llm.rows import column
from tabloom.llm.text import flat, mix, pieces

SLOTS, DIMENSIONS = 1024, 48
PAIR_SLOT = (mix(np.arange(1 << 16, dtype=np.uint64)) & np.uint64(SLOTS - 1)).astype(np.int64)


def features(texts: pa.Array) -> np.ndarray:
    """Counts of hashed byte pairs, one row per text."""
    data, offsets = flat(texts)
    row = np.repeat(np.arange(len(texts)), np.diff(offsets))
    slot = PAIR_SLOT[data[:-1].astype(np.int64) * 256 + data[1:]]
    inside = row[:-1] == row[1:]
    return np.bincount(row[:-1][inside] * SLOTS + slot[inside], minlength=len(texts) * SLOTS).reshape(-1, SLOTS).astype(np.float32)


class Neighbours:
    """The labelled vectors and the map of feature counts into their space."""

    def __init__(self, counts: np.ndarray, labels: np.ndarray):
        self.labels, self.prior = labels.astype(np.float32), float(labels.mean()) if len(labels) else 0.5
        self.rarity = (np.log((1 + len(counts)) / (1 + (counts > 0).sum(0))) + 0.1).astype(np.float32)
        weighted = self.weighted(counts)
        self.center = weighted.mean(0) if len(counts) else np.zeros(SLOTS, np.float32)
        weighted = weighted - self.center
        self.directions = np.linalg.eigh((weighted.T @ weighted).astype(np.float64))[1][:, -DIMENSIONS:].astype(np.float32)
        self.vectors = self.latent(counts)

    def weighted(self, counts: np.ndarray) -> np.ndarray:
        out = np.log1p(counts) * self.rarity
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)

    def latent(self, counts: np.ndarray) -> np.ndarray:
        out = (self.weighted(counts) - self.center) @ self.directions
        out /= np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)
        out[counts.sum(1) == 0] = 0
        return out

    def vote(self, counts: np.ndarray, neighbours: int, power: int, block=512) -> np.ndarray:
        scores = np.full(len(counts), self.prior)
        near = min(neighbours, len(self.labels))
        for a in range(0, len(counts) if near else 0, block):
            cosine = self.latent(counts[a:a + block]) @ self.vectors.T
            bar = -np.partition(-cosine, near - 1, axis=1)[:, near - 1:near]
            above, level = cosine > bar, cosine == bar
            chosen = above | (level & (np.cumsum(level, axis=1) <= near - above.sum(1, keepdims=True)))
            weight = np.where(chosen, np.maximum(cosine, 0), 0).astype(np.float64) ** power
            total = weight.sum(1)
            scores[a:a + block] = np.where(total > 0, (weight @ self.labels) / np.where(total > 0, total, 1), self.prior)
        return np.clip(scores, 0, 1)


def counts_of(texts: pa.Array):
    return [pa.array(list(features(texts)), pa.list_(pa.float32()))]


def fit_neighbours(docs: DataFrame, labels: DataFrame, label="quality", key="doc_id", text="text", sample=4000) -> Neighbours:
    """A voter from at most ``sample`` rows of ``docs`` that have a label.

    The rows are chosen by their keys alone; only the texts of the chosen keys, at most ``sample`` of which are sent to all tasks, are
    read again, and their features are counted by tasks, not by the driver.
    """
    marked = labels.select(column(labels, key).alias("k"), column(labels, label).cast("int").alias("label")).filter("label IS NOT NULL")
    order = [F.md5(F.col("k").cast("string")), F.col("k"), F.col("label")]
    chosen = docs.select(column(docs, key).alias("k")).join(marked, "k").orderBy(*order).limit(sample).distinct()
    some = docs.select(column(docs, key).alias("k"), column(docs, text).alias("text")).join(F.broadcast(chosen), "k")
    found = annotate(some, lambda: counts_of, "counts array<float>", "f", keep=["k", "label"]).select("k", "label", "f.counts")
    found = found.orderBy(*order).limit(sample).toPandas()          # keys may repeat
    found = found.sort_values(["k", "label"], kind="stable")
    counts = np.stack(found["counts"].to_list()) if len(found) else np.zeros((0, SLOTS), np.float32)
    return Neighbours(counts, found["label"].to_numpy())


def score_quality(docs: DataFrame, voter: Neighbours, text="text", into="quality", keep=None, neighbours=15, power=8, threshold=0.3) -> DataFrame:
    """``docs`` with a struct ``into``: score (0 to 1) and predicted (1 from ``threshold`` on)."""
    sent = docs.sparkSession.sparkContext.broadcast(voter)

    def judge(texts):
        parts = [sent.value.vote(features(p.column(0)), neighbours, power) for p in pieces(pa.RecordBatch.from_arrays([texts], ["text"]))]
        scores = np.concatenate(parts) if parts else np.zeros(0)
        return scores, (scores >= threshold).astype(np.int32)

    return annotate(docs, lambda: judge, "score double, predicted int", into, text, keep)
