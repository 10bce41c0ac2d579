"""Hard negatives by slot-decomposed selection: every window of an anchor is answered from disjoint slots of scores.

The rows are dealt into chunks and the anchors into blocks, both of bounded size; each pair of a chunk and a block is a cell, where all
scores are exact blocked products. A first pass keeps the best rows of an anchor's own label, its positives. Their upper limits, in descending
order, split the scores into slots; a second pass keeps the best rows of other labels in each slot, per cell, per task, and at last
per anchor. A window reaches from its positive's upper limit down, so its first rows are those of its own slot, then of the slots below, down
to its lower limit: one list of slots, read from the window's slot on, answers all windows, overlapping as they are.

Defined results: rows with a null key or label, a null vector, or any null or non-finite component take no part; only vectors of the same length
are compared; higher scores come first, ties go to the smaller key, then to the row read first; rows with equal keys are rows of their own, and
an anchor leaves out only its own row; an anchor without positives, and a positive whose window is empty, give no rows; an empty table gives
none; other columns are not read. Scores must fit a long.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.llm.rows import column, partitions
from tabloom.llm.topk import exact, matrix
from tabloom.session import materialize

CHUNK_ROWS = 65_536      # rows of a cell: 32 MB at 64 components
BLOCK_ROWS = 4_096       # anchors of a cell
SCORES = 1 << 21         # scores held at once
FOUND = "anchor long, slot int, row long, key long, score long"


class Side:
    """The rows of a cell of one vector length, by (key, row)."""

    def __init__(self, rows: pa.Table, length: int, labels: pa.Array):
        same = np.flatnonzero(pc.equal(pc.list_value_length(rows.column("vector")), length).to_numpy())
        row, key = (rows.column(c).to_numpy()[same] for c in ("row", "key"))
        by = np.lexsort((row, key))
        self.row, self.key, some = row[by], key[by], rows.take(pa.array(same[by]))
        self.vectors = matrix(some.column("vector").combine_chunks(), length)
        self.label = pc.index_in(some.column("label"), labels).to_numpy()
        self.limits = some.column("limits").to_pylist() if "limits" in rows.column_names else None


def best(scores: np.ndarray, allowed: np.ndarray, k: int):
    """(line, place) of each line's k best allowed scores; of equal scores the first."""
    width = scores.shape[1]
    if scores.dtype == object or np.abs(scores).max(initial=0) >= (1 << 62) // max(1, width):
        scores, found = scores.astype(object), []
        for line in range(len(scores)):
            places = sorted(np.flatnonzero(allowed[line]).tolist(), key=lambda p: (-scores[line, p], p))[:k]
            found += [(line, p) for p in places]
        return tuple(np.array(x, np.int64) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
    order = np.where(allowed, scores * width + np.arange(width - 1, -1, -1), np.iinfo(np.int64).min)
    if width > k:
        places = np.argpartition(order, width - k, axis=1)[:, width - k:]
    else:
        places = np.broadcast_to(np.arange(width), order.shape)
    line, at = np.nonzero(np.take_along_axis(allowed, places, axis=1))
    return line, places[line, at]


def cells(rows: pa.Table, anchors: pa.Table):
    """Pairs of sides of one length, and blocks of their scores: (anchors, rows, first anchor, scores, same label)."""
    if not rows.num_rows or not anchors.num_rows:         # then a side may lack its columns too
        return
    labels = pc.unique(pa.chunked_array([*rows.column("label").chunks, *anchors.column("label").chunks], pa.string()))
    for length in pc.unique(pc.list_value_length(anchors.column("vector"))).to_pylist():
        asks, given = Side(anchors, length, labels), Side(rows, length, labels)
        if not len(asks.row) or not len(given.row):
            continue
        queries, vectors = exact(asks.vectors, given.vectors)
        step = max(1, SCORES // len(given.row))
        for a in range(0, len(asks.row), step):
            scores = queries[a:a + step] @ vectors.T
            if scores.dtype != object:
                scores = scores.astype(np.int64)
            yield asks, given, a, scores, asks.label[a:a + step, None] == given.label[None, :]


def found_rows(asks, given, a, scores, line, place, slot: int):
    """Rows of ``FOUND`` for the chosen scores."""
    columns = [asks.row[a + line], np.full(len(line), slot, np.int32), given.row[place], given.key[place], [int(s) for s in scores[line, place]]]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                                      names=["anchor", "slot", "row", "key", "score"])


def table_of(batches: list) -> pa.Table:
    schema = pa.schema([("anchor", pa.int64()), ("slot", pa.int32()), ("row", pa.int64()), ("key", pa.int64()), ("score", pa.int64())])
    return pa.Table.from_batches(batches, schema)


def best_of_own_label(k: int):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = []
        for asks, given, a, scores, same in cells(rows, anchors):
            allowed = same & (asks.row[a:a + len(scores), None] != given.row[None, :])
            out.append(found_rows(asks, given, a, scores, *best(scores, allowed, k), 0))
        return table_of(out)
    return run


def best_of_slots(k: int):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = []
        for asks, given, a, scores, same in cells(rows, anchors):
            limits = asks.limits[a:a + len(scores)]
            slots = max(map(len, limits))
            nothing = scores.min(initial=0) - 1           # a limit that leaves nothing: windows beyond an anchor's last
            uppers = np.array([[w["upper"] for w in ws] + [nothing] * (slots + 1 - len(ws)) for ws in limits], scores.dtype)
            wide = [[w["lower"] for w in ws if w["lower"] <= w["upper"]] for ws in limits]
            lowest = np.array([min(lows, default=scores.max(initial=0) + 1) for lows in wide], scores.dtype)
            other = ~same & (scores >= lowest[:, None])
            for slot in range(slots):
                allowed = other & (scores <= uppers[:, slot, None]) & (scores > uppers[:, slot + 1, None])
                out.append(found_rows(asks, given, a, scores, *best(scores, allowed, k), slot))
        return table_of(out)
    return run


def in_cells(rows: DataFrame, anchors: DataFrame, chunks: int, blocks: int, work) -> DataFrame:
    """``work`` on every cell: rows go to their chunk in each block, anchors to their block in each chunk."""
    given = rows.withColumn("chunk", F.pmod(F.xxhash64("row"), F.lit(chunks))).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asking = anchors.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))
    asking = asking.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))))
    asking = asking.toDF(*[f"asking_{c}" for c in asking.columns])         # both sides come from one table: columns of their own

    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        return work(rows, anchors.rename_columns([c.removeprefix("asking_") for c in anchors.column_names]))

    return given.groupBy("chunk", "block").cogroup(asking.groupBy("asking_chunk", "asking_block")).applyInArrow(run, FOUND)


def first_rows(found: DataFrame, group, k: int) -> DataFrame:
    order = Window.partitionBy(*group).orderBy(F.col("score").desc(), "key", "row")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def mine_negatives(table: DataFrame, is_anchor: Column, key="vec_id", vector="embedding", label="label", scale=256, positives=5, negatives=10,
                   lower_percent=30, upper_percent=90, chunk_rows=CHUNK_ROWS, block_rows=BLOCK_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: the first negatives of each anchor and positive.

    ``is_anchor`` is a condition on the column ``key``, under this name. A positive of score p has the window of scores n with
    ``lower_percent`` * p <= 100 * n <= ``upper_percent`` * p. Scores are inner products of floor(scale * component).
    """
    spark = table.sparkSession
    rows = table.select(F.monotonically_increasing_id().alias("row"), column(table, key).cast("long").alias("key"),
                        column(table, label).cast("string").alias("label"), column(table, vector).cast("array<double>").alias("vector"))
    rows = rows.withColumn("asks", F.coalesce(is_anchor, F.lit(False)))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.filter(F.col("key").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite, F.lit(False)))
    rows = materialize(rows.withColumn("vector", F.transform("vector", lambda x: F.floor(x * scale).cast("double"))), "rows")
    anchors = rows.filter("asks").drop("asks")
    rows = rows.drop("asks")
    chunks = max(4 * partitions(spark), -(-rows.count() // chunk_rows))
    blocks = max(1, -(-anchors.count() // block_rows))

    near = first_rows(in_cells(rows, anchors, chunks, blocks, best_of_own_label(positives)), ["anchor"], positives)
    lower, upper = F.expr(f"cast(-floor(-cast(score as decimal(38, 0)) * {lower_percent} / 100) as long)"), F.expr(f"cast(floor(cast(score as decimal(38, 0)) * {upper_percent} / 100) as long)")
    window = F.struct("place", F.col("key").alias("positive_id"), F.col("score").alias("positive_score"), lower.alias("lower"), upper.alias("upper"))
    limits = near.groupBy("anchor").agg(F.array_sort(F.collect_list(window)).alias("limits"))
    limited = materialize(anchors.join(limits, anchors["row"] == limits["anchor"]).drop("anchor"), "anchors")

    found = in_cells(rows, limited, chunks, blocks, best_of_slots(negatives))
    kept = first_rows(found, ["anchor", "slot"], negatives)
    entry = F.struct("slot", "place", F.col("key").alias("negative_id"), F.col("score").alias("negative_score"))
    slots = kept.groupBy("anchor").agg(F.array_sort(F.collect_list(entry)).alias("slots"))
    answered = limited.select("row", F.col("key").alias("anchor_id"), "limits").join(slots, F.col("row") == F.col("anchor"))
    answered = answered.select("anchor_id", F.explode("limits").alias("window"), "slots")
    inside = F.filter("slots", lambda s: (s["slot"] >= F.col("window.place") - 1) & (s["negative_score"] >= F.col("window.lower")))
    answered = answered.select("anchor_id", "window.*", F.posexplode(F.slice(inside, 1, negatives)).alias("at", "negative"))
    return answered.select("anchor_id", "positive_id", (F.col("at") + 1).alias("rank"), "negative.negative_id", "positive_score", "negative.negative_score")


SQL = r"""
WITH vectors AS (
  SELECT row_number() OVER () AS row, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.row AS anchor, a.vec_id AS anchor_id, o.row AS other, o.vec_id, a.label = o.label AS same,
    CAST(coalesce(list_sum(list_transform(list_zip(a.v, o.v), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
  FROM vectors a JOIN vectors o ON a.row <> o.row AND len(a.v) = len(o.v) WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor, anchor_id, other, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, other) <= 5)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY s.score DESC, s.vec_id, s.other) AS INTEGER) AS rank,
  s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor = p.anchor AND NOT s.same AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY rank <= 10
"""
