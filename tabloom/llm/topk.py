"""Exact top-k inner products by no-random-access aggregation over sorted lists.

Each Arrow batch of vectors is a shard. It keeps one list of (value, row) per component, sorted by value. A query reads its lists
sequentially in their best direction (from the top for a positive weight, from the bottom for a negative one), all to the
same depth; what lists of a direction have given is shared by the queries of a block. Entries read since the last depth are added to the known
part of each row's score; unread components lie between the worst end of their list (lower bound) and the last value read (upper
bound). Rows, seen or not, whose upper bound is below the k-th best lower bound are out, and nothing more is read for them; reading stops
when no query has more than k rows left, or, at the latest, at the last depth; the remaining rows' scores are then resolved from their vectors.
Spark keeps k rows per query and task before the last shuffle. Queries travel in parts of at most ``part_rows``, with a pass over
the shards for each part.

How soon reading stops depends on the data: skewed components stop it at the first depth, components without skew (all alike in spread,
many of them) hardly before the last.

Defined results: null vectors, vectors with null or non-finite components and rows with a null key take no part; only vectors of
the same length are compared; empty vectors score 0; ties go to the smaller key; rows with equal keys are rows of their own, and a query
leaves out only its own row; an empty table, or one without queries, gives no rows; other columns are not read.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabloom.llm.rows import column, partitions
from tabloom.session import materialize

DEPTHS = (0.03125, 0.125, 0.375, 0.625, 0.8125)      # shares of the lists read before bounds are compared again
EXACT = 1 << 53
SCHEMA = "query_row long, query_id long, row long, vec_id long, score long"
PART_ROWS = 50_000       # queries sent to every task at once: 25 MB at 64 components
BLOCK = 256              # queries whose bounds are held together


class Lists:
    """Sorted lists of (value, row) of a shard, one per component, read from both ends."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.rows = np.argsort(vectors, axis=0, kind="stable")
        self.values = np.take_along_axis(vectors, self.rows, axis=0)
        self.entries = 0          # entries read so far, over all blocks of queries

    def read(self, begin: int, end: int, left: np.ndarray):
        """The entries from depth ``begin`` to ``end`` of the lists' tops and of their bottoms: for each a matrix of the values of the rows
        ``left`` and one of flags, both 0 where nothing was read."""
        n, d = self.vectors.shape
        place = np.full(n, -1)
        place[left] = np.arange(len(left))
        out = []
        for part in (slice(n - end, n - begin), slice(begin, end)):
            at = place[self.rows[part]]
            kept = at >= 0
            value, flag = np.zeros((2, len(left), d), self.values.dtype)
            component = np.broadcast_to(np.arange(d), at.shape)[kept]
            value[at[kept], component] = self.values[part][kept]
            flag[at[kept], component] = 1
            self.entries += int(kept.sum())
            out.append((value, flag))
        return out

    def top(self, queries: np.ndarray, keys: np.ndarray, own: np.ndarray, k: int):
        """(query numbers, row numbers, scores) of each query's k best rows; ``own`` is a query's row here or -1."""
        n = len(self.vectors)
        up, down = np.maximum(queries, 0), np.minimum(queries, 0)
        left = np.arange(n)                          # rows that may still qualify for some query of the block
        alive = np.ones((len(queries), n), bool)
        alive[np.flatnonzero(own >= 0), own[own >= 0]] = False
        known = np.zeros((len(queries), n), queries.dtype)       # score of the components read, by rows left
        unread = list(np.ones((2, *self.vectors.shape), self.values.dtype))
        begin = 0
        for end in sorted({max(1, int(n * share)) for share in DEPTHS}):
            if not len(left) or alive.sum(1).max(initial=0) <= k:
                break
            tops, bottoms = self.read(begin, end, left)
            known += up @ tops[0].T + down @ bottoms[0].T
            unread = [before - now[1] for before, now in zip(unread, (tops, bottoms))]
            upper = known + (up * self.values[n - end]) @ unread[0].T + (down * self.values[end - 1]) @ unread[1].T
            lower = known + (up * self.values[0]) @ unread[0].T + (down * self.values[-1]) @ unread[1].T
            lower = np.where(alive[:, left], lower, -np.inf)
            bar = np.partition(lower, -k, axis=1)[:, -k] if len(left) > k else np.full(len(queries), -np.inf)
            alive[:, left] &= upper >= bar[:, None]
            stays = alive[:, left].any(0)
            left, known, unread, begin = left[stays], known[:, stays], [u[stays] for u in unread], end
        query, row = np.nonzero(alive)
        scores = np.concatenate([np.einsum("ij,ij->i", queries[query[a:a + (1 << 16)]], self.vectors[row[a:a + (1 << 16)]])
                                 for a in range(0, len(query), 1 << 16)] or [np.zeros(0)])
        order = np.lexsort((row, keys[row], -scores, query))
        query, row, scores = query[order], row[order], scores[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        return query[place < k], row[place < k], scores[place < k]


def matrix(vectors: pa.Array, length: int) -> np.ndarray:
    """Vectors of one length as the rows of a matrix."""
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), length)


def exact(queries: np.ndarray, vectors: np.ndarray):
    """Both matrices of floats where every score is exact in them, else of Python integers."""
    if np.abs(queries).max(initial=0) * np.abs(vectors).max(initial=0) * max(1, vectors.shape[1]) < EXACT:
        return queries, vectors
    return queries.astype(object), vectors.astype(object)


def search(sent, k: int):
    def run(batches):
        for batch in batches:
            lengths = pc.list_value_length(batch.column("vector")).to_numpy()
            for length in np.unique(lengths):
                if int(length) not in sent.value:
                    continue
                some = batch.filter(pa.array(lengths == length))
                q_rows, q_ids, queries = sent.value[int(length)]
                rows, keys = some.column("row").to_numpy(), some.column("key").to_numpy()
                place = {int(r): i for i, r in enumerate(rows)}
                own = np.array([place.get(int(r), -1) for r in q_rows], np.int64)
                all_queries, vectors = exact(queries, matrix(some.column("vector"), int(length)))
                lists = Lists(vectors)
                for a in range(0, len(q_rows), BLOCK):
                    query, row, score = lists.top(all_queries[a:a + BLOCK], keys, own[a:a + BLOCK], k)
                    yield pa.RecordBatch.from_arrays([pa.array(q_rows[a:a + BLOCK][query]), pa.array(q_ids[a:a + BLOCK][query]), pa.array(rows[row]),
                                                      pa.array(keys[row]), pa.array([int(s) for s in score], pa.int64())],
                                                     names=["query_row", "query_id", "row", "vec_id", "score"])
    return run


def top_inner_products(table: DataFrame, is_query, key="vec_id", vector="embedding", scale=256, k=5, part_rows=PART_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best other rows by the inner product of floor(scale * component).

    ``is_query`` is a condition on the column ``key`` of the table.
    """
    spark = table.sparkSession
    rows = table.select(F.monotonically_increasing_id().alias("row"), column(table, key).cast("long").alias("key"),
                        column(table, vector).cast("array<double>").alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.filter(F.col("key").isNotNull() & F.coalesce(finite, F.lit(False)))
    whole = F.transform("vector", lambda x: F.floor(x * scale).cast("double"))
    rows = materialize(rows.withColumn("vector", whole).repartition(partitions(spark), F.xxhash64("row")), "vectors")
    asking = rows.filter("asks")
    count = asking.count()
    parts = -(-count // part_rows)
    out = None
    for part in range(parts):
        some = asking.filter(F.pmod(F.xxhash64("row"), F.lit(parts)) == part).select("row", "key", "vector").toArrow()
        lengths = pc.list_value_length(some.column("vector")).to_numpy()
        by_length = {}
        for length in np.unique(lengths):
            same = some.filter(pa.array(lengths == length)).combine_chunks()
            by_length[int(length)] = (same.column("row").to_numpy(), same.column("key").to_numpy(), matrix(same.column("vector").combine_chunks(), int(length)))
        found = rows.select("row", "key", "vector").mapInArrow(search(spark.sparkContext.broadcast(by_length), k), SCHEMA)
        found = ranked(found, k)
        out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return out.select("query_id", "rank", "vec_id", "score")


def ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


SQL = r"""
WITH vectors AS (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.row, q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score, c.row AS other
  FROM vectors q JOIN vectors c ON q.row <> c.row AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id, other) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
