"""Exact k nearest neighbours as a distributed join.

Training rows are dealt to cells, boxes cut at medians of a bounded sample (a k-d tree); the box of a cell is the exact
least and largest coordinate of its rows. A query first meets its own cell. The k-th distance found there is a limit, and
only cells whose boxes come as near as this limit are met after it (two rounds, as in the kNN joins of Lu et al. 2012 and of
SpatialHadoop). Cells with many rows or many queries are cut into blocks of bounded size on both sides, so no task depends on
how full a cell is. Inside a block the same boxes, smaller, tell which rows a query is compared with, and every block
returns only its k best per query.
"""

import heapq

import numpy as np
import pandas as pd
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabloom.functions.expressions import double_array
from tabloom.models.base import BinaryEstimator, Columns, Param, Params, TypeConverters, keyword_only
from tabloom.session import materialize, scratch_path

MOST_CELLS = 2048       # cells; their boxes travel with the tasks
FEW_CELLS = 16          # cells of a smaller table, so that there are blocks for many tasks
SAMPLE_ROWS = 16        # rows a cell that the cuts are chosen from
BLOCK_ROWS = 20_000     # most training rows, and most queries, of one block
LEAF_ROWS = 128         # rows of a small box of a block; eight times as many beyond FLAT columns, where boxes tell little
FLAT = 8
SPARSE = 0.1            # share of a matrix of pairs below which its pairs are computed one by one
TILE = 32_768           # numbers of a temporary array, which stays in a core's cache
CHUNK = 2_000_000       # least distances to boxes that are held at once
METRICS = ("euclidean", "manhattan", "minkowski", "chebyshev", "mahalanobis")
SLACK = 1e-9            # relative allowance for rounding when boxes are skipped


def power_of(metric, p):
    """The metric as the power of a Minkowski distance (mahalanobis data is whitened beforehand)."""
    return {"euclidean": 2.0, "mahalanobis": 2.0, "manhattan": 1.0, "chebyshev": np.inf}.get(metric, p)


def folded(differences, shape, power):
    """The distance whose absolute differences come one array a column; the arrays are overwritten."""
    out = np.zeros(shape)
    for t in differences:
        if power == np.inf:
            np.maximum(out, t, out=out)
            continue
        if power in (2, 3, 4):
            once = t.copy() if power > 2 else t
            for _ in range(int(power) - 1):
                t *= once
        elif power != 1:
            t **= power
        out += t
    if power == 2:
        return np.sqrt(out, out=out)
    return out if power in (1, np.inf) else out ** (1.0 / power)


def distances(a, b, metric, p):
    """Matrix of distances between the rows of two arrays."""
    power, out = power_of(metric, p), np.empty((len(a), len(b)))
    left, right = np.ascontiguousarray(a.T), np.ascontiguousarray(b.T)
    step = max(1, TILE // max(1, len(b)))
    for start in range(0, len(a), step):
        t = np.empty((len(a[start:start + step]), len(b)))

        def differences():
            for x, y in zip(left, right):
                np.subtract(x[start:start + step, None], y[None, :], out=t)
                yield np.abs(t, out=t)
        out[start:start + step] = folded(differences(), t.shape, power)
    return out


def box_distances(a, low, high, metric, p):
    """Matrix of the least distances from the rows of an array to boxes."""
    def differences():
        for x, lo, hi in zip(a.T, low.T, high.T):
            t = np.maximum(lo[None, :] - x[:, None], x[:, None] - hi[None, :])
            yield np.maximum(t, 0.0, out=t)
    return folded(differences(), (len(a), len(low)), power_of(metric, p))


class Boxes:
    """A tree of at most ``wanted`` boxes, cut at medians of the widest column, always the box of the most rows."""

    def __init__(self, points, wanted):
        self.column, self.value, self.below, self.above = [-1], [0.0], [0], [0]
        waiting, leaves = [(-len(points), 0, points)], 1
        while waiting and leaves < wanted:
            _, node, rows = heapq.heappop(waiting)
            if len(rows) < 2:
                break
            widths = rows.max(axis=0) - rows.min(axis=0)
            widest = int(widths.argmax())
            if not widths[widest] > 0:
                continue        # equal rows
            x, middle = rows[:, widest], (len(rows) - 1) // 2
            value = np.partition(x, middle)[middle]
            if value == x.max():
                value = x[x < value].max()
            small = x <= value
            self.column[node], self.value[node] = widest, value
            self.below[node], self.above[node] = len(self.column), len(self.column) + 1
            for part in (rows[small], rows[~small]):
                heapq.heappush(waiting, (-len(part), len(self.column), part))
                for values, empty in ((self.column, -1), (self.value, 0.0), (self.below, 0), (self.above, 0)):
                    values.append(empty)
            leaves += 1
        self.column, self.value, self.below, self.above = (np.array(v) for v in (self.column, self.value, self.below, self.above))

    def place(self, points):
        """The number of each row's box."""
        node, every = np.zeros(len(points), dtype=np.int64), np.arange(len(points))
        while (inner := self.column[node] >= 0).any():
            small = points[every, np.maximum(self.column[node], 0)] <= self.value[node]
            node = np.where(inner, np.where(small, self.below[node], self.above[node]), node)
        return node


def nearest_rows(points, asked, limits, k, metric, p):
    """Per row of ``asked`` the places of its k nearest ``points`` and their distances, equal ones in order of place; the place
    ``len(points)`` stands for none. Points beyond a row's limit (NaN: no limit) may be left out."""
    power, none = power_of(metric, p), len(points)
    leaf = Boxes(points, max(1, none // (LEAF_ROWS if points.shape[1] <= FLAT else 8 * LEAF_ROWS))).place(points)
    order = np.argsort(leaf, kind="stable")
    starts = np.flatnonzero(np.diff(leaf[order], prepend=-1))
    low, high = (f.reduceat(points[order], starts) for f in (np.minimum, np.maximum))
    places = np.split(order, starts[1:])
    best, where = np.full((len(asked), k), np.nan), np.full((len(asked), k), none)
    limits = np.array(limits, dtype="float64")

    def visit(rows, at):
        a, b = asked[rows], points[at]
        known = None
        if 2 <= power < np.inf and points.shape[1] > FLAT:
            # A distance of power 2 or more is at least the euclidean one by the power mean; pairs beyond the limit are left out.
            whole = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :]
            least = np.sqrt(np.maximum(whole - 2 * (a @ b.T) - 1e-11 * whole, 0)) * a.shape[1] ** (1 / power - 0.5)
            known = ~(least > limits[rows, None] * (1 + SLACK))
        if known is not None and known.mean() < SPARSE:
            i, j = np.nonzero(known)
            d = np.full(known.shape, np.nan)
            d[i, j] = folded((np.abs(x[i] - y[j]) for x, y in zip(a.T, b.T)), i.shape, power)
            some = known.any(axis=1)
        else:
            d, known = distances(a, b, metric, p), None
            some = ~(d.min(axis=1) > limits[rows])
        rows, d = rows[some], d[some]
        if not len(rows):
            return
        first = np.argsort(d, axis=1, kind="stable")[:, :k]
        place = at[first] if known is None else np.where(np.take_along_axis(known[some], first, axis=1), at[first], none)
        d = np.concatenate([best[rows], np.take_along_axis(d, first, axis=1)], axis=1)
        place = np.concatenate([where[rows], place], axis=1)
        first = np.lexsort((place, d), axis=1)[:, :k]
        best[rows], where[rows] = np.take_along_axis(d, first, axis=1), np.take_along_axis(place, first, axis=1)
        limits[rows] = np.fmin(limits[rows], best[rows, -1])

    step = max(1, CHUNK // len(places))
    for start in range(0, len(asked), step):
        least = box_distances(asked[start:start + step], low, high, metric, p)
        own = least.argmin(axis=1)
        some = np.argsort(own, kind="stable")
        for rows in np.split(some, np.flatnonzero(np.diff(own[some])) + 1):
            visit(start + rows, places[own[rows[0]]])
        for j, at in enumerate(places):
            rows = np.flatnonzero(~(least[:, j] > limits[start:start + step] * (1 + SLACK)) & (own != j))
            if len(rows):
                visit(start + rows, at)
    return where, best


def whitening(train: DataFrame, x: str):
    """Matrix L with |L'(a - b)| the Mahalanobis distance under the sample covariance. Two aggregates."""
    rows = train.select(F.col(x).alias("x"))
    first = rows.agg(Summarizer.metrics("mean", "count").summary(array_to_vector("x")).alias("s")).first()["s"]
    mean, n = first["mean"].toArray(), first["count"]
    z = F.zip_with("x", double_array(mean), lambda a, m: a - m)
    product = rows.select(z.alias("z")).select(
        array_to_vector(F.flatten(F.transform("z", lambda a: F.transform("z", lambda b: a * b)))).alias("p"))
    covariance = product.agg(Summarizer.mean(F.col("p")).alias("m")).first()["m"].toArray().reshape(len(mean), -1) * n / (n - 1)
    return np.linalg.cholesky(np.linalg.inv(covariance))


def matrix_of(series) -> np.ndarray:
    return np.array(series.tolist(), dtype="float64").reshape(len(series), -1)


def knn_join(queries: DataFrame, train: DataFrame, k: int, metric="euclidean", p=2.0, block_rows=BLOCK_ROWS,
             cells=None, whiten=None) -> DataFrame:
    """(qid, id, distance): the k nearest training rows per query; equal distances in order of id.

    ``queries`` holds (qid, x), ``train`` holds (id, x) with x an array of doubles and unique ids; both must be
    reproducible, such as tables.
    """
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")
    if k < 1 or (metric == "minkowski" and p < 1):
        raise ValueError("k and p must be at least 1")
    # einsum gives equal rows equal results, whatever batch they are in
    change = (lambda m: np.einsum("ij,jk->ik", m, whiten)) if whiten is not None else (lambda m: m)
    count = train.count()
    if not count:
        raise ValueError("no training rows")
    cells = cells or max(1, min(MOST_CELLS, max(count // max(1, block_rows // 2), min(FEW_CELLS, count // 500))))
    # The cuts come from the rows of one remainder of their hashes, a bounded random choice.
    every = max(1, count // (SAMPLE_ROWS * cells))
    chosen = train.filter(F.pmod(F.xxhash64("id"), F.lit(every)) == 0).select("x").limit(4 * SAMPLE_ROWS * cells).collect()
    tree = Boxes(change(np.array([r["x"] for r in chosen], dtype="float64").reshape(len(chosen), -1)), cells if chosen else 1)

    def to_cells(batches):
        for batch in batches:
            points = change(matrix_of(batch.iloc[:, 1]))
            yield batch.assign(x=list(points), cell=tree.place(points).astype("int32"))

    def in_cells(rows, key, label):
        return materialize(rows.select(F.col(key).cast("bigint").alias(key), "x").mapInPandas(
            to_cells, f"{key} bigint, x array<double>, cell int"), label)

    assigned, asked = in_cells(train, "id", "knn-train"), in_cells(queries, "qid", "knn-queries")
    boxes = assigned.groupBy("cell").agg(Summarizer.metrics("min", "max", "count").summary(array_to_vector("x")).alias("s")).select(
        "cell", "s.min", "s.max", "s.count").orderBy("cell").collect()
    used = np.array([r["cell"] for r in boxes])
    low, high = (np.array([r[side].toArray() for r in boxes]) for side in ("min", "max"))
    train_pieces = {r["cell"]: -(-r["count"] // block_rows) for r in boxes}

    def meet(routed):
        """The k best of each query in each block: every query piece of a cell meets every train piece of that cell."""
        query_pieces = {r["cell"]: -(-2 * r["count"] // block_rows) for r in routed.groupBy("cell").count().collect()}
        t_pieces, q_pieces = pieces_of(train_pieces), pieces_of(query_pieces)
        left = (assigned.filter(F.col("cell").isin(list(query_pieces))).select("id", "x", "cell", piece("id", t_pieces).alias("tp"),
                F.explode(F.sequence(F.lit(0), q_pieces - 1)).alias("qp")))
        right = routed.select("qid", "x", "limit", "cell", piece("qid", q_pieces).alias("qp"),
                              F.explode(F.sequence(F.lit(0), t_pieces - 1)).alias("tp"))
        return (left.groupBy("cell", "tp", "qp").cogroup(right.groupBy("cell", "tp", "qp"))
                .applyInPandas(nearest_in_block, "qid bigint, id bigint, distance double"))

    def pieces_of(lookup):
        pairs = [F.lit(v) for item in sorted(lookup.items()) for v in item]
        return F.coalesce(F.try_element_at(F.create_map(*pairs), F.col("cell")), F.lit(1)) if pairs else F.lit(1)

    def piece(key, count):
        return F.pmod(F.xxhash64(key), count).cast("int")

    def nearest_in_block(rows, some):
        if not len(rows) or not len(some):
            return pd.DataFrame({"qid": [], "id": [], "distance": []}).astype({"qid": "int64", "id": "int64", "distance": "float64"})
        rows = rows.sort_values("id", kind="stable")
        where, best = nearest_rows(matrix_of(rows["x"]), matrix_of(some["x"]), some["limit"].to_numpy(dtype="float64"), k, metric, p)
        query, rank = np.nonzero(where < len(rows))
        return pd.DataFrame({"qid": some["qid"].to_numpy()[query], "id": rows["id"].to_numpy()[where[query, rank]],
                             "distance": best[query, rank]})

    def to_other_cells(batches):
        step = max(1, CHUNK // len(used))
        for whole in batches:
            for start in range(0, len(whole), step):
                batch = whole.iloc[start:start + step]
                least = box_distances(matrix_of(batch["x"]), low, high, metric, p)
                needed = ~(least > batch["limit"].to_numpy(dtype="float64")[:, None] * (1 + SLACK))
                needed &= used[None, :] != batch["cell"].to_numpy()[:, None]
                some = np.flatnonzero(needed.any(axis=1))
                if len(some):
                    yield pd.DataFrame({"qid": batch["qid"].iloc[some], "x": batch["x"].iloc[some], "limit": batch["limit"].iloc[some],
                                        "cells": [used[needed[i]].astype("int32") for i in some]})

    own = materialize(k_least(meet(asked.withColumn("limit", F.lit(None).cast("double"))), "qid", ["distance", "id"], k), "knn-own")
    limits = own.groupBy("qid").agg(F.when(F.count("*") == k, F.max("distance")).alias("limit")).withColumnRenamed("qid", "__of")
    limited = asked.join(limits, F.col("qid").eqNullSafe(F.col("__of")), "left").select("qid", "x", "cell", "limit")
    routed = materialize(limited.mapInPandas(to_other_cells, "qid bigint, x array<double>, limit double, cells array<int>"), "knn-routed")
    others = meet(routed.select("qid", "x", "limit", F.explode("cells").alias("cell")))
    return k_least(own.unionByName(others), "qid", ["distance", "id"], k)


def k_least(df: DataFrame, group, order, k) -> DataFrame:
    """The k first rows per group. Spark keeps only k rows per group and task before the shuffle."""
    first = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(first)).filter(F.col("__rank") <= k).drop("__rank")


class KNNClassifier(BinaryEstimator):
    """Majority of the k nearest training rows, each counting once or by 1 / distance."""

    k = Param(Params._dummy(), "k", "number of neighbours", TypeConverters.toInt)
    metric = Param(Params._dummy(), "metric", "distance", TypeConverters.toString)
    p = Param(Params._dummy(), "p", "power of the minkowski distance", TypeConverters.toFloat)
    weights = Param(Params._dummy(), "weights", "uniform or distance", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, k=5, metric="minkowski", p=2.0, weights="uniform", featuresCol="features", labelCol="label"):
        super().__init__()
        self._setDefault(k=5, metric="minkowski", p=2.0, weights="uniform")
        self._set(**self._input_kwargs)

    def _fit(self, df):
        if self.getOrDefault("weights") not in ("uniform", "distance"):
            raise ValueError("weights must be 'uniform' or 'distance'")
        path = scratch_path(df.sparkSession, "knn-model")
        rows = self.rows(df).select("y", "x")
        rows.withColumn("id", F.monotonically_increasing_id()).write.parquet(path)
        model = KNNModel()
        model._set(table=path, **{n: self.getOrDefault(n) for n in ("k", "metric", "p", "weights")})
        return self.hand_over(model)


class KNNModel(Model, Columns, DefaultParamsReadable, DefaultParamsWritable):
    """The training rows as a table in the shared folder; its path is part of the saved model."""

    table = Param(Params._dummy(), "table", "path of the training rows", TypeConverters.toString)
    k, metric, p, weights = KNNClassifier.k, KNNClassifier.metric, KNNClassifier.p, KNNClassifier.weights

    def __init__(self):
        super().__init__()

    def _transform(self, df):
        spark = df.sparkSession
        train = spark.read.parquet(self.getOrDefault("table"))
        queries = materialize(df.withColumn("__qid", F.monotonically_increasing_id()), "knn-asked")
        metric, k = self.getOrDefault("metric"), self.getOrDefault("k")
        whiten = whitening(train, "x") if metric == "mahalanobis" else None
        near = knn_join(queries.select(F.col("__qid").alias("qid"), vector_to_array(F.col(self.getFeaturesCol())).alias("x")),
                        train.select("id", "x"), k, metric, self.getOrDefault("p"), whiten=whiten)
        votes = vote(near.join(train.select("id", "y"), "id"), self.getOrDefault("weights"))
        scored = queries.join(votes.withColumnRenamed("qid", "__qid"), "__qid")
        p = F.col("__p")
        return scored.withColumns({
            self.getRawPredictionCol(): array_to_vector(F.array(1 - p, p)),
            self.getProbabilityCol(): array_to_vector(F.array(1 - p, p)),
            self.getPredictionCol(): (p > 0.5).cast("double"),
        }).drop("__qid", "__p")


def vote(neighbours: DataFrame, weights="uniform") -> DataFrame:
    """(qid, __p): weighted share of class 1. With distance weights, neighbours at distance 0 decide alone."""
    if weights == "uniform":
        return neighbours.groupBy("qid").agg(F.avg(F.col("y").cast("double")).alias("__p"))
    exact = F.col("distance") == 0
    near = neighbours.groupBy("qid").agg(
        F.count_if(exact).alias("hits"), F.count_if(exact & (F.col("y") == 1)).alias("ones"),
        F.sum(F.when(~exact, 1 / F.col("distance"))).alias("all"),
        F.sum(F.when(~exact & (F.col("y") == 1), 1 / F.col("distance")).otherwise(0.0)).alias("part"))
    p = F.when(F.col("hits") > 0, F.try_divide(F.col("ones"), F.col("hits"))).otherwise(F.try_divide(F.col("part"), F.col("all")))
    return near.select("qid", p.alias("__p"))
