"""Hard negatives against the definition: ties, equal limits, empty windows, negative scores, nulls, repeats, several lengths."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label string, row long, key int, slot int, limits int"


def plain(rows, positives, wanted, low=30, high=90):
    good = [(k, lab, [int(np.floor(256 * x)) for x in v]) for k, lab, v in rows
            if k is not None and lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = Counter()
    for a, (key, label, v) in enumerate(good):
        if key % 10:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), k, other == label) for b, (k, other, w) in enumerate(good) if a != b and len(w) == len(v))
        for p, pk, _ in [s for s in scored if s[2]][:positives]:
            fits = [(k, -n) for n, k, same in scored if not same and low * -p <= 100 * -n <= high * -p][:wanted]
            out.update((key, pk, rank, k, -p, n) for rank, (k, n) in enumerate(fits, 1))
    return out


def some_rows(seed, n=150):
    rng = random.Random(seed)
    grid = [-0.5, -0.25, 0.0, 0.01, 0.25, 0.5, 0.75]
    rows = [(i, rng.choice("abc"), [rng.choice(grid) for _ in range(4)]) for i in range(n)]
    rows += [(10, "a", [0.5] * 4), (10, "a", [0.5] * 4), (20, "a", [0.0] * 4), (30, "b", [-0.5] * 4), (31, "b", [0.5] * 4)]       # repeats, zero and negative scores
    rows += [(None, "a", [0.5] * 4), (200, None, [0.5] * 4), (210, "a", None), (220, "a", [0.5, None, 0.5, 0.5]), (230, "b", [float("nan")] * 4),
             (240, "b", [float("inf")] * 4), (250, "c", [0.5, 0.5]), (260, "c", [0.25, 0.5]), (261, "a", [0.25, 0.25]), (270, "c", []), (271, "c", []), (280, "only", [0.5] * 4)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,positives,wanted,chunk_rows,block_rows", [(1, 5, 10, 65_536, 4_096), (2, 5, 3, 5, 4), (3, 1, 2, 10, 100), (4, 9, 40, 65_536, 1)])
def test_negatives(spark, seed, positives, wanted, chunk_rows, block_rows):
    rows = some_rows(seed)
    table = spark.createDataFrame([(k, v, lab, 1, 2, 3, 4) for k, lab, v in rows], SCHEMA).repartition(3)
    got = negatives.mine_negatives(table, F.col("key") % 10 == 0, positives=positives, negatives=wanted, chunk_rows=chunk_rows, block_rows=block_rows)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = plain(rows, positives, wanted)
    assert Counter(map(tuple, got.collect())) == want and len(want) > 30


def test_no_rows(spark):
    table = spark.createDataFrame([], SCHEMA)
    assert negatives.mine_negatives(table, F.col("key") % 10 == 0).count() == 0
    alone = spark.createDataFrame([(0, [1.0], "a", 1, 2, 3, 4), (1, [1.0], "b", 1, 2, 3, 4)], SCHEMA)
    assert negatives.mine_negatives(alone, F.col("key") % 10 == 0).count() == 0


def test_large_scores(spark):
    rows = [(0, "a", [1e6, 2.0]), (1, "a", [1e6, 1.0])] + [(i, "b", [1e6 * i / 40, -1.0]) for i in range(2, 40)]
    table = spark.createDataFrame([(k, v, lab, 1, 2, 3, 4) for k, lab, v in rows], SCHEMA)
    got = negatives.mine_negatives(table, F.col("key") == 0, negatives=4)
    want = Counter({t: n for t, n in plain(rows, 5, 4).items() if t[0] == 0})
    assert Counter(map(tuple, got.collect())) == want and len(want) == 4


def test_best_takes_the_first_of_equal_scores():
    rng = np.random.default_rng(5)
    for wide in (False, True):
        scores = rng.integers(-3, 3, (20, 30)) * (1 << 60 if wide else 1)
        allowed = rng.random((20, 30)) < 0.5
        line, place = negatives.best(scores, allowed, 4)
        got = {x: sorted(place[line == x].tolist()) for x in range(20)}
        assert got == {x: sorted(sorted(np.flatnonzero(allowed[x]).tolist(), key=lambda p: (-scores[x, p], p))[:4]) for x in range(20)}
