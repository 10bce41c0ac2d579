"""Exact, linearly interpolated quantiles by descent over the leading bits of the values, bounded at any data size.

A double has a 64-bit key in the same order: sign, exponent, fraction, with the infinities at the ends. A round counts the
rows per column and leading bits of the key, which combines map-side and is dealt by both, so no task holds a column. The counts,
at most ``GROUPS`` in all, tell which groups hold the wanted ranks; the next round counts the following bits of these groups only,
starting at their least key and as fine as the bound allows. A rank is found when its group holds a single value. Where
the number of rows or of distinct values is known to be small, the first round takes all 64 bits and is the only one.
"""

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions.expressions import double_array, num

GROUPS = 1 << 20            # counted groups of a round that come to the driver, 24 bytes each
INFINITE = 2047 << 52       # key of the infinity


def interpolate(position: float, low_value, high_value):
    low = math.floor(position)
    if low_value == high_value:
        return low_value
    return (low + 1 - position) * low_value + (position - low) * high_value


def long_numbers(df: DataFrame, names) -> DataFrame:
    """(slot, x): one row per value, slot being the column's place in ``names``.

    Aggregates over this form keep the same small generated code for any number of columns.
    """
    return df.select(F.posexplode(F.array(*[num(c) for c in names])).alias("slot", "x"))


def keyed_numbers(df: DataFrame, names) -> DataFrame:
    """(slot, key): the values that are present, as integers in the order of the doubles; 0 is 0, and -x has the key of x negated.

    The exponent is guessed by a logarithm and set right by comparison; all else is exact arithmetic with powers of two.
    """
    binary = " * ".join(f"IF(m & {1 << k} = 0, 1D, {2.0 ** (1 << k)!r}D)" for k in range(10))
    binary += f" * IF(m & 1024 = 0, 1D, {2.0 ** 512!r}D) * IF(m & 1024 = 0, 1D, {2.0 ** 512!r}D)"
    small, huge = f"{2.0 ** -1022!r}D", f"{2.0 ** 537!r}D"
    x = long_numbers(df, names).filter("x IS NOT NULL").selectExpr("slot", "x", "abs(x) AS a")
    guessed = x.selectExpr("slot", "x", "a", f"CASE WHEN a >= {small} AND a < double('Infinity') THEN greatest(0, least(2045, int(floor(log2(a))) + 1022)) ELSE 0 END AS m")
    power = guessed.selectExpr("slot", "x", "a", "m", f"{small} * {binary} AS p")
    right = power.selectExpr("slot", "x", "a", "CASE WHEN a < p THEN m ELSE m + IF(a >= 2 * p, 2, 1) END AS biased", "CASE WHEN a < p THEN p / 2 ELSE p * IF(a >= 2 * p, 2, 1) END AS p")
    key = F.expr(f"""IF(x < 0, -1L, 1L) * CASE
        WHEN a = double('Infinity') THEN {INFINITE}L WHEN a < {small} THEN bigint(a * {huge} * {huge})
        ELSE biased * {1 << 52}L + bigint((a / p - 1) * {float(1 << 52)!r}D) END""")
    return right.select("slot", F.explode(F.array(key)).alias("key"))       # computed here once, however often later expressions use it


def values_of(keys: np.ndarray) -> np.ndarray:
    """The doubles of keys."""
    found = np.abs(keys).view(np.float64)
    return np.where(keys < 0, -found, found)


def counted(groups: DataFrame, *by) -> DataFrame:
    """(by, n, lo, hi): the rows, the least and the greatest key of each group."""
    return groups.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi"))


class Descent:
    """Wanted ranks of several columns on their way to single values."""

    def __init__(self, keyed: DataFrame, fractions: list[list[float]], bits: int):
        self.keyed, self.fractions, self.shift = keyed, fractions, 64 - bits

    def first_round(self) -> DataFrame:
        return counted(self.keyed.select("slot", "key", F.expr(f"shiftright(key, {self.shift})").alias("part")), "slot", "part")

    def run(self, first: pa.Table) -> list[dict[float, float | None]]:
        """Values by fraction for each column, from the first round's counts on."""
        slot, part, n, lo, hi = (first.column(c).to_numpy() for c in ("slot", "part", "n", "lo", "hi"))
        order = np.lexsort((part, slot))
        slot, part, n, lo, hi = slot[order], part[order], n[order], lo[order], hi[order]
        ends = np.searchsorted(slot, np.arange(len(self.fractions) + 1))
        upto = np.concatenate([[0], np.cumsum(n)])
        totals = [int(upto[b] - upto[a]) for a, b in zip(ends, ends[1:])]
        ranks = [sorted({k for p in ps for k in (math.floor((t - 1) * p), math.ceil((t - 1) * p))}) if t else [] for ps, t in zip(self.fractions, totals)]
        place = np.concatenate([upto[ends[i]] + np.array(r, np.int64) for i, r in enumerate(ranks)]) if any(ranks) else np.zeros(0, np.int64)
        group = np.searchsorted(upto[1:], place, "right")
        keys = self.descend(place - upto[group], group, (slot, part), n, lo, hi)
        values = iter(values_of(keys).tolist())
        out = []
        for ps, t, r in zip(self.fractions, totals, ranks):
            by_rank = {k: next(values) for k in r}
            at = {p: (t - 1) * p for p in ps}
            out.append({p: interpolate(at[p], by_rank[math.floor(at[p])], by_rank[math.ceil(at[p])]) if t else None for p in ps})
        return out

    def descend(self, rank, group, names, n, lo, hi) -> np.ndarray:
        """The key of each rank, given the group it is in and its rank there; ``names`` are the columns that tell groups apart."""
        keys, rows, by = np.zeros(len(rank), np.int64), self.keyed.withColumn("part", F.expr(f"shiftright(key, {self.shift})")), ["slot", "part"]
        left = np.arange(len(rank))
        while True:
            single = lo[group] == hi[group]
            keys[left[single]] = lo[group[single]]
            left, rank, group = left[~single], rank[~single], group[~single]
            if not len(left):
                return keys
            chosen, group = np.unique(group, return_inverse=True)
            width = hi[chosen] - lo[chosen]
            bits = 64 if n[chosen].sum() <= GROUPS else max(1, (GROUPS // len(chosen)).bit_length() - 1)
            shift = np.maximum(0, np.array([int(w).bit_length() for w in width]) - bits)
            table = {c: pa.array(v[chosen]) for c, v in zip(by, names)}
            table |= {"g": pa.array(np.arange(len(chosen), dtype=np.int64)), "base": pa.array(lo[chosen]), "shift": pa.array(shift, pa.int32())}
            wanted = self.keyed.sparkSession.createDataFrame(pa.table(table))
            rows = rows.join(F.broadcast(wanted), by).select("key", F.col("g").alias("slot"), F.expr("shiftright(key - base, shift)").alias("part"))
            found = counted(rows, "slot", "part").toArrow()
            slot, part, n, lo, hi = (found.column(c).to_numpy() for c in ("slot", "part", "n", "lo", "hi"))
            order = np.lexsort((part, slot))
            slot, part, n, lo, hi = slot[order], part[order], n[order], lo[order], hi[order]
            upto = np.concatenate([[0], np.cumsum(n)])
            place = upto[np.searchsorted(slot, group)] + rank
            group = np.searchsorted(upto[1:], place, "right")
            rank, names = place - upto[group], (slot, part)


def first_bits(columns: int, rows=None, distinct=None) -> int:
    """Leading bits of the first round: all, where the groups are known to be few enough; else as many as the bound allows."""
    sizes = [d if rows is None else min(rows, d) for d in distinct] if distinct else [rows] * columns
    if None not in sizes and sum(sizes) <= GROUPS:
        return 64
    return max(12, (GROUPS // columns).bit_length() - 1)


def quantiles_and_more(df: DataFrame, wanted: dict[str, list[float]], also: DataFrame | None = None, rows: int | None = None,
                       distinct: dict[str, int] | None = None):
    """``({column: {fraction: value}}, {slot: values})``: quantiles as in ``exact_quantiles``, and the rows of ``also``.

    ``also`` is a small aggregate (slot int, v array<double>); it is answered in the same job as the first round.
    """
    wanted = {c: sorted(set(float(p) for p in ps)) for c, ps in wanted.items() if ps}
    if not wanted:
        return {}, {r["slot"]: r["v"] for r in also.collect()} if also is not None else {}
    sizes = [int(1.3 * distinct[c]) + 1 for c in wanted] if distinct else None
    descent = Descent(keyed_numbers(df, list(wanted)), list(wanted.values()), first_bits(len(wanted), rows, sizes))
    first = descent.first_round()
    if also is not None:
        nothing = [F.lit(None).cast("long").alias(c) for c in ("part", "n", "lo", "hi")]
        first = first.withColumn("v", F.lit(None).cast("array<double>")).unionByName(also.select("slot", *nothing, "v"))
    answer = first.toArrow()
    more = {}
    if also is not None:
        extra = answer.filter(pc.is_null(answer.column("n")))
        more = dict(zip(extra.column("slot").to_pylist(), extra.column("v").to_pylist()))
        answer = answer.filter(pc.is_valid(answer.column("n")))
    return dict(zip(wanted, descent.run(answer))), more


def exact_quantiles(df: DataFrame, wanted: dict[str, list[float]], rows: int | None = None,
                    distinct: dict[str, int] | None = None) -> dict[str, dict[float, float | None]]:
    """``{column: {fraction: value}}``; null for a column without values. Infinite values take their places at the ends.

    ``rows`` is an upper bound of the row count and ``distinct`` holds estimates of the distinct values, if the caller
    knows them; they save rounds.
    """
    return quantiles_and_more(df, wanted, None, rows, distinct)[0]


def parted(x: DataFrame, cuts) -> DataFrame:
    """Long (i, part, x). Part 2j-1 is the value of cut j, part 2j lies between cut j and cut j+1 (cuts from 1)."""
    cut = [i for i in cuts if cuts[i]]
    tagged = x if not cut else Bucketizer(
        splitsArray=[[float("-inf"), *cuts[i], float("inf")] for i in cut], inputCols=[f"x{i}" for i in cut],
        outputCols=[f"b{i}" for i in cut], handleInvalid="keep").transform(x)
    entries = []
    for i in cuts:
        value, part = F.col(f"x{i}"), F.lit(0)
        if cuts[i]:
            bucket = F.col(f"b{i}").cast("int")
            lower = F.get(double_array(cuts[i]), bucket - 1)
            part = F.when(value == lower, bucket * 2 - 1).otherwise(bucket * 2)
        entries.append(F.struct(F.lit(i).alias("i"), part.alias("part"), value.alias("x")).alias(f"s{i}"))
    return (tagged.select(*entries).unpivot([], [f"s{i}" for i in cuts], "slot", "s")
            .select("s.*").filter(F.col("x").isNotNull()))
