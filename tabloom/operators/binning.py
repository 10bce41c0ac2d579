"""Right-closed binning: manual, equal width and quantile edges."""

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions.expressions import bin_index, col, half_even, num, replace_columns, require_numeric
from tabloom.functions.quantiles import exact_quantiles, parted

# Limits of a bin's share and the least bin size.
LOWER_SHARE, UPPER_SHARE, LEAST_SIZE = 0.02, 0.1, 20
FRACTIONS = 20_000      # of one percentile job of the search, but for a single candidate
FETCHED = 20_000        # distinct values of a column whose search runs on the driver


def bin_size_bounds(n: int) -> tuple[int, int, int]:
    """(wanted rows per bin, lower, upper) for ``n`` non-null values; Python's half-even rounding."""
    lower, upper = round(n * LOWER_SHARE), round(n * UPPER_SHARE)
    root = round(math.sqrt(n))
    wanted = lower if root < lower else upper if root > upper else root
    return max(wanted, LEAST_SIZE), lower, upper


def bin_size_table(df: DataFrame, columns) -> DataFrame:
    """(column, n, bin_rows, lower_rows, upper_rows) as one lazy aggregate."""
    wide = df.agg(*[F.count(num(c)).alias(f"n{i}") for i, c in enumerate(columns)])
    entries = []
    for i, c in enumerate(columns):
        n = F.col(f"n{i}")
        lower, upper = half_even(n * F.lit(LOWER_SHARE), 0), half_even(n * F.lit(UPPER_SHARE), 0)
        root = half_even(F.sqrt(n.cast("double")), 0)
        wanted = F.greatest(F.when(root < lower, lower).when(root > upper, upper).otherwise(root), F.lit(float(LEAST_SIZE)))
        entries.append(F.struct(F.lit(c).alias("column"), n.alias("n"), wanted.cast("bigint").alias("bin_rows"),
                                lower.cast("bigint").alias("lower_rows"), upper.cast("bigint").alias("upper_rows")))
    return wide.select(F.explode(F.array(*entries)).alias("r")).select("r.*")


def check_rule(rule) -> str:
    """The binning method of a rule, after checking its parameters."""
    method, c = rule.get("binning_method", "equal_number_of_bins"), rule["column"]
    if method == "manual":
        bins = rule.get("bins") or []
        if len(bins) < 2:
            raise ValueError(f"column '{c}': manual binning needs bins")
        if len(set(bins)) != len(bins):
            raise ValueError(f"column '{c}': the bins must be unique")
        if sorted(bins) != list(bins):
            raise ValueError(f"column '{c}': the bins must be in increasing order")
    elif method == "equal_number_of_bins":
        bins = rule.get("bins")
        if not isinstance(bins, int) or isinstance(bins, bool) or bins <= 0:
            raise ValueError(f"column '{c}': bins must be a positive integer")
    elif method == "equal_size":
        q = rule.get("quantiles")
        if q != "max" and (not isinstance(q, int) or isinstance(q, bool) or q <= 0):
            raise ValueError(f"column '{c}': quantiles must be a positive integer or 'max'")
    else:
        raise ValueError("binning_method must be 'equal_size', 'equal_number_of_bins' or 'manual'")
    return method


def fit_bins(df: DataFrame, rules, full: DataFrame | None = None, rows=None) -> dict[str, dict]:
    """``{column: {'bins': edges, ...}}`` for rules on different columns.

    One aggregate over the full data for all ranges and manual-bin checks, one percentile job over ``df`` for all
    quantile edges. Quantile edges are ``df``'s; their outer ends are widened to the full data's range.
    """
    full = df if full is None else full
    methods = {r["column"]: check_rule(r) for r in rules}
    require_numeric(df, methods)
    ranges = full_ranges(full, rules, methods)
    fixed = {r["column"]: r["quantiles"] for r in rules
             if methods[r["column"]] == "equal_size" and r["quantiles"] != "max"}
    open_ended = [r["column"] for r in rules if methods[r["column"]] == "equal_size" and r["quantiles"] == "max"]
    quantiles = exact_quantiles(df, {c: [i / q for i in range(q + 1)] for c, q in fixed.items()}, rows)
    found = {c: unique_edges(quantiles[c], q) for c, q in fixed.items()}
    searched = best_quantiles(df, open_ended) if open_ended else {}
    learned = {}
    for r in rules:
        c, (low, high) = r["column"], ranges[r["column"]]
        if low is None:
            raise ValueError(f"column '{c}' holds no value to bin")
        entry = {}
        if methods[c] == "manual":
            edges = [float(e) for e in r["bins"]]
        elif methods[c] == "equal_number_of_bins":
            edges = equal_width_edges(low, high, r["bins"])
        else:
            edges = found[c] if c in found else searched[c]["bins"]
            if not edges:
                raise ValueError(f"column '{c}' holds no value to bin")
            edges = widened(edges, low, high)
            if c in searched:
                entry = {k: v for k, v in searched[c].items() if k != "bins"}
        learned[c] = {"bins": edges, **entry}
    return learned


def widened(edges, low, high):
    """Quantile edges with the outer ends moved to the full range; a single edge stays a degenerate bin."""
    if len(edges) == 1:
        edges = edges * 2
    return [min(edges[0], low), *edges[1:-1], max(edges[-1], high)]


def equal_width_edges(low, high, bins) -> list[float]:
    step = (high - low) / bins
    return [low + i * step for i in range(bins)] + [high]


def unique_edges(quantiles: dict, q: int) -> list[float]:
    """The quantile edges for ``q`` bins in order, equal neighbours merged."""
    values = [quantiles[i / q] for i in range(q + 1)]
    return [] if values[0] is None else sorted(set(values))


def full_ranges(full, rules, methods):
    """(min, max) per column over the full data; manual bins must cover it and none may be empty."""
    aggregates = []
    for i, r in enumerate(rules):
        x = num(r["column"])
        aggregates += [F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
        if methods[r["column"]] == "manual":
            bins = r["bins"]
            aggregates.append(F.array(*[
                F.count_if(x.between(F.lit(float(a)), F.lit(float(b)))) for a, b in zip(bins, bins[1:])]).alias(f"c{i}"))
    row = full.agg(*aggregates).first()
    ranges = {}
    for i, r in enumerate(rules):
        c = r["column"]
        low, high = row[f"lo{i}"], row[f"hi{i}"]
        ranges[c] = (low, high)
        if methods[c] == "manual" and low is not None:
            bins = r["bins"]
            if low < bins[0] or high > bins[-1]:
                raise ValueError(f"column '{c}': values from {low} to {high} are not covered by the bins")
            empty = [(a, b) for a, b, n in zip(bins, bins[1:], row[f"c{i}"]) if n == 0]
            if empty:
                raise ValueError(f"column '{c}': the bins {empty} hold no value")
    return ranges


def best_quantiles(df: DataFrame, columns) -> dict[str, dict]:
    """Per column the largest number of quantile bins of which each holds enough rows (see ``bin_size_bounds``).

    One sizing job. Then for many candidates at once: one percentile job over their edges and one job counting the rows
    between all these edges. Columns with few distinct values try all candidates together; others start with the largest
    ones and double the number of candidates, as most succeed at once; ``FRACTIONS`` bounds the edges of a job.

    The search starts at all rows over the wanted size, so missing values raise the start beyond the bins that the values
    could fill. There a column's counted values come to the driver, if few are distinct, and every candidate is tried on
    them. Otherwise candidates are left out that cannot succeed (``highest_start``).
    """
    sizes = df.agg(F.count(F.lit(1)).alias("rows"), *[
        e for i, c in enumerate(columns)
        for e in (F.count(num(c)).alias(f"n{i}"), F.approx_count_distinct(num(c), 0.05).alias(f"d{i}"))
    ]).first()
    search = {}
    for i, c in enumerate(columns):
        n = sizes[f"n{i}"]
        wanted = bin_size_bounds(n)[0]
        start = sizes["rows"] // wanted
        search[c] = {"wanted": wanted, "next": max(start, 1), "batch": start if sizes[f"d{i}"] <= 5000 else 8,
                     "n": n, "distinct": sizes[f"d{i}"]}
    done = {c: {"bins": [], "quantiles": 1} for c, s in search.items() if not s["n"]}
    for c, s in search.items():
        if s["n"] and s["next"] > 2 * max(s["n"] // s["wanted"], 1):
            counted = df.select(num(c).alias("x")).filter("x IS NOT NULL").groupBy("x").count()
            if s["distinct"] <= FETCHED:
                found = sorted((r["x"], r["count"]) for r in counted.collect())
                done[c] = widest_on_counts(np.array([x for x, _ in found], float), np.array([k for _, k in found]), s["next"], s["wanted"])
            else:
                s["next"] = highest_start(s["next"], s["wanted"], s["n"], counted.agg(F.max("count")).first()[0])
    while len(done) < len(columns):
        batches = {}
        for c, s in search.items():
            if c not in done:
                size = max(1, min(s["batch"], FRACTIONS // (s["next"] + 1)))
                batches[c] = list(range(s["next"], max(0, s["next"] - size), -1))
                s["next"] -= len(batches[c])
                s["batch"] *= 2
        edges = candidate_edges(df, batches, sizes["rows"], {c: search[c]["distinct"] for c in batches})
        below = rows_up_to(df, {c: sorted({e for es in qs.values() for e in es}) for c, qs in edges.items()})
        for c, qs in edges.items():
            for q in batches[c]:
                least = smallest_bin(qs[q], below[c])
                if least >= search[c]["wanted"] or q == 1:
                    done[c] = {"bins": qs[q], "quantiles": q}
                    break
    return done


def highest_start(start: int, wanted: int, n: int, heaviest: int) -> int:
    """The first candidate that can succeed, where no value occurs more than ``heaviest`` times.

    Edges of neighbouring quantiles are (n - 1) / q places apart, so a bin after the first holds at most one value more
    than that, and the further occurrences of its upper edge: fewer than (n - 1) / q + 1 + heaviest.
    """
    spare = wanted - 1 - heaviest
    return max(1, min(start, (n - 1) // spare)) if spare > 0 and n >= 2 * wanted else start


def widest_on_counts(values, counts, start: int, wanted: int) -> dict:
    """The search over a column's distinct values in order and their counts; most candidates fail on their first edges.

    From four edges on between two neighbouring values that are well apart, a bin there is empty: larger candidates are left out.
    """
    ends = np.concatenate([[0], np.cumsum(counts)])
    n = int(ends[-1])
    if n < wanted or len(values) == 1:
        start = 1
    elif np.isfinite(values).all() and (np.diff(values) > 1e-6 * np.maximum(abs(values[1:]), abs(values[:-1]))).any():
        start = min(start, 4 * (n - 1))
    for q in range(start, 0, -1):
        for last in (min(q, 256), q):
            place = (n - 1) * (np.arange(last + 1) / q)
            floor, ceil = np.floor(place), np.ceil(place)
            low, high = (values[np.searchsorted(ends[1:], at, "right")] for at in (floor, ceil))
            with np.errstate(invalid="ignore"):
                edges = np.unique(np.where(low == high, low, (floor + 1 - place) * low + (place - floor) * high))
            below = ends[np.searchsorted(values, edges, "right")]
            if len(edges) > 1:
                sizes = np.diff(below)
                sizes[0] = below[1]
                if sizes.min() < wanted:
                    break
            elif last == q:
                break       # no bin
        else:
            return {"bins": edges.tolist(), "quantiles": q}
    return {"bins": edges.tolist(), "quantiles": 1}


def candidate_edges(df, batches, rows, distinct):
    fractions = {c: [i / q for q in qs for i in range(q + 1)] for c, qs in batches.items()}
    quantiles = exact_quantiles(df, fractions, rows, distinct=distinct)
    return {c: {q: unique_edges(quantiles[c], q) for q in qs} for c, qs in batches.items()}


def rows_up_to(df, edges) -> dict[str, dict[float, int]]:
    """Per column and edge, the number of values at or below the edge. One job for all columns."""
    names = list(edges)
    x = df.select(*[num(c).alias(f"x{i}") for i, c in enumerate(names)])
    counted = parted(x, {i: edges[c] for i, c in enumerate(names)}).groupBy("i", "part").count().collect()
    by_part = {(r["i"], r["part"]): r["count"] for r in counted}
    result = {}
    for i, c in enumerate(names):
        total = by_part.get((i, 0), 0)
        result[c] = {}
        for j, e in enumerate(edges[c], start=1):
            total += by_part.get((i, 2 * j - 1), 0)
            result[c][e] = total
            total += by_part.get((i, 2 * j), 0)
    return result


def smallest_bin(edges, below) -> int:
    if len(edges) < 2:
        return 0        # no bin, as every edge is the same value
    counts = [below[edges[1]]] + [below[b] - below[a] for a, b in zip(edges[1:], edges[2:])]
    return min(counts)


def apply_bins(df: DataFrame, learned) -> DataFrame:
    """Replace each column by its bin number; values outside the edges become null."""
    numbers = replace_columns(df, {c: num(c) for c in learned})
    return replace_columns(numbers, {c: bin_index(c, entry["bins"]) for c, entry in learned.items()})


def bin_columns(df: DataFrame, rules, full=None, rows=None, check=True) -> tuple[DataFrame, dict]:
    """Fit and apply in one go; a column that falls into a single bin is refused (one more small job)."""
    learned = fit_bins(df, rules, full, rows)
    binned = apply_bins(df, learned)
    if check:
        row = binned.agg(*[
            e for i, c in enumerate(learned)
            for e in (F.min(col(c)).alias(f"lo{i}"), F.max(col(c)).alias(f"hi{i}"), F.count_if(col(c).isNull()).alias(f"m{i}"))
        ]).first()
        for i, c in enumerate(learned):
            if row[f"lo{i}"] == row[f"hi{i}"] and not row[f"m{i}"]:
                raise ValueError(f"column '{c}' has become constant after binning")
    return binned, learned


def bin_count_report(df: DataFrame, column) -> DataFrame:
    """(bin, n, lower_rows, upper_rows): bins of a binned column whose size lies outside 2 % to 10 % of its values.

    The totals are sums over the bins' counts, so the table is read once.
    """
    bins = df.filter(col(column).isNotNull()).groupBy(col(column).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    bounds = bins.agg(half_even(F.sum("n") * F.lit(LOWER_SHARE), 0).cast("bigint").alias("lower_rows"),
                      half_even(F.sum("n") * F.lit(UPPER_SHARE), 0).cast("bigint").alias("upper_rows"))
    both = bins.withColumn("all", F.lit(1)).join(F.broadcast(bounds.withColumn("all", F.lit(1))), "all").drop("all")
    return both.filter((F.col("n") < F.col("lower_rows")) | (F.col("n") > F.col("upper_rows")))


def rare_category_report(df: DataFrame, column, threshold=20) -> DataFrame:
    """(value, n): categories or bins with fewer rows than the threshold."""
    return (df.filter(col(column).isNotNull()).groupBy(col(column).alias("value"))
            .agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") < threshold))
