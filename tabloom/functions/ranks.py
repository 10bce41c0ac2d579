"""Cutting rows at exact ranks of their hash without sorting or a global window.

A row's 32-digit hash orders the rows at random but reproducibly. The hash at a wanted rank is found like a word in a
dictionary: count rows per leading four digits, keep the bucket that holds the rank, count its next four digits, and
so on until the bucket is small enough to fetch. Each step is one narrow aggregate of at most 65,536 groups per class
and wanted rank; the result is a plain filter on literals, whatever the number of rows.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STEP = 4             # hex digits per refinement: 16^4 buckets
FETCH_BOUND = 1000   # hashes of one bucket that may come to the driver


def hash_cuts(df: DataFrame, hash_column, group_column, wanted):
    """``({group: [cut, ...]}, {group: rows})`` such that exactly ``rank`` rows of the group have hash <= cut.

    ``wanted`` gets the row count per group and returns ``{group: [rank, ...]}`` with 1 <= rank <= rows.
    """
    rows = df.select(group_column.alias("g"), hash_column.alias("h"))
    top = rows.groupBy("g", F.substring("h", 1, STEP).alias("p")).count().collect()
    sizes = {}
    for r in top:
        sizes[r["g"]] = sizes.get(r["g"], 0) + r["count"]
    targets = {(g, k): ["", k] for g, ranks in wanted(sizes).items() for k in ranks}
    descend(targets, top)
    cuts = {}
    while targets:
        length = len(next(iter(targets.values()))[0])
        pending = {}
        prefixes = sorted({(t[0], g) for (g, _), t in targets.items()}, key=str)
        scope = prefix_scope(rows, prefixes, length)
        small = {(g, k) for (g, k), t in targets.items() if t[2] <= FETCH_BOUND}
        if small:
            chosen = sorted({(targets[key][0], key[0]) for key in small}, key=str)
            fetched = prefix_scope(rows, chosen, length).collect()
            for key in small:
                prefix, rank, _ = targets[key]
                hashes = sorted(r["h"] for r in fetched if r["g"] == key[0] and r["h"].startswith(prefix))
                if rank < len(hashes) and hashes[rank] == hashes[rank - 1]:
                    raise ValueError("the key columns do not identify single rows: equal keys lie on the cut")
                cuts[key] = hashes[rank - 1]
        pending = {key: t for key, t in targets.items() if key not in small}
        if pending:
            if length >= 32:
                raise ValueError("the key columns do not identify single rows: equal keys lie on the cut")
            deeper = scope.groupBy("g", F.substring("h", 1, length + STEP).alias("p")).count().collect()
            descend(pending, deeper)
        targets = pending
    grouped = {}
    for (g, k), cut in cuts.items():
        grouped.setdefault(g, {})[k] = cut
    return grouped, sizes


def prefix_scope(rows, prefixes, length):
    keep = None
    for prefix, group in prefixes:
        one = F.col("g").eqNullSafe(F.lit(group)) & (F.substring("h", 1, length) == F.lit(prefix))
        keep = one if keep is None else keep | one
    return rows.filter(keep)


def descend(targets, counts):
    """Move every target to the bucket that holds its rank; ranks become relative to that bucket."""
    by_group = {}
    for r in counts:
        by_group.setdefault(r["g"], []).append((r["p"], r["count"]))
    for entries in by_group.values():
        entries.sort()
    for (g, _), target in targets.items():
        prefix, rank = target[0], target[1]
        for p, n in by_group[g]:
            if not p.startswith(prefix):
                continue
            if rank <= n:
                target[:] = [p, rank, n]
                break
            rank -= n
