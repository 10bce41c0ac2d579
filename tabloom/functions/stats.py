"""All the statistics one step needs, from as few aggregates as possible."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions.frequencies import modes
from tabloom.functions.quantiles import long_numbers, quantiles_and_more

MOMENTS = {
    "n": F.count, "mean": F.avg, "std": F.stddev_samp, "std_pop": F.stddev_pop, "min": F.min, "max": F.max,
}


def column_stats(df: DataFrame, wanted: dict[str, list], rows=None) -> dict[str, dict]:
    """``{column: {name: value}}`` for names in MOMENTS, 'mode', or a fraction for a quantile.

    Moments come with the first round of the quantiles, in one job, each from an aggregate of its own kind; modes need the
    frequency job, and quantiles of columns with very many values further rounds.
    """
    columns = list(wanted)
    moments = sorted({w for ws in wanted.values() for w in ws if w in MOMENTS})
    with_moments = [c for c in columns if any(w in MOMENTS for w in wanted[c])]
    fractions = {c: [w for w in wanted[c] if not isinstance(w, str)] for c in columns}
    found = {c: {w: 0 if w == "n" else None for w in wanted[c]} for c in columns}
    also = None
    if with_moments:
        grouped = long_numbers(df, with_moments).groupBy("slot").agg(*[MOMENTS[m]("x").cast("double").alias(m) for m in moments])
        also = grouped.select("slot", F.array(*moments).alias("v"))
    quantiles, more = quantiles_and_more(df, fractions, also, rows)
    for slot, v in more.items():
        c = with_moments[slot]
        values = dict(zip(moments, v))
        found[c].update({w: values[w] for w in wanted[c] if w in values})
    for c, values in quantiles.items():
        found[c].update(values)
    for c, value in modes(df, [c for c in columns if "mode" in wanted[c]]).items():
        found[c]["mode"] = value
    return found


def independent_batches(rules) -> list[list[dict]]:
    """Rules in order, cut where a column recurs: inside a batch no rule's statistics depend on another's result."""
    batches, seen = [], set()
    for rule in rules:
        if not batches or rule["column"] in seen:
            batches.append([])
            seen = set()
        batches[-1].append(rule)
        seen.add(rule["column"])
    return batches
