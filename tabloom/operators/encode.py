"""One-hot, ordinal, target and weight-of-evidence encoding, and information value."""

import math
import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.functions.expressions import (
    FRACTIONAL, INTEGRAL, bin_index, col, half_even, literal, num, replace_columns, require_columns,
)
from tabloom.functions.frequencies import is_missing, mode_order, python_value, value_counts
from tabloom.functions.lookup import INLINE_ROWS, replace_by_bin, replace_by_map, store_map, text_key
from tabloom.functions.running import range_edges, running_sums
from tabloom.operators.binning import fit_bins
from tabloom.operators.steps import Step
from tabloom.operators.validate import one_hot_name
from tabloom.session import materialize

WIDEST_TABLE = 10_000       # indicator columns one fit may create before it asks the caller
COUNTED_TARGETS = 10_000    # distinct target values a per-category percentile may count
# Additive smoothing, prior weight, and the bands of information value.
SMOOTHING, PRIOR_WEIGHT = 1, 5
IV_NONE, IV_WEAK, IV_SUSPICIOUS = 0.02, 0.1, 0.5


class OneHot(Step):
    """0/1 columns ``{column}_{value}`` for the categories of the full data, in value order; nulls are all zero.

    ``drop_first`` leaves out the most frequent category (the smallest on ties). A value not seen at fit is all zero.
    """

    kind = "one_hot_encoding"
    required = ("column", "drop_first")

    def fit(self, df, action, full=None, rows=None):
        full = df if full is None else full
        rules = self.rules(action)
        if not rules:
            return {}
        names = [r["column"] for r in rules]
        require_columns(full, names, "full data")
        widest = max([WIDEST_TABLE, *[r.get("max_categories", 0) for r in rules]])
        counts = value_counts(full, names).filter(~is_missing()).select("*", mode_order().alias("m"))
        found = counts.take(widest + 1)
        if len(found) > widest:
            raise ValueError(f"one-hot encoding of {names} would make more than {widest} columns; set max_categories "
                             "in a rule to allow more")
        learned = {}
        for rule in rules:
            c = rule["column"]
            kind = full.schema[c].dataType
            mine = sorted((r["m"] for r in found if r["column"] == c),
                          key=lambda m: (m["v_num"] is None, m["v_num"] or 0.0, m["v_long"] or 0, m["v_str"] or ""))
            learned[c] = {"values": [python_value(kind, m) for m in mine]}
            if rule["drop_first"] and mine:
                top = min(mine, key=lambda m: (m["neg_n"], mine.index(m)))
                learned[c]["dropped"] = python_value(kind, top)
        return learned

    def apply(self, df, action, learned):
        require_columns(df, learned)
        keep = [col(c) for c in df.columns if c not in learned]
        indicators = []
        for c, entry in learned.items():
            native = isinstance(df.schema[c].dataType, INTEGRAL + FRACTIONAL)
            value = col(c) if native else col(c).cast("string")
            indicators += [
                F.when(value == F.lit(v), F.lit(1)).otherwise(F.lit(0)).alias(one_hot_name(c, v))
                for v in entry["values"] if v != entry.get("dropped")
            ]
        return df.select(*keep, *indicators)


class Ordinal(Step):
    """Value -> number by a configured mapping; a value without a code, null included, fails the query."""

    kind = "ordinal_encoding"
    required = ("column", "mapping")

    def asks(self, action):
        return {}

    def apply(self, df, action, learned=None):
        for rule in self.rules(action):
            require_columns(df, [rule["column"]])
            df = replace_columns(df, {rule["column"]: self.code(df, rule["column"], rule["mapping"])})
        return df

    @staticmethod
    def code(df, name, mapping):
        codes = sorted(mapping.values())
        twice = sorted({v for v in codes if codes.count(v) > 1})
        if twice:
            raise ValueError(f"column '{name}': the codes {twice} are given to more than one category")
        if 0 in codes:
            warnings.warn(f"column '{name}': a category has the code 0, which reads like 'nothing'")
        gaps = [n for a, b in zip(codes, codes[1:]) if float(b - a) > 1 for n in range(int(a) + 1, math.ceil(b))]
        if gaps:
            warnings.warn(f"column '{name}': the mapping leaves out the numbers {gaps}")
        kind = df.schema[name].dataType.simpleString()
        number = "bigint" if all(isinstance(v, int) for v in codes) else "double"
        result = None
        for key, value in mapping.items():
            hit = col(name) == literal(key, kind)
            result = F.when(hit, F.lit(value).cast(number)) if result is None else result.when(hit, F.lit(value).cast(number))
        unmapped = F.raise_error(F.concat(
            F.lit(f"column '{name}': value without a code: "), F.coalesce(col(name).cast("string"), F.lit("NULL"))))
        return result.otherwise(unmapped.cast(number))


def category_key(df: DataFrame, name, bins):
    """The category or bin number of a column, as text."""
    return bin_index(name, bins[name]["bins"]).cast("string") if name in bins else text_key(df, name)


def category_stats(df: DataFrame, pairs, quantiles=()) -> DataFrame:
    """(i, key, n, n_y, sum_y, pos, neg[, q25, q50, q75]) per category of each (key column, target column) pair.

    All pairs share one shuffle of partially aggregated rows. Missing keys form a group of their own, as they count
    for the totals.
    """
    entries = [
        F.struct(F.lit(i).alias("i"), key.alias("key"), num(y).alias("y")).alias(f"s{i}")
        for i, (key, y) in enumerate(pairs)
    ]
    long = df.select(*entries).unpivot([], [f"s{i}" for i in range(len(pairs))], "slot", "s").select("s.*")
    plain = long.groupBy("i", "key").agg(
        F.count(F.lit(1)).alias("n"), F.count("y").alias("n_y"), F.sum("y").alias("sum_y"),
        F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") == 0).alias("neg"))
    if not quantiles:
        return plain
    wanted = long.filter(F.col("i").isin(list(quantiles)) & F.col("y").isNotNull() & F.col("key").isNotNull())
    by_value = wanted.groupBy("i", "key", "y").agg(F.count(F.lit(1)).alias("m"))
    targets = sorted({pairs[i][1] for i in quantiles})
    spread = df.agg(*[F.approx_count_distinct(num(y)).alias(f"d{j}") for j, y in enumerate(targets)]).first()
    if max(spread) <= COUNTED_TARGETS:
        q = by_value.groupBy("i", "key").agg(
            F.percentile("y", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.col("m")).alias("q"))
        q = q.select("i", "key", F.col("q")[0].alias("q25"), F.col("q")[1].alias("q50"), F.col("q")[2].alias("q75"))
    else:
        q = ranked_quartiles(by_value)
    return plain.join(q, ["i", "key"], "left")


def ranked_quartiles(by_value: DataFrame) -> DataFrame:
    """Quartiles per category from running counts, for targets with too many values to count in one buffer."""
    edges = range_edges(by_value, "y", int(by_value.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranked = running_sums(by_value, ["i", "key"], "y", {"at_or_above": "m"}, edges, small=False)
    totals = by_value.groupBy("i", "key").agg(F.sum("m").alias("total"))
    ranked = ranked.join(totals, ["i", "key"]).withColumn("start", F.col("total") - F.col("at_or_above"))
    picks = []
    for name, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75)):
        place = (F.col("total") - 1) * F.lit(p)
        for end, rank in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            holds = (F.col("start") <= rank) & (rank < F.col("start") + F.col("m"))
            picks.append(F.max(F.when(holds, F.col("y"))).alias(f"{name}{end}"))
    wide = ranked.groupBy("i", "key").agg(F.max("total").alias("total"), *picks)
    out = []
    for name, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75)):
        place = (F.col("total") - 1) * F.lit(p)
        share = place - F.floor(place)
        out.append((F.col(f"{name}lo") * (1 - share) + F.col(f"{name}hi") * share).alias(name))
    return wide.select("i", "key", *out)


ENCODINGS = {
    "mean": lambda prior: F.col("sum_y") / F.col("n_y"),
    "sum": lambda prior: F.coalesce(F.col("sum_y"), F.lit(0.0)),
    "median": lambda prior: F.col("q50"),
    "quantile_25": lambda prior: F.col("q25"),
    "quantile_75": lambda prior: F.col("q75"),
    "count": lambda prior: F.col("n_y").cast("double"),
    "smoothed_target_encoding": lambda prior: (F.coalesce(F.col("sum_y"), F.lit(0.0)) + SMOOTHING) / (F.col("n_y") + 2 * SMOOTHING),
    "bayesian_target_encoding": lambda prior: (F.coalesce(F.col("sum_y"), F.lit(0.0)) + F.lit(prior) * PRIOR_WEIGHT) / (F.col("n_y") + PRIOR_WEIGHT),
}
QUANTILE_ENCODINGS = ("median", "quantile_25", "quantile_75")


class CategoryEncoder(Step):
    """Shared part of target and WOE encoding: bin what is continuous, then one grouped job for all columns."""

    outside_fails = True

    def value(self, rule, totals):
        raise NotImplementedError

    def fit(self, df, action, full=None, rows=None):
        rules = self.rules(action)
        if not rules:
            return {}
        require_columns(df, [c for r in rules for c in (r["column"], r["target_column"])])
        if len({r["column"] for r in rules}) < len(rules):
            raise ValueError(f"{self.kind}: a column is listed twice")
        for r in rules:
            self.check(r)
        continuous = [r for r in rules if r["type"] == "continuous"]
        bins = fit_bins(df, continuous, full, rows) if continuous else {}
        df = replace_columns(df, {c: num(c) for c in bins})
        pairs = [(category_key(df, r["column"], bins), r["target_column"]) for r in rules]
        needed = [i for i, r in enumerate(rules) if r.get("encoding_method") in QUANTILE_ENCODINGS]
        stats = category_stats(df, pairs, needed)
        found = stats.take(INLINE_ROWS * len(rules) + 1)
        if len(found) > INLINE_ROWS * len(rules):
            return self.fit_large(df.sparkSession, stats, rules, bins)
        learned = {}
        for i, r in enumerate(rules):
            groups = [g for g in found if g["i"] == i]
            learned[r["column"]] = self.entry(df.sparkSession, r, groups, bins.get(r["column"]))
        return learned

    def entry(self, spark, rule, groups, bins):
        if bins and len(groups) == 1:
            raise ValueError(f"column '{rule['column']}' has become constant after binning")
        totals = {k: sum(g[k] or 0 for g in groups) for k in ("n", "n_y", "sum_y", "pos", "neg")}
        rows = [[g["key"], self.number(rule, g, totals)] for g in groups if g["key"] is not None]
        entry = {"rows": sorted(rows, key=lambda kv: int(kv[0]) if bins else kv[0])}
        if bins:
            entry.update(bins)
        return {**entry, **self.extra(groups, totals)}

    def extra(self, groups, totals):
        return {}

    def fit_large(self, spark, stats, rules, bins):
        """High-cardinality categories: the maps stay distributed and are written as tables."""
        stats = materialize(stats, "category-stats")
        totals = {r["i"]: r.asDict() for r in stats.groupBy("i").agg(
            F.count(F.lit(1)).alias("groups"), *[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in ("n", "n_y", "sum_y", "pos", "neg")]).collect()}
        learned = {}
        for i, r in enumerate(rules):
            mine = stats.filter(F.col("i") == i)
            if totals[i]["groups"] <= INLINE_ROWS or r["column"] in bins:     # never more groups than configured bins
                learned[r["column"]] = self.entry(spark, r, mine.collect(), bins.get(r["column"]))
                continue
            encoded = mine.filter(F.col("key").isNotNull()).select("key", "n", self.value(r, totals[i]).alias("value"))
            learned[r["column"]] = {**store_map(spark, encoded, totals[i]["n"], "encoding"),
                                    **self.extra_large(mine, totals[i])}
        return learned

    def extra_large(self, stats, totals):
        return {}

    def apply(self, df, action, learned):
        rules = self.rules(action)
        require_columns(df, [r["column"] for r in rules])
        by_bin = {}
        df = replace_columns(df, {r["column"]: num(r["column"]) for r in rules if learned[r["column"]].get("bins")})
        for r in rules:
            entry = learned[r["column"]]
            if entry.get("bins"):
                index = bin_index(r["column"], entry["bins"])
                by_bin[r["column"]] = replace_by_bin(
                    r["column"], index, entry, max(1, len(entry["bins"]) - 1), r.get("on_unseen", "error"), self.outside_fails)
        df = replace_columns(df, by_bin) if by_bin else df
        for r in rules:
            if r["column"] not in by_bin:
                df = replace_by_map(df, r["column"], learned[r["column"]], r.get("on_unseen", "error"))
        return df


class TargetEncode(CategoryEncoder):
    """Category or bin -> statistic of the target. Missing keys stay missing."""

    kind = "target_encoding"
    required = ("column", "type", "target_column", "encoding_method")

    def check(self, rule):
        if rule["encoding_method"] not in ENCODINGS:
            raise ValueError(f"encoding_method must be one of {list(ENCODINGS)}")

    def value(self, rule, totals):
        return ENCODINGS[rule["encoding_method"]](totals["sum_y"] / totals["n_y"] if totals["n_y"] else None)

    def number(self, rule, g, totals):
        how, n, s = rule["encoding_method"], g["n_y"], g["sum_y"] or 0.0
        if how == "mean":
            return s / n if n else None
        if how == "sum":
            return s
        if how == "count":
            return float(n)
        if how == "smoothed_target_encoding":
            return (s + SMOOTHING) / (n + 2 * SMOOTHING)
        if how == "bayesian_target_encoding":
            return (s + totals["sum_y"] / totals["n_y"] * PRIOR_WEIGHT) / (n + PRIOR_WEIGHT)
        return g[{"median": "q50", "quantile_25": "q25", "quantile_75": "q75"}[how]]


class WoeEncode(CategoryEncoder):
    """ln(((pos + 1) / P) / ((neg + 1) / N)) per category or bin; P and N count all rows, unsmoothed."""

    kind = "woe_encoding"
    required = ("column", "type", "target_column")
    outside_fails = False

    def check(self, rule):
        pass

    @staticmethod
    def two_classes(totals):
        if not totals["pos"] or not totals["neg"]:
            raise ValueError("weight of evidence needs both target classes 0 and 1")

    def value(self, rule, totals):
        self.two_classes(totals)
        return F.log((F.col("pos") + 1) / F.lit(totals["pos"]) / ((F.col("neg") + 1) / F.lit(totals["neg"])))

    def number(self, rule, g, totals):
        self.two_classes(totals)
        return math.log((g["pos"] + 1) / totals["pos"] / ((g["neg"] + 1) / totals["neg"]))

    def extra(self, groups, totals):
        iv = 0.0
        for g in groups:
            if g["key"] is not None:
                p, n = (g["pos"] + 1) / totals["pos"], (g["neg"] + 1) / totals["neg"]
                iv += (p - n) * math.log(p / n)
        return {"iv": round(iv, 3), "band": iv_band(round(iv, 3))}

    def extra_large(self, stats, totals):
        p, n = (F.col("pos") + 1) / F.lit(totals["pos"]), (F.col("neg") + 1) / F.lit(totals["neg"])
        iv = round(stats.filter(F.col("key").isNotNull()).agg(F.sum((p - n) * F.log(p / n)).alias("iv")).first()["iv"], 3)
        return {"iv": iv, "band": iv_band(iv)}


def iv_band(iv: float) -> str:
    if iv < IV_NONE:
        return "not informative"
    if iv <= IV_WEAK:
        return "poorly informative"
    return "suspiciously informative" if iv > IV_SUSPICIOUS else "informative"


def information_value(df: DataFrame, columns, target, bins: dict[str, dict] | None = None) -> DataFrame:
    """(column, iv, band) of categorical columns, or of columns binned by ``fit_bins`` entries, in one shuffle.

    The class totals are sums over the same grouped counts.
    """
    bins = bins or {}
    df = replace_columns(df, {c: num(c) for c in columns if c in bins})
    pairs = [(category_key(df, c, bins), target) for c in columns]
    stats = category_stats(df, pairs)
    totals = stats.groupBy("i").agg(F.sum("pos").alias("all_pos"), F.sum("neg").alias("all_neg"))
    # Missing keys count for the totals only. They are left out inside the sum, so that both uses share one shuffle.
    p, n = (F.col("pos") + 1) / F.col("all_pos"), (F.col("neg") + 1) / F.col("all_neg")
    part = F.when(F.col("key").isNotNull(), (p - n) * F.log(p / n))
    iv = stats.join(F.broadcast(totals), "i").groupBy("i").agg(half_even(F.sum(part), 3).alias("iv"))
    names = F.array(*[F.lit(c) for c in columns])
    band = (F.when(F.col("iv") < IV_NONE, "not informative").when(F.col("iv") <= IV_WEAK, "poorly informative")
            .when(F.col("iv") > IV_SUSPICIOUS, "suspiciously informative").otherwise("informative"))
    return iv.select(F.get(names, F.col("i")).alias("column"), "iv", band.alias("band"))
