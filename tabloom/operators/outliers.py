"""Removing and replacing outliers."""

from pyspark.sql import functions as F

from tabloom.functions.expressions import num, replace_columns, require_numeric
from tabloom.functions.stats import column_stats, independent_batches
from tabloom.operators.steps import Step

FENCE_FACTOR = {"iqr": 1.5, "tukey_fences": 3.0}
QUARTILE_RANGE = (0.25, 0.75)


def search_stats(rule) -> list:
    method = rule["search_method"]
    if method == "z_score":
        return ["mean", "std"]
    if method in FENCE_FACTOR:
        return list(QUARTILE_RANGE)
    raise ValueError("search_method must be one of 'z_score', 'iqr', 'tukey_fences'")


def search_bounds(rule, stats) -> tuple[float | None, float | None]:
    """Value bounds of a rule: mean -+ threshold std, or Q1 - k IQR and Q3 + k IQR."""
    if rule["search_method"] == "z_score":
        center, spread, factor = stats["mean"], stats["std"], float(rule.get("threshold", 3))
        if center is None or spread is None:
            return None, None
        return center - factor * spread, center + factor * spread
    low, high = stats[0.25], stats[0.75]
    if low is None:
        return None, None
    k = float(rule.get("k", FENCE_FACTOR[rule["search_method"]]))
    return low - k * (high - low), high + k * (high - low)


class RemoveOutliers(Step):
    """Keep the rows strictly inside the bounds; rows without a value are removed.

    Every rule's statistics see the removals of the rules before it, so each rule is one aggregate.
    """

    kind = "removing_outliers"
    required = ("column", "search_method")
    carries_full = True

    def fit(self, df, action, full=None, rows=None):
        learned = {}
        for i, rule in enumerate(self.rules(action)):
            require_numeric(df, [rule["column"]])
            stats = column_stats(df, {rule["column"]: search_stats(rule)}, rows)[rule["column"]]
            low, high = search_bounds(rule, stats)
            learned[f"{i}:{rule['column']}"] = {
                "column": rule["column"], "bounds": {"lower": low, "upper": high}, "method": rule["search_method"]}
            df = self.inside(df, rule["column"], low, high)
        return learned

    @staticmethod
    def inside(df, column, low, high):
        if low is None:
            return df.filter(F.lit(False))
        return df.filter((num(column) > F.lit(low)) & (num(column) < F.lit(high)))

    def apply(self, df, action, learned):
        for entry in learned.values():
            df = self.inside(df, entry["column"], entry["bounds"]["lower"], entry["bounds"]["upper"])
        return df


class ReplaceOutliers(Step):
    """Values outside the bounds become a statistic of the untouched column; missing values stay.

    ``lower_bound`` and ``upper_bound`` replace both tails by that one bound; ``clip`` moves each tail to its own.
    Rules on different columns share one aggregate.
    """

    kind = "replacing_outliers"
    required = ("column", "search_method", "replacement_method")
    carries_full = True
    values = {"mean": "mean", "median": 0.5, "mode": "mode", "quantile_25": 0.25, "quantile_75": 0.75}
    bounds = ("lower_bound", "upper_bound", "clip")

    def wanted(self, rules):
        wanted = {}
        for r in rules:
            how = r["replacement_method"]
            if how not in self.values and how not in self.bounds:
                raise ValueError(f"replacement_method must be one of {[*self.values, *self.bounds]}")
            wanted[r["column"]] = search_stats(r) + ([self.values[how]] if how in self.values else [])
        return wanted

    def asks(self, action):
        rules = self.rules(action)
        return self.wanted(rules) if len(independent_batches(rules)) < 2 else None

    def fit(self, df, action, full=None, rows=None, known=None):
        learned = {}
        for number, batch in enumerate(independent_batches(self.rules(action))):
            require_numeric(df, [r["column"] for r in batch])
            wanted = self.wanted(batch)
            stats = column_stats(df, wanted, rows) if known is None else known
            round_learned = {}
            for r in batch:
                found, how = stats[r["column"]], r["replacement_method"]
                low, high = search_bounds(r, found)
                value = {"lower_bound": low, "upper_bound": high, "clip": None}.get(how) if how in self.bounds \
                    else found[self.values[how]]
                round_learned[f"{number}:{r['column']}"] = {
                    "column": r["column"], "value": value, "bounds": [low, high], "method": r["search_method"],
                    "clip": how == "clip"}
            learned.update(round_learned)
            df = self.apply(df, action, round_learned)
        return learned

    def apply(self, df, action, learned):
        rounds = {}
        for key, entry in learned.items():
            rounds.setdefault(key.split(":")[0], {})[entry["column"]] = entry
        for entries in rounds.values():
            df = replace_columns(df, {c: self.replaced(c, e) for c, e in entries.items() if e["bounds"][0] is not None})
        return df

    @staticmethod
    def replaced(column, entry):
        x, (low, high) = num(column), entry["bounds"]
        if entry["clip"]:
            return F.when(x < low, F.lit(low)).when(x > high, F.lit(high)).otherwise(x)
        return F.when((x < low) | (x > high), F.lit(float(entry["value"]))).otherwise(x)
