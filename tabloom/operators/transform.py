"""Casts, scalar transforms and scaling."""

from pyspark.sql import functions as F

from tabloom.functions.expressions import num, replace_columns, require_columns, require_numeric
from tabloom.functions.stats import column_stats
from tabloom.operators.steps import Step
from tabloom.operators.validate import cast_numeric


class ConvertToNumber(Step):
    kind = "converting_to_number"
    required = ("column", "to_type")
    carries_full = True

    def asks(self, action):
        return {}

    def apply(self, df, action, learned=None):
        for rule in self.rules(action):
            df = cast_numeric(df, {rule["column"]: rule["to_type"]})
        return df


def transformed(column, method, power=None):
    """ln(x + 1), square root or power; null where the function has no finite value."""
    x = num(column)
    if method == "log":
        return F.when(x > -1, F.log1p(x))
    if method == "sqrt":
        return F.when(x >= 0, F.sqrt(x))
    if method == "power":
        if power is None:
            raise ValueError("power must be given for the 'power' transformation")
        y = F.pow(x, F.lit(float(power)))
        return F.when(~F.isnan(y) & (F.abs(y) != float("inf")), y)
    raise ValueError("transformation_method must be one of 'log', 'sqrt', 'power'")


class Transform(Step):
    kind = "transformation"
    required = ("column", "transformation_method")
    carries_full = True

    def asks(self, action):
        return {}

    def fit(self, df, action, full=None, rows=None, known=None):
        learned = {}
        for i, r in enumerate(self.rules(action)):
            require_numeric(df, [r["column"]])
            transformed(r["column"], r["transformation_method"], r.get("power"))
            learned[f"{i}:{r['column']}"] = {
                "column": r["column"], "transformation_method": r["transformation_method"], "power": r.get("power")}
        return learned

    def apply(self, df, action, learned):
        for entry in learned.values():
            require_columns(df, [entry["column"]])
            df = replace_columns(df, {
                entry["column"]: transformed(entry["column"], entry["transformation_method"], entry["power"])})
        return df


class Scale(Step):
    """(x - center) / spread as expressions on literals; a spread of 0 counts as 1, so constants become 0."""

    kind = "scaling"
    scalers = {"standard": ("mean", "std_pop"), "robust": (0.5, 0.25, 0.75), "minmax": ("min", "max"), "none": ()}

    def rules(self, action):
        rule = action[self.kind]
        for key in ("scaler_type", "columns"):
            if key not in rule:
                raise ValueError(f"scaling: the key '{key}' is missing")
        if rule["scaler_type"] not in self.scalers:
            raise ValueError(f"scaler_type must be one of {list(self.scalers)}")
        return rule

    def asks(self, action):
        rule = self.rules(action)
        return {c: list(self.scalers[rule["scaler_type"]]) for c in rule["columns"]}

    def changes(self, action):
        return set(self.rules(action)["columns"])

    def fit(self, df, action, full=None, rows=None, known=None):
        rule = self.rules(action)
        require_columns(df, rule["columns"])
        how = rule["scaler_type"]
        if how == "none":
            return {}
        require_numeric(df, rule["columns"])
        stats = column_stats(df, self.asks(action), rows) if known is None else known
        learned = {}
        for c in dict.fromkeys(rule["columns"]):
            s = stats[c]
            if how == "standard":
                center, spread = s["mean"], s["std_pop"]
            elif how == "robust":
                center, spread = s[0.5], None if s[0.25] is None else s[0.75] - s[0.25]
            else:
                center, spread = s["min"], None if s["min"] is None else s["max"] - s["min"]
            learned[c] = {"center": center, "spread": spread or 1.0}
        return learned

    def apply(self, df, action, learned):
        require_columns(df, learned)
        return replace_columns(df, {
            c: (num(c) - F.lit(s["center"])) / F.lit(s["spread"]) for c, s in learned.items() if s["center"] is not None})
