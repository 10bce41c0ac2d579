"""Filling missing values."""

from pyspark.sql import functions as F

from tabloom.functions.expressions import col, num, replace_columns, require_columns
from tabloom.functions.stats import column_stats
from tabloom.operators.steps import Step


def filled(df, name, value):
    """The column with missing values replaced; a whole-number column becomes double when the value is fractional."""
    present = num(name) if isinstance(value, float) else col(name)
    kind = "double" if isinstance(value, float) else df.schema[name].dataType
    if df.schema[name].dataType.typeName() in ("float", "double") and not isinstance(value, float):
        present = F.when(~F.isnan(col(name)), col(name))
    return F.coalesce(present, F.lit(value).cast(kind))


class FillZero(Step):
    """Missing numbers become 0. The action lists column names."""

    kind = "filling_missing_numeric_values_with_zeroes"
    carries_full = True

    def rules(self, action):
        return [c for c in action[self.kind] if c]

    def asks(self, action):
        return {}

    def changes(self, action):
        return set(self.rules(action))

    def apply(self, df, action, learned=None):
        names = self.rules(action)
        require_columns(df, names)
        return replace_columns(df, {c: filled(df, c, 0) for c in names})


class FillNumeric(Step):
    """Missing numbers become the mode (smallest on ties), exact median or mean of the column."""

    kind = "filling_missing_numeric_values_with_stats_method"
    required = ("column", "fill_missing_values_method")
    carries_full = True
    methods = {"mode": "mode", "median": 0.5, "mean": "mean"}

    def active(self, action):
        """Rules with a method; an empty method leaves the column alone, in fit and in apply."""
        return [r for r in self.rules(action) if r["fill_missing_values_method"]]

    def asks(self, action):
        wanted = {}
        for r in self.active(action):
            if r["fill_missing_values_method"] not in self.methods:
                raise ValueError(f"fill_missing_values_method must be one of {list(self.methods)}")
            wanted[r["column"]] = [self.methods[r["fill_missing_values_method"]]]
        return wanted

    def fit(self, df, action, full=None, rows=None, known=None):
        wanted = self.asks(action)
        require_columns(df, wanted)
        stats = column_stats(df, wanted, rows) if known is None else known
        learned = {c: stats[c][names[0]] for c, names in wanted.items()}
        empty = [c for c, v in learned.items() if v is None and wanted[c] == ["mode"]]
        if empty:
            raise ValueError(f"columns {empty} hold no value to take the mode of")
        return learned

    def apply(self, df, action, learned):
        names = [r["column"] for r in self.active(action)]
        require_columns(df, names)
        return replace_columns(df, {c: filled(df, c, learned[c]) for c in names if learned[c] is not None})


class FillText(FillNumeric):
    """Missing text becomes the mode or a placeholder."""

    kind = "filling_missing_text_values"

    def asks(self, action):
        return {r["column"]: ["mode"] for r in self.active(action) if r["fill_missing_values_method"] == "mode"}

    def fit(self, df, action, full=None, rows=None, known=None):
        rules = self.active(action)
        require_columns(df, [r["column"] for r in rules])
        learned, by_mode = {}, []
        for r in rules:
            method, c = r["fill_missing_values_method"], r["column"]
            if method == "placeholder":
                if r.get("placeholder") in (None, ""):
                    raise ValueError(f"column '{c}': the placeholder must not be empty")
                learned[c] = r["placeholder"]
            elif method == "mode":
                by_mode.append(c)
            else:
                raise ValueError("fill_missing_values_method must be 'mode' or 'placeholder'")
        found = column_stats(df, {c: ["mode"] for c in by_mode}) if known is None else known
        for c in by_mode:
            if found[c]["mode"] is None:
                raise ValueError(f"column '{c}' holds no value to take the mode of")
            learned[c] = found[c]["mode"]
        return learned


def fill_zero(df, columns):
    return FillZero().apply(df, {FillZero.kind: list(columns)})

