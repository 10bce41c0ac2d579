"""The common shape of learned preparation steps."""

from pyspark.sql import DataFrame


class Step:
    """One kind of preparation action.

    ``fit`` gathers statistics with aggregates and returns plain, JSON-able ``learned`` values; ``apply`` replays them
    as a lazy projection or filter and starts no job, so it also serves streaming DataFrames.
    """

    kind = ""
    required: tuple[str, ...] = ("column",)
    carries_full = False    # does the step also run over the unsplit data that later steps learn ranges from?

    def rules(self, action) -> list[dict]:
        """The non-empty rules of an action, checked for their required keys."""
        rules = [r for r in action[self.kind] if r]
        for r in rules:
            lacking = [k for k in self.required if k not in r]
            if lacking:
                raise ValueError(f"{self.kind}: rule {r} lacks the keys {lacking}")
        return rules

    def fit(self, df: DataFrame, action, full: DataFrame | None = None, rows: int | None = None, known: dict | None = None) -> dict:
        return {}

    def asks(self, action) -> dict[str, list] | None:
        """Statistics by column that ``fit`` takes from ``column_stats``; None if it gathers what it needs in another way.

        Steps that ask can learn together: ``fit`` takes their answers as ``known`` and starts no job of its own.
        """
        return None

    def changes(self, action) -> set[str]:
        """Columns whose values the step replaces; asked of steps that say what they ask."""
        return {r["column"] for r in self.rules(action)}

    def apply(self, df: DataFrame, action, learned: dict) -> DataFrame:
        raise NotImplementedError

    def fit_apply(self, df: DataFrame, action, full=None, rows=None, known=None) -> tuple[DataFrame, dict]:
        learned = self.fit(df, action, full, rows) if known is None else self.fit(df, action, full, rows, known)
        return self.apply(df, action, learned), learned
