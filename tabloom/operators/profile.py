"""Dataset profile: one row per column from four jobs, whatever the number of columns."""

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.functions.expressions import (
    INTEGRAL, col, double_array, num, numeric_columns, require_numeric, row_fingerprint,
)
from tabloom.functions.frequencies import is_missing, mode_order, value_counts
from tabloom.functions.quantiles import exact_quantiles, long_numbers, quantiles_and_more
from tabloom.functions.stats import column_stats
from tabloom.operators.validate import missing, tidy

QUARTILES = [0.25, 0.5, 0.75]


def table_shape(df: DataFrame) -> DataFrame:
    """(n_columns, n_rows, n_duplicates, duplicate_pct); nulls are equal to one another.

    Rows are compared by a 128-bit fingerprint, so 16 bytes per distinct row are shuffled instead of the row. Two
    different rows among 10^12 share one with a chance below 10^-14.
    """
    prints = df.select(*[h.alias(f"h{i}") for i, h in enumerate(row_fingerprint(df.schema.fields))])
    groups = prints.groupBy("h0", "h1").agg(F.count(F.lit(1)).alias("n"))
    totals = groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("distinct"))
    duplicates = F.col("rows") - F.col("distinct")
    return totals.select(
        F.lit(len(df.columns)).cast("bigint").alias("n_columns"), F.col("rows").alias("n_rows"),
        duplicates.alias("n_duplicates"),
        F.try_divide(duplicates.cast("double") * 100, F.col("rows").cast("double")).alias("duplicate_pct"))


def named(df: DataFrame, names, aggregated: DataFrame) -> DataFrame:
    """One row per column name beside its aggregates; columns of an empty table have none."""
    labels = df.sparkSession.createDataFrame(list(enumerate(names)), "slot int, `column` string")
    return labels.join(F.broadcast(aggregated), "slot", "left")


def moments(df: DataFrame, names) -> DataFrame:
    """(slot, n, min, max, mean, std, rmsd, skew, kurt, zero, neg), all columns in one narrow aggregate."""
    x = F.col("x")
    return long_numbers(df, names).groupBy("slot").agg(
        F.count(x).alias("n"), F.min(x).alias("min"), F.max(x).alias("max"), F.avg(x).alias("mean"),
        F.stddev_samp(x).alias("std"), F.stddev_pop(x).alias("rmsd"), F.skewness(x).alias("skew"), F.kurtosis(x).alias("kurt"),
        F.count_if(x == 0).alias("zero"), F.count_if(x < 0).alias("neg"))


def corrected_skewness(n, g, constant):
    """Bias-corrected skewness from the population one; 0 for a constant, null below three values."""
    full = F.when(constant, F.lit(0.0)).otherwise(g * F.sqrt(n * (n - 1)) / F.when(n > 2, n - 2))
    return F.when(n >= 3, full)


def corrected_kurtosis(n, g, constant):
    """Bias-corrected excess kurtosis; 0 for a constant, null below four values."""
    scale = (n - 1) / F.when(n > 3, (n - 2) * (n - 3))
    return F.when(n >= 4, F.when(constant, F.lit(0.0)).otherwise(scale * ((n + 1) * g + 6)))


def shape_columns():
    n, same = F.col("n").cast("double"), F.col("min") == F.col("max")
    return {"skewness": corrected_skewness(n, F.col("skew"), same), "kurtosis": corrected_kurtosis(n, F.col("kurt"), same)}


def numeric_summary(df: DataFrame, columns=None, approx=False, rows=None) -> DataFrame:
    """(column, n, min, max, range, mean, median, q1, q3, std).

    ``approx`` reads the quartiles from Spark's bounded sketch. Otherwise they are exact, counted bit by bit.
    """
    names = columns or numeric_columns(df)
    require_numeric(df, names)
    x = F.col("x")
    stats = long_numbers(df, names).groupBy("slot").agg(
        F.count(x).alias("n"), F.min(x).alias("min"), F.max(x).alias("max"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"))
    if approx:
        q = long_numbers(df, names).groupBy("slot").agg(F.percentile_approx(x, QUARTILES).alias("q"))
    else:
        found = exact_quantiles(df, {c: QUARTILES for c in names}, rows)
        q = df.sparkSession.createDataFrame([(i, [found[c][p] for p in QUARTILES]) for i, c in enumerate(names)], "slot int, q array<double>")
    both = named(df, names, stats).join(F.broadcast(q), "slot", "left")
    return both.select("column", F.coalesce("n", F.lit(0)).alias("n"), "min", "max", (F.col("max") - F.col("min")).alias("range"), "mean",
                       F.get("q", 1).alias("median"), F.get("q", 0).alias("q1"), F.get("q", 2).alias("q3"), "std")


def dispersion_shape(df: DataFrame, columns=None) -> DataFrame:
    """(column, rmsd, variation, kurtosis, skewness)."""
    names = columns or numeric_columns(df)
    require_numeric(df, names)
    shape = shape_columns()
    return named(df, names, moments(df, names)).select(
        "column", "rmsd", F.try_divide("std", "mean").alias("variation"), shape["kurtosis"].alias("kurtosis"), shape["skewness"].alias("skewness"))


def literals_by_slot(values):
    """The entry of a literal list at the row's slot."""
    return F.get(double_array(values), F.col("slot"))


def count_over(condition):
    return F.count_if(F.coalesce(condition, F.lit(False)))


def zscore_count(means, deviations, threshold=3.0):
    """Aggregate counting |x - mean| / std above the threshold; a constant column has none."""
    spread = F.when(literals_by_slot(deviations) > 0, literals_by_slot(deviations))
    return count_over(F.abs((F.col("x") - literals_by_slot(means)) / spread) > F.lit(float(threshold)))


def fence_counts(q1, q3, k):
    """Aggregates counting values strictly below and above the fences."""
    low = [None if a is None else a - k * (b - a) for a, b in zip(q1, q3)]
    high = [None if a is None else b + k * (b - a) for a, b in zip(q1, q3)]
    return count_over(F.col("x") < literals_by_slot(low)), count_over(F.col("x") > literals_by_slot(high))


def zscore_outlier_counts(df: DataFrame, columns=None, threshold=3.0) -> DataFrame:
    """(column, n_outliers): |x - mean| / std above the threshold. Two narrow aggregates."""
    names = columns or numeric_columns(df)
    require_numeric(df, names)
    stats = column_stats(df, {c: ["mean", "std"] for c in names})
    counted = long_numbers(df, names).groupBy("slot").agg(
        zscore_count([stats[c]["mean"] for c in names], [stats[c]["std"] for c in names], threshold).alias("z"))
    return named(df, names, counted).select("column", F.coalesce("z", F.lit(0)).alias("n_outliers"))


def fence_outlier_counts(df: DataFrame, columns=None, k=1.5, rows=None) -> DataFrame:
    """(column, n_outliers, n_below, n_above) strictly outside Q1 - k IQR and Q3 + k IQR; k 1.5 is IQR, 3 is Tukey."""
    names = columns or numeric_columns(df)
    require_numeric(df, names)
    q = exact_quantiles(df, {c: [0.25, 0.75] for c in names}, rows)
    below, above = fence_counts([q[c][0.25] for c in names], [q[c][0.75] for c in names], k)
    counted = long_numbers(df, names).groupBy("slot").agg(below.alias("lo"), above.alias("hi"))
    zero = F.lit(0)
    return named(df, names, counted).select(
        "column", F.coalesce(F.col("lo") + F.col("hi"), zero).alias("n_outliers"), F.coalesce("lo", zero).alias("n_below"),
        F.coalesce("hi", zero).alias("n_above"))


def percent(part, whole):
    return F.try_divide(part.cast("double") * 100, whole.cast("double"))


def missing_profile(df: DataFrame) -> DataFrame:
    """(column, n_missing, missing_pct)."""
    wide = df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(missing(df, c)).alias(f"m{i}") for i, c in enumerate(df.columns)])
    return tidy(wide, [
        [("column", F.lit(c)), ("n_missing", F.col(f"m{i}")), ("missing_pct", percent(F.col(f"m{i}"), F.col("n")))]
        for i, c in enumerate(df.columns)
    ])


def zero_negative_profile(df: DataFrame, columns=None) -> DataFrame:
    """(column, n_zero, zero_pct, n_negative, negative_pct); percentages over all rows."""
    names = columns or numeric_columns(df)
    require_numeric(df, names)
    x = F.col("x")
    counted = long_numbers(df, names).groupBy("slot").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(x == 0).alias("zero"), F.count_if(x < 0).alias("neg"))
    return named(df, names, counted).select(
        "column", F.coalesce("zero", F.lit(0)).alias("n_zero"), percent(F.col("zero"), F.col("rows")).alias("zero_pct"),
        F.coalesce("neg", F.lit(0)).alias("n_negative"), percent(F.col("neg"), F.col("rows")).alias("negative_pct"))


def of_every_column(df: DataFrame, names, found: DataFrame) -> DataFrame:
    """One row per column name beside what was found for it, also for the columns of an empty table."""
    labels = df.sparkSession.createDataFrame([(c,) for c in names], "`column` string")
    return labels.join(F.broadcast(found), "column", "left")


def mode(df: DataFrame, columns=None, whole=False) -> DataFrame:
    """(column, mode_num, mode_str, n): most frequent value, the smallest on ties; nulls without values.

    ``whole`` adds mode_long, the exact value in columns of whole numbers, which a double holds up to 2^53 only.
    """
    names = list(columns or df.columns)
    best = value_counts(df, names).groupBy("column").agg(F.min(mode_order(whole)).alias("m"))
    exact = [F.col("m.v_long").alias("mode_long")] if whole else []
    return of_every_column(df, names, best).select(
        "column", *exact, F.col("m.v_num").alias("mode_num"), F.col("m.v_str").alias("mode_str"), (-F.col("m.neg_n")).alias("n"))


def distinct_count(df: DataFrame, columns=None, approx=False) -> DataFrame:
    """(column, n_distinct), null counted as one value; 0 for an empty table; ``approx`` uses a bounded sketch and no shuffle."""
    names = list(columns or df.columns)
    if approx:
        values = df.select(*[col(c).cast("string").alias(f"c{i}") for i, c in enumerate(names)])
        wide = values.agg(*[
            (F.coalesce(F.hll_sketch_estimate(F.hll_sketch_agg(f"c{i}", 14)), F.lit(0)) + F.coalesce(F.max(F.col(f"c{i}").isNull().cast("int")), F.lit(0))).alias(f"d{i}")
            for i in range(len(names))])
        return tidy(wide, [[("column", F.lit(c)), ("n_distinct", F.col(f"d{i}"))] for i, c in enumerate(names)])
    counted = value_counts(df, names).groupBy("column").agg(F.count(F.lit(1)).alias("n_distinct"))
    return of_every_column(df, names, counted).select("column", F.coalesce("n_distinct", F.lit(0)).alias("n_distinct"))


def value_distribution(df: DataFrame, columns=None, threshold=10, whole=False) -> DataFrame:
    """(column, v_num, v_str, n, pct) of the columns with at most ``threshold`` distinct values, null included.

    The per-column totals come from the same shuffled counts, so the table is read and shuffled once. ``whole`` adds v_long, the
    exact value in columns of whole numbers. An empty table has no values, so no rows.
    """
    counts = value_counts(df, columns or df.columns)
    totals = counts.groupBy("column").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("rows"))
    few = totals.filter(F.col("k") <= threshold).select("column", "rows")
    exact = ["v_long"] if whole else []
    return (counts.join(F.broadcast(few), "column")
            .select("column", *exact, "v_num", "v_str", "n", percent(F.col("n"), F.col("rows")).alias("pct"))
            .orderBy("column", F.desc("n"), *exact, "v_num", "v_str"))


def example_value(df: DataFrame, columns=None, threshold=10, whole=False) -> DataFrame:
    """(column, lo_num, lo_str): the smallest value of the columns with more than ``threshold`` distinct values.

    ``whole`` adds lo_long, the exact value in columns of whole numbers.
    """
    counts = value_counts(df, columns or df.columns)
    per = counts.groupBy("column").agg(F.count(F.lit(1)).alias("k"), F.min("v_num").alias("lo_num"),
                                       F.min("v_str").alias("lo_str"), F.min("v_long").alias("lo_long"))
    return per.filter(F.col("k") > threshold).select("column", *(["lo_long"] if whole else []), "lo_num", "lo_str")


def whole_number_profile(df: DataFrame, columns=None) -> DataFrame:
    """(column, n, min, max, range, sum) of the columns of whole numbers, exact over all of bigint: range and sum are decimal(38, 0)."""
    names = list(columns or [f.name for f in df.schema.fields if isinstance(f.dataType, INTEGRAL)])
    wrong = [c for c in names if not isinstance(df.schema[c].dataType, INTEGRAL)]
    if wrong:
        raise ValueError(f"not columns of whole numbers: {wrong}")
    long = df.select(F.posexplode(F.array(*[col(c).cast("bigint") for c in names])).alias("slot", "x")) if names else None
    if long is None:
        return df.sparkSession.createDataFrame([], "`column` string, n bigint, min bigint, max bigint, range decimal(38,0), sum decimal(38,0)")
    x, wide = F.col("x"), "decimal(38,0)"
    seen = long.groupBy("slot").agg(F.count(x).alias("n"), F.min(x).alias("min"), F.max(x).alias("max"), F.sum(x.cast("decimal(28,0)")).cast(wide).alias("sum"))
    return named(df, names, seen).select("column", F.coalesce("n", F.lit(0)).alias("n"), "min", "max",
                                         (F.col("max").cast("decimal(20,0)") - F.col("min").cast("decimal(20,0)")).cast(wide).alias("range"), "sum")


PROFILE_SCHEMA = T.StructType(
    [T.StructField("column", T.StringType()), T.StructField("type", T.StringType())]
    + [T.StructField(n, T.LongType()) for n in ("n_distinct", "n_missing")]
    + [T.StructField("missing_pct", T.DoubleType())]
    + [T.StructField("mode_num", T.DoubleType()), T.StructField("mode_str", T.StringType())]
    + [T.StructField("n_zero", T.LongType()), T.StructField("zero_pct", T.DoubleType()),
       T.StructField("n_negative", T.LongType()), T.StructField("negative_pct", T.DoubleType())]
    + [T.StructField(n, T.DoubleType()) for n in (
        "min", "max", "range", "mean", "median", "q1", "q3", "std", "rmsd", "variation", "kurtosis", "skewness")]
    + [T.StructField(n, T.LongType()) for n in (
        "z_outliers", "iqr_outliers", "iqr_below", "iqr_above", "tukey_outliers", "tukey_below", "tukey_above")]
    + [T.StructField("example_num", T.DoubleType()), T.StructField("example_str", T.StringType()),
       T.StructField("distribution", T.ArrayType(T.StructType([
           T.StructField("v_num", T.DoubleType()), T.StructField("v_str", T.StringType()),
           T.StructField("n", T.LongType()), T.StructField("pct", T.DoubleType())])))]
)


def frequency_facts(df: DataFrame, threshold) -> dict:
    """Per column: distinct and missing values, mode, smallest value, and the whole distribution where short. One job.

    Only columns with at most ``threshold`` values reach the collected list, so no group grows with the data; the
    shuffled counts are used twice but computed once.
    """
    counts = value_counts(df, df.columns)
    per = counts.groupBy("column").agg(
        F.count(F.lit(1)).alias("k"), F.sum(F.when(is_missing(), F.col("n")).otherwise(0)).alias("missing"),
        F.min(mode_order()).alias("mode"), F.min("v_num").alias("lo_num"), F.min("v_str").alias("lo_str"))
    short = per.filter(F.col("k") <= threshold).select("column")
    lists = counts.join(F.broadcast(short), "column").groupBy("column").agg(
        F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), "v_num", "v_str"))).alias("all"))
    return {r["column"]: r for r in per.join(F.broadcast(lists), "column", "left").collect()}


def numeric_facts(df: DataFrame, names, distinct) -> dict[str, dict]:
    """Moments, quartiles and outlier counts per numeric column. Two jobs, and further rounds for columns of very many values."""
    counts = ("n", "zero", "neg")
    first = moments(df, names).withColumns(shape_columns())
    facts = [c for c in first.columns if c != "slot"]
    also = first.select("slot", F.array(*[F.col(c).cast("double") for c in facts]).alias("v"))
    quartiles, more = quantiles_and_more(df, {c: QUARTILES for c in names}, also, distinct=distinct)
    seen = {names[slot]: {c: int(x) if c in counts else x for c, x in zip(facts, v)} for slot, v in more.items()}

    def listed(pick):
        return [pick(c) for c in names]

    def quartile(c, k):
        return quartiles[c][QUARTILES[k]]

    aggregates = [zscore_count(listed(lambda c: seen.get(c, {}).get("mean")), listed(lambda c: seen.get(c, {}).get("std"))).alias("z")]
    for tag, k in (("iqr", 1.5), ("tukey", 3.0)):
        below, above = fence_counts(listed(lambda c: quartile(c, 0)), listed(lambda c: quartile(c, 2)), k)
        aggregates += [below.alias(f"{tag}_lo"), above.alias(f"{tag}_hi")]
    outliers = {names[r["slot"]]: r for r in long_numbers(df, names).groupBy("slot").agg(*aggregates).collect()}
    facts = {}
    for c in names:
        fact = {"n_zero": 0, "n_negative": 0, "z_outliers": 0, **{f"{t}_{n}": 0 for t in ("iqr", "tukey") for n in ("outliers", "below", "above")}}
        if c in seen:
            m, out = seen[c], outliers[c]
            fact.update({
                "n_zero": m["zero"], "n_negative": m["neg"], "min": m["min"], "max": m["max"],
                "range": None if m["min"] is None else m["max"] - m["min"], "mean": m["mean"], "median": quartile(c, 1),
                "q1": quartile(c, 0), "q3": quartile(c, 2), "std": m["std"], "rmsd": m["rmsd"],
                "variation": m["std"] / m["mean"] if m["mean"] and m["std"] is not None else None,
                "kurtosis": m["kurtosis"], "skewness": m["skewness"], "z_outliers": out["z"]})
            for tag in ("iqr", "tukey"):
                below, above = out[f"{tag}_lo"], out[f"{tag}_hi"]
                fact.update({f"{tag}_outliers": below + above, f"{tag}_below": below, f"{tag}_above": above})
        facts[c] = fact
    return facts


def profile(df: DataFrame, threshold=10) -> tuple[DataFrame, DataFrame]:
    """``(table, columns)``: the shape of the table and one row of facts per column.

    Four jobs: shape, frequencies, moments with quartiles, outlier counts. Columns with more distinct values than one
    round of the quartiles may count add a few rounds, each an aggregate that combines map-side. What comes to the driver
    is one row per column, and the rounds' counts.
    """
    spark = df.sparkSession
    lazy_shape = table_shape(df)
    shape = lazy_shape.first()
    total = shape["n_rows"]
    frequencies = frequency_facts(df, threshold)
    names = numeric_columns(df)
    numbers = numeric_facts(df, names, {c: frequencies[c]["k"] if total else 0 for c in names}) if names else {}

    def share(n):
        return n * 100.0 / total if total and n is not None else None

    rows = []
    for f in df.schema.fields:
        row = dict.fromkeys(PROFILE_SCHEMA.names)
        row.update(column=f.name, type=f.dataType.simpleString(), n_distinct=0, n_missing=0, **numbers.get(f.name, {}))
        seen = frequencies.get(f.name)
        if seen:
            row.update(n_distinct=seen["k"], n_missing=seen["missing"])
            if seen["mode"]:
                row.update(mode_num=seen["mode"]["v_num"], mode_str=seen["mode"]["v_str"])
            if seen["k"] > threshold:
                row.update(example_num=seen["lo_num"], example_str=seen["lo_str"])
            else:
                row["distribution"] = [(v["v_num"], v["v_str"], -v["m"], share(-v["m"])) for v in seen["all"]]
        row.update(missing_pct=share(row["n_missing"]), zero_pct=share(row["n_zero"]), negative_pct=share(row["n_negative"]))
        rows.append(tuple(row[n] for n in PROFILE_SCHEMA.names))
    return spark.createDataFrame([shape], lazy_shape.schema), spark.createDataFrame(rows, PROFILE_SCHEMA)


def pearson(x, y):
    """Correlation over the rows where both are present; null, not an error, when one of them is constant."""
    spread = F.stddev_pop(F.when(y.isNotNull(), x)) * F.stddev_pop(F.when(x.isNotNull(), y))
    return F.try_divide(F.covar_pop(x, y), spread)


def correlation_matrix(df: DataFrame, target=None, check=True) -> DataFrame:
    """Long (row, col, r): Pearson correlation of the numeric columns but the target.

    Missing, infinite or constant columns are refused, by one aggregate over all columns. Without the check, pairs are
    taken over the rows where both are present.
    """
    names = numeric_columns(df, leave_out=[target] if target else ())
    if not names:
        raise ValueError("no numeric feature columns")
    if check:
        facts = df.agg(*[
            e for i, c in enumerate(names) for e in (
                F.count_if(num(c).isNull() | (F.abs(num(c)) == float("inf"))).alias(f"bad{i}"),
                F.min(num(c)).alias(f"lo{i}"), F.max(num(c)).alias(f"hi{i}"))
        ]).first()
        bad = [c for i, c in enumerate(names) if facts[f"bad{i}"]]
        if bad:
            raise ValueError(f"columns with missing or infinite values: {bad}")
        constant = [c for i, c in enumerate(names) if facts[f"lo{i}"] == facts[f"hi{i}"]]
        if constant:
            raise ValueError(f"constant columns: {constant}")
    if check:
        # No gaps: one pass over vectors of any width.
        vectors = VectorAssembler(inputCols=[f"x{i}" for i in range(len(names))], outputCol="v").transform(
            df.select(*[num(c).alias(f"x{i}") for i, c in enumerate(names)]))
        matrix = Correlation.corr(vectors, "v").first()[0].toArray()
        rows = [(a, b, float(matrix[i, j])) for i, a in enumerate(names) for j, b in enumerate(names)]
        return df.sparkSession.createDataFrame(rows, "row string, col string, r double")
    pairs = [(i, j) for i in range(len(names)) for j in range(i + 1, len(names))]
    wide = df.agg(F.lit(1).alias("one"), *[pearson(num(names[i]), num(names[j])).alias(f"r{i}_{j}") for i, j in pairs])

    def r(i, j):
        return F.lit(1.0) if i == j else F.col(f"r{min(i, j)}_{max(i, j)}")

    return tidy(wide, [
        [("row", F.lit(a)), ("col", F.lit(b)), ("r", r(i, j))]
        for i, a in enumerate(names) for j, b in enumerate(names)
    ])
