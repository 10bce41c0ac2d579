"""Profile, validation, and tables in and out."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.catalog.registry import FX_ORDERS, fx_orders, query, r, rounded, share, table, union
from tabloom.operators import profile as P
from tabloom.operators import validate as V
from tabloom.operators.sample import split
from tabloom.session import scratch_path
from tabloom.sources.tables import read_table, write_split, write_table

LINE_NUMBERS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
EVENT_NUMBERS = ["event_id", "user_id", "value"]
EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]
ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority", "price_n", "prio_n", "y"]

TEXT_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType()), T.StructField("o_orderstatus", T.StringType()),
    T.StructField("price_n", T.DoubleType()), T.StructField("prio_n", T.StringType()), T.StructField("y", T.IntegerType()),
])


def orders_as_text(spark, sf_dir, delimiter):
    path = scratch_path(spark, "text") + ".csv"
    text = fx_orders(spark, sf_dir).select(
        "o_orderkey", "o_orderstatus", F.coalesce(F.col("price_n").cast("string"), F.lit("NA")).alias("price_n"),
        F.coalesce("prio_n", F.lit("null")).alias("prio_n"), "y")
    return write_table(text, path, delimiter)


@query("s01_read_table", f"SELECT o_orderkey, o_orderstatus, price_n, prio_n, y FROM {FX_ORDERS}")
def s01(spark, sf_dir):
    return read_table(spark, orders_as_text(spark, sf_dir, ";"), ";", TEXT_SCHEMA)


@query("s01_read_table_inferred", f"SELECT o_orderkey, o_orderstatus, price_n, prio_n, CAST(y AS BIGINT) AS y FROM {FX_ORDERS}")
def s01_inferred(spark, sf_dir):
    return read_table(spark, orders_as_text(spark, sf_dir, ","))


@query("s02_write_table", f"""SELECT format, part, count(*) AS n, {r('sum(o_totalprice)', 2)} AS total
    FROM (SELECT o_totalprice, CASE WHEN {share('o_orderkey', 42)} < 0.3 THEN 'test' ELSE 'train' END AS part FROM orders),
         (SELECT unnest(['csv', 'parquet']) AS format) GROUP BY format, part""")
def s02(spark, sf_dir):
    train, test = split(table(spark, sf_dir, "orders"), 0.3, ["o_orderkey"], 42)
    parts = []
    for file_format in ("csv", "parquet"):
        paths = write_split(train, test, scratch_path(spark, "split"), "orders", file_format)
        for part, path in paths.items():
            back = read_table(spark, path, schema=train.schema).select(
                F.lit(file_format).alias("format"), F.lit(part).alias("part"), "o_totalprice")
            parts.append(back)
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    return rounded(whole.groupBy("format", "part").agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total")), 2)


@query("v01_keep_columns", "SELECT o_totalprice, o_orderkey, o_orderpriority FROM orders")
def v01(spark, sf_dir):
    return V.keep_columns(fx_orders(spark, sf_dir), ["y", "o_totalprice", "o_orderkey", "o_orderpriority"], "y", expect_target=False)


@query("v02_order_columns", """SELECT o_totalprice, o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS "o_orderstatus_F",
    CAST(NULL AS INTEGER) AS "o_orderstatus_X" FROM orders""")
def v02(spark, sf_dir):
    state = {"o_orderstatus": {"values": ["F", "O", "X"], "dropped": "O"}}
    coded = table(spark, sf_dir, "orders").withColumn("o_orderstatus_F", (F.col("o_orderstatus") == "F").cast("int"))
    return V.order_columns(coded, ["o_totalprice", "o_orderstatus", "o_orderkey"], state)


@query("v03_cast_numeric", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def v03(spark, sf_dir):
    text = table(spark, sf_dir, "orders").select(*[F.col(c).cast("string").alias(c) for c in ("o_orderkey", "o_custkey", "o_totalprice")])
    return V.cast_numeric(text, {"o_orderkey": "int", "o_custkey": "int", "o_totalprice": "float"})


@query("v03_cast_numeric_lenient", """SELECT o_orderkey, TRY_CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS level,
    TRY_CAST(o_orderstatus AS DOUBLE) AS status FROM orders""")
def v03_lenient(spark, sf_dir):
    text = table(spark, sf_dir, "orders").select("o_orderkey", F.substring("o_orderpriority", 1, 1).alias("level"), F.col("o_orderstatus").alias("status"))
    return V.cast_numeric(text, {"level": "int", "status": "float"}, lenient=True)


@query("v04_split_features_label", f"""SELECT y, count(*) AS n, CAST(5 AS BIGINT) AS n_features FROM {FX_ORDERS} GROUP BY y""")
def v04(spark, sf_dir):
    data = fx_orders(spark, sf_dir).select("o_orderkey", "o_custkey", "o_orderstatus", "price_n", "prio_n", "y")
    features, label = V.split_features_label(data, "y")
    return label.groupBy("y").agg(F.count(F.lit(1)).alias("n"), F.lit(len(features.columns)).cast("bigint").alias("n_features"))


@query("v04_features", f"SELECT o_orderkey, o_custkey, o_orderstatus, price_n, prio_n FROM {FX_ORDERS}")
def v04_features(spark, sf_dir):
    data = fx_orders(spark, sf_dir).select("o_orderkey", "o_custkey", "o_orderstatus", "price_n", "prio_n", "y")
    return V.split_features_label(data, "y")[0]


@query("v05_missing_and_non_numeric", union(
    f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS n_missing, {str(c in ('o_orderkey', 'o_custkey', 'o_totalprice', 'price_n', 'y')).lower()} AS is_numeric FROM {FX_ORDERS}"
    for c in ORDER_COLUMNS))
def v05(spark, sf_dir):
    return V.missing_and_non_numeric(fx_orders(spark, sf_dir))


@query("v07_class_ratio", """SELECT max(n) AS n_majority, min(n) AS n_minority, round(max(n) * 1.0::DOUBLE / min(n), 6) AS ratio
    FROM (SELECT count(*) AS n FROM events GROUP BY event_type = 'error')""")
def v07(spark, sf_dir):
    from tabloom.catalog.registry import fx_events
    return rounded(V.class_ratio(fx_events(spark, sf_dir), "y"))


FX_CONST = f"(SELECT *, 7.5::DOUBLE AS one_value, CAST(NULL AS DOUBLE) AS all_null, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE 1 END AS one_or_null FROM orders)"
CONST_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority", "one_value", "all_null", "one_or_null"]


def fx_const(spark, sf_dir):
    return table(spark, sf_dir, "orders").withColumns({
        "one_value": F.lit(7.5), "all_null": F.lit(None).cast("double"),
        "one_or_null": F.expr("CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE 1 END")})


@query("v08_constant_columns", union(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) = 1 AS is_constant FROM {FX_CONST}"
    for c in CONST_COLUMNS))
def v08(spark, sf_dir):
    return V.constant_columns(fx_const(spark, sf_dir))


@query("v09_non_finite", union(
    f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL OR isnan({c}::DOUBLE) OR isinf({c}::DOUBLE)) AS n_non_finite FROM {FX_CONST}"
    for c in ("o_orderkey", "o_custkey", "o_totalprice", "one_value", "all_null", "one_or_null")))
def v09(spark, sf_dir):
    return V.non_finite(fx_const(spark, sf_dir))


FX_DUP = "(SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderkey % 10 = 0)"


@query("p01_table_shape", f"""SELECT CAST(6 AS BIGINT) AS n_columns, CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(n - 1) AS BIGINT) AS n_duplicates,
    {r('sum(n - 1) * 100.0 / sum(n)')} AS duplicate_pct
    FROM (SELECT count(*) AS n FROM {FX_DUP} GROUP BY o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority)""")
def p01(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return rounded(P.table_shape(orders.unionByName(orders.filter("o_orderkey % 10 = 0"))))


def per_number(select, columns, source):
    return union(f"SELECT '{c}' AS \"column\", {select.replace('@', c)} FROM {source}" for c in columns)


SUMMARY = (f"count(@) AS n, min(@)::DOUBLE AS min, max(@)::DOUBLE AS max, {r('max(@) - min(@)')} AS range, {r('avg(@)', 4)} AS mean, "
           f"{r('quantile_cont(@, 0.5)', 4)} AS median, {r('quantile_cont(@, 0.25)', 4)} AS q1, {r('quantile_cont(@, 0.75)', 4)} AS q3, {r('stddev_samp(@)', 4)} AS std")


@query("p02_numeric_summary", per_number(SUMMARY, LINE_NUMBERS, "lineitem"))
def p02(spark, sf_dir):
    return rounded(P.numeric_summary(table(spark, sf_dir, "lineitem")), 4).withColumn("range", F.round("range", 6))


@query("p02_numeric_summary_approx")
def p02_approx(spark, sf_dir):
    return P.numeric_summary(table(spark, sf_dir, "lineitem"), approx=True)


DISPERSION = (f"{r('stddev_pop(@)', 4)} AS rmsd, {r('stddev_samp(@) / avg(@)', 4)} AS variation, "
              f"{r('kurtosis(@)', 4)} AS kurtosis, {r('skewness(@)', 4)} AS skewness")


@query("p03_dispersion_shape", per_number(DISPERSION, EVENT_NUMBERS, "events"))
def p03(spark, sf_dir):
    return rounded(P.dispersion_shape(table(spark, sf_dir, "events")), 4)


@query("p04_zscore_outlier_counts", union(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (abs(({c} - m) / s) > 3) AS n_outliers FROM events, (SELECT avg({c}) AS m, stddev_samp({c}) AS s FROM events)"
    for c in EVENT_NUMBERS))
def p04(spark, sf_dir):
    return P.zscore_outlier_counts(table(spark, sf_dir, "events"))


def fence_sql(k):
    return union(
        f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} < q1 - {k} * (q3 - q1) OR {c} > q3 + {k} * (q3 - q1)) AS n_outliers, "
        f"count(*) FILTER ({c} < q1 - {k} * (q3 - q1)) AS n_below, count(*) FILTER ({c} > q3 + {k} * (q3 - q1)) AS n_above "
        f"FROM events, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM events)"
        for c in EVENT_NUMBERS)


@query("p05_iqr_outlier_counts", fence_sql("1.5::DOUBLE"))
def p05(spark, sf_dir):
    return P.fence_outlier_counts(table(spark, sf_dir, "events"))


@query("p06_tukey_outlier_counts", fence_sql("3.0::DOUBLE"))
def p06(spark, sf_dir):
    return P.fence_outlier_counts(table(spark, sf_dir, "events"), k=3.0)


@query("p07_missing_profile", union(
    f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS n_missing, {r(f'(count(*) - count({c})) * 100.0 / count(*)')} AS missing_pct FROM {FX_ORDERS}"
    for c in ORDER_COLUMNS))
def p07(spark, sf_dir):
    return rounded(P.missing_profile(fx_orders(spark, sf_dir)))


@query("p08_zero_negative_profile", per_number(
    f"count(*) FILTER (@ = 0) AS n_zero, {r('count(*) FILTER (@ = 0) * 100.0 / count(*)')} AS zero_pct, "
    f"count(*) FILTER (@ < 0) AS n_negative, {r('count(*) FILTER (@ < 0) * 100.0 / count(*)')} AS negative_pct",
    ["c_custkey", "c_nationkey", "c_acctbal"], "customer"))
def p08(spark, sf_dir):
    return rounded(P.zero_negative_profile(table(spark, sf_dir, "customer")))


LINE_COLUMNS = LINE_NUMBERS + ["l_returnflag", "l_linestatus"]


@query("p09_mode", union(
    f"(SELECT '{c}' AS \"column\", {f'{c}::DOUBLE' if c in LINE_NUMBERS else 'CAST(NULL AS DOUBLE)'} AS mode_num, "
    f"{'CAST(NULL AS VARCHAR)' if c in LINE_NUMBERS else c} AS mode_str, count(*) AS n FROM lineitem WHERE {c} IS NOT NULL "
    f"GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)" for c in LINE_COLUMNS))
def p09(spark, sf_dir):
    return P.mode(table(spark, sf_dir, "lineitem"), LINE_COLUMNS)


@query("p10_distinct_count", union(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS n_distinct FROM {FX_ORDERS}"
    for c in ORDER_COLUMNS))
def p10(spark, sf_dir):
    return P.distinct_count(fx_orders(spark, sf_dir))


@query("p10_distinct_count_approx")
def p10_approx(spark, sf_dir):
    return P.distinct_count(fx_orders(spark, sf_dir), approx=True)


SHORT = ["o_orderstatus", "o_orderpriority", "prio_n", "y"]


@query("p11_value_distribution", union(
    f"SELECT '{c}' AS \"column\", {'y::DOUBLE' if c == 'y' else 'CAST(NULL AS DOUBLE)'} AS v_num, {'CAST(NULL AS VARCHAR)' if c == 'y' else c} AS v_str, "
    f"count(*) AS n, {r('count(*) * 100.0 / (SELECT count(*) FROM orders)')} AS pct FROM {FX_ORDERS} GROUP BY {c}" for c in SHORT))
def p11(spark, sf_dir):
    return rounded(P.value_distribution(fx_orders(spark, sf_dir)))


@query("p12_example_value", union(
    f"SELECT '{c}' AS \"column\", {f'min({c})::DOUBLE' if c in EVENT_NUMBERS else 'CAST(NULL AS DOUBLE)'} AS lo_num, "
    f"{'CAST(NULL AS VARCHAR)' if c in EVENT_NUMBERS else f'min({c})'} AS lo_str FROM events" for c in ("event_id", "user_id", "value", "props")) + """ UNION ALL
    SELECT 'ts', CAST(NULL AS DOUBLE), CAST(min(ts) AS VARCHAR) FROM events""")
def p12(spark, sf_dir):
    return P.example_value(table(spark, sf_dir, "events"))


def profile_sql():
    parts = []
    for c, numeric in (("event_id", True), ("user_id", True), ("event_type", False), ("value", True), ("props", False), ("ts", False)):
        mode = f"(SELECT {c if numeric else f'CAST({c} AS VARCHAR)'} FROM events GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"
        none = "CAST(NULL AS DOUBLE)"

        def number(x, digits=4):
            return r(x, digits) if numeric else none

        def whole(x):
            return f"count(*) FILTER ({x})" if numeric else "CAST(NULL AS BIGINT)"

        q = f"(SELECT avg({c}) AS m, stddev_samp({c}) AS s, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM events)" if numeric else "(SELECT 1 AS m)"
        kind = {"event_id": "bigint", "user_id": "bigint", "value": "double", "ts": "timestamp_ntz"}.get(c, "string")
        parts.append(f"""SELECT '{c}' AS "column", '{kind}' AS type, count(DISTINCT {c}) AS n_distinct, count(*) - count({c}) AS n_missing,
            {r(f'(count(*) - count({c})) * 100.0 / count(*)', 4)} AS missing_pct,
            {f'{mode}::DOUBLE' if numeric else none} AS mode_num, {'CAST(NULL AS VARCHAR)' if numeric else mode} AS mode_str,
            {whole(f'{c} = 0')} AS n_zero, {number(f'count(*) FILTER ({c} = 0) * 100.0 / count(*)') if numeric else none} AS zero_pct,
            {whole(f'{c} < 0')} AS n_negative, {number(f'count(*) FILTER ({c} < 0) * 100.0 / count(*)') if numeric else none} AS negative_pct,
            {number(f'min({c})')} AS min, {number(f'max({c})')} AS max, {number(f'max({c}) - min({c})')} AS range, {number(f'avg({c})')} AS mean,
            {number(f'quantile_cont({c}, 0.5)')} AS median, {number(f'quantile_cont({c}, 0.25)')} AS q1, {number(f'quantile_cont({c}, 0.75)')} AS q3,
            {number(f'stddev_samp({c})')} AS std, {number(f'stddev_pop({c})')} AS rmsd, {number(f'stddev_samp({c}) / avg({c})')} AS variation,
            {number(f'kurtosis({c})')} AS kurtosis, {number(f'skewness({c})')} AS skewness,
            {whole(f'abs(({c} - m) / s) > 3')} AS z_outliers,
            {whole(f'{c} < q1 - 1.5::DOUBLE * (q3 - q1) OR {c} > q3 + 1.5::DOUBLE * (q3 - q1)')} AS iqr_outliers,
            {whole(f'{c} < q1 - 1.5::DOUBLE * (q3 - q1)')} AS iqr_below, {whole(f'{c} > q3 + 1.5::DOUBLE * (q3 - q1)')} AS iqr_above,
            {whole(f'{c} < q1 - 3.0::DOUBLE * (q3 - q1) OR {c} > q3 + 3.0::DOUBLE * (q3 - q1)')} AS tukey_outliers,
            {whole(f'{c} < q1 - 3.0::DOUBLE * (q3 - q1)')} AS tukey_below, {whole(f'{c} > q3 + 3.0::DOUBLE * (q3 - q1)')} AS tukey_above,
            {f'min({c})::DOUBLE' if numeric else none} AS example_num,
            {'CAST(NULL AS VARCHAR)' if numeric or c == 'event_type' else f'CAST(min({c}) AS VARCHAR)'} AS example_str,
            CAST({'5' if c == 'event_type' else 'NULL'} AS INTEGER) AS n_listed
            FROM events, {q}""")
    return union(parts)


@query("p14_profile", profile_sql())
def p14(spark, sf_dir):
    _, columns = P.profile(table(spark, sf_dir, "events"))
    return rounded(columns.withColumn("n_listed", F.expr("size(distribution)")).drop("distribution"), 4)


@query("p14_profile_shape", """SELECT CAST(6 AS BIGINT) AS n_columns, count(*) AS n_rows, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM events)) AS n_duplicates,
    round((count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM events))) * 100.0::DOUBLE / count(*), 6) AS duplicate_pct FROM events""")
def p14_shape(spark, sf_dir):
    return rounded(P.profile(table(spark, sf_dir, "events"))[0])


@query("p14_profile_distribution", f"""SELECT 'event_type' AS "column", CAST(NULL AS DOUBLE) AS v_num, event_type AS v_str, count(*) AS n,
    {r('count(*) * 100.0 / (SELECT count(*) FROM events)')} AS pct FROM events GROUP BY event_type""")
def p14_distribution(spark, sf_dir):
    _, columns = P.profile(table(spark, sf_dir, "events"))
    return rounded(columns.select("column", F.explode("distribution").alias("d")).select("column", "d.*"))


# Whole numbers beyond 2^53, where neighbours are the same double.
LARGE = "(SELECT 9007199254740993 + o_orderkey AS id, 9007199254740993 + o_custkey % 5 AS code, o_custkey - 9007199254740993 AS below FROM orders)"


def large(spark, sf_dir):
    start = F.lit(9007199254740993)
    return table(spark, sf_dir, "orders").select((start + F.col("o_orderkey")).alias("id"), (start + F.col("o_custkey") % 5).alias("code"),
                                                 (F.col("o_custkey") - start).alias("below"))


@query("p02_whole_number_profile", union(
    f"""SELECT '{c}' AS "column", count({c}) AS n, min({c}) AS min, max({c}) AS max, CAST(max({c}) - min({c}) AS VARCHAR) AS range,
    CAST(sum(CAST({c} AS HUGEINT)) AS VARCHAR) AS sum FROM {LARGE}""" for c in ("id", "code", "below")))
def p02_whole(spark, sf_dir):
    found = P.whole_number_profile(large(spark, sf_dir))
    return found.withColumns({c: F.col(c).cast("string") for c in ("range", "sum")})     # decimals as text, which every reader compares exactly


@query("p09_mode_whole", union(
    f"""SELECT * FROM (SELECT '{c}' AS "column", {c} AS mode_long, CAST({c} AS DOUBLE) AS mode_num, CAST(NULL AS VARCHAR) AS mode_str, count(*) AS n
    FROM {LARGE} GROUP BY {c} ORDER BY n DESC, {c} LIMIT 1)""" for c in ("id", "code", "below")))
def p09_whole(spark, sf_dir):
    return P.mode(large(spark, sf_dir), whole=True)


@query("p11_value_distribution_whole", f"""SELECT 'code' AS "column", code AS v_long, CAST(code AS DOUBLE) AS v_num, CAST(NULL AS VARCHAR) AS v_str, count(*) AS n,
    {r('count(*) * 100.0 / (SELECT count(*) FROM orders)')} AS pct FROM {LARGE} GROUP BY code""")
def p11_whole(spark, sf_dir):
    return rounded(P.value_distribution(large(spark, sf_dir), whole=True))


@query("p12_example_value_whole", union(
    f"""SELECT '{c}' AS "column", min({c}) AS lo_long, CAST(min({c}) AS DOUBLE) AS lo_num, CAST(NULL AS VARCHAR) AS lo_str FROM {LARGE}""" for c in ("id", "below")))
def p12_whole(spark, sf_dir):
    return P.example_value(large(spark, sf_dir), whole=True)


@query("p15_correlation_matrix", union(
    f"SELECT '{a}' AS \"row\", '{b}' AS col, {r(f'corr({a}, {b})') if a != b else 'max(1.0::DOUBLE)'} AS r FROM lineitem"
    for a in LINE_NUMBERS[1:] for b in LINE_NUMBERS[1:]))
def p15(spark, sf_dir):
    return rounded(P.correlation_matrix(table(spark, sf_dir, "lineitem"), "l_orderkey"))
