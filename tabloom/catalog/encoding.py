"""Binning, one-hot, ordinal, target and weight-of-evidence encoding, information value."""

from pyspark.sql import functions as F

from tabloom.catalog.preparation import TEST_EVENTS, TEST_ORDERS, TRAIN_EVENTS, TRAIN_ORDERS, fitted, replayed
from tabloom.catalog.registry import (
    FX_DOCS, FX_EVENTS, FX_ORDERS, fx_docs, fx_events, fx_orders, query, r, rounded, table,
)
from tabloom.operators.binning import apply_bins, bin_columns, bin_count_report, bin_size_table, fit_bins, rare_category_report
from tabloom.operators.encode import OneHot, Ordinal, TargetEncode, WoeEncode, information_value
from tabloom.operators.sample import split

ONE_HOT = [{"column": "o_orderpriority", "drop_first": True}, {"column": "o_orderstatus", "drop_first": False}]


@query("e01_one_hot", "SELECT event_id, " + ", ".join(
    f"CASE WHEN event_type = '{v}' THEN 1 ELSE 0 END AS event_type_{v}" for v in ("click", "error", "purchase", "signup", "view")) + " FROM events")
def e01(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "event_type")
    return fitted(OneHot(), rows, [{"column": "event_type", "drop_first": False}])


PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


@query("e01_one_hot_drop_first", f"""WITH top AS (SELECT prio_n AS d FROM {FX_ORDERS} WHERE prio_n IS NOT NULL GROUP BY prio_n ORDER BY count(*) DESC, prio_n LIMIT 1)
    SELECT o_orderkey, v AS category, CASE WHEN prio_n = v THEN 1 ELSE 0 END AS indicator
    FROM {FX_ORDERS}, (SELECT DISTINCT prio_n AS v FROM {FX_ORDERS} WHERE prio_n IS NOT NULL), top WHERE v <> d""")
def e01_drop(spark, sf_dir):
    rows = fx_orders(spark, sf_dir).select("o_orderkey", "prio_n")
    coded = fitted(OneHot(), rows, [{"column": "prio_n", "drop_first": True}])
    names = [c for c in coded.columns if c != "o_orderkey"]
    return coded.unpivot("o_orderkey", names, "category", "indicator").withColumn("category", F.expr("substring(category, 8)"))


@query("e02_one_hot_apply", """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS "o_orderstatus_F",
    CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS "o_orderstatus_O" FROM orders""")
def e02(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    action = {OneHot.kind: [{"column": "o_orderstatus", "drop_first": False}]}
    learned = OneHot().fit(rows.filter("o_orderstatus <> 'P'"), action)     # 'P' is unseen at fit: all zeros
    return OneHot().apply(rows, action, learned)


@query("e03_ordinal", "SELECT o_orderkey, CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS o_orderpriority FROM orders")
def e03(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    mapping = {p: i + 1 for i, p in enumerate(PRIORITIES)}
    return Ordinal().apply(rows, {Ordinal.kind: [{"column": "o_orderpriority", "mapping": mapping}]})


def interval_sql(key, x, source, edges):
    """Bin numbers from the definition: right-closed intervals between neighbouring edges, the first one closed."""
    return f"""WITH e AS ({edges}), bins AS (SELECT row_number() OVER (ORDER BY hi) - 1 AS b, lo, hi, min(lo) OVER () AS first
        FROM (SELECT edge AS hi, lag(edge) OVER (ORDER BY edge) AS lo FROM (SELECT DISTINCT edge FROM e)) WHERE lo IS NOT NULL)
        SELECT {key}, CAST(b AS INTEGER) AS {x} FROM {source} t LEFT JOIN bins ON (t.{x} > lo AND t.{x} <= hi) OR (t.{x} = lo AND lo = first)"""


@query("e04_bin_manual", "SELECT event_id, CASE WHEN value <= 20 THEN 0 WHEN value <= 50 THEN 1 WHEN value <= 100 THEN 2 ELSE 3 END AS value FROM events")
def e04(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "value")
    return bin_columns(rows, [{"column": "value", "binning_method": "manual", "bins": [0, 20, 50, 100, 1000]}])[0]


@query("e05_bin_equal_width", interval_sql("event_id", "value", "events", """SELECT CASE WHEN i = 8 THEN hi ELSE lo + i * ((hi - lo) / 8) END AS edge
    FROM (SELECT min(value) AS lo, max(value) AS hi FROM events), (SELECT unnest(range(9)) AS i)"""))
def e05(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "value")
    return bin_columns(rows, [{"column": "value", "bins": 8}])[0]


@query("e06_bin_quantile", interval_sql("o_orderkey", "price_n", FX_ORDERS, f"""SELECT unnest(quantile_cont(price_n, [i / 7.0::DOUBLE for i in range(8)])) AS edge FROM {FX_ORDERS}"""))
def e06(spark, sf_dir):
    rows = fx_orders(spark, sf_dir).select("o_orderkey", "price_n")
    return bin_columns(rows, [{"column": "price_n", "binning_method": "equal_size", "quantiles": 7}])[0]


def widened_edges(x, train, full, q):
    return f"""SELECT CASE WHEN k = 0 THEN least(edge, lo) WHEN k = {q} THEN greatest(edge, hi) ELSE edge END AS edge
        FROM (SELECT unnest(range({q + 1})) AS k, unnest(quantile_cont({x}, [i / {q}::DOUBLE for i in range({q + 1})])) AS edge FROM {train}),
             (SELECT min({x}) AS lo, max({x}) AS hi FROM {full})"""


@query("e06_bin_quantile_apply", interval_sql("event_id", "value", TEST_EVENTS, widened_edges("value", TRAIN_EVENTS, FX_EVENTS, 10)))
def e06_apply(spark, sf_dir):
    events = fx_events(spark, sf_dir).select("event_id", "value")
    train, test = split(events, 0.3, ["event_id"], 42)
    return apply_bins(test, fit_bins(train, [{"column": "value", "binning_method": "equal_size", "quantiles": 10}], events))


def max_quantiles_sql(x, source):
    """The search from its definition: every candidate q, its merged edges, its bin counts."""
    return f"""WITH v AS (SELECT {x}::DOUBLE AS x FROM {source} WHERE {x} IS NOT NULL),
        n AS (SELECT count(*) AS n, (SELECT count(*) FROM {source}) AS total, list(x ORDER BY x) AS a FROM v),
        size AS (SELECT n, total, a, greatest(20, CASE WHEN round_even(sqrt(n), 0) < round_even(n * 0.02::DOUBLE, 0) THEN round_even(n * 0.02::DOUBLE, 0)
            WHEN round_even(sqrt(n), 0) > round_even(n * 0.1::DOUBLE, 0) THEN round_even(n * 0.1::DOUBLE, 0) ELSE round_even(sqrt(n), 0) END)::BIGINT AS m FROM n),
        place AS (SELECT q, i, a, (n - 1) * (i / q::DOUBLE) AS p FROM size, (SELECT unnest(range(1, 101)) AS q), (SELECT unnest(range(0, 101)) AS i)
            WHERE q <= total // m AND i <= q),
        edges AS (SELECT DISTINCT q, CASE WHEN a[floor(p)::BIGINT + 1] = a[ceil(p)::BIGINT + 1] THEN a[floor(p)::BIGINT + 1]
            ELSE (floor(p) + 1 - p) * a[floor(p)::BIGINT + 1] + (p - floor(p)) * a[ceil(p)::BIGINT + 1] END AS edge FROM place),
        cum AS (SELECT x, max(c) AS c FROM (SELECT x, count(*) OVER (ORDER BY x) AS c FROM v) GROUP BY x),
        upto AS (SELECT q, edge, coalesce(c, 0) AS c FROM edges ASOF LEFT JOIN cum ON edges.edge >= cum.x),
        bins AS (SELECT q, row_number() OVER (PARTITION BY q ORDER BY edge) AS k, c - lag(c) OVER (PARTITION BY q ORDER BY edge) AS n,
            c AS c FROM upto),
        counts AS (SELECT q, CASE WHEN k = 2 THEN c ELSE n END AS n FROM bins WHERE k > 1),
        good AS (SELECT q FROM counts, size GROUP BY q, m HAVING min(counts.n) >= m)
        SELECT '{x}' AS "column", CAST(coalesce(max(q), 1) AS BIGINT) AS quantiles,
            CAST((SELECT count(*) FROM edges WHERE q = (SELECT max(q) FROM good)) AS BIGINT) AS n_edges FROM good"""


def max_quantiles(df, columns):
    rules = [{"column": c, "binning_method": "equal_size", "quantiles": "max"} for c in columns]
    learned = fit_bins(df, rules)
    return df.sparkSession.createDataFrame(
        [(c, e["quantiles"], len(e["bins"])) for c, e in learned.items()], '"column" string, quantiles bigint, n_edges bigint'.replace('"', "`"))


@query("e07_bin_quantile_max", "\nUNION ALL\n".join(f"({max_quantiles_sql(x, 'lineitem')})" for x in ("l_quantity", "l_discount", "l_linenumber", "l_extendedprice")))
def e07(spark, sf_dir):
    return max_quantiles(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_discount", "l_linenumber", "l_extendedprice"])


@query("e07_bin_quantile_max_nulls", max_quantiles_sql("price_n", FX_ORDERS))
def e07_nulls(spark, sf_dir):
    return max_quantiles(fx_orders(spark, sf_dir), ["price_n"])


def bin_size_sql(x, source):
    return f"""SELECT '{x}' AS "column", n, greatest(20, CASE WHEN root < lo THEN lo WHEN root > hi THEN hi ELSE root END)::BIGINT AS bin_rows,
        lo::BIGINT AS lower_rows, hi::BIGINT AS upper_rows FROM (SELECT n, round_even(sqrt(n), 0) AS root, round_even(n * 0.02::DOUBLE, 0) AS lo,
        round_even(n * 0.1::DOUBLE, 0) AS hi FROM (SELECT count({x}) AS n FROM {source}))"""


@query("e08_bin_size_bounds", f"{bin_size_sql('o_totalprice', FX_ORDERS)} UNION ALL {bin_size_sql('price_n', FX_ORDERS)}")
def e08(spark, sf_dir):
    return bin_size_table(fx_orders(spark, sf_dir), ["o_totalprice", "price_n"])


@query("e09_bin_count_report", """WITH b AS (SELECT CASE WHEN value <= 5 THEN 0 WHEN value <= 50 THEN 1 WHEN value <= 200 THEN 2 ELSE 3 END AS bin, count(*) AS n FROM events GROUP BY 1),
    t AS (SELECT round_even(sum(n) * 0.02::DOUBLE, 0)::BIGINT AS lower_rows, round_even(sum(n) * 0.1::DOUBLE, 0)::BIGINT AS upper_rows FROM b)
    SELECT bin, n, lower_rows, upper_rows FROM b, t WHERE n < lower_rows OR n > upper_rows""")
def e09(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("value")
    binned, _ = bin_columns(rows, [{"column": "value", "binning_method": "manual", "bins": [0, 5, 50, 200, 1000]}], check=False)
    return bin_count_report(binned, "value")


@query("e10_rare_category_report", "SELECT o_custkey AS value, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) < 8")
def e10(spark, sf_dir):
    return rare_category_report(table(spark, sf_dir, "orders"), "o_custkey", 8)


STATS = {
    "e11_target_mean": ("mean", "avg(y)"),
    "e12_target_sum": ("sum", "sum(y)"),
    "e13_target_median": ("median", "quantile_cont(y, 0.5)"),
    "e14_target_quantile_25": ("quantile_25", "quantile_cont(y, 0.25)"),
    "e14_target_quantile_75": ("quantile_75", "quantile_cont(y, 0.75)"),
    "e15_target_count": ("count", "count(y)"),
    "e16_target_smoothed": ("smoothed_target_encoding", "(sum(y) + 1) / (count(y) + 2)::DOUBLE"),
    "e17_target_bayesian": ("bayesian_target_encoding", f"(sum(y) + 5 * (SELECT avg(y) FROM {FX_ORDERS})) / (count(y) + 5)"),
}


def register_target(name, method, value):
    @query(name, f"""SELECT o_orderkey, {r('code')} AS prio_n FROM {FX_ORDERS} t
        LEFT JOIN (SELECT prio_n AS k, {value} AS code FROM {FX_ORDERS} WHERE prio_n IS NOT NULL GROUP BY prio_n) ON t.prio_n = k""")
    def encode(spark, sf_dir):
        rows = fx_orders(spark, sf_dir).select("o_orderkey", "prio_n", "y")
        rule = [{"column": "prio_n", "type": "categorical", "target_column": "y", "encoding_method": method}]
        return rounded(fitted(TargetEncode(), rows, rule).drop("y"))


for _name, _spec in STATS.items():
    register_target(_name, *_spec)


def encoded_bins_sql(key, x, source, edges, train, value):
    """Target statistic per bin of ``train``, looked up for ``source``."""
    on = "(t.{x} > lo AND t.{x} <= hi) OR (t.{x} = lo AND lo = first)".format(x=x)
    return f"""WITH e AS ({edges}), bins AS (SELECT row_number() OVER (ORDER BY hi) - 1 AS b, lo, hi, min(lo) OVER () AS first
        FROM (SELECT edge AS hi, lag(edge) OVER (ORDER BY edge) AS lo FROM (SELECT DISTINCT edge FROM e)) WHERE lo IS NOT NULL),
        codes AS (SELECT b, {value} AS code FROM {train} t JOIN bins ON {on} GROUP BY b)
        SELECT {key}, {r('code')} AS {x} FROM {source} t LEFT JOIN bins ON {on} LEFT JOIN codes ON bins.b = codes.b"""


@query("e18_target_encode_fit", encoded_bins_sql(
    "o_orderkey", "price_n", FX_ORDERS, f"SELECT unnest(quantile_cont(price_n, [i / 10::DOUBLE for i in range(11)])) AS edge FROM {FX_ORDERS}", FX_ORDERS, "avg(y)"))
def e18(spark, sf_dir):
    rows = fx_orders(spark, sf_dir).select("o_orderkey", "price_n", "y")
    rule = [{"column": "price_n", "type": "continuous", "target_column": "y", "encoding_method": "mean", "binning_method": "equal_size", "quantiles": 10}]
    return rounded(fitted(TargetEncode(), rows, rule).drop("y"))


@query("e18_target_encode_high_cardinality", """SELECT l_orderkey, l_linenumber, l_suppkey, code AS l_partkey FROM
    (SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey FROM lineitem) t JOIN (SELECT l_partkey AS k, round((sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) + 1) / (count(*) + 2)::DOUBLE, 6) AS code
    FROM lineitem GROUP BY l_partkey) ON l_partkey = k""")
def e18_large(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "int(l_returnflag = 'R') AS y")
    rule = [{"column": "l_partkey", "type": "categorical", "target_column": "y", "encoding_method": "smoothed_target_encoding"}]
    return rounded(fitted(TargetEncode(), rows, rule).drop("y"))


@query("e19_target_encode_apply", encoded_bins_sql("event_id", "value", TEST_EVENTS, widened_edges("value", TRAIN_EVENTS, FX_EVENTS, 10), TRAIN_EVENTS, "avg(y)"))
def e19(spark, sf_dir):
    events = fx_events(spark, sf_dir).select("event_id", "value", "y")
    train, test = split(events, 0.3, ["event_id"], 42)
    action = {TargetEncode.kind: [{"column": "value", "type": "continuous", "target_column": "y", "encoding_method": "mean", "binning_method": "equal_size", "quantiles": 10}]}
    return rounded(TargetEncode().apply(test, action, TargetEncode().fit(train, action, events)).drop("y"))


def woe_value(source):
    return (f"ln((count(*) FILTER (y = 1) + 1) / (SELECT count(*) FROM {source} WHERE y = 1)::DOUBLE / "
            f"((count(*) FILTER (y = 0) + 1) / (SELECT count(*) FROM {source} WHERE y = 0)::DOUBLE))")


@query("e20_woe_encode", f"""SELECT o_orderkey, {r('code')} AS prio_n FROM {FX_ORDERS} t
    LEFT JOIN (SELECT prio_n AS k, {woe_value(FX_ORDERS)} AS code FROM {FX_ORDERS} WHERE prio_n IS NOT NULL GROUP BY prio_n) ON t.prio_n = k""")
def e20(spark, sf_dir):
    rows = fx_orders(spark, sf_dir).select("o_orderkey", "prio_n", "y")
    return rounded(fitted(WoeEncode(), rows, [{"column": "prio_n", "type": "categorical", "target_column": "y"}]).drop("y"))


@query("e20_woe_encode_continuous", encoded_bins_sql("doc_id", "n_chars", FX_DOCS.replace("l.quality, l.toxic", "l.quality AS y"),
       f"""SELECT CASE WHEN i = 3 THEN hi ELSE lo + i * ((hi - lo) / 3) END AS edge FROM (SELECT min(n_chars)::DOUBLE AS lo, max(n_chars)::DOUBLE AS hi FROM {FX_DOCS}), (SELECT unnest(range(4)) AS i)""",
       FX_DOCS.replace("l.quality, l.toxic", "l.quality AS y"), woe_value(FX_DOCS.replace("l.quality, l.toxic", "l.quality AS y"))))
def e20_continuous(spark, sf_dir):
    rows = fx_docs(spark, sf_dir).select("doc_id", "n_chars", F.col("quality").alias("y"))
    return rounded(fitted(WoeEncode(), rows, [{"column": "n_chars", "type": "continuous", "target_column": "y", "bins": 3}]).drop("y"))


@query("e21_woe_encode_apply", f"""SELECT o_orderkey, {r('code')} AS prio_n FROM {TEST_ORDERS} t
    LEFT JOIN (SELECT prio_n AS k, {woe_value(TRAIN_ORDERS)} AS code FROM {TRAIN_ORDERS} WHERE prio_n IS NOT NULL GROUP BY prio_n) ON t.prio_n = k""")
def e21(spark, sf_dir):
    rows = fx_orders(spark, sf_dir).select("o_orderkey", "prio_n", "y")
    return rounded(replayed(WoeEncode(), rows, [{"column": "prio_n", "type": "categorical", "target_column": "y"}], "o_orderkey").drop("y"))


def iv_sql(x):
    totals = f"(SELECT count(*) FILTER (y = 1)::DOUBLE AS p, count(*) FILTER (y = 0)::DOUBLE AS n FROM {FX_ORDERS})"
    return f"""SELECT '{x}' AS "column", round_even(sum((a - b) * ln(a / b)), 3)::DOUBLE AS iv FROM
        (SELECT (count(*) FILTER (y = 1) + 1) / max(p) AS a, (count(*) FILTER (y = 0) + 1) / max(n) AS b FROM {FX_ORDERS}, {totals} WHERE {x} IS NOT NULL GROUP BY {x})"""


IV_COLUMNS = ("o_orderstatus", "prio_n", "o_custkey")


@query("e22_information_value", f"""SELECT "column", iv, CASE WHEN iv < 0.02 THEN 'not informative' WHEN iv <= 0.1 THEN 'poorly informative'
    WHEN iv > 0.5 THEN 'suspiciously informative' ELSE 'informative' END AS band FROM ({' UNION ALL '.join(iv_sql(c) for c in IV_COLUMNS)})""")
def e22(spark, sf_dir):
    return information_value(fx_orders(spark, sf_dir), list(IV_COLUMNS), "y")
