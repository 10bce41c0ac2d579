"""Missing values, outliers, scalar transforms and scaling."""

from tabloom.catalog.registry import FX_EVENTS, FX_ORDERS, fx_events, fx_orders, query, r, rounded, share
from tabloom.operators.fill import FillNumeric, FillText, FillZero
from tabloom.operators.outliers import RemoveOutliers, ReplaceOutliers
from tabloom.operators.sample import split
from tabloom.operators.transform import Scale, Transform


def fitted(step, df, rule):
    return step.fit_apply(df, {step.kind: rule})[0]


def replayed(step, df, rule, key):
    """Fit on the hash split's train part, apply to its test part."""
    train, test = split(df, 0.3, [key], 42)
    action = {step.kind: rule}
    return step.apply(test, action, step.fit(train, action))


TRAIN_ORDERS = f"(SELECT * FROM {FX_ORDERS} WHERE {share('o_orderkey', 42)} >= 0.3)"
TEST_ORDERS = f"(SELECT * FROM {FX_ORDERS} WHERE {share('o_orderkey', 42)} < 0.3)"
TRAIN_EVENTS = f"(SELECT * FROM {FX_EVENTS} WHERE {share('event_id', 42)} >= 0.3)"
TEST_EVENTS = f"(SELECT * FROM {FX_EVENTS} WHERE {share('event_id', 42)} < 0.3)"


@query("f01_fill_zero", f"SELECT o_orderkey, coalesce(price_n, 0) AS price_n FROM {FX_ORDERS}")
def f01(spark, sf_dir):
    return fitted(FillZero(), fx_orders(spark, sf_dir), ["price_n"]).select("o_orderkey", "price_n")


def numeric_mode(source):
    return f"(SELECT price_n FROM {source} WHERE price_n IS NOT NULL GROUP BY price_n ORDER BY count(*) DESC, price_n LIMIT 1)"


def text_mode(source):
    return f"(SELECT prio_n FROM {source} WHERE prio_n IS NOT NULL GROUP BY prio_n ORDER BY count(*) DESC, prio_n LIMIT 1)"


FILLS = {"f02_fill_mode": ("mode", numeric_mode(FX_ORDERS)),
         "f03_fill_median": ("median", f"(SELECT quantile_cont(price_n, 0.5) FROM {FX_ORDERS})"),
         "f04_fill_mean": ("mean", f"(SELECT avg(price_n) FROM {FX_ORDERS})")}


def register_fill(name, method, value):
    @query(name, f"SELECT o_orderkey, {r(f'coalesce(price_n, {value})', 4)} AS price_n FROM {FX_ORDERS}")
    def fill(spark, sf_dir):
        done = fitted(FillNumeric(), fx_orders(spark, sf_dir), [{"column": "price_n", "fill_missing_values_method": method}])
        return rounded(done.select("o_orderkey", "price_n"), 4)


for _name, (_method, _value) in FILLS.items():
    register_fill(_name, _method, _value)


@query("f05_fill_numeric_apply", f"""SELECT o_orderkey, {r(f"coalesce(price_n, (SELECT quantile_cont(price_n, 0.5) FROM {TRAIN_ORDERS}))", 4)} AS price_n
    FROM {TEST_ORDERS}""")
def f05(spark, sf_dir):
    done = replayed(FillNumeric(), fx_orders(spark, sf_dir), [{"column": "price_n", "fill_missing_values_method": "median"}], "o_orderkey")
    return rounded(done.select("o_orderkey", "price_n"), 4)


@query("f06_fill_text_mode", f"SELECT o_orderkey, coalesce(prio_n, {text_mode(FX_ORDERS)}) AS prio_n FROM {FX_ORDERS}")
def f06(spark, sf_dir):
    return fitted(FillText(), fx_orders(spark, sf_dir), [{"column": "prio_n", "fill_missing_values_method": "mode"}]).select("o_orderkey", "prio_n")


@query("f07_fill_text_placeholder", f"SELECT o_orderkey, coalesce(prio_n, 'unknown') AS prio_n FROM {FX_ORDERS}")
def f07(spark, sf_dir):
    rule = [{"column": "prio_n", "fill_missing_values_method": "placeholder", "placeholder": "unknown"}]
    return fitted(FillText(), fx_orders(spark, sf_dir), rule).select("o_orderkey", "prio_n")


@query("f08_fill_text_apply", f"SELECT o_orderkey, coalesce(prio_n, {text_mode(TRAIN_ORDERS)}) AS prio_n FROM {TEST_ORDERS}")
def f08(spark, sf_dir):
    rule = [{"column": "prio_n", "fill_missing_values_method": "mode"}]
    return replayed(FillText(), fx_orders(spark, sf_dir), rule, "o_orderkey").select("o_orderkey", "prio_n")


def z_bounds(source, t="3"):
    return f"(SELECT avg(value) - {t} * stddev_samp(value) AS lo, avg(value) + {t} * stddev_samp(value) AS hi FROM {source})"


def fence_bounds(source, k):
    return (f"(SELECT q1 - {k}::DOUBLE * (q3 - q1) AS lo, q3 + {k}::DOUBLE * (q3 - q1) AS hi FROM "
            f"(SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM {source}))")


REMOVALS = {"o01_remove_z_score": ({"search_method": "z_score"}, z_bounds("events")),
            "o02_remove_iqr": ({"search_method": "iqr"}, fence_bounds("events", "1.5")),
            "o03_remove_tukey": ({"search_method": "tukey_fences"}, fence_bounds("events", "3"))}


def register_removal(name, rule, bounds):
    @query(name, f"SELECT event_id, value FROM events, {bounds} WHERE value > lo AND value < hi")
    def remove(spark, sf_dir):
        return fitted(RemoveOutliers(), fx_events(spark, sf_dir), [{"column": "value", **rule}]).select("event_id", "value")


for _name, (_rule, _bounds) in REMOVALS.items():
    register_removal(_name, _rule, _bounds)


@query("o04_remove_apply", f"SELECT event_id, value FROM {TEST_EVENTS}, {fence_bounds(TRAIN_EVENTS, '1.5')} WHERE value > lo AND value < hi")
def o04(spark, sf_dir):
    return replayed(RemoveOutliers(), fx_events(spark, sf_dir), [{"column": "value", "search_method": "iqr"}], "event_id").select("event_id", "value")


@query("o04_remove_in_sequence", f"""WITH kept AS (SELECT event_id, user_id, value FROM events, {fence_bounds('events', '1.5')} WHERE value > lo AND value < hi)
    SELECT event_id, value FROM kept, (SELECT avg(user_id) AS m, stddev_samp(user_id) AS s FROM kept) WHERE abs((user_id - m) / s) < 1.5""")
def o04_sequence(spark, sf_dir):
    rules = [{"column": "value", "search_method": "iqr"}, {"column": "user_id", "search_method": "z_score", "threshold": 1.5}]
    return fitted(RemoveOutliers(), fx_events(spark, sf_dir), rules).select("event_id", "value")


MODE = "(SELECT value FROM events GROUP BY value ORDER BY count(*) DESC, value LIMIT 1)"
REPLACEMENTS = {
    "o05_replace_z_score": ("z_score", "mean", "avg(value)"),
    "o05_replace_tukey": ("tukey_fences", "mean", "avg(value)"),
    "o06_replace_mean": ("iqr", "mean", "avg(value)"),
    "o06_replace_median": ("iqr", "median", "quantile_cont(value, 0.5)"),
    "o07_replace_mode": ("iqr", "mode", MODE),
    "o08_replace_quantile_25": ("iqr", "quantile_25", "quantile_cont(value, 0.25)"),
    "o08_replace_quantile_75": ("iqr", "quantile_75", "quantile_cont(value, 0.75)"),
    "o09_replace_lower_bound": ("iqr", "lower_bound", "lo"),
    "o09_replace_upper_bound": ("iqr", "upper_bound", "hi"),
}


def register_replacement(name, search, how, value):
    bounds = {"z_score": z_bounds("events"), "iqr": fence_bounds("events", "1.5"), "tukey_fences": fence_bounds("events", "3")}[search]
    scalar = value if value in ("lo", "hi") else f"(SELECT {value} FROM events LIMIT 1)" if value == MODE else f"(SELECT {value} FROM events)"

    @query(name, f"SELECT event_id, {r(f'CASE WHEN value < lo OR value > hi THEN {scalar} ELSE value END', 4)} AS value FROM events, {bounds}")
    def replace(spark, sf_dir):
        rule = [{"column": "value", "search_method": search, "replacement_method": how}]
        return rounded(fitted(ReplaceOutliers(), fx_events(spark, sf_dir), rule).select("event_id", "value"), 4)


for _name, (_search, _how, _value) in REPLACEMENTS.items():
    register_replacement(_name, _search, _how, _value)


@query("o09_replace_clip", f"SELECT event_id, {r('greatest(least(value, hi), lo)', 4)} AS value FROM events, {fence_bounds('events', '1.5')}")
def o09_clip(spark, sf_dir):
    rule = [{"column": "value", "search_method": "iqr", "replacement_method": "clip"}]
    return rounded(fitted(ReplaceOutliers(), fx_events(spark, sf_dir), rule).select("event_id", "value"), 4)


@query("o10_replace_apply", f"""SELECT event_id, {r(f"CASE WHEN value < lo OR value > hi THEN (SELECT quantile_cont(value, 0.5) FROM {TRAIN_EVENTS}) ELSE value END", 4)} AS value
    FROM {TEST_EVENTS}, {fence_bounds(TRAIN_EVENTS, '1.5')}""")
def o10(spark, sf_dir):
    rule = [{"column": "value", "search_method": "iqr", "replacement_method": "median"}]
    return rounded(replayed(ReplaceOutliers(), fx_events(spark, sf_dir), rule, "event_id").select("event_id", "value"), 4)


CENTERED = "(SELECT c_custkey, c_acctbal AS x FROM customer)"


def customers(spark, sf_dir):
    from tabloom.catalog.registry import table
    return table(spark, sf_dir, "customer").selectExpr("c_custkey", "c_acctbal AS x")


TRANSFORMS = {"t01_transform_log": ({"transformation_method": "log"}, "CASE WHEN x > -1 THEN ln(x + 1) END"),
              "t02_transform_sqrt": ({"transformation_method": "sqrt"}, "CASE WHEN x >= 0 THEN sqrt(x) END"),
              "t03_transform_power": ({"transformation_method": "power", "power": 1.5}, "CASE WHEN x >= 0 THEN pow(x, 1.5::DOUBLE) END")}


def register_transform(name, rule, expression):
    @query(name, f"SELECT c_custkey, {r(expression, 5)} AS x FROM {CENTERED}")
    def transform(spark, sf_dir):
        return rounded(fitted(Transform(), customers(spark, sf_dir), [{"column": "x", **rule}]), 5)


for _name, (_rule, _expression) in TRANSFORMS.items():
    register_transform(_name, _rule, _expression)


@query("t04_transform_apply", f"SELECT event_id, {r('ln(value + 1)')} AS value, {r('sqrt(user_id)')} AS user_id FROM {TEST_EVENTS}")
def t04(spark, sf_dir):
    rules = [{"column": "value", "transformation_method": "log"}, {"column": "user_id", "transformation_method": "sqrt"}]
    return rounded(replayed(Transform(), fx_events(spark, sf_dir), rules, "event_id").select("event_id", "value", "user_id"))


SCALED = ["l_quantity", "l_extendedprice", "l_discount"]
KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
SCALERS = {"t05_scale_standard": ("standard", "avg({c})", "stddev_pop({c})"),
           "t06_scale_robust": ("robust", "quantile_cont({c}, 0.5)", "quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)"),
           "t07_scale_minmax": ("minmax", "min({c})", "max({c}) - min({c})"),
           "t08_scale_none": ("none", "0", "1")}


def scale_sql(source, stats_source, columns, key, center, spread):
    stats = ", ".join(f"{center.format(c=c)} AS m_{c}, coalesce(nullif({spread.format(c=c)}, 0), 1) AS s_{c}" for c in columns)
    out = ", ".join(f"{r(f'({c} - m_{c}) / s_{c}')} AS {c}" for c in columns)
    return f"SELECT {', '.join(key)}, {out} FROM {source}, (SELECT {stats} FROM {stats_source})"


def register_scaler(name, how, center, spread):
    from tabloom.catalog.registry import table
    stats_source = "lineitem" if how != "none" else "(SELECT 1)"

    @query(name, scale_sql("lineitem", stats_source, SCALED, KEY, center, spread))
    def scale(spark, sf_dir):
        rows = table(spark, sf_dir, "lineitem").select(*KEY, *SCALED)
        return rounded(fitted(Scale(), rows, {"scaler_type": how, "columns": SCALED}))


for _name, _spec in SCALERS.items():
    register_scaler(_name, *_spec)


@query("t07_scale_constant", "SELECT o_orderkey, 0.0::DOUBLE AS one_value, CAST(NULL AS DOUBLE) AS all_null FROM orders")
def t07_constant(spark, sf_dir):
    from tabloom.catalog.profiling import fx_const
    rows = fx_const(spark, sf_dir).select("o_orderkey", "one_value", "all_null")
    return fitted(Scale(), rows, {"scaler_type": "standard", "columns": ["one_value", "all_null"]})


@query("t09_scale_apply", scale_sql(TEST_EVENTS, TRAIN_EVENTS, ["value", "user_id"], ["event_id"], "quantile_cont({c}, 0.5)",
                                    "quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)"))
def t09(spark, sf_dir):
    rule = {"scaler_type": "robust", "columns": ["value", "user_id"]}
    return rounded(replayed(Scale(), fx_events(spark, sf_dir), rule, "event_id").select("event_id", "value", "user_id"))
