"""Whole preparation pipelines."""

from pyspark.sql import functions as F

from tabloom.catalog.registry import FX_ORDERS, fx_orders, query, r, rounded, share
from tabloom.operators.sample import split
from tabloom.plans.pipeline import apply_pipeline, fit_pipeline, prepare
from tabloom.session import scratch_path
from tabloom.sources.state import load_state, save_state
from tabloom.streaming.scoring import apply_to_stream, read_stream

COLUMNS = ["o_orderkey", "y", "price_n", "prio_n", "o_orderstatus", "o_orderpriority", "o_totalprice"]

CONFIG = {
    "tag": "orders", "columns": COLUMNS, "target_column": "y", "test_size": 0.3, "random_state": 42, "key_columns": ["o_orderkey"],
    "preprocessing": {
        "steps": ["fill_number", "fill_text", "indicators", "levels", "price_code", "prio_code", "scale"],
        "actions": {
            "fill_number": {"filling_missing_numeric_values_with_stats_method": [{"column": "price_n", "fill_missing_values_method": "median"}]},
            "fill_text": {"filling_missing_text_values": [{"column": "prio_n", "fill_missing_values_method": "placeholder", "placeholder": "none"}]},
            "indicators": {"one_hot_encoding": [{"column": "o_orderstatus", "drop_first": True}]},
            "levels": {"ordinal_encoding": [{"column": "o_orderpriority", "mapping": {
                "1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3, "4-NOT SPECIFIED": 4, "5-LOW": 5}}]},
            "price_code": {"target_encoding": [{"column": "price_n", "type": "continuous", "target_column": "y", "encoding_method": "mean",
                                                "binning_method": "equal_size", "quantiles": 10}]},
            "prio_code": {"woe_encoding": [{"column": "prio_n", "type": "categorical", "target_column": "y"}]},
            "scale": {"scaling": {"scaler_type": "standard", "columns": ["price_n", "o_totalprice", "o_orderpriority"]}},
        },
    },
}


def chain_sql(part):
    """The chain from its definitions: everything is learned on train, ranges and categories on the full data."""
    return f"""WITH base AS (SELECT * FROM {FX_ORDERS}),
    train0 AS (SELECT * FROM base WHERE {share('o_orderkey', 42)} >= 0.3), test0 AS (SELECT * FROM base WHERE {share('o_orderkey', 42)} < 0.3),
    med AS (SELECT quantile_cont(price_n, 0.5) AS m FROM train0), med_full AS (SELECT quantile_cont(price_n, 0.5) AS m FROM base),
    train1 AS (SELECT *, coalesce(price_n, m) AS p, coalesce(prio_n, 'none') AS pr FROM train0, med),
    part1 AS (SELECT *, coalesce(price_n, m) AS p, coalesce(prio_n, 'none') AS pr FROM {part}0, med),
    full1 AS (SELECT coalesce(price_n, m) AS p FROM base, med_full),
    edges AS (SELECT DISTINCT CASE WHEN k = 0 THEN least(edge, lo) WHEN k = 10 THEN greatest(edge, hi) ELSE edge END AS edge FROM
        (SELECT unnest(range(11)) AS k, unnest(quantile_cont(p, [i / 10::DOUBLE for i in range(11)])) AS edge FROM train1), (SELECT min(p) AS lo, max(p) AS hi FROM full1)),
    bins AS (SELECT lo, hi, min(lo) OVER () AS first FROM (SELECT edge AS hi, lag(edge) OVER (ORDER BY edge) AS lo FROM edges) WHERE lo IS NOT NULL),
    codes AS (SELECT hi, avg(y) AS code FROM train1 t JOIN bins ON (p > lo AND p <= hi) OR (p = lo AND lo = first) GROUP BY hi),
    woe AS (SELECT pr, ln((count(*) FILTER (y = 1) + 1) / (SELECT count(*) FROM train1 WHERE y = 1)::DOUBLE / ((count(*) FILTER (y = 0) + 1) / (SELECT count(*) FROM train1 WHERE y = 0)::DOUBLE)) AS w
        FROM train1 GROUP BY pr),
    top AS (SELECT o_orderstatus AS s FROM base GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
    coded AS (SELECT t.*, code, w, substr(o_orderpriority, 1, 1)::DOUBLE AS level FROM part1 t JOIN bins ON (p > lo AND p <= hi) OR (p = lo AND lo = first)
        JOIN codes ON codes.hi = bins.hi JOIN woe ON woe.pr = t.pr),
    train2 AS (SELECT code, o_totalprice, substr(o_orderpriority, 1, 1)::DOUBLE AS level FROM train1 JOIN bins ON (p > lo AND p <= hi) OR (p = lo AND lo = first) JOIN codes ON codes.hi = bins.hi),
    s AS (SELECT avg(code) AS cm, stddev_pop(code) AS cs, avg(o_totalprice) AS tm, stddev_pop(o_totalprice) AS ts, avg(level) AS lm, stddev_pop(level) AS ls FROM train2)
    SELECT o_orderkey, y, {r('(code - cm) / cs')} AS price_n, {r('w')} AS prio_n, {r('(level - lm) / ls')} AS o_orderpriority, {r('(o_totalprice - tm) / ts')} AS o_totalprice,
        CASE WHEN o_orderstatus = v[1] THEN 1 ELSE 0 END AS indicator_1, CASE WHEN o_orderstatus = v[2] THEN 1 ELSE 0 END AS indicator_2
    FROM coded, s, (SELECT list(DISTINCT o_orderstatus ORDER BY o_orderstatus) AS v FROM base, top WHERE o_orderstatus <> top.s)"""


def numbered(df):
    """Give the indicator columns fixed names: which category is dropped depends on the data."""
    indicators = [c for c in df.columns if c.startswith("o_orderstatus_")]
    return rounded(df.withColumnsRenamed({c: f"indicator_{i + 1}" for i, c in enumerate(indicators)}))


def parts(spark, sf_dir):
    data = fx_orders(spark, sf_dir)
    return (data, *split(data, 0.3, ["o_orderkey"], 42))


@query("l01_fit_steps", chain_sql("train"))
def l01(spark, sf_dir):
    data, train, _ = parts(spark, sf_dir)
    return numbered(fit_pipeline(train, CONFIG, data)[0])


@query("l02_apply_steps", chain_sql("test"))
def l02(spark, sf_dir):
    data, train, test = parts(spark, sf_dir)
    return numbered(apply_pipeline(test, CONFIG, fit_pipeline(train, CONFIG, data)[1]))


@query("l02_apply_steps_stream", chain_sql("test"))
def l02_stream(spark, sf_dir):
    """The test part arrives as a stream of files and is prepared with the state learned from the train part."""
    data, train, test = parts(spark, sf_dir)
    _, state = fit_pipeline(train, CONFIG, data)
    arriving, prepared = scratch_path(spark, "arriving"), scratch_path(spark, "prepared")
    test.write.parquet(arriving)
    stream = read_stream(spark, arriving, test.schema)
    apply_to_stream(stream, CONFIG, state, prepared, scratch_path(spark, "stream-log")).awaitTermination()
    return numbered(spark.read.parquet(prepared))


@query("l03_prepare", chain_sql("test"))
def l03(spark, sf_dir):
    done = prepare(spark, CONFIG, fx_orders(spark, sf_dir), output=scratch_path(spark, "prepared"))
    return numbered(done["test"])


@query("s03_state_roundtrip", chain_sql("test"))
def s03(spark, sf_dir):
    data, train, test = parts(spark, sf_dir)
    _, state = fit_pipeline(train, CONFIG, data)
    back = load_state(spark, save_state(spark, state, scratch_path(spark, "state")))
    return numbered(apply_pipeline(test, CONFIG, back))


def flagship(spark, sf_dir):
    done = prepare(spark, CONFIG, fx_orders(spark, sf_dir), check=True)
    both = done["train"].withColumn("part", F.lit("train")).unionByName(done["test"].withColumn("part", F.lit("test")))
    return both
