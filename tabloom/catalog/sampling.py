"""Splits, resampling and folds."""

from pyspark.sql import functions as F

from tabloom.catalog.registry import FX_EVENTS, fx_events, query, share, table
from tabloom.operators import sample as S

HASH = "md5('42|' || event_id)"


@query("r01_split", f"SELECT o_orderkey, CASE WHEN {share('o_orderkey', 42)} < 0.3 THEN 'test' ELSE 'train' END AS part FROM orders")
def r01(spark, sf_dir):
    train, test = S.split(table(spark, sf_dir, "orders"), 0.3, ["o_orderkey"], 42)
    return train.select("o_orderkey", F.lit("train").alias("part")).unionByName(test.select("o_orderkey", F.lit("test").alias("part")))


@query("r02_split_exact", """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
    CASE WHEN row_number() OVER (ORDER BY md5('42|' || l_orderkey || '|' || l_partkey || '|' || l_suppkey || '|' || l_linenumber)) <= ceil(count(*) OVER () * 0.3::DOUBLE)
    THEN 'test' ELSE 'train' END AS part FROM lineitem""")
def r02(spark, sf_dir):
    key = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    train, test = S.split_exact(table(spark, sf_dir, "lineitem"), 0.3, key, 42)
    return train.select(*key, F.lit("train").alias("part")).unionByName(test.select(*key, F.lit("test").alias("part")))


@query("r03_oversample", f"""WITH n AS (SELECT count(*) FILTER (y = 1) AS few, count(*) FILTER (y = 0) AS many FROM {FX_EVENTS}),
    ranked AS (SELECT event_id, y, row_number() OVER (PARTITION BY y ORDER BY {HASH}) AS k FROM {FX_EVENTS})
    SELECT event_id, y, CAST(CASE WHEN y = 0 THEN 1 ELSE 1 + (many - few) // few + CASE WHEN k <= (many - few) % few THEN 1 ELSE 0 END END AS BIGINT) AS copies
    FROM ranked, n""")
def r03(spark, sf_dir):
    balanced = S.oversample(fx_events(spark, sf_dir), "y", ["event_id"], 42)
    return balanced.groupBy("event_id", "y").agg(F.count(F.lit(1)).alias("copies"))


@query("r04_undersample", f"""SELECT event_id, y, value FROM (SELECT *, row_number() OVER (PARTITION BY y ORDER BY {HASH}) AS k FROM {FX_EVENTS})
    WHERE k <= (SELECT least(count(*) FILTER (y = 1), count(*) FILTER (y = 0)) FROM {FX_EVENTS})""")
def r04(spark, sf_dir):
    return S.undersample(fx_events(spark, sf_dir), "y", ["event_id"], 42).select("event_id", "y", "value")


@query("r05_stratified_folds", f"""WITH ranked AS (SELECT event_id, y, row_number() OVER (PARTITION BY y ORDER BY {HASH}) AS k, count(*) OVER (PARTITION BY y) AS n FROM {FX_EVENTS})
    SELECT event_id, y, CAST(CASE WHEN k <= n * 1 // 5 THEN 0 WHEN k <= n * 2 // 5 THEN 1 WHEN k <= n * 3 // 5 THEN 2 WHEN k <= n * 4 // 5 THEN 3 ELSE 4 END AS INTEGER) AS fold
    FROM ranked""")
def r05(spark, sf_dir):
    return S.stratified_folds(fx_events(spark, sf_dir), "y", ["event_id"], 5, 42).select("event_id", "y", "fold")
