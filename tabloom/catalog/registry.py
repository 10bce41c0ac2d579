"""Registration of queries, table access, and the fixtures planted in the driver's tables."""

from pyspark.sql import functions as F

QUERIES, ORACLES = {}, {}


def query(name, sql=None):
    def register(function):
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql
        return function
    return register


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# The driver's tables hold no nulls and no label. These definitions plant both, in Spark and in the SQL alike.
PRICE_N = "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END"
PRIO_N = "CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderpriority END"
ORDER_Y = "CASE WHEN o_totalprice > 300000 OR o_orderkey % 5 = 0 THEN 1 ELSE 0 END"
EVENT_Y = "CASE WHEN event_type = 'error' THEN 1 ELSE 0 END"

FX_ORDERS = f"(SELECT *, {PRICE_N} AS price_n, {PRIO_N} AS prio_n, {ORDER_Y} AS y FROM orders)"
FX_EVENTS = f"(SELECT *, {EVENT_Y} AS y FROM events)"
FX_SCORES = f"""(SELECT o_orderkey, y AS label, score, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS prediction, model,
    CASE WHEN ('0x' || substr(md5('7|' || o_orderkey), 1, 8))::BIGINT / 4294967296.0 < 0.3 THEN 'test' ELSE 'train' END AS split
    FROM (SELECT o_orderkey, {ORDER_Y} AS y, round(o_totalprice / 500000.0, 3) AS score, 'price' AS model FROM orders
          UNION ALL
          SELECT o_orderkey, {ORDER_Y}, round(o_custkey % 1000 / 1000.0, 3)::DOUBLE, 'customer' FROM orders))"""


def fx_orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").withColumns({"price_n": F.expr(PRICE_N), "prio_n": F.expr(PRIO_N), "y": F.expr(ORDER_Y)})


def fx_events(spark, sf_dir):
    return table(spark, sf_dir, "events").withColumn("y", F.expr(EVENT_Y))


def fx_scores(spark, sf_dir):
    """Two scorers' predictions: by price, which carries the label, and by customer, which does not."""
    from tabloom.functions.expressions import hash_share
    orders = table(spark, sf_dir, "orders")
    scored = orders.select(
        "o_orderkey", F.expr(ORDER_Y).alias("label"),
        F.when(hash_share(["o_orderkey"], 7) < 0.3, "test").otherwise("train").alias("split"),
        F.explode(F.array(
            F.struct(F.lit("price").alias("model"), F.round(F.col("o_totalprice") / 500000, 3).alias("score")),
            F.struct(F.lit("customer").alias("model"), F.round((F.col("o_custkey") % 1000) / 1000, 3).alias("score")),
        )).alias("s"))
    return scored.select("o_orderkey", "label", F.col("s.score").alias("score"),
                         (F.col("s.score") >= 0.5).cast("int").alias("prediction"), F.col("s.model").alias("model"), "split")


def fx_docs(spark, sf_dir):
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")


FX_DOCS = "(SELECT d.*, l.quality, l.toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"


def rounded(df, digits=6):
    """Round every double, so that the order of summation does not show; adding 0.0 removes negative zeros."""
    return df.select(*[
        (F.round(F.col(f"`{f.name}`"), digits) + F.lit(0.0)).alias(f.name) if f.dataType.typeName() == "double" else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def r(expression, digits=6):
    """The same rounding in SQL."""
    return f"(round(CAST({expression} AS DOUBLE), {digits}) + CAST(0 AS DOUBLE))"


def union(parts):
    return "\nUNION ALL\n".join(parts)


def share(key, seed):
    return f"(('0x' || substr(md5('{seed}|' || {key}), 1, 8))::BIGINT / 4294967296.0)"
