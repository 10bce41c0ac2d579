"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in shuffled order, then of the same documents once more. A document's virtual
finish time is the number of words its source has sent with it, divided by the source's weight. All documents are sorted by
finish time over the whole cluster, and the sorted list is cut where the total budget is reached. A queue that runs empty
leaves its share to the others by weight, so each source ends near its target.

Inputs of every kind give a defined result: a null or empty text has size 0 and takes nothing; a null source is one source,
the last; a null key shuffles like any other value; rows with equal keys are ordered by size and count as rows of their own;
an empty table gives an empty result. Other columns of the input are not read, whatever their names.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabloom.llm.rows import ROW, column, numbered, partitions
from tabloom.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
BUCKET_DIGITS = 3        # hexadecimal digits of the shuffle key that name a bucket: 4,096 stretches of each queue


def mix_sources(docs: DataFrame, key="doc_id", text="text", source="source", weights=(5.0, 2.0, 1.0), share=1.5,
                most=2, seed="mix") -> DataFrame:
    """One row per document: key, size, source, source_size, target, taken, copies.

    ``weights`` are dealt to the sources by code point and repeat; ``share`` times all words is the budget; no document is
    taken more than ``most`` times. The order of a queue is the md5 of seed and key, so reruns agree on any partitioning.
    """
    spark = docs.sparkSession
    digest = F.md5(F.concat_ws("|", F.lit(seed), column(docs, key).cast("string")))
    sized = numbered(docs, {
        "key": column(docs, key), "source": column(docs, source),
        "size": F.coalesce(F.regexp_count(column(docs, text), F.lit(WORD)), F.lit(0)).cast("long"), "digest": digest}, "sizes")
    sources = source_targets(sized, weights, share, most)
    sized = sized.join(sources, sized["source"].eqNullSafe(sources["source"])).drop(sources["source"])
    queued = materialize(with_finish(sized), "queues")
    copies = queued.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(most - 1)))).select(
        ROW, "size", "rank", "copy", "digest", ((F.col("sent") + F.col("copy") * F.col("source_size")) / F.col("weight")).alias("finish"))
    order = ["finish", "rank", "copy", "digest", "size"]
    ranged = copies.filter("size > 0").repartitionByRange(partitions(spark), *order).withColumn("part", F.spark_partition_id())
    taken = truncate(materialize(ranged, "ranged"), order, F.lit(share), sized)
    taken = taken.groupBy(ROW).agg(F.sum("size").alias("taken"), F.count("*").alias("copies"))
    return queued.join(taken, ROW, "left").select(
        F.col("key").alias(key), "size", F.col("source").alias(source), "source_size", "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), F.coalesce("copies", F.lit(0)).cast("int").alias("copies"), ROW)


def source_targets(sized: DataFrame, weights, share, most) -> DataFrame:
    """source, rank, weight, source_size, target: the budget dealt by weight, with what exceeds ``most`` sizes dealt again.

    Sources are filled in the order in which they run full; the level is the words per weight that the others reach.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = sources.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    ranked = ranked.withColumn("weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") - 1) % len(weights)))
    filling = Window.orderBy(F.col("source_size") * most / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    ranked = ranked.withColumns({
        "left_words": F.sum("source_size").over(every) * share - F.coalesce(F.sum("source_size").over(filling), F.lit(0)) * most,
        "left_weight": F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(filling), F.lit(0.0))})
    ranked = ranked.withColumn("level", F.col("left_words") / F.col("left_weight"))
    full = F.col("source_size") * most / F.col("weight") <= F.col("level")
    ranked = ranked.withColumn("level", F.max(F.when(~full, F.col("level"))).over(every))
    target = F.least(F.col("source_size") * F.lit(float(most)), F.coalesce(F.col("level") * F.col("weight"), F.lit(float("inf"))))
    return ranked.select("source", "rank", "weight", "source_size", target.alias("target"))


def with_finish(sized: DataFrame) -> DataFrame:
    """Words sent by the source up to and with each row, as sums over buckets of the queue and inside each bucket.

    A bucket holds one in 4,096 documents of a source, so that a source with a third of all rows is not one task.
    """
    sized = sized.withColumn("bucket", F.substring("digest", 1, BUCKET_DIGITS))
    before = Window.partitionBy("rank").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = sized.groupBy("rank", "bucket").agg(F.sum("size").alias("bucket_size")).select(
        "rank", "bucket", F.coalesce(F.sum("bucket_size").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("rank", "bucket").orderBy("digest", "size", ROW).rowsBetween(Window.unboundedPreceding, 0)
    return sized.join(buckets, ["rank", "bucket"]).withColumn("sent", F.col("offset") + F.sum("size").over(inside)).drop("offset", "bucket")


def truncate(ranged: DataFrame, order: list, share, sized: DataFrame) -> DataFrame:
    """The longest beginning of the range-sorted list that fits the budget.

    Sums per range (one number for each of the shuffle partitions) tell which range holds the cut; only this one is sorted.
    """
    budget = sized.agg((F.sum("size") * share).alias("b")).first()["b"] or 0.0
    sums = sorted((r["part"], r["size"]) for r in ranged.groupBy("part").agg(F.sum("size").alias("size")).collect())
    whole, left = [], budget
    for part, size in sums:
        if size > left:
            break
        whole.append(part)
        left -= size
    cut = next((part for part, _ in sums[len(whole):]), -1)
    last = whole[-1] if whole else -1
    running = F.sum("size").over(Window.orderBy(*order, ROW).rowsBetween(Window.unboundedPreceding, 0))
    at_cut = ranged.filter(F.col("part") == cut).withColumn("running", running).filter(F.col("running") <= left).drop("running")
    return ranged.filter(F.col("part") <= last).unionByName(at_cut)


SQL = r"""
WITH sized AS (
  SELECT row_number() OVER () AS row, doc_id, source, md5('mix|' || CAST(doc_id AS VARCHAR)) AS digest,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM {documents}),
ranked AS (
  SELECT source, source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) AS rank
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source)),
weighed AS (SELECT *, CAST(CASE (rank - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS DOUBLE) AS weight FROM ranked),
filled AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
             - coalesce(sum(source_size) OVER (ORDER BY 2 * source_size / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * 2)
            / (sum(weight) OVER ()
               - coalesce(sum(weight) OVER (ORDER BY 2 * source_size / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
  FROM weighed),
targets AS (
  SELECT source, rank, weight, source_size,
         least(2.0::DOUBLE * source_size, coalesce((SELECT max(level) FROM filled WHERE 2 * source_size / weight > level) * weight, 'inf'::DOUBLE)) AS target
  FROM filled),
queued AS (
  SELECT s.*, t.rank, t.weight, t.source_size, t.target,
         CAST(sum(size) OVER (PARTITION BY t.rank ORDER BY digest, size, row) AS BIGINT) AS sent
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
copies AS (
  SELECT row, size, rank, c AS copy, digest, (sent + c * source_size) / weight AS finish FROM queued, (VALUES (0), (1)) v(c) WHERE size > 0),
running AS (SELECT row, size, sum(size) OVER (ORDER BY finish, rank, copy, digest, size, row) AS total FROM copies),
taken AS (SELECT row, sum(size) AS taken FROM running WHERE total <= (SELECT sum(size) * 1.5::DOUBLE FROM sized) GROUP BY row)
SELECT doc_id, size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken FROM queued LEFT JOIN taken USING (row)
"""
