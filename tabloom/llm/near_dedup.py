"""Near-duplicates by a multi-index Hamming join of b-bit MinHash signatures.

A text is its set of ``width``-word shingles. Texts with equal sets are one class. Each class has a signature of ``HASHES``
minima cut to ``BITS`` bits; the distance allowed is such that two sets just similar enough differ in more places with a
chance below ``MISSED`` (14 of 32 places at 85 percent). Signatures are split into ``CHUNKS`` chunks: by the pigeonhole
principle, two signatures within the distance have a chunk with at most distance // ``CHUNKS`` differing places, so the
chunk with every choice of so many places left out is a key, and all pairs within the distance share one. Buckets are not
expanded: in each turn a text is compared with one or a few (``TURNS``) representatives of its buckets that are not in its component
yet, so a turn makes at most so many pairs a text. After them, members of buckets that still hold several components are split by their rarest
shingles: two similar sets share one of them, near enough to the front of both. A pair under such a shingle is held to the distance, which means a
shared bucket, and to a lower bound of how many shingles the two sets differ by, from the parity of the shingles in each of ``PARITY`` slots.
Links are confirmed on the full sets, and components come from alternating large and small stars on written tables.

Defined results: null, empty and blank texts have an empty set and are components of their own; shorter texts are one
shingle; a null key is left out of the smallest key of its component, and is not kept; repeated rows are members of one
class; an empty table gives no rows; other columns are not read. Shingles are compared by 64-bit hashes.
"""

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabloom.llm.annotate import annotate
from tabloom.llm.rows import ROW, column, numbered
from tabloom.llm.text import BASE, SPACED, Words, mix, pieces, spread
from tabloom.session import materialize

HASHES, BITS, CHUNKS, MISSED = 32, 15, 5, 2e-5
SALTS = 8
SLOTS = 1 << 20          # counts of shingles, sent to all tasks: 8 MB
PARITY = 1024            # slots whose parities travel with a rare shingle: 128 bytes
TURNS = (1, 1, 4)  # representatives that a text is compared with in each turn
SKETCH = "n long, digest binary, signature array<short>"
FACTORS = mix(np.arange(1, HASHES + 1, dtype=np.uint64)) | np.uint64(1)


def allowed_distance(percent: int) -> int:
    """The least number of differing places that a pair of the given similarity exceeds with a chance below ``MISSED``."""
    differ = 1 - percent / 100
    chance = [comb(HASHES, k) * differ ** k * (1 - differ) ** (HASHES - k) for k in range(HASHES + 1)]
    return next(t for t in range(HASHES + 1) if sum(chance[t + 1:]) < MISSED)


def choices(distance: int) -> list:
    """Places of the signature that make up each key."""
    out = []
    for chunk in np.array_split(np.arange(HASHES), CHUNKS):
        out += [np.setdiff1d(chunk, left_out) for left_out in combinations(chunk.tolist(), distance // CHUNKS)]
    return out


def shingle_sets(words: Words, width: int):
    """(row, hash) of the distinct shingles, by row and hash."""
    hashes, counts = words.hashes(), words.counts
    sizes = np.where(counts > 0, np.maximum(counts - width + 1, 1), 0)
    at, span = spread(words.bounds[:-1], sizes), np.repeat(np.minimum(counts, width), sizes)
    total = span.astype(np.uint64)
    for k in range(width):
        inside = span > k
        total[inside] = mix(total[inside] * BASE + hashes[at[inside] + k])
    row = np.repeat(np.arange(len(counts)), sizes)
    order = np.lexsort((total, row))
    row, total = row[order], total[order]
    fresh = np.concatenate([[True], (row[1:] != row[:-1]) | (total[1:] != total[:-1])]) if len(row) else np.zeros(0, bool)
    return row[fresh], total[fresh]


def nested(values: np.ndarray, sizes: np.ndarray, kind) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def sketch(texts: pa.Array, width: int):
    """Size, digest and signature of each text's set."""
    parts = [[], [], []]
    for piece in pieces(pa.RecordBatch.from_arrays([texts], ["text"])):
        row, items = shingle_sets(Words(piece.column(0), SPACED), width)
        sizes = np.bincount(row, minlength=piece.num_rows)
        full = np.flatnonzero(sizes)
        first = (np.cumsum(sizes) - sizes)[full]
        minima = np.zeros((len(full), HASHES), np.uint64)
        sums = np.zeros((piece.num_rows, 2), np.uint64)
        if len(full):
            for k in range(HASHES):
                minima[:, k] = np.minimum.reduceat(items * FACTORS[k], first)
            sums[full, 0], sums[full, 1] = np.add.reduceat(items, first), np.add.reduceat(mix(items + BASE), first)
        signature = (mix(minima) & np.uint64((1 << BITS) - 1)).astype(np.int16)
        parts[0].append(pa.array(sizes.astype(np.int64)))
        parts[1].append(pa.array([s.tobytes() for s in sums], pa.binary()))
        parts[2].append(nested(signature.ravel(), np.where(sizes > 0, HASHES, 0), pa.int16()))
    return [pa.concat_arrays(p) for p in parts]


def full_sets(texts: pa.Array, width: int):
    out = []
    for piece in pieces(pa.RecordBatch.from_arrays([texts], ["text"])):
        row, items = shingle_sets(Words(piece.column(0), SPACED), width)
        out.append(nested(items.view(np.int64), np.bincount(row, minlength=piece.num_rows), pa.int64()))
    return [pa.concat_arrays(out)]


def near_duplicates(docs: DataFrame, key="doc_id", text="text", width=3, percent=85, row=None) -> DataFrame:
    """One row per document: key, n_shingles, component_id (smallest key reachable by links), kept.

    Two documents are linked where 100 * common shingles >= ``percent`` * all shingles of both. ``row`` names a long column with a number of
    each row's own in a written table (``with_row_id``), which is then read as it is; without it rows are numbered in a copy of the texts.
    """
    distance = allowed_distance(percent)
    columns = {"key": column(docs, key), "text": column(docs, text)}
    if row is None:
        texts = numbered(docs, columns, "texts")
    else:
        texts = docs.select(column(docs, row).alias(ROW), *[c.alias(n) for n, c in columns.items()])
    sets = materialize(annotate(texts, lambda: lambda batch: sketch(batch, width), SKETCH, "s", keep=[ROW, "key"]).select(ROW, "key", "s.*"), "sketches")
    full = sets.filter("n > 0")
    classes = materialize(full.groupBy("digest").agg(
        F.min(ROW).alias("id"), F.min("key").alias("least"), F.min_by(F.struct("signature", "n"), ROW).alias("s")), "classes")
    keys = F.array(*[F.xxhash64(F.lit(number), *[F.col("s.signature")[int(place)] for place in places]) for number, places in enumerate(choices(distance))])
    keyed = classes.select("id", F.explode(keys).alias("bucket"))
    shared = keyed.withColumn("size", F.count("*").over(Window.partitionBy("bucket"))).filter("size > 1").drop("size")
    shared = materialize(shared, "buckets")
    # only texts that share a bucket are compared; the ids are written first, so that Spark knows their size when it joins
    ids = materialize(shared.select(F.col("id").alias(ROW)).distinct(), "ids")
    members = annotate(texts.join(ids, ROW, "left_semi"), lambda: lambda batch: full_sets(batch, width), "items array<long>", "s", keep=[ROW])
    sizes = classes.select(F.col("id").alias(ROW), "s.signature", "s.n")
    heads = materialize(members.select(ROW, "s.items"), "sets")
    signed = sizes.join(ids, ROW, "left_semi")
    links, parts = None, None
    for turn, several in enumerate(TURNS):
        members = open_buckets(with_component(shared, parts))
        lead = F.min(F.struct(F.xxhash64("id", F.lit(turn)).alias("h"), "id", "part")).over(Window.partitionBy("bucket"))
        leads = members.withColumn("lead", lead).filter(F.col("part") != F.col("lead.part")).groupBy("id", "lead").agg(F.count("*").alias("buckets"))
        best = F.sort_array(F.collect_list(F.struct("buckets", "lead.h", "lead.id")), asc=False)        # most buckets: likely the nearest
        leads = leads.groupBy("id").agg(F.slice(best, 1, several).alias("leads")).select("id", F.explode("leads").alias("lead"))
        pairs = leads.select(F.least("id", "lead.id").alias("a"), F.greatest("id", "lead.id").alias("b"))
        for side in ("a", "b"):
            pairs = pairs.join(signed_as(signed, side), side)
        links, parts = grow(links, confirmed(pairs.filter(close(percent, distance)), heads, percent))
    left = open_buckets(with_component(shared, parts)).groupBy("id").agg(F.first("part").alias("part"))
    rare = materialize(rare_shingles(heads.join(left, heads[ROW] == left["id"]).select("id", "part", "items"), percent), "rare")
    near = under_rare_shingles(rare, percent)
    for side in ("a", "b"):
        near = near.join(signed_as(signed, side), side)
    links, parts = grow(links, confirmed(near.filter(close(percent, distance)), heads, percent))
    labelled = classes.join(parts, "id", "left").withColumn("part", F.coalesce("part", "id"))
    least = labelled.groupBy("part").agg(F.min("least").alias("component"))
    labelled = labelled.select("digest", "part").join(least, "part").select("digest", "component")
    salted = labelled.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    named = sets.select(ROW, "key", "n", "digest", F.pmod(F.xxhash64(ROW), F.lit(SALTS)).cast("int").alias("salt"))
    named = named.join(salted, ["digest", "salt"], "left")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("key"))
    return named.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"),
                        F.coalesce(F.col("key") == component, F.lit(False)).alias("kept"))


def with_component(shared: DataFrame, parts) -> DataFrame:
    if parts is None:
        return shared.withColumn("part", F.col("id"))
    return shared.join(parts, "id", "left").withColumn("part", F.coalesce("part", "id"))


def open_buckets(members: DataFrame) -> DataFrame:
    """Members of buckets that hold more than one component."""
    every = Window.partitionBy("bucket")
    spread_out = members.withColumns({"low": F.min("part").over(every), "high": F.max("part").over(every)})
    return spread_out.filter("low != high").drop("low", "high")


def signed_as(signed: DataFrame, side: str) -> DataFrame:
    return signed.select(F.col(ROW).alias(side), F.col("signature").alias(f"signature_{side}"), F.col("n").alias(f"n_{side}"))


def close(percent: int, distance: int):
    """Signatures within the distance and sizes that allow the similarity; compared place by place, in generated code."""
    differing = sum((F.col("signature_a")[k] != F.col("signature_b")[k]).cast("int") for k in range(HASHES))
    return (100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")) & (differing <= distance)


def rare_shingles(members: DataFrame, percent: int) -> DataFrame:
    """(item, id, part, place, n, parity): of each member the shingles that a similar one must share one of, by place from the rarest on.

    All sets are put in one order, by how often a shingle's slot is used, then by hash. A set of n shingles shares ceil(``percent`` * n / 100)
    with a similar one, so one of its first n - that + 1. The ``SLOTS`` counts, sent to all tasks, only choose the order: any one loses nothing.
    """
    spark = members.sparkSession
    slots = members.select(F.explode("items").alias("item")).groupBy(F.col("item").bitwiseAND(F.lit(SLOTS - 1)).alias("slot")).count().toArrow()
    used = np.zeros(SLOTS, np.int64)
    used[slots.column("slot").to_numpy()] = slots.column("count").to_numpy()
    sent = spark.sparkContext.broadcast(used)

    def run(batches):
        for batch in batches:
            items, n = batch.column(2).flatten().to_numpy(), pc.list_value_length(batch.column(2)).to_numpy().astype(np.int64)
            if not len(items):
                continue
            row = np.repeat(np.arange(len(n)), n)
            uses = sent.value[items & (SLOTS - 1)]
            order = np.lexsort((items, uses, row))
            row, items, uses = row[order], items[order], uses[order]
            place = np.arange(len(row)) - (np.cumsum(n) - n)[row]
            kept = np.flatnonzero((place <= n[row] - -(-percent * n[row] // 100)) & (uses > 1))
            at = pa.array(row[kept])
            words = parities(items, row, len(n))[row[kept]]
            yield pa.RecordBatch.from_arrays([pa.array(items[kept]), batch.column(0).take(at), batch.column(1).take(at), pa.array(place[kept]), pa.array(n[row[kept]]),
                                              nested(words.ravel(), np.full(len(kept), words.shape[1]), pa.int64())],
                                             names=["item", "id", "part", "place", "n", "parity"])

    return members.mapInArrow(run, "item long, id long, part long, place long, n long, parity array<long>")


def parities(items: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """For each row, in ``PARITY`` bits, whether an odd number of its items fall into a slot.

    An item that only one of two sets has changes one bit, one of both changes none: the bits that differ are at most the items that do.
    """
    slot = (mix(items.view(np.uint64)) % np.uint64(PARITY)).astype(np.int64)
    out = np.zeros(rows * PARITY // 64, np.uint64)
    np.bitwise_xor.at(out, row * (PARITY // 64) + slot // 64, np.uint64(1) << (slot % 64).astype(np.uint64))
    return out.view(np.int64).reshape(rows, -1)


def under_rare_shingles(rare: DataFrame, percent: int) -> DataFrame:
    """(a, b): members of different components with a rare shingle in common, from which on both have enough shingles left, and whose
    parities do not show them to differ in too many.

    The first shingle that a similar pair has in common is such a one, as all that they share stands behind it in both. Similar sets differ
    in at most (100 - ``percent``) / (100 + ``percent``) of the sum of their sizes.
    """
    sides = [rare.select("item", *[F.col(c).alias(f"{c}_{side}") for c in ("part", "place", "n", "parity")], F.col("id").alias(side)) for side in ("a", "b")]
    total = F.col("n_a") + F.col("n_b")
    enough = F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b")) * (100 + percent) >= percent * total
    differing = sum(F.bit_count(F.col("parity_a")[k].bitwiseXOR(F.col("parity_b")[k])) for k in range(PARITY // 64))
    enough &= differing * (100 + percent) <= (100 - percent) * total
    return sides[0].join(sides[1], "item").filter((F.col("a") < F.col("b")) & (F.col("part_a") != F.col("part_b")) & enough).select("a", "b").distinct()


def confirmed(near: DataFrame, heads: DataFrame, percent: int) -> DataFrame:
    """The distinct pairs whose full sets are similar enough."""
    near = materialize(near.select("a", "b", "n_a", "n_b").distinct(), "near")
    for side in ("a", "b"):
        near = near.join(heads.select(F.col(ROW).alias(side), F.col("items").alias(f"items_{side}")), side)
    common = F.size(F.array_intersect("items_a", "items_b"))
    return near.filter(100 * common >= percent * (F.col("n_a") + F.col("n_b") - common)).select("a", "b")


def grow(links, more: DataFrame):
    """(all links so far, components of them as (id, part)); both written."""
    more = materialize(more, "links")
    links = more if links is None else links.unionByName(more)
    return links, components(links)


def components(links: DataFrame) -> DataFrame:
    """(id, part) for all ends of links, part being the smallest id reachable, by alternating stars until nothing changes."""
    edges, before = materialize(links.filter("a != b").distinct(), "edges"), None
    while True:
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).filter("a != b").distinct()
        large = materialize(large, "large")
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(low, "b")
        small = small.select(F.col("m").alias("a"), "b").union(small.select("m", "a")).toDF("a", "b").filter("a != b").distinct()
        edges = materialize(small, "small")
        state = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == before:
            break
        before = state
    return materialize(edges.select(F.col("b").alias("id"), F.col("a").alias("part")).union(
        edges.select("a", "a").distinct().toDF("id", "part")), "components")


SQL = r"""
WITH RECURSIVE words AS (
  SELECT row_number() OVER () AS row, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
shingles AS (
  SELECT DISTINCT row, doc_id, array_to_string(w[i:i + least(3, len(w)) - 1], ' ') AS s
  FROM (SELECT row, doc_id, w, unnest(range(1, greatest(1, len(w) - 2) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT row, count(*) AS n FROM shingles GROUP BY row),
common AS (SELECT x.row AS a, y.row AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.s = y.s AND x.row <> y.row GROUP BY x.row, y.row),
links AS (
  SELECT a, b FROM common JOIN sizes p ON p.row = a JOIN sizes q ON q.row = b WHERE 100 * c >= 85 * (p.n + q.n - c)),
reach AS (SELECT row AS a, row AS b FROM words UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least_of AS (SELECT a, min(doc_id) AS component_id FROM reach JOIN words ON row = b GROUP BY a)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, coalesce(doc_id = component_id, false) AS kept
FROM words LEFT JOIN sizes USING (row) JOIN least_of ON a = words.row
"""
