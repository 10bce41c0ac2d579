"""Removal of repeated byte strings by suffix orders of the places that can repeat.

A string of ``length`` bytes that occurs twice holds, at the same distance from its start, the gram that is least by hash
among its grams. So every such string lies in the context of an anchor, a gram that is least in some stretch; one byte in 69 is an anchor.
Anchors that occur once in the corpus are dropped. Contexts that occur more than once are repeated as a whole. Of
the others, one for each different context of an anchor, the suffixes are put in order by linear grouping (``suffix_order``); neighbours
with the same first ``length`` bytes are repeated strings, if they stand at different places. An anchor with very many
different contexts is cut into blocks; a string that is repeated in its block is told once, and those that are not are compared once more by
hash over all blocks. Before the order, contexts are cut down to the bytes that repeated strings can lie in, of equal ones one is ordered, and
what all strings of an anchor's contexts hold around it is one symbol. Documents are rewritten last.

Defined results: null and empty texts have no bytes and keep the hash of nothing; texts shorter than ``length`` lose nothing; a repeat inside
one text counts, overlapping itself too; repeated rows remove each other, as all occurrences go; null keys are keys like others;
other columns are not read. Strings are compared by 64-bit hashes.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabloom.llm.annotate import annotate
from tabloom.llm.rows import ROW, column, numbered
from tabloom.llm.suffix_order import suffix_order
from tabloom.llm.text import flat, mix, pieces, prefix_hash, range_hash, runs, spread
from tabloom.session import materialize

GRAM = 64
BUCKET = 2048            # contexts whose suffixes are ordered together, on average; more of one anchor are cut into blocks
PIECE_BYTES = 1 << 20    # texts searched for anchors together; a longer text by itself, with about 80 bytes of memory a byte
PACK = 6                 # bytes a symbol behind the core: 9 bits each, so that the end of a range is less than any byte
STEP = 4                 # bytes by which the tests of a context's strings are apart
LOW = np.uint64((1 << 32) - 1)
ANCHORS = "anchors array<struct<anchor:long,context:long,pos:int>>"


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(values)] = values
    blocks = padded.reshape(-1, width)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:n], forward[width - 1:width - 1 + n])


def find_anchors(texts: pa.Array, length: int):
    """The anchors of each text: hash of the gram, hash of its context, first byte."""
    out = []
    for piece in pieces(pa.RecordBatch.from_arrays([texts], ["text"]), size=PIECE_BYTES):
        data, offsets = flat(piece.column(0))
        starts, sizes = offsets[:-1], np.maximum(np.diff(offsets) - length + 1, 0)
        at = np.zeros(0, np.int64)
        prefix = prefix_hash(data)
        if sizes.sum():
            begin = np.arange(len(data) - GRAM + 1)
            hashes = range_hash(prefix, begin, begin + GRAM)
            least = sliding_least((hashes & ~LOW) | begin.astype(np.uint64), length - GRAM + 1)
            at = np.unique((least[spread(starts, sizes)] & LOW).astype(np.int64))
            hashes = hashes[at]
        row = np.searchsorted(offsets, at, "right") - 1
        left, right = context_range(at, offsets[row], offsets[row + 1], length)
        context = mix(range_hash(prefix, left, right) + (at - left).astype(np.uint64)) if len(at) else np.zeros(0, np.uint64)
        grams = hashes if len(at) else np.zeros(0, np.uint64)
        bounds = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=piece.num_rows))]).astype(np.int32)
        values = pa.StructArray.from_arrays([pa.array(grams.view(np.int64)), pa.array(context.view(np.int64)),
                                             pa.array((at - offsets[row]).astype(np.int32))], names=["anchor", "context", "pos"])
        out.append(pa.ListArray.from_arrays(pa.array(bounds), values))
    return [pa.concat_arrays(out)]


def context_range(at, first, last, length: int):
    """Where the strings that hold the gram at ``at`` begin and end, inside the text [first, last)."""
    return np.maximum(at + GRAM - length, first), np.minimum(at + length, last)


def cut_contexts(length: int):
    """(anchor, block, row, start, side, bytes) of the wanted places of each text."""
    def run(batches):
        for batch in batches:
            out = []
            for row, text, wanted in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                data = text.as_py().encode()
                for w in wanted:
                    left, right = max(0, w["pos"] + GRAM - length), min(len(data), w["pos"] + length)
                    out.append((w["anchor"], w["bucket"], w["split"], row, left, w["pos"] - left, data[left:right]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int32(), pa.int32(), pa.binary()))],
                                                 names=["anchor", "bucket", "split", "row", "start", "at", "data"])
    return run


def order_bucket(length: int):
    """Repeated strings of a bucket's contexts as (row, start, end); each different string of a split anchor with its hash, for the other blocks."""
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        pick = lambda c: table.column(c).to_numpy(zero_copy_only=False)
        anchor, split, row, start, at = (pick(c) for c in ("anchor", "split", "row", "start", "at"))
        data, offsets = flat_bytes(table.column("data"))
        prefix = prefix_hash(data)
        first, last = extents(prefix, offsets, at, anchor, length)
        first, last = np.where(split, offsets[:-1], first), np.where(split, offsets[1:], last)
        hopeful = last - first >= length
        gram = (offsets[:-1] + at)[hopeful]
        first, last, row, split, anchor = first[hopeful], last[hopeful], row[hopeful], split[hopeful], anchor[hopeful]
        start = start[hopeful] + first - offsets[:-1][hopeful]
        same, alone = copies(data, first, last, row, start, split)
        copied = result(np.zeros(len(same), np.int64), row[same], start[same], start[same] + (last - first)[same], np.ones(len(same), bool))
        if not len(alone):
            return copied
        first, row, start, split = first[alone], row[alone], start[alone], split[alone]
        symbols, begin, left = core_symbols(data, prefix, first, last[alone], gram[alone], anchor[alone], length)
        order = np.array(suffix_order(symbols.tolist()), np.int64)
        owner = np.searchsorted(begin, order, "right") - 1
        inside = order - begin[owner]
        whole = (inside <= left[owner]) & (inside + length <= (last[alone] - first)[owner])     # what begins behind a core holds none
        owner, inside = owner[whole], inside[whole]
        hashes = range_hash(prefix, first[owner] + inside, first[owner] + inside + length)
        row, where, split = row[owner], start[owner] + inside, split[owner]
        firsts, lengths = runs(hashes)
        number = np.repeat(np.arange(len(firsts)), lengths)
        differs = (row != row[firsts][number]) | (where != where[firsts][number])
        repeated = np.bincount(number, differs, len(firsts))[number] > 0
        order = np.lexsort((where[repeated], row[repeated]))
        own, at = row[repeated][order], where[repeated][order]
        fresh = np.concatenate([[True], (own[1:] != own[:-1]) | (at[1:] > at[:-1] + length)]) if len(at) else np.zeros(0, bool)
        first = np.flatnonzero(fresh)
        last = np.concatenate([first[1:], [len(at)]])[:len(first)] - 1      # overlapping strings as one span
        none = np.zeros(len(first), np.int64)
        told = split & (~repeated | (np.arange(len(split)) == firsts[number]))      # a string repeated here is told once, as an empty span
        end = np.where(repeated, where, where + length)
        ordered = result(np.concatenate([none, hashes[told].view(np.int64)]), np.concatenate([own[first], row[told]]), np.concatenate([at[first], where[told]]),
                         np.concatenate([at[last] + length, end[told]]), np.concatenate([none == 0, np.zeros(int(told.sum()), bool)]))
        return pa.concat_tables([copied, ordered])
    return run


def core_symbols(data, prefix, first, last, gram, anchor, length: int):
    """(symbols to order, where each range begins in them, symbols of each range before its core).

    Strings that repeat hold their anchor's gram at the same place, so they hold what all strings in the anchor's ranges hold around it, too. This
    core is one symbol, one for each different core of an anchor. The bytes before it are symbols as they are. Those behind it are compared from the
    core on only, so ``PACK`` of them are one symbol, whose order is theirs: strings that end inside a symbol are neighbours all the same.
    """
    _, group = np.unique(anchor, return_inverse=True)
    low, high = np.full(group.max() + 1, GRAM - length), np.full(group.max() + 1, length)
    np.maximum.at(low, group, last - gram - length)
    np.minimum.at(high, group, first - gram + length)
    core, after = gram + low[group], gram + high[group]
    _, number = np.unique(mix(range_hash(prefix, core, after) + anchor.view(np.uint64)), return_inverse=True)
    left, right = core - first, last - after
    packed = -(-right // PACK)
    sizes = left + 1 + packed
    begin = np.cumsum(sizes + 1) - sizes - 1
    symbols = np.zeros(int(sizes.sum()) + len(sizes) + 1, np.int64)     # each range ends in a 1, the whole in a 0
    symbols[spread(begin, left)] = data[spread(first, left)].astype(np.int64) + 2
    symbols[begin + left] = number + 258
    behind, ends, value = np.repeat(after, packed) + PACK * spread(np.zeros_like(packed), packed), np.repeat(last, packed), np.zeros(int(packed.sum()), np.int64)
    for k in range(PACK):
        value = value << 9 | np.where(behind + k < ends, data[np.minimum(behind + k, len(data) - 1)].astype(np.int64) + 1, 0)
    symbols[spread(begin + left + 1, packed)] = value
    symbols[begin + sizes] = 1
    return symbols, begin, left


def flat_bytes(chunked):
    array = (pa.concat_arrays(chunked.chunks) if chunked.num_chunks else pa.array([], pa.binary())).cast(pa.large_binary())
    _, offsets, data = array.buffers()
    offsets = np.frombuffer(offsets, np.int64)[array.offset:array.offset + len(array) + 1] if len(array) else np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), offsets


def extents(prefix, offsets, at, anchor, length: int):
    """The range [first, last) of each context that its repeated strings can lie in; empty where it can have none.

    A string with the gram ``o`` bytes after its start has, for the multiple ``k`` of ``STEP`` below ``o``, the gram with ``k`` bytes on its left and
    all but ``STEP`` - 1 of the others on its right. If no other context of the anchor has the same, the string is not repeated.
    """
    spare, gram = length - GRAM, offsets[:-1] + at
    first, last = gram + length, gram.copy()
    for k in range(0, spare + 1, STEP):
        most = min(k + STEP - 1, spare)
        left, right = gram - k, gram + GRAM + spare - most
        fits = np.flatnonzero((left >= offsets[:-1]) & (right <= offsets[1:]))
        key = mix(range_hash(prefix, left[fits], right[fits]) + anchor[fits].view(np.uint64))
        _, code, count = np.unique(key, return_inverse=True, return_counts=True)
        fits = fits[count[code] > 1]
        first[fits] = np.minimum(first[fits], gram[fits] - most)
        last[fits] = np.maximum(last[fits], gram[fits] + length - k)
    return np.maximum(first, offsets[:-1]), np.minimum(last, offsets[1:])


def copies(data, first, last, row, start, split):
    """(ranges whose bytes stand at several places, ranges to put in order: one of each text of bytes, and all of split anchors)."""
    alone, by_bytes, whole = [], {}, data.tobytes()
    for i, (a, b, kept) in enumerate(zip(first.tolist(), last.tolist(), split.tolist())):
        if kept:
            alone.append(i)
        else:
            by_bytes.setdefault(whole[a:b], []).append(i)
    same = []
    for members in by_bytes.values():
        alone.append(members[0])
        if len({(row[i], start[i]) for i in members}) > 1:
            same += members
    return np.array(same, np.int64), np.array(sorted(alone), np.int64)


def result(hashes, row, start, end, repeated) -> pa.Table:
    return pa.table([pa.array(hashes), pa.array(row), pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32)), pa.array(repeated)],
                    names=["hash", "row", "start", "end", "repeated"])


def cut(data: bytes, spans):
    """(kept bytes, maximal removed runs)."""
    kept, removed, at = [], [], 0
    for a, b in sorted((s["start"], s["end"]) for s in spans or []):
        if removed and a <= removed[-1][1]:
            removed[-1][1] = max(removed[-1][1], b)
        else:
            removed.append([a, b])
    for a, b in removed:
        kept.append(data[at:a])
        at = b
    return b"".join([*kept, data[at:]]), removed


def rewritten(batches):
    for batch in batches:
        out = [[], [], [], [], []]
        for text, spans in zip(batch.column(1), batch.column(2).to_pylist()):
            data = (text.as_py() or "").encode()
            kept, removed = cut(data, spans)
            for values, value in zip(out, (len(data), len(data) - len(kept), [{"start": a, "end": b} for a, b in removed], hashlib.sha256(kept).hexdigest(), kept)):
                values.append(value)
        kinds = (pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])), pa.string(), pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(v, t) for v, t in zip(out, kinds)]],
                                         names=["key", "n_bytes", "n_removed", "removed", "kept_sha256", "kept"])


def remove_repeats(docs: DataFrame, key="doc_id", text="text", length=200, bucket=BUCKET) -> DataFrame:
    """One row per document: key, n_bytes, n_removed, removed (byte ranges), kept_sha256, kept (the bytes that stay)."""
    rows = numbered(docs, {"key": column(docs, key), "text": F.coalesce(column(docs, text).cast("string"), F.lit(""))}, "texts")
    found = annotate(rows, lambda: lambda texts: find_anchors(texts, length), ANCHORS, "a", keep=[ROW])
    anchors = materialize(found.select(F.col(ROW).alias("row"), F.explode("a.anchors").alias("x")).select("row", "x.*"), "anchors")
    contexts = anchors.groupBy("anchor", "context").agg(F.count("*").alias("n"), F.min(F.struct("row", "pos")).alias("first"))
    contexts = contexts.withColumn("different", F.count("*").over(Window.partitionBy("anchor")))
    contexts = materialize(contexts.filter("n > 1 OR different > 1"), "contexts")      # most anchors occur once and are not written again
    whole = anchors.join(contexts.filter("n > 1").select("anchor", "context"), ["anchor", "context"], "left_semi")
    sizes = rows.select(F.col(ROW).alias("row"), F.octet_length("text").alias("size"))
    left, right = F.greatest(F.col("pos") + GRAM - length, F.lit(0)), F.least(F.col("pos") + length, "size")
    whole = materialize(whole.join(sizes, "row").select("row", left.cast("int").alias("start"), right.cast("int").alias("end")), "whole")
    blocks = F.ceil(F.col("different") / bucket)
    wanted = contexts.filter("different > 1").select(
        "first.row", F.struct("anchor", F.xxhash64("anchor", F.pmod(F.xxhash64("context"), blocks)).alias("bucket"), (blocks > 1).alias("split"), "first.pos").alias("w"))
    wanted = materialize(wanted, "wanted")
    buckets = F.pmod("bucket", F.lit(max(1, wanted.count() // bucket)))
    schema = "anchor long, bucket long, split boolean, row long, start int, at int, data binary"
    texts = wanted.groupBy("row").agg(F.collect_list("w").alias("wanted")).join(rows.select(F.col(ROW).alias("row"), "text"), "row")
    cuts = texts.select("row", "text", "wanted").mapInArrow(cut_contexts(length), schema)
    strings = cuts.groupBy(buckets.alias("b")).applyInArrow(order_bucket(length), "hash long, row long, start int, end int, repeated boolean")
    strings = materialize(strings, "strings")
    place = F.struct("row", "start")
    across = strings.filter("NOT repeated").groupBy("hash").agg(F.min(place).alias("low"), F.max(place).alias("high")).filter("low != high").select("hash")
    more = strings.filter("NOT repeated AND end > start").join(across, "hash", "left_semi")
    spans = whole.union(strings.filter("repeated").select("row", "start", "end")).union(more.select("row", "start", "end")).distinct()
    spans = materialize(spans.groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("spans")), "spans")
    joined = rows.select(F.col(ROW).alias("row"), "key", "text").join(spans, "row", "left").select("key", "text", "spans")
    kind = rows.schema["key"].dataType.simpleString()
    return joined.mapInArrow(rewritten, f"key {kind}, n_bytes long, n_removed long, removed array<struct<start:int,end:int>>, kept_sha256 string, kept binary").withColumnRenamed("key", key)
