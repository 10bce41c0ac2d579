"""Secret scans judged by how many owners share a value.

Every text is scanned for assignments of secrets, access keys, long hexadecimal runs and other long mixed tokens. Hashes of
the values are counted over the whole corpus, first per (value, owner) and (value, repository), then per value, so that a
value in a third of all documents costs one row per task. A value that ``shared_owners`` or more owners have, or that stands in
``shared_repositories`` or more repositories whoever owns them, is a copied example; a value of fewer of both that looks random is live;
the rest is weak. Mixed tokens are reported only where live.

Defined results: null and empty texts hold nothing; null owners are one owner, null repositories one repository; repeated
rows are rows of their own but add no owner; an empty table gives no rows; a very long text is looked at as a whole, with about 20 bytes of
memory a byte; other columns pass through, whatever their names, and one named like the new array is replaced. Values leave the scan
only as hashes.
"""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.annotate import annotate
from tabloom.llm.rows import ROW, column
from tabloom.llm.text import byte_class, flat, pieces, runs
from tabloom.session import materialize

KINDS = ("assign", "access", "hex", "mixed")      # in this order where spans start together
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
KEYWORD = re.compile(rb"password|passwd|secret|token|api_?key", re.I)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST, MIXED_LEAST = 6, 20, 24, 20
RANDOM_BITS = 2.5        # entropy per character from which a value looks random
HEX = ~byte_class([*b"0123456789abcdef"])
MIXED = ~byte_class([*b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"])
FOUND = "found array<struct<kind:int,start:int,end:int,hash:string,random:boolean>>"


def long_runs(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray, least: int):
    """(row, start, end) of maximal runs of the bytes inside one text."""
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    starts, lengths = runs(np.where(inside[data], row, -1))
    kept = (lengths >= least) & inside[data[starts]] if len(data) else lengths >= least
    return row[starts[kept]], starts[kept], (starts + lengths)[kept]


def scan(texts: pa.Array) -> list:
    """For each text its finds by start, then kind, as code point ranges."""
    out = []
    for piece in pieces(pa.RecordBatch.from_arrays([texts], ["text"])):
        data, offsets = flat(piece.column(0))
        raw = data.tobytes()
        spans = {}

        def add(row, kind, start, end, value):
            spans.setdefault(row, []).append((start, kind, end, value))

        def rows_of(hits):
            """Rows that any hit touches: one that crosses a boundary may hide the next row's own, which the search by row finds."""
            touched = set()
            for m in hits:
                first, last = np.searchsorted(offsets, (m.start(), m.end() - 1), "right") - 1
                touched.update(range(int(first), int(last) + 1))
            return sorted(touched)

        for row in rows_of(KEYWORD.finditer(raw)):
            for m in ASSIGN.finditer(raw, offsets[row], offsets[row + 1]):
                if len(m[2]) >= ASSIGN_LEAST:
                    add(row, 0, m.start(), m.end(), m[2])
        for row in rows_of(ACCESS.finditer(raw)):
            for m in ACCESS.finditer(raw, offsets[row], offsets[row + 1]):
                if len(m[0]) >= ACCESS_LEAST:
                    add(row, 1, m.start(), m.end(), m[0])
        for row, start, end in zip(*(x.tolist() for x in long_runs(data, offsets, HEX, HEX_LEAST))):
            add(row, 2, start, end, raw[start:end])
        for row, start, end in zip(*(x.tolist() for x in long_runs(data, offsets, MIXED, MIXED_LEAST))):
            value = raw[start:end]
            if is_mixed(value) and not any(a < end and start < e for a, _, e, _ in spans.get(row, ())):
                add(row, 3, start, end, value)
        found = [[] for _ in range(len(offsets) - 1)]
        for row, own in spans.items():
            base = int(offsets[row])
            points = np.concatenate([[0], np.cumsum((data[base:offsets[row + 1]] & 0xC0) != 0x80)])
            found[row] = [{"kind": kind, "start": int(points[start - base]), "end": int(points[end - base]),
                           "hash": hashlib.sha256(value).hexdigest()[:32], "random": looks_random(value)}
                          for start, kind, end, value in sorted(own)]
        out += found
    return out


def is_mixed(value: bytes) -> bool:
    return bool(re.search(rb"[a-z]", value) and re.search(rb"[A-Z]", value) and re.search(rb"[0-9]", value))


def looks_random(value: bytes) -> bool:
    bits = -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values())
    return bits >= RANDOM_BITS


def scan_secrets(docs: DataFrame, text="text", owner="source", repository="doc_id", shared_owners=3, into="secrets", shared_repositories=100, with_text=False) -> DataFrame:
    """One row per document with all columns, the text only ``with_text``, and the struct array ``into``: kind, start, end, owners, repositories, verdict.

    Spans are code point ranges, by start and kind. Rows are written once with their finds; only those with any are joined with the verdicts.
    """
    names = docs.columns
    kept = [i for i, n in enumerate(names) if n != into and (with_text or n != text)]
    place = {n: F.col(f"c{i}") for i, n in enumerate(names)}
    rows = docs.toDF(*[f"c{i}" for i in range(len(names))])
    rows = rows.select(*[f"c{i}" for i in kept], F.monotonically_increasing_id().alias(ROW), place[owner].alias("owner"),
                       place[repository].alias("repository"), place[text].alias("text"))
    found = materialize(annotate(rows, lambda: lambda texts: [scan(texts)], FOUND, "finds", keep=[c for c in rows.columns if c != "text"]), "finds")
    finds = found.select(ROW, "owner", "repository", F.explode("finds.found").alias("f")).select(ROW, "owner", "repository", "f.*")
    shared = ownership(finds)
    judged = finds.select(ROW, "kind", "start", "end", "hash", "random").join(shared, "hash")
    copied = (F.col("owners") >= shared_owners) | (F.col("repositories") >= shared_repositories)
    verdict = (F.when(copied, "example").when(F.col("random"), "live").otherwise("weak"))
    judged = judged.withColumn("verdict", verdict).filter((F.col("kind") < 3) | (F.col("verdict") == "live"))
    one = F.struct("start", "kind", "end", "owners", "repositories", "verdict")
    lists = judged.groupBy(ROW).agg(F.sort_array(F.collect_list(one)).alias("finds"))
    empty = F.array().cast("array<struct<start:int,kind:int,end:int,owners:bigint,repositories:bigint,verdict:string>>")
    places = [F.col(f"c{i}") for i in kept]
    held, bare = F.size("finds.found") > 0, F.size("finds.found") == 0
    joined = found.filter(held).select(ROW, *places).join(lists, ROW, "left").select(*places, F.coalesce("finds", empty).alias("finds"))
    return joined.unionAll(found.filter(bare).select(*places, empty.alias("finds"))).toDF(*[names[i] for i in kept], into)


def ownership(finds: DataFrame) -> DataFrame:
    """hash, owners, repositories: numbers of distinct owners and repositories of each value."""
    owners = finds.groupBy("hash", "owner").agg(F.count("*").alias("n")).groupBy("hash").agg(F.count("*").alias("owners"))
    repositories = finds.groupBy("hash", "repository").agg(F.count("*").alias("n")).groupBy("hash").agg(F.count("*").alias("repositories"))
    return owners.join(repositories, "hash")


def listed(finds, kinds=KINDS):
    """Spans as ``kind:start:end`` separated by commas."""
    names = F.array(*[F.lit(k) for k in kinds])
    return F.concat_ws(",", F.transform(finds, lambda f: F.concat_ws(":", F.get(names, f["kind"]), f["start"].cast("string"), f["end"].cast("string"))))


def redact(text, finds, mark="[secret]"):
    """The text without its live and weak secrets, overlapping spans taken together, as one column expression."""
    hidden = F.filter(finds, lambda f: f["verdict"] != "example")
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(acc, f):
        gap = F.substring(text, acc["at"] + 1, F.greatest(f["start"] - acc["at"], F.lit(0)))
        return F.struct(F.concat(acc["out"], F.when(f["start"] >= acc["at"], F.concat(gap, F.lit(mark))).otherwise(F.lit(""))).alias("out"),
                        F.greatest(acc["at"], f["end"]).alias("at"))

    done = F.aggregate(hidden, start, step)
    return F.when(F.size(hidden) == 0, text).otherwise(F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text))))
