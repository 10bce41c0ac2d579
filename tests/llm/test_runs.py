"""Periodic runs against the definition, and the query against plain Python over a whole small table."""

import hashlib
import random
import re
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tabloom.llm import runs
from tabloom.llm.catalog import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def plain_runs(words, shortest=12):
    """(start, length, period) by trying every period at every place."""
    found, n = {}, len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(shortest, 2 * q):
                found.setdefault((i, j - i + q), q)
            i = j
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_digests(words, found):
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest()


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def some_words(rng):
    words = [rng.randint(0, rng.choice([1, 2, 3, 6])) for _ in range(rng.randint(0, 70))]
    if words and rng.random() < 0.5:
        a = rng.randrange(len(words))
        p = 1 + rng.randrange(len(words) - a)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(len(words))]
    return [("é", "W", "w", "x")[x % 4] + str(x) for x in words]


@pytest.mark.parametrize("shortest", [2, 5, 12])
def test_runs_of_random_words(shortest):
    rng = random.Random(shortest)
    for _ in range(400):
        docs = [some_words(rng) for _ in range(rng.randint(1, 6))]
        counts, found, listed, collapsed = (c.to_pylist() for c in runs.runs_of_piece(pa.array([" ".join(d) for d in docs]), shortest))
        for i, d in enumerate(docs):
            want = plain_runs(d, shortest)
            assert (counts[i], [(r["start"], r["length"], r["period"]) for r in found[i]]) == (len(d), want)
            assert (listed[i], collapsed[i]) == plain_digests(d, want)


def test_words_that_all_repeat():
    """Fibonacci words and one word repeated have the most and the deepest intervals."""
    a, b = "a", "ab"
    while len(b) < 20_000:
        a, b = b, b + a
    counts, found, _, _ = runs.runs_of_piece(pa.array(["z " * 60_000, " ".join(b), " ".join(b[:700])]), 12)
    assert found[0].as_py() == [{"start": 0, "length": 60_000, "period": 1}]
    assert [(r["start"], r["length"], r["period"]) for r in found[2].as_py()] == plain_runs(b[:700])
    assert len(found[1].as_py()) < len(b)


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(12)
    line = "one two three four five six seven eight"
    texts = [None, "", " \n\t ", "word", "a " * 30, f"{line}\n" * 9, f"{line} " * 2 + "end", "a b " * 20, "A a " * 20, "\x1f" * 3 + " x" * 14]
    rows = [(i, t) for i, t in enumerate(texts)] + [(5, texts[5]), (None, texts[5]), (99, " ".join(f"w{i % 7919}" for i in range(200_000)))]
    rows += [(100 + i, " ".join(some_words(rng))) for i in range(60)]
    return spark.createDataFrame([(*r, "x", 1, [2]) for r in rows], "doc_id long, text string, runs string, periodic int, c0 array<int>").repartition(3)


@pytest.mark.parametrize("piece_bytes", [1, 1 << 20])
def test_find_runs(docs, piece_bytes):
    got = runs.find_runs(docs, piece_bytes=piece_bytes)
    assert got.columns == ["doc_id", "text", "runs", "c0", "periodic"]
    rows = got.collect()
    assert len(rows) == docs.count()
    for r in rows:
        words = words_of(r["text"])
        want = plain_runs(words) if len(words) < 1000 else [(0, 200_000, 7919)]
        p = r["periodic"]
        assert (p["n_words"], [tuple(x) for x in p["runs"]]) == (len(words), want)
        assert (p["runs_sha256"], p["collapsed_sha256"]) == plain_digests(words, want)
        assert (r["runs"], r["c0"]) == ("x", [2])
    assert runs.find_runs(docs.filter("false")).count() == 0


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_query_over_the_whole_table(spark):
    rows = QUERIES["op12_periodic_runs"](spark, SF_DIR).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        words = planted(r["doc_id"], words_of(texts[r["doc_id"]]))
        want = plain_runs(words)
        s, n, q = min(want, key=lambda x: (-x[1], x[0], x[2])) if want else (None,) * 3
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(want), s, n, q)
        assert r["exponent_milli"] == (1000 * n // q if want else None)
        assert (r["runs_sha256"], r["collapsed_sha256"]) == plain_digests(words, want)
    assert sum(r["n_runs"] > 0 for r in rows) > 5


def test_null_text_and_key_in_the_query(spark, tmp_path):
    path = str(tmp_path / "sf")
    spark.createDataFrame([(None, "a " * 40), (10, None), (None, None)], "doc_id long, text string").write.parquet(f"{path}/documents.parquet")
    rows = QUERIES["op12_periodic_runs"](spark, path).collect()
    assert sorted((r["n_runs"], r["length"]) for r in rows if r["n_runs"]) == [(1, 40)] and len(rows) == 3
    assert {r["collapsed_sha256"] for r in rows if not r["n_runs"]} == {hashlib.sha256(b"").hexdigest()}
    assert not spark.read.parquet(f"{path}/documents.parquet").filter(F.lit(False)).count()
