"""The operators against brute force on small tables, with nulls, empty and long texts, ties, repeats and clashing names."""

import hashlib
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tabloom.llm import decontaminate, language, mixing, near_dedup, quality, repeats, secrets, tokens, topk, toxicity
from tabloom.llm.suffix_order import suffix_order

WORDS = [f"w{i}" for i in range(40)]
EDGES = [(900, None), (901, ""), (902, "  \n\t "), (903, "one"), (904, "one two"), (None, "null key text"), (905, "1234 5678 !!")]
SCHEMA = "doc_id long, text string, lang string, source string, key string, language string, s string, a string"


def texts_with_copies():
    random.seed(3)
    out = list(EDGES)
    for i in range(30):
        words = random.choices(WORDS, k=random.randint(20, 120))
        out.append((i, " ".join(words)))
        if i % 3 == 0:
            out.append((100 + i, " ".join(words)))
            out.append((200 + i, " ".join(words + ["end"])))
            out.append((300 + i, " ".join(["start"] + words[: len(words) // 2])))
    out += [(7, out[10][1]), (950, "long " * 20000)]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, "en" if (k or 0) % 2 else None, None if (k or 0) % 5 == 0 else f"s{(k or 0) % 3}", "x", "y", "z", "q") for k, t in texts_with_copies()]
    return spark.createDataFrame(rows, SCHEMA)


def empty(docs):
    return docs.filter("false")


def test_suffix_order():
    random.seed(1)
    for _ in range(500):
        s = [random.randint(1, random.choice([1, 2, 4])) for _ in range(random.randint(0, 25))] + [0]
        assert suffix_order(s) == sorted(range(len(s)), key=lambda i: s[i:])


@pytest.mark.parametrize("bucket", [1, 2048])
def test_repeats(docs, bucket):
    rows = docs.select("doc_id", "text").collect()
    count = Counter(b[i:i + 200] for b in ((r.text or "").encode() for r in rows) for i in range(len(b) - 199))
    want = []
    for r in rows:
        b = (r.text or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - 199):
            if count[b[i:i + 200]] > 1:
                gone[i:i + 200] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        want.append((r.doc_id, len(b), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum() + gone[0]) if len(b) else 0, hashlib.sha256(kept).hexdigest()))
    got = repeats.remove_repeats(docs, bucket=bucket).collect()
    assert Counter((g.doc_id, g.n_bytes, g.n_removed, len(g.removed), g.kept_sha256) for g in got) == Counter(want)
    assert repeats.remove_repeats(empty(docs)).count() == 0


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return {tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_near_duplicates(docs, width, percent):
    rows = docs.select("doc_id", "text").collect()
    sets = [shingles(r.text, width) for r in rows]
    part = list(range(len(rows)))

    def root(i):
        while part[i] != i:
            i = part[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                part[root(i)] = root(j)
    least = {}
    for i, r in enumerate(rows):
        if r.doc_id is not None:
            least[root(i)] = min(least.get(root(i), r.doc_id), r.doc_id)
    want = [(r.doc_id, len(sets[i]), least.get(root(i)), r.doc_id is not None and least.get(root(i)) == r.doc_id) for i, r in enumerate(rows)]
    assert Counter(map(tuple, near_dedup.near_duplicates(docs, width=width, percent=percent).collect())) == Counter(want)
    assert near_dedup.near_duplicates(empty(docs)).count() == 0


def test_components_of_chains(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 102)], "a long, b long")
    assert {tuple(r) for r in near_dedup.components(links).collect()} == {(i, 0) for i in range(41)} | {(100, 100), (101, 100), (102, 100)}


def test_top_k(spark):
    random.seed(5)
    vectors = [(i, [random.choice([-1.5, -0.25, 0.0, 0.3, 2.0]) for _ in range(4)]) for i in range(120)]
    vectors += [(0, [0.3, 0.3, 0.3, 0.3]), (200, None), (201, [1.0, None, 1.0, 1.0]), (202, [float("nan")] * 4), (203, [float("inf")] * 4),
                (None, [1.0] * 4), (204, [1.0, 1.0]), (205, []), (250, [1e9, -1e9, 1e9, 3.0])]
    table = spark.createDataFrame([(*v, 1) for v in vectors], "vec_id long, embedding array<double>, row int").repartition(3)
    good = [(k, [int(np.floor(256 * x)) for x in v]) for k, v in vectors if k is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = Counter()
    for n, (k, v) in enumerate(good):
        if k % 50 == 0:
            found = sorted((-sum(a * b for a, b in zip(v, w)), o) for m, (o, w) in enumerate(good) if m != n and len(w) == len(v))[:5]
            want.update((k, rank, o, -s) for rank, (s, o) in enumerate(found, 1))
    for part_rows in (1, 50_000):
        got = topk.top_inner_products(table, F.col("key") % 50 == 0, part_rows=part_rows).collect()
        assert Counter(map(tuple, got)) == want
    assert topk.top_inner_products(table.filter("false"), F.col("key") % 50 == 0).count() == 0


def greedy(word, starts, following):
    node, at, n = starts, 0, 0
    while at < len(word):
        size = next((s for s in range(len(word) - at, 0, -1) if word[at:at + s] in node), 0)
        if not size:
            return -1
        at, n, node = at + size, n + 1, following
    return n


def test_automaton_counts_greedy_pieces():
    random.seed(2)
    for _ in range(60):
        pool = ["".join(random.choices("ab", k=random.randint(1, 5))).encode() for _ in range(14)]
        starts, following = set(pool[:7]), set(pool[7:])
        automaton = tokens.Automaton(sorted(starts), sorted(following))
        words = ["".join(random.choices("abc", [5, 5, 1], k=random.randint(1, 9))).encode() for _ in range(40)]
        ends = np.cumsum([len(w) for w in words])
        got = automaton.count(np.frombuffer(b"".join(words), np.uint8), ends - [len(w) for w in words], ends)
        assert got.tolist() == [greedy(w, starts, following) for w in words]


def test_token_counts(docs):
    starts, following = map(set, tokens.read_vocabulary())
    for r in tokens.count_tokens(docs.filter("doc_id < 950 OR doc_id IS NULL"), into="s").collect():
        words = (r.text or "").encode().split()
        counts = [greedy(w, starts, following) for w in words]
        assert tuple(r.s) == (len(words), sum(abs(c) for c in counts), sum(c < 0 for c in counts))
    assert tokens.count_tokens(empty(docs)).count() == 0


def test_language(spark, docs):
    random.seed(4)
    made = {"aa": "lorna tisk velm orka".split(), "bb": "dubi ñopa çelu wexi".split()}
    train = spark.createDataFrame([(i, " ".join(random.choices(made[v], k=12)), v) for i, v in enumerate(["aa", "bb"] * 30)], "doc_id long, text string, lang string")
    field = language.fit_languages(train)
    cases = [("lorna velm tisk orka lorna velm", "aa"), ("dubi çelu wexi", "bb"), (None, "und"), ("", "und"), ("12 ¿?! 34", "und")]
    got = language.label_languages(spark.createDataFrame(cases, "text string, want string"), field).collect()
    assert all(r.language.lang == r.want and 0 <= r.language.score <= 1 for r in got)
    mixed = language.label_languages(spark.createDataFrame([("lorna velm tisk orka dubi wexi çelu ñopa",)], "text string"), field, with_spans=True).first()
    assert [(s.start, s.end, s.lang) for s in mixed.language.spans] == [(0, 20, "aa"), (21, 40, "bb")]
    nothing = language.fit_languages(empty(docs))
    assert {r.language.lang for r in language.label_languages(docs, nothing).collect()} == {"und"}
    assert language.label_languages(empty(docs), field).count() == 0


def test_forward_backward_sums_over_all_paths():
    field = language.Field(["a", "b"])
    field.pairs = np.array([[0.4, -0.3], [0.1, 0.7]])
    scores, bounds = np.random.default_rng(0).normal(size=(7, 2)), np.array([0, 4, 4, 7])
    got, _ = field.posteriors(scores, bounds)
    for a, b in ((0, 4), (4, 7)):
        total, marginal = 0, np.zeros((b - a, 2))
        for path in np.ndindex(*[2] * (b - a)):
            weight = np.exp(sum(scores[a + t, y] for t, y in enumerate(path)) + sum(field.pairs[x, y] for x, y in zip(path, path[1:])))
            total += weight
            for t, y in enumerate(path):
                marginal[t, y] += weight
        assert np.allclose(got[a:b], marginal / total)


def test_quality_votes():
    random.seed(6)
    texts = pa.array(["".join(random.choices("abcdef ", k=50)) for _ in range(60)], pa.large_string())
    counts = quality.features(texts)
    voter = quality.Neighbours(counts[:40], np.arange(40) % 2)
    latent = voter.latent(counts)
    for i, score in enumerate(voter.vote(counts, 5, 2, block=7)):
        cosine = latent[i] @ voter.vectors.T
        best = np.argsort(-cosine, kind="stable")[:5]
        weight = np.maximum(cosine[best].astype(float), 0) ** 2
        assert abs(score - (weight @ voter.labels[best]) / weight.sum()) < 1e-4


def test_quality_and_toxicity_on_edges(spark, docs):
    labels = spark.createDataFrame([(k, (k or 0) % 2, int((k or 0) % 4 == 0)) for k, _ in texts_with_copies()] + [(1, None, None)], "doc_id long, quality int, toxic int")
    voter = quality.fit_neighbours(docs, labels)
    for r in quality.score_quality(docs, voter, into="s").collect():
        assert 0 <= r.s.score <= 1 and r.s.predicted == int(r.s.score >= 0.3)
    for train, mark in ((docs, labels), (empty(docs), labels), (docs, labels.filter("toxic = 0"))):
        models = toxicity.fit_models(train, mark, F.col("doc_id") % 5 == 1, part_rows=3)
        for r in toxicity.score_toxicity(docs, models, into="s").collect():
            assert 0 <= r.s.score <= 1 and r.s.predicted == int(r.s.score >= 0.5)
    assert quality.score_quality(empty(docs), quality.fit_neighbours(empty(docs), labels)).count() == 0


def test_toxicity_models_by_definition(spark):
    rows = [(i, f"common word{i % 3} " + ("vile" if i % 2 else "kind")) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    models = toxicity.fit_models(docs, labels, F.lit(False), discount=2, stretch=1)
    counts = [Counter(w for i, t in rows if i % 2 == k for w in set(t.split())) for k in (0, 1)]
    total = [sum(c.values()) for c in counts]

    def ratio(word):
        shared = (counts[0][word] + counts[1][word]) / sum(total)
        p = [(max(c[word] - 2, 0) + shared * sum(min(v, 2) for v in c.values())) / n for c, n in zip(counts, total)]
        return np.log(p[1] / p[0])

    got = models.evidence(pa.array(["vile", "kind", "common", "unseen", None], pa.large_string()), 1)
    default = np.log(sum(min(v, 2) for v in counts[1].values()) / total[1]) - np.log(sum(min(v, 2) for v in counts[0].values()) / total[0])
    assert np.allclose(got, [ratio("vile"), ratio("kind"), ratio("common"), default, default])


def test_toxicity_pairs_by_definition(spark):
    """Pairs, continuations and estimated discounts against plain Python; rare words and toxic pairs of ordinary words speak."""
    random.seed(12)
    plain, seen = WORDS[:12], []
    for i in range(60):
        words = random.choices(plain, k=8)
        seen.append((i, " ".join(words + (["go", "away"] if i % 2 else ["away", "go"]) + (["rare"] if i in (1, 3) else [])), i % 2))
    docs = spark.createDataFrame([r[:2] for r in seen], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in seen] + [(None, 1)], "doc_id long, toxic int")
    pairs = [Counter(p for _, t, y in seen if y == k for w in [t.split()] for p in set(zip(["^", *w], w))) for k in (0, 1)]
    follows = [Counter(w for _, w in c) for c in pairs]
    shared = Counter(w for _, w in set(pairs[0]) | set(pairs[1]))
    ps = {w: n / sum(shared.values()) for w, n in shared.items()}

    def discount(c):
        n = Counter(c.values())
        return n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.75

    def word(w):
        if w not in ps:
            return np.log(discount(follows[1]) * len(follows[1]) / sum(follows[1].values())) - np.log(discount(follows[0]) * len(follows[0]) / sum(follows[0].values()))
        p = [(max(c[w] - discount(c), 0) + discount(c) * len(c) * ps[w]) / sum(c.values()) for c in follows]
        return np.log(p[1] / p[0])

    def pair(u, w):
        p, base = [], ps.get(w, 1.0)
        for c in pairs:
            own = {x: n for (v, x), n in c.items() if v == u}
            p.append((max(own.get(w, 0) - discount(c), 0) + discount(c) * len(own) * base) / sum(own.values()) if own else base)
        return np.log(p[1] / p[0])

    texts = ["go away w1 W2", "away go w1 w2", "rare", "unseen words here", "w3 unseen w4", None, "", "go away w1 W2"] + [t for _, t, _ in seen[:9]]
    models = toxicity.fit_models(docs, labels, F.col("doc_id") % 5 == 9, part_rows=5)
    asked = spark.createDataFrame([(t, "c") for t in texts], "text string, c0 string").repartition(3)
    got = toxicity.score_toxicity(asked, models, into="t").collect()
    assert len(got) == len(texts) and asked.columns == ["text", "c0"]
    for r in got:
        words = (r.text or "").lower().split()
        assert np.isclose(r.t.evidence, max(map(word, words), default=word("unseen")))
        assert np.isclose(r.t.likelihood, sum(map(pair, ["^", *words], words)) / max(1, len(words)))
    value = {r.text: r.t for r in got}
    assert value["go away w1 W2"].likelihood > value["away go w1 w2"].likelihood + 0.1      # the same ordinary words
    assert value["rare"].evidence > value["unseen words here"].evidence + 0.1              # two documents in all


def test_toxicity_counts_the_sample_of_each_class(spark):
    """The first keys of each class in md5 order are counted, and no others; every text is scored, parts or not."""
    random.seed(21)
    rows = [(i, " ".join(random.choices(WORDS, k=12))) for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = [(i, int(i % 3 == 0)) for i in range(90)]
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    first = lambda k: sorted((i for i, y in marks if y == k and i % 5), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())[:7]
    some = labels.filter(F.col("doc_id").isin(first(0) + first(1)) | (F.col("doc_id") % 5 == 0))
    curve = F.col("doc_id") % 5 == 0
    bounded = toxicity.fit_models(docs, labels, curve, sample=7)
    curved = sorted((i for i, _ in marks if i % 5 == 0), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())[:7]
    some = some.filter((F.col("doc_id") % 5 != 0) | F.col("doc_id").isin(curved))
    whole = toxicity.fit_models(docs, some, curve, part_rows=4)
    got, want = ({r.doc_id: tuple(r.t) for r in toxicity.score_toxicity(docs, m, into="t").collect()} for m in (bounded, whole))
    assert got.keys() == want.keys() and all(np.allclose(got[k], want[k]) for k in got)
    assert toxicity.score_toxicity(docs.filter("false"), bounded, into="t").collect() == []


def test_toxicity_counts_every_labelled_row(spark):
    """More rows of a class than the former sample: the last of them in md5 order teaches the one word that tells; the table of words and pairs that are
    not sent gives the same scores."""
    order = sorted(range(8_300), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())
    told = set(order[8_200:])
    rows = [(i, f"plain w{i % 7} " + ("grim" if i in told else "calm"), 1) for i in range(8_300)] + [(9_000 + i, f"plain w{i % 7} calm", 0) for i in range(300)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    asked = spark.createDataFrame([(0, "grim"), (1, "calm"), (2, "calm w1 unseen grim"), (3, None), (4, "")], "doc_id long, text string")
    got = []
    for part_rows in (1_000_000, 6):
        models = toxicity.fit_models(docs, labels, F.col("doc_id") % 50 == 1, part_rows=part_rows)
        assert (models.rest is not None) == (part_rows == 6)
        got.append({r.doc_id: tuple(r.t) for r in toxicity.score_toxicity(asked, models, into="t").collect()})
    assert got[0][0][2] > got[0][1][2] + 0.3
    assert got[0].keys() == got[1].keys() and all(np.allclose(got[0][k], got[1][k]) for k in got[0])


def test_lists_are_read_only_as_far_as_needed():
    """Skewed lists stop at the first depths, with the answer of all scores; lists without skew are read on."""
    rng = np.random.default_rng(5)
    for spread, some in ((3.0, True), (0.0, False)):
        vectors = np.floor(np.exp(rng.normal(0, 1, (2000, 12)) + spread * rng.normal(0, 1, (2000, 1))) * 10)
        queries, keys = np.floor(rng.random((9, 12)) * 50), rng.permutation(2000)
        lists = topk.Lists(vectors)
        query, row, score = lists.top(queries, keys, np.full(9, -1), 5)
        whole = queries @ vectors.T
        for q in range(9):
            want = np.lexsort((keys, -whole[q]))[:5]
            assert row[query == q].tolist() == want.tolist() and score[query == q].tolist() == whole[q][want].tolist()
        assert lists.entries < vectors.size * (0.1 if some else 2)
    signed = np.floor(rng.normal(0, 40, (300, 6)))
    query, row, _ = topk.Lists(signed).top(signed[:20], np.arange(300), np.arange(20), 3)
    whole = signed[:20] @ signed.T
    whole[np.arange(20), np.arange(20)] = -np.inf
    assert [row[query == q].tolist() for q in range(20)] == [np.lexsort((np.arange(300), -whole[q]))[:3].tolist() for q in range(20)]


def test_decontamination_mixing_and_secrets_on_edges(spark, docs):
    bench = spark.createDataFrame([(1, "w1 w2 W3"), (1, None), (None, ""), (2, "one two")], "item_id long, text string")
    marked = {r.doc_id: r.overlap for r in decontaminate.mark_contaminated(docs, bench).collect()}
    assert marked[904].contaminated and marked[904].items == ["2"] and marked[900].n_words == 0
    assert decontaminate.mark_contaminated(empty(docs), bench).count() == 0
    mixed = mixing.mix_sources(docs).collect()
    assert len(mixed) == docs.count() and all(0 <= r.taken <= 2 * r.size and r.target >= 0 for r in mixed)
    sources = {r.source: (r.source_size, r.target) for r in mixed}
    assert abs(sum(t for _, t in sources.values()) - 1.5 * sum(s for s, _ in sources.values())) < 1e-6
    assert mixing.mix_sources(empty(docs)).count() == 0
    keys = spark.createDataFrame([(i, t, f"s{i}") for i, t in enumerate(["token: abc12345", "token: abc12345", "TOKEN = 'abc12345'", "password=Zx81qPl0v!", None, ""])], "doc_id long, text string, source string")
    verdicts = {r.doc_id: [f.verdict for f in r.secrets] for r in secrets.scan_secrets(keys).collect()}
    assert verdicts == {0: ["example"], 1: ["example"], 2: ["example"], 3: ["live"], 4: [], 5: []}
    assert secrets.scan_secrets(empty(docs)).count() == 0


def test_repeats_write_no_anchor_that_occurs_once(spark, monkeypatch, tmp_path):
    """Texts of their own beside a passage in two of them: only contexts around the passage are written again; no write leaves shuffle files."""
    rng, seen = random.Random(3), {}
    text = lambda n: "".join(rng.choices("abcdefgh ", k=n))
    passage = text(400)
    docs = spark.createDataFrame([(i, text(3000)) for i in range(20)] + [(100 + i, text(600) + passage + text(600)) for i in range(2)], "doc_id long, text string")
    write = repeats.materialize
    monkeypatch.setattr(repeats, "materialize", lambda df, label: seen.setdefault(label, write(df, label)))
    got = {r.doc_id: r.n_removed for r in repeats.remove_repeats(docs).collect()}
    assert all(n >= 400 for k, n in got.items() if k >= 100) and not any(n for k, n in got.items() if k < 100)
    assert 0 < seen["contexts"].count() < 40 < 500 < seen["anchors"].count()


def test_near_copies_that_never_link_make_no_pairs(spark):
    """Texts that share four fifths of their words with all others, and pairs among them that do link: only those meet."""
    rng = random.Random(8)
    base = [f"b{i}" for i in range(300)]
    rows = []
    for i in range(60):
        words = list(base)
        for at in rng.sample(range(300), 22):
            words[at] = f"own{i}-{at}"
        rows.append((i, " ".join(words)))
        if i % 6 == 0:
            words[rng.randrange(300)] = f"more{i}"
            rows.append((1000 + i, " ".join(words)))
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.component_id) for r in found} == {(k, k - 1000 if k >= 1000 else k) for k, _ in rows}
    sets = spark.createDataFrame([(k, k, sorted(hash(s) for s in shingles(t, 3))) for k, t in rows], "id long, part long, items array<long>")
    pairs = near_dedup.under_rare_shingles(near_dedup.rare_shingles(sets, 85), 85).collect()
    assert {(i, 1000 + i) for i in range(0, 60, 6)} <= set(map(tuple, pairs)) and len(pairs) < 200


def test_sets_a_little_too_far_apart_make_no_pairs(spark):
    """A large group of sets just below the similarity, all with rare shingles in common: pairs grow with the links, not with the square."""
    rng = random.Random(4)
    base = rng.sample(range(1 << 60), 110)
    sets = [[x for x in base if x not in set(rng.sample(base, 9))] + rng.sample(range(1 << 60), 2) for _ in range(120)]
    sets += [s[1:] for s in sets[:10]]
    table = spark.createDataFrame([(i, i, s) for i, s in enumerate(sets)], "id long, part long, items array<long>").repartition(3)
    pairs = set(map(tuple, near_dedup.under_rare_shingles(near_dedup.rare_shingles(table, 85), 85).collect()))
    links = {(a, b) for b in range(len(sets)) for a in range(b) if 100 * len(set(sets[a]) & set(sets[b])) >= 85 * len(set(sets[a]) | set(sets[b]))}
    assert links <= pairs and {(i, 120 + i) for i in range(10)} <= links and len(pairs) < 120 * 119 / 2 / 4


@pytest.mark.parametrize("percent", [60, 85, 100])
def test_rare_shingles_lose_no_similar_pair(spark, percent):
    rng = random.Random(percent)
    sets = [set(rng.sample(range(60), rng.randint(1, 40))) for _ in range(80)]
    sets += [{x + (x % 9 == 0) * 1000 for x in s} for s in sets[:40]] + [set(s) for s in sets[:10]]
    table = spark.createDataFrame([(i, i, [x * 7919 for x in sorted(s)]) for i, s in enumerate(sets)], "id long, part long, items array<long>").repartition(3)
    pairs = set(map(tuple, near_dedup.under_rare_shingles(near_dedup.rare_shingles(table, percent), percent).collect()))
    want = {(a, b) for b in range(len(sets)) for a in range(b) if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])}
    assert want <= pairs and len(want) >= 10


def test_repeats_order_what_an_anchors_strings_share_as_one_symbol(monkeypatch):
    """Two near copies of a context: few symbols are ordered, and the repeated strings are those of the bytes."""
    rng, ordered = random.Random(5), []
    text = lambda n: "".join(rng.choices("abcdefgh ", k=n)).encode()
    shared = text(232)
    contexts = [text(46) + shared + text(58), text(46) + shared + text(58)]      # the gram is at 136, the shared bytes are 46 to 278
    order = repeats.suffix_order
    monkeypatch.setattr(repeats, "suffix_order", lambda s: ordered.append(len(s)) or order(s))
    got = repeats.order_bucket(200)(bucket_of(contexts, split=False)).to_pylist()
    assert sorted((r["row"], r["start"], r["end"]) for r in got) == [(0, 46, 278), (1, 46, 278)]
    assert sum(ordered) < 120


def bucket_of(contexts, split):
    n = len(contexts)
    kinds = {"anchor": pa.int64(), "bucket": pa.int64(), "split": pa.bool_(), "row": pa.int64(), "start": pa.int32(), "at": pa.int32(), "data": pa.binary()}
    values = [[7] * n, [7] * n, [split] * n, list(range(n)), [0] * n, [136] * n, contexts]
    return pa.table([pa.array(v, t) for v, t in zip(values, kinds.values())], names=list(kinds))


def test_repeats_of_a_block_are_told_once():
    """Contexts of a split anchor: other blocks learn a string that is repeated in its block from one row, the others from theirs."""
    rng = random.Random(6)
    text = lambda n: "".join(rng.choices("abcdefgh ", k=n)).encode()
    shared = text(236)
    contexts = [text(99) + b"%d" % i + shared for i in range(6)]
    told = [r for r in repeats.order_bucket(200)(bucket_of(contexts, split=True)).to_pylist() if not r["repeated"]]
    once = [r for r in told if r["end"] == r["start"]]
    assert len(once) == 37 and sum(r["end"] > r["start"] for r in told) == 6 * 100 and len({r["hash"] for r in told}) == 637


@pytest.mark.parametrize("bucket", [2, 2048])
def test_repeats_around_passages_in_many_surroundings(spark, bucket):
    """Passages, near copies and periods among texts of their own, against brute force."""
    rng, rows = random.Random(9), []
    text = lambda n, letters="abcdefgh ": "".join(rng.choices(letters, k=n))
    passage = text(500)
    for i in range(30):
        at, changed = rng.randint(0, 499), passage
        if i % 3:
            changed = passage[:at] + "#" * (i % 3) + passage[at + 1:]
        rows.append((i, text(rng.randint(0, 90)) + changed[rng.randint(0, 80):] + text(rng.randint(0, 90)) + text(i % 4, "x") * 70))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    count = Counter(t[i:i + 200] for _, t in rows for i in range(len(t) - 199))
    want = {k: len({x for i in range(len(t) - 199) if count[t[i:i + 200]] > 1 for x in range(i, i + 200)}) for k, t in rows}
    assert {r.doc_id: r.n_removed for r in repeats.remove_repeats(docs, bucket=bucket).collect()} == want


def test_decontamination_holds_little_beside_its_texts():
    """A batch of texts with few test words takes less than 12 bytes of memory a byte of text beside the pieces."""
    texts = pa.array(["abcde fg " * 1000] * 2000)
    windows = decontaminate.Windows(["1"], ["one two three"], 13)
    windows.hits(texts.slice(0, 200))
    tracemalloc.start()
    counts, hit, pairs = windows.hits(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert counts.tolist() == [2000] * 2000 and not hit.any() and not len(pairs) and peak < 12 * texts.nbytes
