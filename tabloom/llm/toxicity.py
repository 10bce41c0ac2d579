"""Toxicity by two class-conditional Kneser-Ney models over words and pairs of words.

Each class has a model of a word given the word before it (the start of the text for the first): the number of the class's
documents with the pair, less a discount; what the discounts take away is given to a backoff distribution that both classes
share, built from continuation counts: after how many different words a word appears, in either class. The difference of the
two log-likelihoods of a whole text, divided by its number of words, is compared. So is its word of the greatest
difference under the models' lower order, where a word's count is the number of different words it follows in the class, less
a discount, over the same shared distribution. Discounts are Kneser and Ney's estimate n1 / (n1 + 2 n2) from the numbers of pairs (or
words) that are counted once and twice, for each class and order; 0.75 where there are none of either. A logistic curve over both
values, learned on documents that are not counted, turns them into a score.

With ``stretch=1`` there is no context: a word's count is the number of the class's documents that use it, the shared distribution
is their sum over the classes, and only the greatest difference is used.

The difference of a pair is the context's own, ``log`` of the ratio of the two backoff weights, unless a class has the pair. So texts
read the contexts' from the table of words, and only counted pairs need a value of their own. All labelled rows are counted, and the curve is
fitted on all of its rows. At most ``part_rows`` words and as many pairs, the most used, are sent to all tasks and looked up where a text is
read; what a text has beyond them is joined by shuffle with the written table of the others. ``sample`` bounds the labelled rows of each class
instead, chosen by the md5 of their keys without reading texts. Every text is scored whole.

Defined results: null and empty texts have the value of a word that both models back off on, and no difference of pairs; without
labelled rows, or with one class only, every score is the share of toxic rows (0 without rows); rows with a null key or label teach
nothing, repeated label rows teach once; repeated documents are rows of their own, all rows of a chosen key are counted; an empty table
has no scores; very long texts are pieces of their own, of about 60 bytes of memory a byte; other columns pass through, and one named
like the new struct is replaced. Words and pairs are compared by 64-bit hashes.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.annotate import annotate
from tabloom.llm.rows import column
from tabloom.llm.text import LETTERED, Words, pieces
from tabloom.session import materialize

PART_ROWS = 1_000_000    # words or pairs that pass the driver and are sent to all tasks: 24 to 32 MB
PIECE = 2 << 20          # bytes of text looked at together
START = 0                # stands for the word before a text's first
BIN = 0.05               # width of the bins of the curve's sample
CLASSES = ("ordinary", "toxic")
COUNTS = "before long, word long, ordinary int, toxic int"
READ = "word double, total double, n long, rest array<struct<pair:boolean,name:long,times:long>>"


def with_before(words: Words, stretch: int):
    """Hashes of the words and of the word before each, START at the start of a text and everywhere without context."""
    hashes = words.hashes()
    before = np.full(len(hashes), START, np.uint64)
    if stretch > 1:
        before[1:] = hashes[:-1]
        before[words.bounds[:-1][words.counts > 0]] = START
    return before, hashes


def gram(before, word):
    """One hash of a pair; ``gram_column`` is the same in Spark."""
    return (before << np.uint64(1) | before >> np.uint64(63)) ^ word


def gram_column():
    return F.shiftleft("before", 1).bitwiseOR(F.shiftrightunsigned("before", 63)).bitwiseXOR(F.col("word"))


def counted(batches, stretch):
    """Document counts of the pairs of a batch by class."""
    for batch in batches:
        for piece in pieces(batch, size=PIECE):
            words = Words(piece.column(0), LETTERED)
            toxic = piece.column(1).to_numpy().astype(bool)
            before, word = with_before(words, stretch)
            _, first, code = np.unique(gram(before, word), return_index=True, return_inverse=True)
            both = np.unique(words.row() * max(1, len(first)) + code)
            row, code = both // max(1, len(first)), both % max(1, len(first))
            by_class = [np.bincount(code[toxic[row] == k], minlength=len(first)).astype(np.int32) for k in (False, True)]
            yield pa.RecordBatch.from_arrays([pa.array(a[first].view(np.int64)) for a in (before, word)] + [pa.array(a) for a in by_class],
                                             names=["before", "word", *CLASSES])


def look_up(parts, wanted: np.ndarray, defaults) -> list:
    """The values of each wanted hash (sorted, distinct) in broadcast parts of (sorted hashes, values...), else the defaults."""
    out = [np.full(len(wanted), d) for d in defaults]
    wanted = wanted.view(np.int64)
    order = np.argsort(wanted, kind="stable")
    for part in parts:
        names, *values = part.value
        if len(names):
            at = np.minimum(np.searchsorted(names, wanted[order]), len(names) - 1)
            hit = names[at] == wanted[order]
            for known, value in zip(out, values):
                known[order[hit]] = value[at[hit]]
    return out


def sorted_parts(table: DataFrame, part_rows: int) -> list:
    """Broadcast parts of a table whose first column is a hash, each sorted by it."""
    out, count = [], table.count()
    first, *others = table.columns
    for part in range(-(-count // part_rows)):
        some = table.filter(F.pmod(F.xxhash64(first), F.lit(-(-count // part_rows))) == part).toArrow()
        names, values = some.column(first).to_numpy(), [some.column(c).to_numpy() for c in others]
        order = np.argsort(names)
        out.append(table.sparkSession.sparkContext.broadcast((names[order], *[v[order] for v in values])))
    return out


def most_used(table: DataFrame, rows: int):
    """The condition on ``uses`` that the most used of a table fulfil, at most ``rows`` of them, and whether that leaves any out."""
    seen = table.groupBy("uses").count().toPandas().sort_values("uses", ascending=False)
    fits = seen["count"].cumsum() <= rows
    return F.col("uses") >= F.lit(int(seen["uses"][fits].min()) if fits.any() else 1 << 62), not fits.all()


class Models:
    """Broadcast parts of (word, log-ratio, log-ratio as a context, 1) and of (pair, what it adds to its context's, 1), the log-ratio of every
    other word, and the curve. ``rest`` is the table of the words and pairs that are not sent: pair, name, ratio, gain."""

    def __init__(self, parts, default, slopes=(0.0, 0.0), shift=0.0, grams=(), rest=None):
        self.parts, self.default, self.slopes, self.shift, self.grams = parts, default, slopes, shift, grams
        self.rest, self.partial = rest, rest is not None

    def __getstate__(self):
        return {**self.__dict__, "rest": None}      # tasks look up only what was sent

    def read(self, texts: pa.Array):
        """For each text the greatest difference of a word and the sum of the differences of its pairs, both of what was sent, the number of
        words, and the names to look up in the table of the others: a word as often as it is a context."""
        out = [[], [], [], []]
        for piece in pieces(pa.RecordBatch.from_arrays([texts], ["text"]), size=PIECE):
            words = Words(piece.column(0), LETTERED)
            row, n = words.row(), piece.num_rows
            before, hashes = with_before(words, 2)
            named, code = np.unique(np.concatenate([[np.uint64(START)], hashes]), return_inverse=True)
            ratios, contexts, known = look_up(self.parts, named, (np.nan if self.partial else self.default, 0.0, 0.0))
            context = np.where(before == np.uint64(START), code[0], code[:-1])
            pair, which = np.unique(gram(before, hashes), return_inverse=True)
            gains, paired = look_up(self.grams, pair, (0.0, 0.0))
            best = np.full(n, np.nan)
            full = np.flatnonzero(words.counts)
            if len(full):
                best[full] = np.fmax.reduceat(ratios[code[1:]], words.bounds[:-1][full])
            out[0].append(pa.array(best, mask=np.isnan(best)))
            out[1].append(pa.array(np.bincount(row, contexts[context] + gains[which], n)))
            out[2].append(pa.array(words.counts.astype(np.int64)))
            out[3].append(self.left_over(n, row, named, known == 0, code[1:], context, pair, paired == 0, which))
        return [pa.concat_arrays(p) for p in out]

    def left_over(self, n, row, named, unknown, word, context, pair, unpaired, which) -> pa.Array:
        if not self.partial:
            unknown, unpaired = np.zeros(len(named), bool), np.zeros(len(pair), bool)
        lone, after, both = unknown[word], unknown[context], unpaired[which]
        owner = np.concatenate([row[lone], row[after], row[both]])
        number = np.concatenate([word[lone], context[after], len(named) + which[both]])
        times = np.concatenate([np.zeros(int(lone.sum()), np.int64), np.ones(int(after.sum() + both.sum()), np.int64)])
        key, code = np.unique(owner * (len(named) + len(pair)) + number, return_inverse=True)
        times = np.bincount(code, times, len(key)).astype(np.int64)
        owner, number = key // (len(named) + len(pair)), key % (len(named) + len(pair))
        names = np.concatenate([named, pair])[number].view(np.int64)
        bounds = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))]).astype(np.int32)
        values = pa.StructArray.from_arrays([pa.array(number >= len(named)), pa.array(names), pa.array(times)], names=["pair", "name", "times"])
        return pa.ListArray.from_arrays(pa.array(bounds), values)

    def evidence(self, texts: pa.Array, stretch: int) -> np.ndarray:
        """The greatest length-normalised log-likelihood difference of any stretch of each text under the models of single words."""
        if self.partial:
            raise ValueError("not all words are at hand: use score_toxicity")
        out = []
        for piece in pieces(pa.RecordBatch.from_arrays([texts], ["text"]), size=PIECE):
            words = Words(piece.column(0), LETTERED)
            named, code = np.unique(words.hashes(), return_inverse=True)
            total = np.concatenate([[0], np.cumsum(look_up(self.parts, named, (self.default,))[0][code])])
            row = words.row()
            end = np.minimum(np.arange(len(row)) + stretch, words.bounds[1:][row])
            begin = np.maximum(end - stretch, words.bounds[:-1][row])
            mean = (total[end] - total[begin]) / np.maximum(end - begin, 1)
            best = np.full(piece.num_rows, self.default)
            full = np.flatnonzero(words.counts)
            if len(full):
                best[full] = np.maximum.reduceat(mean, words.bounds[:-1][full])
            out.append(best)
        return np.concatenate(out) if out else np.zeros(0)


def read_texts(docs: DataFrame, models: Models, text="text", into="t", keep=None) -> DataFrame:
    """``docs`` with a struct ``into``: the greatest difference of a word, and the difference of the whole text by its number of words."""
    read = annotate(docs, lambda: models.read, READ, into, text, keep)
    names = read.columns
    kept = [f"c{i}" for i in range(len(names) - 1)]
    read = read.toDF(*kept, "t")
    best, total = F.col("t.word"), F.col("t.total")
    if models.rest is not None:
        # written, as its numbers join the values back to the texts
        read = materialize(read.withColumn("row", F.monotonically_increasing_id()), "read")
        asked = read.select("row", F.explode("t.rest").alias("x")).select("row", "x.*").join(models.rest, ["pair", "name"], "left")
        found = asked.groupBy("row").agg(F.max(F.when(~F.col("pair"), F.coalesce("ratio", F.lit(models.default)))).alias("best"),
                                         F.sum(F.col("times") * F.coalesce("gain", F.lit(0.0))).alias("total"))
        read = read.join(found, "row", "left")
        best, total = F.greatest(best, "best"), total + F.coalesce("total", F.lit(0.0))
    both = F.struct(F.coalesce(best, F.lit(models.default)).alias("word"), (total / F.greatest("t.n", F.lit(1))).alias("likelihood"))
    return read.select(*kept, both.alias("t")).toDF(*names)


def discounts(counts: DataFrame, fixed) -> dict:
    """The discount of each class: the given one, or Kneser and Ney's estimate from its counts of counts."""
    if fixed is not None:
        return dict.fromkeys(CLASSES, fixed)
    seen = counts.agg(*[F.count_if(F.col(c) == n).alias(f"{c}{n}") for c in CLASSES for n in (1, 2)]).first()
    return {c: seen[f"{c}1"] / (seen[f"{c}1"] + 2 * seen[f"{c}2"]) if seen[f"{c}1"] and seen[f"{c}2"] else 0.75 for c in CLASSES}


def fit_models(docs: DataFrame, labels: DataFrame, curve, label="toxic", key="doc_id", text="text", discount=None, stretch=2,
               part_rows=PART_ROWS, sample=None) -> Models:
    """The two models from all labelled rows of ``docs``; rows where ``curve`` (a condition on the column ``key``) holds only fit the curve.

    With ``sample``, at most so many rows of each class are counted, and as many fit the curve."""
    if stretch not in (1, 2):
        raise ValueError("the models have 1 or 2 words")
    marked = labels.select(column(labels, key).alias(key), (column(labels, label).cast("int") == 1).cast("int").alias("label")).filter("label IS NOT NULL")
    marked = marked.withColumn("curve", F.coalesce(curve, F.lit(False)))
    texts = docs.select(column(docs, key).alias(key), column(docs, text).cast("string").alias("text"))
    known = docs.select(column(docs, key).alias(key)).join(marked, key)
    if sample is None:
        rows = texts.join(marked.distinct(), key)
    else:
        order = [F.md5(F.col(f"`{key}`").cast("string")), F.col(f"`{key}`"), F.col("label")]
        chosen = [known.filter(which).orderBy(*order).limit(sample) for which in ("NOT curve AND label = 0", "NOT curve AND label = 1", "curve")]
        rows = texts.join(F.broadcast(materialize(chosen[0].unionByName(chosen[1]).unionByName(chosen[2]).distinct(), "chosen")), key)
    counting = rows.filter("NOT curve").select("text", "label")
    pairs = counting.mapInArrow(lambda batches: counted(batches, stretch), COUNTS).groupBy("before", "word")
    pairs = materialize(pairs.agg(*[F.sum(c).alias(c) for c in CLASSES]), "pairs")
    shared = F.col("ordinary") + F.col("toxic")
    if stretch > 1:
        counts = pairs.groupBy("word").agg(*[F.count_if(F.col(c) > 0).alias(c) for c in CLASSES], F.count("*").alias("shared"))
    else:
        counts = pairs.select("word", *CLASSES, shared.alias("shared"))
    counts = materialize(counts, "words")
    taken = discounts(counts, discount)
    sums = counts.agg(F.sum("shared").alias("shared"), *[F.sum(c).alias(c) for c in CLASSES],
                      *[F.sum(F.least(F.col(c).cast("double"), F.lit(float(taken[c])))).alias(f"taken_{c}") for c in CLASSES]).first()
    if not sums["ordinary"] or not sums["toxic"]:
        share = known.agg(F.avg("label")).first()[0] or 0.0
        return Models([], 0.0, shift=float(np.log(share / (1 - share))) if 0 < share < 1 else (40.0 if share else -40.0))
    backoff = F.col("shared") / F.lit(float(sums["shared"]))
    of_class = [F.log((F.greatest(F.col(c) - F.lit(float(taken[c])), F.lit(0.0)) + backoff * F.lit(float(sums[f"taken_{c}"]))) / F.lit(float(sums[c]))) for c in CLASSES]
    default = float(np.log(sums["taken_toxic"] / sums["toxic"]) - np.log(sums["taken_ordinary"] / sums["ordinary"]))
    # words that both classes' discounts take away whole back off in both models, where the shared distribution cancels out: they need no entry
    ratios = counts.filter(" OR ".join(f"{c} > {float(taken[c])!r}D" for c in CLASSES)).select("word", (of_class[1] - of_class[0]).alias("ratio"), "shared")
    grams, rest = [], []
    if stretch > 1:
        contexts, table = pair_models(pairs, counts, backoff, discounts(pairs, discount))
        often, more = most_used(table, part_rows)
        grams = sorted_parts(table.filter(often).select("gram", "value", F.lit(1.0).alias("known")), part_rows)
        if more:
            rest.append(table.filter(~often).select(F.lit(True).alias("pair"), F.col("gram").alias("name"), F.lit(0.0).alias("ratio"), F.col("value").alias("gain")))
        uses = sum(F.col(f"all_{c}") for c in CLASSES)
        ratios = ratios.join(contexts.select(F.col("before").alias("word"), "context", uses.alias("followed")), "word", "full")
    else:
        ratios = ratios.withColumns({"context": F.lit(0.0), "followed": F.lit(0)})
    uses = F.when(F.col("word") == START, F.lit(1 << 62)).otherwise(F.coalesce("shared", F.lit(0)) + F.coalesce("followed", F.lit(0)))   # START is always sent
    ratios = materialize(ratios.select("word", F.coalesce("ratio", F.lit(default)).alias("ratio"), F.coalesce("context", F.lit(0.0)).alias("context"), uses.alias("uses")), "ratios")
    often, more = most_used(ratios, part_rows)
    if more:
        rest.append(ratios.filter(~often).select(F.lit(False).alias("pair"), F.col("word").alias("name"), "ratio", F.col("context").alias("gain")))
    rest = rest[0].unionByName(rest[-1]) if len(rest) > 1 else rest[0] if rest else None
    models = Models(sorted_parts(ratios.filter(often).select("word", "ratio", "context", F.lit(1.0).alias("known")), part_rows), default, grams=grams, rest=rest)
    seen = read_texts(rows.filter("curve").select("text", "label"), models, keep=["label"])
    bins = seen.groupBy(F.round(F.col("t.word") / BIN).alias("word"), F.round(F.col("t.likelihood") / BIN).alias("likelihood"), "label").count().toPandas()
    models.slopes, models.shift = logistic(bins[["word", "likelihood"]].to_numpy() * BIN, bins["label"].to_numpy(), bins["count"].to_numpy())
    return models


def pair_models(pairs: DataFrame, counts: DataFrame, backoff, taken: dict):
    """(contexts: before, context; table of pairs: gram, value)."""
    contexts = pairs.groupBy("before").agg(*[F.sum(c).alias(f"all_{c}") for c in CLASSES], *[F.count_if(F.col(c) > 0).alias(f"kinds_{c}") for c in CLASSES])
    # a class that lacks the context backs off whole
    left = [F.when(F.col(f"all_{c}") > 0, F.lit(float(taken[c])) * F.col(f"kinds_{c}") / F.col(f"all_{c}")).otherwise(1.0) for c in CLASSES]
    contexts = materialize(contexts.select("before", *[F.col(f"all_{c}") for c in CLASSES], *[v.alias(f"left_{c}") for v, c in zip(left, CLASSES)],
                                           (F.log(left[1]) - F.log(left[0])).alias("context")), "contexts")
    joined = pairs.join(contexts, "before").join(counts.select("word", backoff.alias("backoff")), "word")
    of_class = [F.log(F.when(F.col(f"all_{c}") > 0, F.greatest(F.col(c) - F.lit(float(taken[c])), F.lit(0.0)) / F.col(f"all_{c}")).otherwise(0.0)
                      + F.col(f"left_{c}") * F.col("backoff")) for c in CLASSES]
    table = joined.select(gram_column().alias("gram"), (of_class[1] - of_class[0] - F.col("context")).alias("value"),
                          (F.col("ordinary") + F.col("toxic")).alias("uses"))
    return contexts, materialize(table, "grams")


def logistic(values, labels, counts):
    """Slopes and shift of the logistic curve by Newton steps, with a small penalty on all."""
    values = np.asarray(values, float)
    if len(np.unique(labels)) < 2:
        return (1.0, *[0.0] * (values.shape[1] - 1)), float(-np.median(values[:, 0])) if len(values) else 0.0
    at = np.zeros(values.shape[1] + 1)
    x = np.column_stack([values, np.ones(len(values))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -40, 40)))
        slope = x.T @ (counts * (labels - p)) - 1e-3 * at
        at = at + np.linalg.solve((x * (counts * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(len(at)), slope)
    return tuple(float(v) for v in at[:-1]), float(at[-1])


def score_toxicity(docs: DataFrame, models: Models, text="text", into="toxicity", keep=None, threshold=0.5) -> DataFrame:
    """``docs`` with a struct ``into``: score (0 to 1), predicted (1 from ``threshold`` on), the word evidence and the likelihood of pairs."""
    read = read_texts(docs, models, text, into, keep)
    names = read.columns
    read = read.toDF(*[f"c{i}" for i in range(len(names) - 1)], "t")
    odds = F.lit(models.slopes[0]) * F.col("t.word") + F.lit(models.slopes[1]) * F.col("t.likelihood") + F.lit(models.shift)
    score = 1 / (1 + F.exp(-F.least(F.greatest(odds, F.lit(-40.0)), F.lit(40.0))))
    found = F.struct(score.alias("score"), (score >= threshold).cast("int").alias("predicted"), F.col("t.word").alias("evidence"), F.col("t.likelihood").alias("likelihood"))
    return read.select(*[f"c{i}" for i in range(len(names) - 1)], found.alias("t")).toDF(*names)
