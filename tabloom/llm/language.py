"""Language identification by a linear-chain conditional random field over the words of a text.

Every word has affixes, letter n-grams, its own form and its lexicon entry as features; label-to-label weights are learned
with them. Forward-backward gives each word's distribution over languages, so a text that switches languages is labelled
word by word; the language of a text is the one with most expected words. The certainty of a text is the mean, over its words, of
the probability of each word's likeliest language: near 1 where every word is of some language learned, in a text of two as well,
and low where the field has not seen the like. With one language learned it is 1 for any letters. The field is fitted by stochastic gradient on
``per_language`` labelled texts of each language (a bounded sample, in md5 order of the key, texts of at most ``longest``
bytes); halves of different texts are joined so that switches are seen. Every whole text is then labelled.

Defined results: null texts, empty texts and texts without a letter are ``und`` with score and certainty 0; without labelled texts
every text is; rows with a null language teach nothing; ties go to the smaller language; repeated rows are judged alike;
other columns pass through, and one named like the new struct is replaced.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabloom.llm.annotate import annotate
from tabloom.llm.rows import column
from tabloom.llm.text import Words, byte_class, mix, pieces, prefix_hash, range_hash, runs, spread

LETTERS = byte_class([*range(0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
SLOTS = 1 << 16          # hashed weights per language, numbered by 16 bits
FIT_BYTES = 1 << 18      # texts of the sample whose features are found side by side
PIECE_BYTES = 1 << 20    # texts labelled side by side; a longer text is labelled by itself, with about 60 bytes of memory a byte
FIELDS = "lang string, score double, spans array<struct<start:int,end:int,lang:string>>, certainty double"


class Field:
    """Weights of the features and of label pairs; all arrays are indexed by language number."""

    def __init__(self, languages: list):
        self.languages, k = languages, len(languages)
        self.weights = np.zeros((SLOTS, k), np.float32)
        self.entries = np.zeros((k + 1, k), np.float32)
        self.pairs = np.zeros((k, k), np.float64)
        self.lexicon, self.meant = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def learn_lexicon(self, hashes, labels, share=0.9, least=2):
        """Words that are used at least ``least`` times, and nearly only in one language."""
        self.lexicon, codes = np.unique(hashes, return_inverse=True)
        k = len(self.languages)
        counts = np.bincount(codes * k + labels, minlength=k * len(self.lexicon)).reshape(-1, k)
        clear = (counts.max(1) >= share * counts.sum(1)) & (counts.sum(1) >= least)
        self.lexicon, self.meant = self.lexicon[clear], counts.argmax(1)[clear]

    def kinds(self, words: Words, prefix):
        """(word numbers, weight slots) of the hashed features, kind by kind."""
        start, end = words.start, words.end
        length, every = end - start, np.arange(len(start), dtype=np.int32)

        def slots(hashes):
            return (hashes & np.uint64(SLOTS - 1)).astype(np.int32)

        yield every, slots(range_hash(prefix, start, end))
        for size in (1, 2, 3):
            fits = np.flatnonzero(length >= size)
            for kind, at in ((1, start[fits]), (2, end[fits] - size)):
                yield fits, slots(mix(range_hash(prefix, at, at + size) + np.uint64(kind)))
        for size in (2, 3):
            grams = np.maximum(length - size + 1, 0)
            at = spread(start, grams)
            yield np.repeat(every, grams), slots(mix(range_hash(prefix, at, at + size) + np.uint64(3)))

    def entry_of(self, words: Words, prefix):
        """The lexicon entry of each word."""
        own = range_hash(prefix, words.start, words.end)
        found = np.minimum(np.searchsorted(self.lexicon, own), max(0, len(self.lexicon) - 1))
        return np.where(self.lexicon[found] == own, self.meant[found], len(self.languages)) if len(self.lexicon) else np.full(len(own), len(self.languages))

    def features(self, words: Words):
        """(word numbers, weight slots) of all hashed features, and the lexicon entry of each word."""
        prefix = prefix_hash(words.data)
        word, slot = zip(*self.kinds(words, prefix))
        return np.concatenate(word), np.concatenate(slot), self.entry_of(words, prefix)

    def emissions(self, parts, entry) -> np.ndarray:
        """Each word's score for each language: its lexicon entry's, and its features', which come in ``parts``."""
        out = self.entries[entry].astype(np.float64)
        for word, slot in parts:
            for k in range(out.shape[1]):
                out[:, k] += np.bincount(word, self.weights[slot, k], len(entry))
        return out

    def emissions_of(self, words: Words) -> np.ndarray:
        """The same for whole texts, with the features of one kind in memory at a time."""
        prefix = prefix_hash(words.data)
        return self.emissions(self.kinds(words, prefix), self.entry_of(words, prefix))

    def posteriors(self, scores: np.ndarray, bounds: np.ndarray):
        """(distribution of each word's label, sum of the distributions of neighbouring label pairs).

        All texts step forward, then backward, side by side.
        """
        local = np.exp(scores - scores.max(1, keepdims=True))
        move = np.exp(self.pairs - self.pairs.max())
        length = np.diff(bounds)
        order = np.argsort(-length, kind="stable")
        start, length = bounds[:-1][order], length[order]
        active = np.searchsorted(-length, -np.arange(length[0] if len(length) else 0), "left")
        ahead = local / local.sum(1, keepdims=True)
        for t in range(1, len(active)):
            at = start[:active[t]] + t
            step = ahead[at - 1] @ move * local[at]
            ahead[at] = step / step.sum(1, keepdims=True)
        back = np.ones_like(local)
        for t in range(len(active) - 2, -1, -1):
            at = start[:active[t + 1]] + t
            step = (back[at + 1] * local[at + 1]) @ move.T
            back[at] = step / step.sum(1, keepdims=True)
        inner = np.ones(len(local), bool)
        inner[bounds[:-1][np.diff(bounds) > 0]] = False
        at = np.flatnonzero(inner)
        joint = ahead[at - 1], local[at] * back[at]
        total = np.einsum("ni,ij,nj->n", joint[0], move, joint[1], optimize=True)
        expected = (joint[0] / total[:, None]).T @ joint[1] * move
        both = ahead * back
        return both / both.sum(1, keepdims=True), expected


def fit(languages: list, texts: list, labels: list, rounds=4, batch=64, rate=0.3, seed=7) -> Field:
    """The field by Adagrad on the log-likelihood of the labels of joined half texts."""
    field, k = Field(languages), len(languages)
    sample = pa.RecordBatch.from_arrays([pa.array(texts, pa.large_string())], ["text"])
    hashes, counts = zip(*[(w.hashes(), w.counts) for w in (Words(p.column(0), LETTERS) for p in pieces(sample, size=FIT_BYTES))]) if texts else ((), ())
    if not sum(len(h) for h in hashes):
        return field
    counts = np.concatenate(counts)
    bounds_of = np.concatenate([[0], np.cumsum(counts)])
    label = np.array([languages.index(v) for v in labels], np.int64)
    field.learn_lexicon(np.concatenate(hashes), np.repeat(label, counts))
    slots, sizes, entries = [], [], []
    for piece in pieces(sample, size=FIT_BYTES):
        word, slot, entry = field.features(Words(piece.column(0), LETTERS))
        slots.append(slot[np.argsort(word, kind="stable")].astype(np.uint16))
        sizes.append(np.bincount(word, minlength=len(entry)))
        entries.append(entry)
    slot, entry = np.concatenate(slots), np.concatenate(entries)
    first = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
    del hashes, slots, sizes, entries, sample
    seen = [np.full(a.shape, 1e-2) for a in (field.weights, field.entries, field.pairs)]
    random = np.random.default_rng(seed)
    for _ in range(rounds):
        order = random.permutation(len(texts))
        for some in np.split(order, range(batch, len(order), batch)):
            other = random.permutation(some)
            half = counts // 2
            starts = np.stack([bounds_of[some], bounds_of[other] + half[other]], 1).ravel()
            sizes = np.stack([half[some], counts[other] - half[other]], 1).ravel()
            at = spread(starts, sizes)
            if not len(at):
                continue
            gold = np.repeat(np.stack([label[some], label[other]], 1).ravel(), sizes)
            bounds = np.concatenate([[0], np.cumsum(sizes.reshape(-1, 2).sum(1))])
            grams = first[at + 1] - first[at]
            local_word, local_slot = np.repeat(np.arange(len(at)), grams), slot[spread(first[at], grams)]
            posterior, expected = field.posteriors(field.emissions([(local_word, local_slot)], entry[at]), bounds)
            missing = np.eye(k)[gold] - posterior
            inner = np.ones(len(at), bool)
            inner[bounds[:-1][np.diff(bounds) > 0]] = False
            pairs = np.bincount(gold[np.flatnonzero(inner) - 1] * k + gold[inner], minlength=k * k).reshape(k, k) - expected
            weights = np.stack([np.bincount(local_slot, missing[local_word, j], SLOTS) for j in range(k)], 1)
            entries = np.stack([np.bincount(entry[at], missing[:, j], k + 1) for j in range(k)], 1)
            for value, grown, step in zip((field.weights, field.entries, field.pairs), seen, (weights, entries, pairs)):
                step = step / len(at) ** 0.5
                grown += step ** 2
                value += rate * step / np.sqrt(grown)
    return field


def identify(field: Field, texts: pa.Array, with_spans: bool):
    langs, scores, spans, certainties = [], [], [], []
    for piece in pieces(pa.RecordBatch.from_arrays([texts], ["text"]), size=PIECE_BYTES):
        words = Words(piece.column(0), LETTERS)
        posterior, _ = field.posteriors(field.emissions_of(words), words.bounds) if len(words.start) and field.languages else (None, None)
        points = np.concatenate([[0], np.cumsum((words.data & 0xC0) != 0x80)]) if with_spans else None
        for row, (a, b) in enumerate(zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist())):
            if posterior is None or a == b or not lettered(words, row, piece.column(0)):
                langs.append("und"), scores.append(0.0), spans.append([]), certainties.append(0.0)
                continue
            mean = posterior[a:b].mean(0)
            langs.append(field.languages[int(mean.argmax())])
            scores.append(min(1.0, max(0.0, float(mean.max()))))
            certainties.append(min(1.0, float(posterior[a:b].max(1).mean())))
            spans.append(language_spans(field, words, posterior, points, row, a, b) if with_spans else [])
    return langs, scores, spans, certainties


def lettered(words: Words, row: int, texts: pa.Array) -> bool:
    """Whether the text holds a letter: by bytes where an ASCII letter shows it, else by code points."""
    data = words.data[words.offsets[row]:words.offsets[row + 1]]
    return bool(((data >= 0x61) & (data <= 0x7A)).any()) or any(c.isalpha() for c in texts[row].as_py())


def language_spans(field, words, posterior, points, row, a, b) -> list:
    label = posterior[a:b].argmax(1)
    starts, lengths = runs(label)
    zero = points[words.offsets[row]]
    return [{"start": int(points[words.start[a + s]] - zero), "end": int(points[words.end[a + s + n - 1]] - zero), "lang": field.languages[label[s]]}
            for s, n in zip(starts.tolist(), lengths.tolist())]


def fit_languages(docs: DataFrame, text="text", lang="lang", key="doc_id", per_language=250, longest=1 << 16) -> Field:
    """A field from at most ``per_language`` of the given rows for each language; the rest of the rows is not read into the driver.

    The rows are chosen without their texts, by the hashes that order them; the chosen texts are then read again. What is sent to all
    tasks and what comes to the driver grows with the number of languages only.
    """
    some = docs.select(column(docs, text).cast("string").alias("text"), column(docs, lang).cast("string").alias("lang"),
                       F.md5(F.coalesce(column(docs, key).cast("string"), F.lit(""))).alias("draw"))
    some = some.filter((F.octet_length("text") <= longest) & F.col("lang").isNotNull()).withColumn("same", F.md5("text"))
    order = Window.partitionBy("lang").orderBy("draw", "same")

    def first(rows):
        return rows.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= per_language)

    chosen = first(some.select("lang", "draw", "same")).select("lang", "draw", "same").distinct()
    rows = first(some.join(F.broadcast(chosen), ["lang", "draw", "same"])).select("lang", "text", "n").collect()      # equal rows may be many
    rows = sorted(rows, key=lambda r: (r["lang"], r["n"]))
    return fit(sorted({r["lang"] for r in rows}), [r["text"] for r in rows], [r["lang"] for r in rows])


def label_languages(docs: DataFrame, field: Field, text="text", into="language", keep=None, with_spans=False) -> DataFrame:
    """``docs`` with a struct ``into``: lang, score (mean probability of that language over the words), spans of one language, certainty."""
    sent = docs.sparkSession.sparkContext.broadcast(field)
    return annotate(docs, lambda: lambda texts: identify(sent.value, texts, with_spans), FIELDS, into, text, keep)
