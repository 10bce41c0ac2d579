"""Token counts by a linear longest-match automaton.

The vocabulary is a trie of byte strings, one for the starts of words and one for what follows, as in word-piece vocabularies.
Where a node has no child for the next byte, its failure link says where matching goes on once the longest pieces of what
has been read are taken off, and a count says how many pieces these are. So the number of greedy longest-match pieces of a word follows from
one walk, without building a piece. All distinct words of a batch walk side by side.

Defined results: null and empty texts have no tokens; a word that cannot be cut into pieces counts as one unknown token;
repeated rows are counted alike; other columns pass through, and one named like the new struct is replaced.
"""

import base64
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tabloom.llm.annotate import annotate
from tabloom.llm.text import SPACED, Words, pieces

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
NOWHERE = -1
FIELDS = "n_words long, n_tokens long, n_unknown long"


def read_vocabulary(path=VOCABULARY):
    """(pieces that start a word, pieces that go on) of a public byte vocabulary; a start is written with a space before it."""
    entries = [base64.b64decode(line.split()[0]) for line in Path(path).read_bytes().splitlines() if line]
    return [e[1:] for e in entries if e[:1] == b" " and len(e) > 1], [e for e in entries if e[:1] != b" "]


class Automaton:
    """The trie with failure links and popped-piece counts. Node 0 starts a word, node 1 goes on."""

    def __init__(self, starts: list, following: list):
        children, ends = [{}, {}], [False, False]
        for root, entries in ((0, starts), (1, following)):
            for entry in entries:
                node = root
                for byte in entry:
                    if byte not in children[node]:
                        children[node][byte] = len(children)
                        children.append({})
                        ends.append(False)
                    node = children[node][byte]
                ends[node] = node > 1
        fail, popped = [NOWHERE] * len(children), [0] * len(children)
        level = [0, 1]
        while level:                                   # breadth first: links lead to nodes of shorter strings
            below = []
            for node in level:
                for byte, child in children[node].items():
                    below.append(child)
                    if ends[child]:
                        fail[child], popped[child] = 1, 1
                        continue
                    at, pops = fail[node], popped[node]
                    while at != NOWHERE and byte not in children[at]:
                        pops += popped[at]
                        at = fail[at]
                    if at != NOWHERE:
                        fail[child], popped[child] = children[at][byte], pops
            level = below
        edges = sorted((node * 256 + byte, child) for node, own in enumerate(children) for byte, child in own.items())
        self.edges = np.array([e for e, _ in edges], np.int64)
        self.children = np.array([c for _, c in edges], np.int64)
        self.fail, self.popped = np.array(fail), np.array(popped)

    def step(self, nodes, bytes_):
        """The child of each node for each byte, or NOWHERE."""
        wanted = nodes * 256 + bytes_
        at = np.minimum(np.searchsorted(self.edges, wanted), max(0, len(self.edges) - 1))
        return np.where(self.edges[at] == wanted, self.children[at], NOWHERE) if len(self.edges) else np.full(len(nodes), NOWHERE)

    def count(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Number of pieces of each word [start, end) of the bytes; -1 for a word that cannot be cut."""
        counts, node, at = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64), start.copy()
        going = np.arange(len(start))
        while len(going):
            reading = at[going] < end[going]
            done = going[~reading & (node[going] == 1)]
            going = np.setdiff1d(going, done, assume_unique=True) if len(done) else going
            reading = at[going] < end[going]
            byte = data[np.minimum(at[going], max(0, len(data) - 1))].astype(np.int64)
            child = np.where(reading, self.step(node[going], byte), NOWHERE)
            moved = child != NOWHERE
            node[going[moved]] = child[moved]
            at[going[moved]] += 1
            stuck = going[~moved]
            counts[stuck] += self.popped[node[stuck]]
            node[stuck] = self.fail[node[stuck]]
            dead = stuck[node[stuck] == NOWHERE]
            counts[dead] = -1
            if len(dead):
                going = np.setdiff1d(going, dead, assume_unique=True)
        return counts


def counted(automaton: Automaton, texts: pa.Array):
    out = [[], [], []]
    for piece in pieces(pa.RecordBatch.from_arrays([texts], ["text"])):
        words = Words(piece.column(0), SPACED, lower=False)
        _, first, code = np.unique(words.hashes(), return_index=True, return_inverse=True)
        per_word = automaton.count(words.data, words.start[first], words.end[first])[code] if len(code) else np.zeros(0, np.int64)
        total = np.concatenate([[0], np.cumsum(np.abs(per_word))])
        unknown = np.concatenate([[0], np.cumsum(per_word < 0)])
        for part, values in zip(out, (words.counts, np.diff(total[words.bounds]), np.diff(unknown[words.bounds]))):
            part.append(values.astype(np.int64))
    return [np.concatenate(part) for part in out]


def count_tokens(docs: DataFrame, vocabulary=VOCABULARY, text="text", into="tokens", keep=None) -> DataFrame:
    """``docs`` with a struct ``into``: n_words, n_tokens (greedy longest-match pieces of all words), n_unknown words.

    Words are the texts between white space; case is kept. The vocabulary's size, not the data's, bounds what is broadcast.
    """
    sent = docs.sparkSession.sparkContext.broadcast(Automaton(*read_vocabulary(vocabulary)))
    return annotate(docs, lambda: lambda texts: counted(sent.value, texts), FIELDS, into, text, keep)
