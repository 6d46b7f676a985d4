"""Greedy word-piece lengths by a linear longest-match automaton.

The vocabulary is a byte trie.  Greedy longest match takes, from the left of a
word, the longest piece that is in the vocabulary, again and again.  Instead of
going back after each overshoot, every trie node has a failure link: the node
reached once the pieces that greedy matching would have taken so far are
popped, and a count of those pieces.  One walk over the bytes then gives the
number of pieces; no piece is ever built.

Where no piece fits, the whole word counts as one unknown piece (the usual
word-piece rule); a vocabulary with all single bytes has no unknown words.

A null text counts as empty; repeated rows each get their result; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections import deque

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ingot.llm.bpe import ranks_of
from ingot.llm.common import col, field, texts

#: Words whose lengths a worker remembers.
MEMORY_WORDS = 500_000


class Automaton:
    """Trie over `pieces` with failure links and popped-piece counts."""

    def __init__(self, pieces):
        self.go: dict[int, int] = {}  # node << 8 | byte -> node
        is_piece, edges = [False], [[]]
        for p in pieces:
            node = 0
            for byte in p:
                key = node << 8 | byte
                nxt = self.go.get(key)
                if nxt is None:
                    nxt = self.go[key] = len(is_piece)
                    is_piece.append(False)
                    edges.append([])
                    edges[node].append((byte, nxt))
                node = nxt
            is_piece[node] = node > 0
        # by breadth: a link points to a node of a shorter path
        self.link, self.popped = [-1] * len(is_piece), [0] * len(is_piece)
        todo = deque([0])
        while todo:
            parent = todo.popleft()
            for byte, node in edges[parent]:
                todo.append(node)
                if is_piece[node]:
                    self.link[node], self.popped[node] = 0, 1
                    continue
                at, n = self.link[parent], self.popped[parent]
                while at >= 0 and (nxt := self.go.get(at << 8 | byte)) is None:
                    n += self.popped[at]
                    at = self.link[at]
                if at >= 0:
                    self.link[node], self.popped[node] = nxt, n

    def count(self, word: bytes) -> int:
        """Pieces of a word; 1 if it is unknown, 0 if it is empty."""
        go, link, popped = self.go, self.link, self.popped
        node = n = 0
        for byte in word:
            while (nxt := go.get(node << 8 | byte)) is None:
                if link[node] < 0:
                    return 1
                n += popped[node]
                node = link[node]
            node = nxt
        while node:
            if link[node] < 0:
                return 1
            n += popped[node]
            node = link[node]
        return n


class _Lengths(dict):
    """Lengths of words, computed on demand."""

    def __init__(self, path: str):
        super().__init__()
        self.automaton = Automaton(ranks_of(path))

    def __missing__(self, word: str) -> int:
        n = self[word] = self.automaton.count(word.encode())
        return n


_LOADED: dict[str, _Lengths] = {}


def token_counts(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row `doc_id`, `n_words` (matches of `pattern`) and `n_tokens`, the
    sum of their greedy lengths in the vocabulary of the rank file `path`."""

    def run(batches):
        lengths = _LOADED.get(path) or _LOADED.setdefault(path, _Lengths(path))
        split = regex.compile(pattern).findall
        for b in batches:
            n = []
            for t in texts(b.column(1)):
                if len(lengths) > MEMORY_WORDS:
                    lengths.clear()
                words = split(t or "")
                n.append((len(words), sum(map(lengths.__getitem__, words))))
            counts = np.array(n, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(counts[:, 0]), pa.array(counts[:, 1])], names=["doc_id", "n_words", "n_tokens"])

    schema = T.StructType([field(docs, id_col, "doc_id"), T.StructField("n_words", T.LongType()), T.StructField("n_tokens", T.LongType())])
    return docs.select(col(id_col).alias("doc_id"), col(text_col).cast("string").alias("text")).mapInArrow(run, schema)
