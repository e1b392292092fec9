"""Greedy word-piece counts by a linear longest-match automaton.

The vocabulary is a trie with failure links: a node that cannot go on pops the pieces that
are certain by then and continues in the trie of continuation pieces. Only the *number* of
popped pieces is kept, so a word's length in pieces is found in one pass over its characters
and no piece is ever built. Words are memorised by a worker up to a bound.

The vocabulary comes from a public sentencepiece model: pieces with the word mark begin a
word, the others continue one. A word that the pieces cannot cover is one unknown token.

Defined results: null or empty text has no words and no tokens; repeated rows are counted
each; an empty table gives an empty result; extra columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import small_batches

MARK = "▁"
REMEMBER = 1_000_000


class PieceCounter(dict):
    """word (bytes) -> pieces, or -1 for a word that cannot be covered; remembers what it has seen."""

    def __init__(self, first: Iterable[str], more: Iterable[str]):
        super().__init__()
        self.next: list[dict[str, int]] = [{}, {}]  # 0: begins a word, 1: continues one
        ends = [False, False]
        for root, pieces in ((0, first), (1, more)):
            for piece in pieces:
                at = root
                for c in piece:
                    to = self.next[at].get(c)
                    if to is None:
                        to = self.next[at][c] = len(self.next)
                        self.next.append({})
                        ends.append(False)
                    at = to
                ends[at] = at > 1
        self.fail, self.pops = [-1] * len(ends), [0] * len(ends)
        queue = [0, 1]
        for u in queue:  # grows while it is read: breadth first
            for c, v in self.next[u].items():
                if ends[v]:
                    self.fail[v], self.pops[v] = 1, 1
                else:
                    z, popped = self.fail[u], self.pops[u]
                    while z >= 0 and c not in self.next[z]:
                        popped += self.pops[z]
                        z = self.fail[z]
                    if z >= 0:
                        self.fail[v], self.pops[v] = self.next[z][c], popped
                queue.append(v)

    def count(self, word: str) -> int:
        u, n = 0, 0
        for c in word:
            while (to := self.next[u].get(c)) is None:
                if self.fail[u] < 0:
                    return -1
                n += self.pops[u]
                u = self.fail[u]
            u = to
        while u != 1:
            if self.fail[u] < 0:
                return -1
            n += self.pops[u]
            u = self.fail[u]
        return n

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBER:
            self.clear()
        self[word] = n = self.count(word.decode())
        return n


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def vocabulary(path: str) -> tuple[list[str], list[str]]:
    """Pieces that begin a word (without the mark) and pieces that continue one."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    kept = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i))]
    return [p[1:] for p in kept if p[0] == MARK and p[1:]], [p for p in kept if MARK not in p]


@lru_cache(maxsize=2)
def counter(path: str) -> PieceCounter:
    return PieceCounter(*vocabulary(path))


def token_counts(docs: DataFrame, vocabulary_path: str | None = None) -> DataFrame:
    """doc_id, n_words, n_tokens and n_unknown (words that count as one unknown token) of each row."""
    path = vocabulary_path or default_vocabulary()
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = counter(path)
        for b in batches:
            out = np.zeros((3, b.num_rows), np.int64)
            for i, t in enumerate(b.column(1).to_pylist()):
                if t:
                    found = [pieces[w] for w in t.encode().split()]
                    unknown = found.count(-1)
                    out[:, i] = len(found), sum(found) + 2 * unknown, unknown
            yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, out)], names=["doc_id", "n_words", "n_tokens", "n_unknown"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_words long, n_tokens long, n_unknown long")
