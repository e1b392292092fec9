"""Vectorised words and word hashes of whole texts, straight from Arrow buffers.

A word is a run of bytes other than space and \\x09-\\x0D, which in UTF-8 is the same
as `[^\\x20\\x09-\\x0D]+` over code points. Word hashes are multilinear over the bytes
with a pseudo-random 64-bit factor for each position, so two different words collide
with a probability of about 2**-56.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
SAME = np.arange(256, dtype=np.uint8)
LOWER = SAME.copy()
LOWER[65:91] += 32
#: Bytes of text that one vectorised step works on; a longer document is a step of its own.
CHUNK = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, element by element."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


_factors = np.empty(0, U64)


def factors(n: int) -> np.ndarray:
    """At least n factors, one for each byte position in a word."""
    global _factors
    if n > len(_factors):
        with np.errstate(over="ignore"):
            _factors = mix((np.arange(max(n, 4096), dtype=U64) + U64(1)) * U64(0x9E3779B97F4A7C15)) | U64(1)
    return _factors


@dataclass
class Words:
    """Words of a run of documents; offsets has the byte offsets of the documents in data."""

    data: np.ndarray
    offsets: np.ndarray
    space: np.ndarray
    doc: np.ndarray  # document of each word, from 0
    hash: np.ndarray
    count: np.ndarray  # words of each document

    def per_doc(self, flags: np.ndarray) -> np.ndarray:
        """How many bytes of each document are flagged."""
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray = SAME) -> Words:
    """Words of documents data[offsets[i]:offsets[i+1]]; bytes pass through table before hashing."""
    n = len(offsets) - 1
    space = SPACE[data]
    solid = ~space
    begins = solid.copy()
    if len(data):
        inner = solid[1:] & ~solid[:-1]
        begins[1:] = inner
        firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
        begins[firsts] = solid[firsts]
    at = np.flatnonzero(begins)
    if not len(at):
        return Words(data, offsets, space, np.empty(0, np.int64), np.empty(0, U64), np.zeros(n, np.int64))
    chars = np.flatnonzero(solid)
    first = np.searchsorted(chars, at)
    length = np.diff(np.append(first, len(chars)))
    place = np.arange(len(chars)) - np.repeat(first, length)
    with np.errstate(over="ignore"):
        terms = (table[data[chars]].astype(U64) + U64(1)) * factors(int(length.max()))[place]
        hashes = np.add.reduceat(terms, first)
    doc = np.searchsorted(offsets, at, side="right") - 1
    return Words(data, offsets, space, doc, mix(hashes), np.bincount(doc, minlength=n))


def word_hash(word: bytes) -> int:
    return int(words(np.frombuffer(word, np.uint8), np.array([0, len(word)])).hash[0])


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string array; nulls count as empty."""
    texts = texts.fill_null("") if texts.null_count else texts
    texts = texts.cast(pa.large_utf8())
    if not len(texts):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(texts: pa.Array, table: np.ndarray = SAME) -> Iterator[tuple[int, int, Words]]:
    """Row ranges of texts with their words, about CHUNK bytes at a time."""
    data, offsets = buffers(texts)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + CHUNK, side="right")) - 1)
        hi = min(hi, len(texts))
        own = offsets[lo : hi + 1]
        yield lo, hi, words(data[own[0] : own[-1]], own - own[0], table)
        lo = hi
    pa.default_memory_pool().release_unused()  # workers live on, and the next operator needs the room


def windows(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Document and hash of each window of so many words inside one document."""
    n = len(w.hash) - size + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, U64)
    with np.errstate(over="ignore"):
        out = np.full(n, U64(size) * U64(0xD6E8FEB86659FD93), U64)
        for k in range(size):
            out = mix(out * U64(0x9E3779B97F4A7C15) + w.hash[k : k + n])
    same = w.doc[:n] == w.doc[size - 1 : size - 1 + n]
    return w.doc[:n][same], out[same]
