"""Token ids of whole texts by the tokenizers library, vectorised over the parts of many texts.

A byte-level BPE never merges across the pieces of its pre-tokenizer. Texts are cut, with
numpy, at places where a piece surely begins whatever stands around:

- before a space that follows a character that is no white space;
- between an ASCII letter and one of CLOSERS behind it;
- before a line feed after an ASCII character that is no white space, and behind such a
  line feed if an ASCII letter follows (a single one, so that it is a piece of its own).

The parts tile the text. Arrow's dictionary encoding finds the distinct parts of a chunk,
the library encodes those not yet remembered, and the ids are gathered for all parts at
once. Parts that are letters with at most one space before them are one piece each, so the
library's model gets them without its pre-tokenizer, many in one call; all others pass
through the unchanged tokenizer. A text with a special token is encoded as a whole, as is
every text if the tokenizer's pre-tokenizer or normaliser is of another kind than the rules above are for.

Defined results: null and empty texts have no ids of their own (with `end`, the end id alone).
A worker remembers MEMORY bytes of parts at most and then starts afresh; parts of more than
LONG bytes are not remembered. What it remembers lies in arrays, about 80 bytes a part, and is found by a
hash of the part's bytes; the bytes are then compared, so that ids are exact.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

from quarry.llm.textvec import U64, buffers, mix

#: Bytes of text in one vectorised step; a longer text is a step of its own.
CHUNK = 2 << 20
#: Bytes of remembered parts (with TABLES a part for the tables), and the longest one.
MEMORY, TABLES, LONG = 40 << 20, 40, 64
END = 2
#: Marks that end a run of letters and begin a piece: the ASCII marks but the apostrophe.
CLOSERS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E), *range(0x1C, 0x20)]] = True
LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123)]] = True
CLOSER = np.zeros(256, bool)
CLOSER[list(CLOSERS)] = True
#: First bytes of the accented Latin letters from U+00C0 to U+017F, of which two are signs.
ACCENT = np.zeros(256, bool)
ACCENT[[0xC3, 0xC4, 0xC5]] = True


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones for themselves, others from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(rest)}


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Places in data, ascending and with both ends, where parts begin; every text begins one."""
    n = len(data)
    begins = np.zeros(n + 1, bool)
    begins[offsets] = True
    if n > 1:
        here, before = data[1:], data[:-1]
        plain = (before < 0x80) & ~BLANK[before]
        # A character of more bytes may be white space; only lead bytes that begin none are told here.
        lead = np.zeros(n - 1, bool)
        lead[1:] = (before[1:] >= 0x80) & (before[:-1] >= 0xC3) & (before[:-1] < 0xE0)
        # The byte before must belong to the same text.
        same = ~begins[1:n]
        begins[1:n] |= same & (here == 0x20) & (plain | lead)
        begins[1:n] |= same & CLOSER[here] & LETTER[before]
        line = same & (here == 0x0A) & plain
        begins[1:n] |= line
        begins[2:n] |= line[:-1] & same[1:] & LETTER[data[2:]]
    return np.flatnonzero(begins)


def plain_words(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which parts are a space and letters behind it, ASCII and accented Latin ones: one piece each."""
    before = np.concatenate([np.zeros(1, np.uint8), data[:-1]])
    sign = (before == 0xC3) & ((data == 0x97) | (data == 0xB7))
    fine = LETTER[data] | ACCENT[data] | ((data & 0xC0) == 0x80) & ACCENT[before] & ~sign
    fine[offsets[:-1]] = data[offsets[:-1]] == 0x20
    return np.logical_and.reduceat(fine, offsets[:-1]) & (np.diff(offsets) > 1)


def eights(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For k = 0, 1, ...: the strings that have bytes from 8 * k on, and up to eight of those bytes as an integer."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    at = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    k, some = 0, np.flatnonzero(sizes > 0)
    while len(some):
        left = sizes[some] - 8 * k
        yield k, some, at[starts[some] + 8 * k] & (U64(2**64 - 1) >> (8 * (8 - np.minimum(left, 8))).astype(U64))
        k, some = k + 1, some[left > 8]


def grown(array: np.ndarray, size: int) -> np.ndarray:
    """The array, with room for so many elements."""
    while len(array) < size:
        array = np.concatenate([array, np.zeros_like(array)])
    return array


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        pre = made.get("pre_tokenizer") or {}
        self.cuttable = made["model"]["type"] == "BPE" and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and not made.get("normalizer")
        made |= {"pre_tokenizer": {"type": "WhitespaceSplit"}, "added_tokens": [], "post_processor": None}
        self.model = Tokenizer.from_str(json.dumps(made)) if self.cuttable else None
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        letters = byte_letters()
        self.codes = np.array([ord(letters[b]) for b in range(256)], "<u4")
        self.spaced = np.zeros(max(self.whole.get_vocab().values()) + 1, bool)
        self.spaced[[i for t, i in self.whole.get_vocab().items() if t[0] == letters[0x20]]] = True
        self.forget()

    def forget(self) -> None:
        self.held = self.known = self.filled = 0  # bytes, parts, words
        self.pool = np.empty(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 14, np.int64)  # of each part's ids in the pool, and one more
        self.hashes, self.lengths = np.zeros(1 << 14, U64), np.zeros(1 << 14, np.uint8)  # of each part; 0 for one not remembered
        self.words, self.places = np.zeros(1 << 15, U64), np.zeros(1 << 14, np.int32)  # the parts' bytes, eight a word, and where each part's begin
        self.slots = np.full(1 << 16, -1, np.int32)  # parts by hash, linear probing

    def _add(self, ids: np.ndarray, lengths: np.ndarray) -> int:
        """Append parts to the pool; the first one's index."""
        n = self.known
        end = int(self.starts[n])
        self.pool = grown(self.pool, end + len(ids))
        self.starts = grown(self.starts, n + len(lengths) + 1)
        self.pool[end : end + len(ids)] = ids
        self.starts[n + 1 : n + 1 + len(lengths)] = end + np.cumsum(lengths)
        self.known = n + len(lengths)
        self.held += 4 * len(ids) + TABLES * len(lengths)
        return n

    def _new(self, parts: pa.Array) -> np.ndarray:
        """Indexes of parts that are not remembered yet."""
        out = np.empty(len(parts), np.int64)
        plain = plain_words(*buffers(parts))
        spaced, rest = np.flatnonzero(plain), np.flatnonzero(~plain)
        if len(spaced):
            data, offsets = buffers(parts.take(pa.array(spaced)))
            words = np.insert(self.codes[data], offsets[:-1], 0x20).tobytes().decode("utf-32-le")
            ids = np.array(self.model.encode_batch_fast([words], add_special_tokens=False)[0].ids, np.uint32)
            begins = np.flatnonzero(self.spaced[ids])  # only the first piece of such a part has the space
            if len(begins) != len(spaced):
                raise ValueError("the tokenizer merges across words")
            out[spaced] = self._add(ids, np.diff(np.append(begins, len(ids)))) + np.arange(len(spaced))
        if len(rest):
            found = [e.ids for e in self.whole.encode_batch_fast(parts.take(pa.array(rest)).to_pylist(), add_special_tokens=False)]
            lengths = np.array([len(i) for i in found])
            out[rest] = self._add(np.array([i for ids in found for i in ids], np.uint32), lengths) + np.arange(len(rest))
        return out

    def _place(self, index: np.ndarray) -> None:
        """Put parts into the slots."""
        mask = len(self.slots) - 1
        slot = (self.hashes[index] & U64(mask)).astype(np.int64)
        while len(index):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = index[free]
            left = self.slots[slot] != index
            index, slot = index[left], slot[left] + 1 & mask

    def _find(self, hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Indexes of remembered parts of that hash and size, -1 where there is none."""
        out, mask = np.full(len(hashes), -1, np.int64), len(self.slots) - 1
        slot, left = (hashes & U64(mask)).astype(np.int64), np.flatnonzero(sizes <= LONG)
        while len(left):
            at = self.slots[slot[left]]
            left, at = left[at >= 0], at[at >= 0]
            same = (self.hashes[at] == hashes[left]) & (self.lengths[at] == sizes[left])
            out[left[same]] = at[same]
            left = left[~same]
            slot[left] = slot[left] + 1 & mask
        return out

    def _indexes(self, parts: pa.Array) -> np.ndarray:
        """Indexes of distinct parts, remembered or new."""
        data, offsets = buffers(parts)
        sizes = np.diff(offsets)
        keys = list(eights(data, offsets[:-1], np.where(sizes <= LONG, sizes, 0)))
        hashes = sizes.astype(U64)
        with np.errstate(over="ignore"):
            for _, some, word in keys:
                hashes[some] = mix((hashes[some] ^ word) * U64(0x9E3779B97F4A7C15))
        out = self._find(hashes, sizes)
        keep = (out < 0) & (sizes <= LONG)
        for k, some, word in keys:  # other bytes of the same hash are encoded each time
            at = out[some]
            differ = at >= 0
            differ[differ] = self.words[self.places[at[differ]] + k] != word[differ]
            out[some[differ]] = -1
        missing = np.flatnonzero(out < 0)
        if not len(missing):
            return out
        out[missing] = self._new(parts.take(pa.array(missing)))
        room = len(self.starts)
        self.hashes, self.lengths, self.places = grown(self.hashes, room), grown(self.lengths, room), grown(self.places, room)
        kept = np.flatnonzero(keep)
        index, count = out[kept], (sizes[kept] + 7) // 8
        self.hashes[index], self.lengths[index] = hashes[kept], sizes[kept]
        self.places[index] = self.filled + np.cumsum(count) - count
        self.filled += int(count.sum())
        self.words = grown(self.words, self.filled)
        for k, some, word in keys:
            own = keep[some]
            self.words[self.places[out[some[own]]] + k] = word[own]
        self.held += 8 * int(count.sum())
        if 2 * self.known > len(self.slots):
            while 2 * self.known > len(self.slots):
                self.slots = np.full(2 * len(self.slots), -1, np.int32)
            index = np.flatnonzero(self.lengths[: self.known])
        self._place(index)
        return out

    def __call__(self, data: np.ndarray, offsets: np.ndarray, end: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts data[offsets[i]:offsets[i+1]] one after the other, and where each text's begin (and the last one's end)."""
        if self.held > MEMORY:
            self.forget()
        n, raw = len(offsets) - 1, data.tobytes()
        odd = np.zeros(n, bool)
        if not self.cuttable:
            odd[:] = offsets[1:] > offsets[:-1]
        for token in self.special:
            at = raw.find(t := token.encode())
            while at >= 0:
                odd[int(np.searchsorted(offsets, at, side="right")) - 1] = True
                at = raw.find(t, at + 1)
        places = cuts(data, offsets)
        if odd.any():  # such a text is one part
            inside = odd[np.minimum(np.searchsorted(offsets, places, side="right") - 1, n - 1)]
            places = places[~inside | np.isin(places, offsets)]
        first = places[:-1]
        column = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(places.astype(np.int64)), pa.py_buffer(raw)) if len(first) else pa.array([], pa.large_string())
        coded = column.dictionary_encode()
        index = self._indexes(coded.dictionary)
        part = index[coded.indices.to_numpy()] if len(index) else np.empty(0, np.int64)
        sizes = self.starts[part + 1] - self.starts[part]
        # The ids of a text end where the next text begins; the end id is put in there.
        upto = np.concatenate([[0], np.cumsum(sizes)])
        begin = upto[np.searchsorted(first, offsets[:-1])]
        begin = np.append(begin, upto[-1])
        total = int(upto[-1])
        ids = self.pool[np.repeat(self.starts[part] - upto[:-1], sizes) + np.arange(total)]
        if end:
            ids = np.insert(ids, begin[1:], np.uint32(END))
            begin = begin + np.arange(n + 1)
        return ids, begin


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encoded(texts: pa.Array, path: str, end: bool = True) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(lo, hi, ids, begins) for runs of about CHUNK bytes of texts; begins has hi - lo + 1 places in ids."""
    data, offsets = buffers(texts)
    lo = 0
    while lo < len(texts):
        hi = min(len(texts), max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + CHUNK, side="right")) - 1))
        own = offsets[lo : hi + 1]
        yield lo, hi, *encoder(path)(data[own[0] : own[-1]], own - own[0], end)
        lo = hi
    pa.default_memory_pool().release_unused()  # workers live on, and the next operator needs the room


def encode(texts: list[str], path: str) -> list[bytes]:
    """Ids of each text as little-endian unsigned 32-bit integers, without an end id."""
    out: list[bytes] = []
    for _, _, ids, begins in encoded(pa.array(texts, pa.large_string()), path, end=False):
        raw = ids.astype("<u4").tobytes()
        out += [raw[4 * a : 4 * b] for a, b in zip(begins[:-1].tolist(), begins[1:].tolist())]
    return out
