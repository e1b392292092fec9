"""Secret scans: fixed patterns, and formats learned by grammar inference.

Base spans come from three patterns. Their matches are labelled credentials: a bounded
sample of distinct ones (SAMPLE a kind, those with the smallest md5, of LONGEST characters at most) makes a prefix
tree for each kind over character classes (capitals, a to f, other small letters, digits, and each
mark for itself). Its states are merged while their futures are statistically compatible
(Hoeffding bounds): first the states of one depth, from the root down, which pools the counts of
the many random spellings of a format, then states of different depths, red and blue. What is left is a
probabilistic automaton that keeps prefixes, alphabets and lengths; each state also keeps how often it
saw each character. A bounded sample of all other runs, drawn by occurrence, makes a background automaton in the same way.

Every other run of credential characters that is as long as the shortest labelled credential is scored, and
if it is none itself its parts between "=", "/", "." and ":"; it becomes a `learned` span if its
log-likelihood a character under the best credential automaton reaches that kind's floor (what all but
1 in 50 of its own sample reach, less SLACK) and exceeds the background by MARGIN bits. A kind with fewer
than LEAST distinct matches is not learned.

Base spans are never changed and learned spans never overlap them. Offsets are code points.

Defined results: null text is empty; empty text has no span and the sha256 of the empty
string; without any labelled credential nothing is learned; repeated rows agree; an empty
table gives an empty result; extra columns do not matter. Scoring is linear in a run's length.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm import textvec
from quarry.llm.common import small_batches

KINDS = ("assign", "access", "hex", "learned")
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a maximal run is tried at its start first, so this equals runs of 24 or more
RUN = re.compile(r"[A-Za-z0-9+/_.=-]+")
CUES = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: Shortest base match outside assignments; distinct credentials a kind and background runs that are fitted, and their longest.
MIN_RUN, SAMPLE, BACKGROUND, LONGEST, LEAST = 16, 500, 1000, 96, 8
ALPHA, UNSEEN, SLACK, MARGIN = 0.05, 1e-4, 0.5, 1.0
#: First buckets of the sample, by hash: no task sorts more than their sum.
BUCKETS = 64
PARTS = re.compile(r"[^=/.:]+")
#: Runs that each text offers to the background's sample, of so many characters at least.
DRAWS, ORDINARY = 2, re.compile(r"(?<![A-Za-z0-9+/_.=-])([A-Za-z0-9+/_.=-]{6,})")
#: Words whose verdict a worker remembers.
REMEMBER = 100_000

Span = tuple[int, int, int]  # start, kind, end


def base_spans(text: str, long_words: list[tuple[int, int]], least: int = MIN_RUN) -> tuple[list[Span], list[tuple[int, int]]]:
    """Base spans in order, and other runs of at least so many credential characters; long_words has all words of that many bytes or more."""
    spans: list[Span] = []
    low = text.lower()
    if any(c in low for c in CUES):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    others = []
    for lo, hi in long_words:
        for run in RUN.finditer(text, lo, hi):
            if run.end() - run.start() < least:
                continue
            found = [(m.start(), 1, m.end()) for m in ACCESS.finditer(text, *run.span()) if m.end() - m.start() >= 20]
            found += [(m.start(), 2, m.end()) for m in HEX.finditer(text, *run.span())]
            spans += found
            others.append(run.span())
    spans.sort()
    return spans, [r for r in others if not any(s < r[1] and r[0] < e for s, _, e in spans)]


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def symbol(c: str) -> str:
    """The class of a character: A capital, h for a to f, a other small letter, 0 digit, else the character."""
    return "A" if "A" <= c <= "Z" else "h" if "a" <= c <= "f" else "a" if "g" <= c <= "z" else "0" if "0" <= c <= "9" else c


CLASS_SIZE = {"A": 26, "h": 6, "a": 20, "0": 10}


class Automaton:
    """Probabilistic automaton from strings: prefix tree over character classes, then merging of compatible states."""

    def __init__(self, samples: list[str], alpha: float = ALPHA):
        self.bound = math.sqrt(0.5 * math.log(2 / alpha))
        self.next: list[dict[str, int]] = []
        self.seen: list[dict[str, int]] = []
        self.chars: list[dict[str, int]] = []
        self.total: list[int] = []
        self.ends: list[int] = []
        self.top: list[int] = []  # union-find
        depth = [0]
        self._state()
        for word in samples:
            at = 0
            for k, c in enumerate(word):
                self.total[at] += 1
                s = symbol(c)
                self.seen[at][s] = self.seen[at].get(s, 0) + 1
                self.chars[at][c] = self.chars[at].get(c, 0) + 1
                to = self.next[at].get(s)
                if to is None:
                    to = self.next[at][s] = self._state()
                    depth.append(k + 1)
                at = to
            self.total[at] += 1
            self.ends[at] += 1
        # States of one depth, from the root down: those below come together as their parents do.
        level = [0]
        while level:
            level = sorted({self._find(v) for u in level for v in self.next[u].values()}, key=lambda u: (-self.total[u], u))
            kept: list[int] = []
            for u in level:
                u = self._find(u)
                if u in kept:
                    continue
                for r in kept:
                    if self._compatible(r, u):
                        self._fold(r, u)
                        break
                else:
                    kept.append(u)
            level = kept
        # States of different depths: red ones stay, blue ones follow a red one.
        red = [0]
        while blue := sorted({self._find(v) for u in red for v in self.next[u].values()}.difference(red), key=lambda u: (depth[u], -self.total[u], u)):
            for r in red:
                if self._compatible(r, blue[0]):
                    self._fold(r, blue[0])
                    break
            else:
                red.append(blue[0])
            red = list(dict.fromkeys(self._find(r) for r in red))
        self.red = red

    def _state(self) -> int:
        for c in (self.next, self.seen, self.chars):
            c.append({})
        self.total.append(0)
        self.ends.append(0)
        self.top.append(len(self.top))
        return len(self.top) - 1

    def _find(self, u: int) -> int:
        while self.top[u] != u:
            self.top[u] = self.top[self.top[u]]
            u = self.top[u]
        return u

    def _differs(self, f1: int, n1: int, f2: int, n2: int) -> bool:
        return bool(n1 and n2) and abs(f1 / n1 - f2 / n2) > (1 / math.sqrt(n1) + 1 / math.sqrt(n2)) * self.bound

    def _compatible(self, a: int, b: int) -> bool:
        stack, done = [(a, b)], set()
        while stack:
            a, b = (self._find(u) for u in stack.pop())
            if a == b or (a, b) in done:
                continue
            done.add((a, b))
            if self._differs(self.ends[a], self.total[a], self.ends[b], self.total[b]):
                return False
            for c in self.seen[a].keys() | self.seen[b].keys():
                if self._differs(self.seen[a].get(c, 0), self.total[a], self.seen[b].get(c, 0), self.total[b]):
                    return False
                if c in self.next[a] and c in self.next[b]:
                    stack.append((self.next[a][c], self.next[b][c]))
        return True

    def _fold(self, a: int, b: int) -> None:
        """Make b and what follows it one with a and what follows that; the root stays the root."""
        stack = [(a, b)]
        while stack:
            a, b = (self._find(u) for u in stack.pop())
            if a == b:
                continue
            if b == 0:
                a, b = b, a
            self.top[b] = a
            self.total[a] += self.total[b]
            self.ends[a] += self.ends[b]
            for own, other in ((self.seen[a], self.seen[b]), (self.chars[a], self.chars[b])):
                for c, n in other.items():
                    own[c] = own.get(c, 0) + n
            for c, v in self.next[b].items():
                if c in self.next[a]:
                    stack.append((self.next[a][c], v))
                else:
                    self.next[a][c] = v

    def frozen(self) -> tuple[list[dict[str, tuple[float, int]]], list[float]]:
        """For each state log2 probability and target by character, and log2 probability of the end.

        Each character of a class that the state knows counts as seen once more.
        """
        name = {u: k for k, u in enumerate(self.red)}
        steps = []
        for u in self.red:
            own: dict[str, tuple[float, int]] = {}
            for s, v in self.next[u].items():
                share, size = self.seen[u][s] / self.total[u], CLASS_SIZE.get(s, 1)
                for c in ALPHABET.get(s, s):
                    own[c] = (math.log2(share * (self.chars[u].get(c, 0) + 1) / (self.seen[u][s] + size)), name[self._find(v)])
            steps.append(own)
        return steps, [math.log2(self.ends[u] / self.total[u]) if self.ends[u] else math.log2(UNSEEN) for u in self.red]


ALPHABET = {"A": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "h": "abcdef", "a": "ghijklmnopqrstuvwxyz", "0": "0123456789"}


def score(frozen: tuple, word: str) -> float:
    """Log2 likelihood of the word, a character; unseen steps cost log2(UNSEEN) and stay in place."""
    steps, ends = frozen
    at, total, miss = 0, 0.0, math.log2(UNSEEN)
    for c in word:
        p, at = steps[at].get(c, (miss, at))
        total += p
    return (total + ends[at]) / (len(word) + 1)


def learn(labelled: dict[int, list[str]], background: list[str]) -> dict:
    """Frozen automata and floors by kind, the background's automaton, and the length from which runs are scored."""
    models, least = {}, None
    for kind, words in sorted(labelled.items()):
        if len(words) >= LEAST:
            model = Automaton(words).frozen()
            scores = sorted(score(model, w) for w in words)
            models[kind] = (model, scores[len(scores) // 50] - SLACK)
            shortest = min(map(len, words))
            least = shortest if least is None else min(least, shortest)
    return {"kinds": models, "background": Automaton(background).frozen() if background else None, "least": least}


def is_credential(model: dict, word: str) -> bool:
    ordinary = score(model["background"], word) if model["background"] else -math.inf
    for automaton, floor in model["kinds"].values():
        own = score(automaton, word)
        if own >= floor and own - ordinary >= MARGIN:
            return True
    return False


class Judge:
    """Learned spans of a run of credential characters: the run, or else its parts; remembers verdicts on short words."""

    def __init__(self, model: dict):
        self.model, self.least, self.known = model, model["least"], {}

    def _credential(self, word: str) -> bool:
        if len(word) > LONGEST:
            return is_credential(self.model, word)
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= REMEMBER:
                self.known.clear()
            found = self.known[word] = is_credential(self.model, word)
        return found

    def __call__(self, text: str, start: int, end: int) -> list[Span]:
        if self.least is None or end - start < self.least:
            return []
        if self._credential(text[start:end]):
            return [(start, 3, end)]
        parts = [m.span() for m in PARTS.finditer(text, start, end)]
        return [(a, 3, b) for a, b in parts if self.least <= b - a < end - start and self._credential(text[a:b])]


def long_words(data: np.ndarray, offsets: np.ndarray, least: int = MIN_RUN) -> list[list[tuple[int, int]]]:
    """Code-point ranges, document by document, of words of at least so many bytes."""
    n = len(offsets) - 1
    out: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    if not len(data):
        return out
    solid = ~textvec.SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    starts = solid.copy()
    starts[1:] &= ~solid[:-1] | first[1:-1]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:] | first[1:-1]
    a, b = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    keep = b - a >= least
    a, b = a[keep], b[keep]
    if len(a):
        points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        doc = np.searchsorted(offsets, a, side="right") - 1
        base = points[offsets[doc]]
        for d, lo, hi in zip(doc.tolist(), (points[a] - base).tolist(), (points[b] - base).tolist()):
            out[d].append((lo, hi))
    return out


def _documents(texts: pa.Array, least: int = MIN_RUN) -> Iterator[tuple[str, list[tuple[int, int]]]]:
    data, offsets = textvec.buffers(texts)
    lo = 0
    while lo < len(texts):
        hi = min(len(texts), max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + textvec.CHUNK, side="right")) - 1))
        own = offsets[lo : hi + 1]
        for text, words in zip(texts[lo:hi].to_pylist(), long_words(data[own[0] : own[-1]], own - own[0], least)):
            yield text or "", words
        lo = hi


def drawn(text: str, spans: list[Span]) -> list[tuple[str, str]]:
    """DRAWS runs outside base spans from places that follow from the text, with a hash each: common words come often, credentials seldom."""
    out, crc = [], zlib.crc32(text.encode())
    for k in range(DRAWS if text else 0):
        m = ORDINARY.search(text, zlib.crc32(f"{crc}:{k}".encode()) % len(text))
        if m and m.end(1) - m.start(1) <= LONGEST and not any(s < m.end(1) and m.start(1) < e for s, _, e in spans):
            out.append((hashlib.md5(f"{crc}:{k}:{m[1]}".encode()).hexdigest(), m[1]))
    return out


def train(docs: DataFrame) -> dict:
    """Learn from a bounded sample of the table's own base matches and of its other runs, over all rows."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Each task passes on only the smallest hashes of its own words, which is all that the sample can take.
        kept: dict[int, dict[str, str]] = {0: {}, 1: {}, 2: {}, 3: {}}
        limits = {0: SAMPLE, 1: SAMPLE, 2: SAMPLE, 3: BACKGROUND}
        for b in batches:
            for text, words in _documents(b.column(0)):
                spans, _ = base_spans(text, words)
                for start, kind, end in spans:
                    word = text[start:end] if kind else ASSIGN.match(text, start)[2]
                    if len(word) <= LONGEST:
                        kept[kind][hashlib.md5(word.encode()).hexdigest()] = word
                for key, word in drawn(text, spans):
                    kept[3][key] = word
            for kind, found in kept.items():
                if len(found) > 2 * limits[kind]:
                    kept[kind] = dict(sorted(found.items())[: limits[kind]])
        rows = [(k, h, w) for k, found in kept.items() for h, w in sorted(found.items())[: limits[k]]]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.string(), pa.string()))], names=["kind", "h", "word"])

    rows = docs.select("text").mapInArrow(run, "kind int, h string, word string").distinct()
    most = F.when(F.col("kind") == 3, BACKGROUND).otherwise(SAMPLE)
    first = lambda *by: F.row_number().over(Window.partitionBy("kind", *by).orderBy("h"))
    # Two steps: buckets of the hash, and then BUCKETS * most rows a kind at most.
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("h"), F.lit(BUCKETS)))
    rows = rows.withColumn("place", first("bucket")).where(F.col("place") <= most).withColumn("place", first()).where(F.col("place") <= most)
    found: dict[int, list[str]] = {}
    for r in rows.orderBy("kind", "h").collect():  # at most 3 * SAMPLE + BACKGROUND rows of LONGEST characters
        found.setdefault(r["kind"], []).append(r["word"])
    return learn({k: v for k, v in found.items() if k < 3}, found.get(3, []))


def scan(docs: DataFrame, model: dict | None = None) -> DataFrame:
    """doc_id, counts of base spans, their sha256, and all spans with the learned ones."""
    model = train(docs) if model is None else model
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge, least = Judge(model), min(MIN_RUN, model["least"] or MIN_RUN)
        for b in batches:
            rows = []
            for text, words in _documents(b.column(1), least):
                spans, others = base_spans(text, words, least)
                extra = [x for s, e in others for x in judge(text, s, e)]
                counts = [sum(k == kind for _, k, _ in spans) for kind in range(3)]
                rows.append((*counts, hashlib.sha256(joined(spans).encode()).hexdigest(), joined(sorted(spans + extra)), len(extra)))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([b.column(0), *columns], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_learned"])

    kinds = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_learned long"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, kinds)
