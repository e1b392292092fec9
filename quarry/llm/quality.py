"""Quality rules by distribution: Jensen-Shannon distance to language references.

One pass over whole texts counts, for each document, the base figures, a histogram of
character classes and one of common words (fixed short lists of function words of four
languages, as many of the most frequent words of each other language that documents are
labelled with, and everything else). The references of a language are the sums of those
histograms over *all* documents labelled with it. A document's distance to a language is
the Jensen-Shannon distance (square root of the divergence in bits, 0 to 1) of either
histogram; its best language counts. Work and columns grow with the number of languages. Documents below MIN_CHARS or MIN_WORDS are too short to
judge by either histogram and pass that part (the minimum-length guards); a document passes
if the class distance is at most MAX_CLASS and the word distance at most word_bound(): the
distance that as many words drawn from the reference are expected to have, and a margin. Few
words are far from any reference by chance alone, many are not.

Defined results: null or empty text has no words and fails the base rule; without any
labelled document the references are those of all documents together; repeated rows agree;
an empty table gives an empty result; extra columns are kept by `kept_rows`.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm import textvec
from quarry.llm.common import small_batches, written

#: Frequent function words of each language.
COMMON = {
    "en": "the of and to in a is that it was for on are with as at be this by from or an not have had his they but which one you were all we can her has there been their".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über".split(),
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont la mais comme ou si leur y dont aux elle cette son ont".split(),
    "es": "de la que el en y a los del se las por un para con no una su al lo como más pero sus le ya o este sí porque esta entre cuando muy sin sobre también me hasta hay donde".split(),
}
#: Words taken from the documents of a language without a list.
LEARNED = 45
CLASSES = ("lower", "upper", "digit", "space", "stop", "symbol", "accented", "other")
SYMBOLS = b"#*$%&|<>"

MIN_WORDS, MIN_CHARS = 100, 200
MAX_CLASS = 0.28
#: Above the expected word distance: so many times it, or so much more, whichever is larger.
WORD_FACTOR, WORD_MARGIN = 1.55, 0.1
BASE_WORDS, BASE_REPEATS = 50, 50

FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
STATS = "doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, classes array<int>, common array<int>"


def _class_table() -> np.ndarray:
    """Class of each byte; 8 for continuation bytes, which do not count."""
    out = np.full(256, CLASSES.index("other"), np.uint8)
    for name, members in (
        ("lower", range(97, 123)), ("upper", range(65, 91)), ("digit", range(48, 58)), ("space", (*range(9, 14), 32)),
        ("stop", b".,;:!?'\"()-"), ("symbol", SYMBOLS + b"+/=@[]\\^_`{}~"), ("accented", range(0xC3, 0xD0)), ("", range(0x80, 0xC0)),
    ):
        out[list(members)] = CLASSES.index(name) if name else 8
    return out


References = dict[str, tuple[list[int], list[int]]]
BYTE_CLASS = _class_table()
SYMBOL = np.zeros(256, bool)
SYMBOL[list(SYMBOLS)] = True


def duplicate_lines(text: str | None) -> int:
    r"""Lines (\n-split) with a word that equal an earlier line."""
    if not text or "\n" not in text:
        return 0
    lines = [line for line in text.split("\n") if line.strip(" \t\n\r\x0b\x0c")]
    return len(lines) - len(set(lines))


def repeat_words(w: textvec.Words, n: int) -> np.ndarray:
    """For each document, words in 3-word windows that it has twice or more."""
    size = 3
    doc, h = textvec.windows(w, size)
    if not len(h):
        return np.zeros(n, np.int64)
    places = np.flatnonzero(w.doc[: len(w.doc) - size + 1] == w.doc[size - 1 :])
    with np.errstate(over="ignore"):
        key = textvec.mix(h + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(w.doc), bool)
    for k in range(size):
        covered[places[twice] + k] = True
    return np.bincount(w.doc[covered], minlength=n)


def common_words(docs: DataFrame) -> list[str]:
    """The words of all lists and, for each other non-null language, its LEARNED most frequent words; sorted."""
    other = docs.where(F.col("lang").isNotNull() & ~F.col("lang").isin(*COMMON))
    words = other.select("lang", F.explode(F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))).alias("word"))
    counts = words.groupBy("lang", F.lower("word").alias("word")).agg(F.count(F.lit(1)).alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))  # each task keeps its first ones
    learned = counts.withColumn("place", place).where(F.col("place") <= LEARNED).select("word").distinct()
    return sorted({w for words in COMMON.values() for w in words} | {r["word"] for r in learned.collect()})  # LEARNED rows a language


def _bins(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the common words, small and capitalised, with their bins."""
    pairs = sorted({textvec.word_hash(form.encode()): k for k, word in enumerate(words) for form in (word.capitalize(), word)}.items())
    return np.array([h for h, _ in pairs], np.uint64), np.array([k for _, k in pairs])


def measure(texts: pa.Array, known: np.ndarray, bins: np.ndarray, size: int) -> Iterator[tuple[int, int, dict[str, np.ndarray], np.ndarray, np.ndarray]]:
    """Row ranges of texts with their base figures and both histograms; size: number of common words."""
    for lo, hi, w in textvec.chunks(texts):
        n = hi - lo
        solid = ~w.space
        classes = np.zeros((n, len(CLASSES)), np.int32)
        kinds = BYTE_CLASS[w.data]
        for k in range(len(CLASSES)):
            classes[:, k] = w.per_doc(kinds == k)
        common = np.zeros((n, size + 1), np.int32)
        if len(w.hash):
            at = np.minimum(np.searchsorted(known, w.hash), len(known) - 1)
            column = np.where(known[at] == w.hash, bins[at], size)
            common = np.bincount(w.doc * (size + 1) + column, minlength=common.size).reshape(common.shape).astype(np.int32)
        figures = {
            "n_words": w.count.astype(np.int64), "word_chars": w.per_doc(solid & ((w.data & 0xC0) != 0x80)), "n_symbols": w.per_doc(SYMBOL[w.data]),
            "n_dup_lines": np.array([duplicate_lines(t) for t in texts[lo:hi].to_pylist()], np.int64), "n_repeat_words": repeat_words(w, n).astype(np.int64),
        }
        yield lo, hi, figures, classes, common


def stats(docs: DataFrame, words: list[str]) -> DataFrame:
    """The base figures and both histograms of each row, in one pass over whole texts."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, bins = _bins(words)
        wide = lambda m: pa.ListArray.from_arrays(np.arange(0, m.size + 1, m.shape[1], dtype=np.int32), m.ravel())
        for b in batches:
            for lo, hi, figures, classes, common in measure(b.column(2), known, bins, len(words)):
                columns = {"doc_id": b.column(0)[lo:hi], "lang": b.column(1)[lo:hi], **{c: pa.array(v) for c, v in figures.items()}}
                yield pa.RecordBatch.from_pydict(columns | {"classes": wide(classes), "common": wide(common)})

    return docs.select(F.col("doc_id").cast("long"), "lang", "text").mapInArrow(run, STATS)


def references(figures: DataFrame, size: int) -> References:
    """For each language, in order, the sums of both histograms over all documents labelled with it; without any label "" has all."""
    sums = [F.sum(F.col(c)[k].cast("long")).alias(f"{c}{k}") for c, n in (("classes", len(CLASSES)), ("common", size + 1)) for k in range(n)]
    rows = figures.groupBy("lang").agg(*sums).collect()  # a row a language
    found = {r["lang"]: ([r[f"classes{k}"] for k in range(len(CLASSES))], [r[f"common{k}"] for k in range(size + 1)]) for r in rows}
    return {k: found[k] for k in sorted(k for k in found if k is not None)} or {"": v for v in found.values()}


def divergence(counts: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each row of counts to the reference, 0 to 1; empty rows have 1."""
    p = counts / np.maximum(counts.sum(1, keepdims=True), 1)
    q = (reference / max(reference.sum(), 1))[None, :]
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        part = lambda a: np.where(a > 0, a * np.log2(np.where(a > 0, a, 1) / np.where(m > 0, m, 1)), 0).sum(1)
        return np.sqrt(np.clip((part(p) + part(q)) / 2, 0, 1))


#: Numbers of words for which expected distances are worked out; between them they are interpolated.
LENGTHS = np.geomspace(10, 1e6, 100)


def expected_distance(reference: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance to the reference that LENGTHS words drawn from it are expected to have.

    Bins with few expected words are summed over Poisson counts; others have the quadratic limit.
    """
    q = reference[reference > 0] / max(reference.sum(), 1)
    x = np.arange(200)
    log_factorial = np.array([math.lgamma(k + 1) for k in x])
    out = np.zeros(len(LENGTHS))
    for k, n in enumerate(LENGTHS):
        rare = q[n * q < 60][:, None]
        chance = np.exp(x * np.log(n * rare) - n * rare - log_factorial)
        p = x / n
        m = (p + rare) / 2
        part = np.where(x > 0, p * np.log2(np.where(x > 0, p, 1) / m), 0) + rare * np.log2(rare / m)
        out[k] = (chance * part).sum() / 2 + ((1 - q[n * q >= 60]) / (8 * math.log(2) * n)).sum()
    return np.sqrt(np.maximum(out, 0))


def word_bound(expected: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    """Largest word distance that passes, by the expected distances of LENGTHS words."""
    at = np.interp(np.log(np.maximum(n_words, 1)), np.log(LENGTHS), expected)
    return np.maximum(WORD_FACTOR * at, at + WORD_MARGIN)


def judge(known: References) -> Callable[[dict[str, np.ndarray], np.ndarray, np.ndarray], dict[str, np.ndarray]]:
    """The verdict on rows by their figures and histograms."""
    expected = [expected_distance(np.array(common, float)) for _, common in known.values()] or [np.zeros(len(LENGTHS))]
    names = np.array([*known, ""], object)

    def verdict(figure: dict[str, np.ndarray], classes: np.ndarray, common: np.ndarray) -> dict[str, np.ndarray]:
        n = len(classes)
        by_class, by_word = np.ones((len(expected), n)), np.ones((len(expected), n))
        for k, reference in enumerate(known.values()):
            by_class[k] = divergence(classes.astype(float), np.array(reference[0], float))
            by_word[k] = divergence(common.astype(float), np.array(reference[1], float))
        best = (by_class + by_word).argmin(0)
        pick = lambda m: m[best, np.arange(n)]
        failed = (figure["n_words"] < BASE_WORDS) | (100 * figure["n_repeat_words"] > BASE_REPEATS * figure["n_words"])
        far_class = (figure["word_chars"] >= MIN_CHARS) & (pick(by_class) > MAX_CLASS)
        bound = pick(np.array([word_bound(e, figure["n_words"]) for e in expected]))
        far_words = (figure["n_words"] >= MIN_WORDS) & (pick(by_word) > bound)
        return {
            "base_failed": failed, "kept": ~(failed | far_class | far_words), "nearest": names[best],
            "class_distance": pick(by_class), "word_distance": pick(by_word),
        }

    return verdict


def rules(docs: DataFrame) -> DataFrame:
    """doc_id, base figures, base_failed, kept, best language and both distances of each row."""
    words = common_words(docs)
    figures, _ = written(stats(docs, words), "quality-stats")
    verdict = judge(references(figures, len(words)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_rows
            matrix = lambda c: b.column(c).flatten().to_numpy(zero_copy_only=False).reshape(n, -1)  # noqa: E731, B023
            figure = {c: b.column(c).to_numpy() for c in FIGURES}
            found = verdict(figure, matrix("classes"), matrix("common"))
            columns = {"doc_id": b.column("doc_id"), **{c: pa.array(v) for c, v in figure.items()}}
            yield pa.RecordBatch.from_pydict(columns | {c: pa.array(v, pa.string() if c == "nearest" else None) for c, v in found.items()})

    kinds = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
    return figures.mapInArrow(run, kinds + ", base_failed boolean, kept boolean, nearest string, class_distance double, word_distance double")


def kept_rows(docs: DataFrame) -> DataFrame:
    """The rows of docs that the rules keep, with docs' own columns.

    Each row is judged where it lies, in a second pass over the texts, and so needs no id.
    """
    words = common_words(docs)
    verdict, at = judge(references(stats(docs, words), len(words))), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, bins = _bins(words)
        for b in batches:
            for lo, hi, *found in measure(b.column(at), known, bins, len(words)):
                yield b.slice(lo, hi - lo).filter(pa.array(verdict(*found)["kept"]))

    return docs.mapInArrow(run, docs.schema)
