"""Language by compression: the smallest zstandard output with a language's raw dictionary.

Fit: for each language BUCKETS hash buckets of its labelled training rows give the row with
the smallest hash, and the first EXCERPT characters of those rows make a raw-content
dictionary. This bounded sample (BUCKETS * EXCERPT characters a language, and so many buckets
fewer that all languages together have FITTED characters at most, one excerpt each at least) is all that is
fitted; every language with a labelled row is. Prediction reads whole texts.

Predict: letters are lower-cased and all between them becomes one space, in texts as in
dictionaries. The whole text is compressed in blocks of BLOCK bytes, each of its own, so that
a long text still leans on the dictionary and not on itself; the smallest total wins, ties go to the
language that comes first by name. A language is left within a text once its size so far is too large
to win or to change the score. score is the relative margin to the second, scaled so
that RELIABLE or more is 1; below NARROW the row is marked rejected and keeps its best guess.

Defined results: null text and text without a letter are `und`, score 0; without any labelled
row everything is `und`; with one language it is predicted with score 1; repeated rows agree;
an empty table gives an empty result; extra columns do not matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import small_batches

BUCKETS, EXCERPT, FITTED, LEVEL, BLOCK = 64, 6000, 32_000_000, 12, 512
NARROW, RELIABLE = 0.01, 0.10
LETTERS = re.compile(r"[^\W\d_]+")
RESULT = "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean"


def fold(id_col: str = "doc_id") -> F.Column:
    """0 to 3, from the crc32 of the id as text; 2 is held out. A null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(4))


def dictionaries(docs: DataFrame, buckets: int = BUCKETS, excerpt: int = EXCERPT) -> dict[str, bytes]:
    """A raw dictionary for each language, from training rows only."""
    rows = docs.where((fold() != 2) & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        "lang", F.substring("text", 1, excerpt).alias("part"), F.xxhash64("doc_id", F.lit("dictionary")).alias("h")
    )
    languages = rows.select("lang").distinct().count()
    buckets = max(1, min(buckets, FITTED // (excerpt * max(1, languages))))
    picked = rows.groupBy("lang", F.pmod("h", F.lit(buckets)).alias("bucket")).agg(F.min(F.struct("h", "part")).alias("first"))
    found = picked.groupBy("lang").agg(F.array_sort(F.collect_list("first.part")).alias("parts")).collect()  # FITTED characters, or one excerpt a language
    return {r["lang"]: letters("\n".join(r["parts"])) for r in sorted(found, key=lambda r: r["lang"])}


def letters(text: str) -> bytes:
    """The text's words of letters in lower case, with a space between them; nothing if it has no letter at all."""
    found = " ".join(LETTERS.findall(text.lower()))
    return found.encode() if any(map(str.isalpha, found)) else b""  # fractions and Roman numerals count as word characters


class Classifier:
    def __init__(self, content: dict[str, bytes]):
        self.names = list(content)
        self.packers = []
        for data in content.values():
            raw = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            raw.precompute_compress(level=LEVEL)
            self.packers.append(zstandard.ZstdCompressor(dict_data=raw, write_content_size=False, write_dict_id=False))

    def __call__(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        """lang_pred, score and rejected of each text.

        One language's dictionary is used for all texts before the next one's, so that it stays in the processor's cache. The language
        of the smallest first block goes over a whole text first. Another one is left as soon as its size so far is RELIABLE above the
        least whole one: its total, and with that every other of its kind, cannot be the smallest nor make score less than 1.
        """
        out: list[tuple[str, float, bool]] = [("und", 0.0, True)] * len(texts)
        found = ((k, letters(t or "")) for k, t in enumerate(texts))
        blocks = {k: [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)] for k, data in found if data}
        if len(self.names) < 2:
            return [(self.names[0], 1.0, False) if self.names and k in blocks else r for k, r in enumerate(out)]
        first = [{k: len(p.compress(own[0])) for k, own in blocks.items()} for p in self.packers]
        guess = {k: min(range(len(first)), key=lambda n: first[n][k]) for k in blocks}
        least: dict[int, int] = {}  # of each text, the smallest size of all its blocks
        sizes: dict[int, list[tuple[int, str]]] = {k: [] for k in blocks}
        for guessed in (True, False):
            for n, (p, name) in enumerate(zip(self.packers, self.names)):
                for k, own in blocks.items():
                    if (guess[k] == n) != guessed:
                        continue
                    size, best = first[n][k], least.get(k)
                    for b in own[1:]:
                        if best and size > best and (size - best) / size >= RELIABLE:
                            break
                        size += len(p.compress(b))
                    sizes[k].append((size, name))
                    least[k] = min(size, best or size)
        for k, found_sizes in sizes.items():
            one, two = sorted(found_sizes)[:2]
            margin = (two[0] - one[0]) / two[0]
            out[k] = one[1], min(1.0, margin / RELIABLE), margin < NARROW
        return out


def identify(docs: DataFrame, content: dict[str, bytes] | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score and rejected of each row."""
    content = dictionaries(docs) if content is None else content
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classify = Classifier(content)
        for b in batches:
            out = classify(b.column(2).to_pylist())
            columns = [pa.array([r[k] for r in out], kind) for k, kind in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *columns], names=["doc_id", "held_out", "lang_pred", "score", "rejected"])

    return docs.select(F.col("doc_id").cast("long"), (fold() == 2).alias("held_out"), "text").mapInArrow(run, RESULT)
