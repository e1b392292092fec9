"""The corpus pipeline: quality rules, exact dedup, near-duplicate join, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but
the last return the columns of documents. run() writes each stage's rows to the shared
folder and reads them again, so that a lost executor costs a stage and not the pipeline; what a
stage wrote besides is deleted then.

Defined results: rows are judged and kept one by one, told apart by all their columns, so null
and repeated ids lose no row; null and empty texts go in the first stage (they have no words);
of texts that are equal or near each other one row stays; extra columns pass through all stages
but the last, whatever their names; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import exact_dedup, mixing, ngram_join, packing, quality
from quarry.llm.common import discard, documents, made, remove, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep; each row is judged for itself, whatever its doc_id."""
    return quality.kept_rows(docs)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest doc_id."""
    return exact_dedup.survivors(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of documents linked by five-word shingles at 0.8 or more the one with the smallest doc_id; unlinked ones all stay.

    A row is told by doc_id and text, which the stage before leaves once at most.
    """
    gone, keys = ngram_join.redundant(docs), ngram_join.TEXT_KEY
    rows = ngram_join.with_text_key(docs)
    same = rows["doc_id"].eqNullSafe(gone["doc_id"])
    for c in keys:
        same &= rows[c] == gone[c]
    return rows.join(gone, same, "left_anti").drop(*keys)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.repeated(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: a row a piece with its sequence_id and offset."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_duplicates),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources", source_mix),
    ("best-fit packing", packed),
]

#: Tokenising and best-fit packing are beyond SQL; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    last = ""
    for k, (_, stage) in enumerate(STAGES[:-1]):
        mark = made()
        docs, path = written(stage(spark, docs, sf_dir), f"stage-{k}")
        discard(spark, mark, path)
        if last:
            remove(spark, last)
        last = path
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
