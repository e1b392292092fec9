"""The registered queries of the corpus operators, and their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import exact_dedup, hilbert, language_id, mixing, ngram_join, packing, quality, secret_scan, token_counts, wavelet
from quarry.llm.common import documents


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rules(documents(spark, sf_dir))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", *[f"{mixing.RESULT}.{c}" for c in ("size", "source_size", "target", "taken")])


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir))


def op4_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.read_documents(wavelet.write_shards(documents(spark, sf_dir)))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, sf_dir)).select(
        "doc_id", *[f"{exact_dedup.RESULT}.{c}" for c in ("keep_id", "group_size", "kept", "text_sha256")]
    )


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(documents(spark, sf_dir))


def op8_hilbert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.shards(documents(spark, sf_dir))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(documents(spark, sf_dir))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(documents(spark, sf_dir), n=3, percent=90)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


OP5 = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g USING (t)
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_mixing": mixing.ORACLE, "op5_exact_dedup": OP5}
