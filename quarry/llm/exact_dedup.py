"""Exact dedup: combine locally, then by salted digest groups, then globally.

Every stage groups by the digest *and* the whole content, so a digest alone never makes two
texts equal. A hot group is spread over `salts` reducers, by a hash of a row's other columns, after each task has combined its
own rows; a reducer of the last stage gets one row of a text from each salt at most.

Defined results: a null text counts as empty; of equal texts the row with the largest id
stays (a null id only if no row of the group has one), of those with one id the row whose
other columns hash highest, so reruns agree; of rows that are equal in all columns one stays;
an empty table gives an empty result; extra columns are kept as they are, whatever their names
(but RESULT, which the operator adds).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SALTS = 64
#: Added columns; their names are unlikely in a table of documents. RESULT is the struct that exact_dedup adds.
SHA, CHECK, SALT, TIE, RESULT = "_dedup_sha", "_dedup_check", "_dedup_salt", "_dedup_tie", "_dedup"


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """All rows and columns of docs, with keep_id, group_size, kept and text_sha256 in the struct RESULT."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    others = [F.col(f"`{f.name}`") for f in docs.schema.fields if f.name not in (id_col, text_col) and "map<" not in f.dataType.simpleString()]
    rows = docs.withColumns(
        {
            SHA: F.unhex(F.sha2(text, 256)),
            CHECK: F.xxhash64(text),
            TIE: F.xxhash64(F.col(id_col), *others),
        }
    ).withColumn(SALT, F.pmod(F.col(TIE), F.lit(salts)).cast("int"))
    key = [SHA, CHECK, SALT]
    # The partial aggregation in each task is the local stage, the final one merges salted groups.
    salted = (
        rows.select(*key, text.alias("content"), F.struct(F.col(id_col).alias("id"), F.col(TIE).alias("tie")).alias("own"))
        .groupBy(*key, "content")
        .agg(F.max("own").alias("best"), F.count(F.lit(1)).alias("n"))
    )
    final = (
        salted.repartition(SHA, CHECK)
        .groupBy(SHA, CHECK, "content")
        .agg(F.max("best").alias("best"), F.sum("n").alias("group_size"))
        .groupBy(SHA, CHECK)
        .agg(F.max("best").alias("best"), F.max("group_size").alias("group_size"), F.count(F.lit(1)).alias("contents"))
        .withColumn(
            "group_size",
            F.when(F.col("contents") > 1, F.raise_error(F.lit("two texts share a sha256 and an xxhash64"))).otherwise(F.col("group_size")),
        )
        .drop("contents")
    )
    # Narrow: the salted groups' keys alone, so that their texts are shuffled once and not twice.
    winners = rows.select(*key).distinct().join(final, [SHA, CHECK]).withColumnsRenamed({"best": "_dedup_best", "group_size": "_dedup_size"})
    found = rows.join(winners, key)
    # Of rows that are equal in all columns one stays; they share a salt.
    first = F.row_number().over(Window.partitionBy(*key, F.col(id_col), TIE).orderBy(F.lit(1)))
    best = F.col(id_col).eqNullSafe(F.col("_dedup_best.id")) & (F.col(TIE) == F.col("_dedup_best.tie"))
    return found.withColumn(
        RESULT,
        F.struct(
            F.col("_dedup_best.id").alias("keep_id"), F.col("_dedup_size").alias("group_size"), (best & (first == 1)).alias("kept"), F.lower(F.hex(SHA)).alias("text_sha256")
        ),
    ).select(*[F.col(f"`{c}`") for c in docs.columns], RESULT)


def survivors(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, with docs' own columns."""
    return exact_dedup(docs).where(f"{RESULT}.kept").drop(RESULT)
