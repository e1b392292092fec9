"""Drift between two profiles: schema, profile, annotation and table changes with tolerances.

Profiles are (table, column, type, n_rows, n_distinct, distinct_ratio, null_rate, description)
and, where both sides have them, any of the OPTIONAL columns. Tables of one side alone are told once a table.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RELATIVE, ABSOLUTE = 0.10, 0.05
#: Compared exactly: reason and class by column of the profiles.
OPTIONAL = {
    "nullable": ("type-changed", "schema"), "constraints": ("constraint-changed", "schema"), "indexes": ("index-changed", "schema"), "fingerprint": ("fingerprint-changed", "profile"),
    "flags": ("flags-changed", "profile"), "format": ("format-changed", "profile"), "range": ("range-changed", "profile"), "dense_sequence": ("dense_sequence-changed", "profile"),
    "top_values": ("top_values-changed", "profile"), "annotation": ("annotation-changed", "annotation"), "table_annotation": ("table-annotation-changed", "annotation"),
}
#: Facts of a whole table: told for its first column alone.
BY_TABLE = {"n_rows-shifted", "flags-changed", "table-annotation-changed"}


def shifted(old: Column, new: Column, relative: bool) -> Column:
    """Beyond tolerance; appearing, disappearing and, for relative ones, a change from 0 always are."""
    one_missing = old.isNull() != new.isNull()
    gap = F.abs(new - old)
    beyond = F.when(old == 0, gap > 0).otherwise(gap / F.abs(old) > RELATIVE) if relative else gap > ABSOLUTE
    return one_missing | F.coalesce(beyond, F.lit(False))


def drift(old: DataFrame, new: DataFrame, by_table: bool = False) -> DataFrame:
    """table, column, class, reason, invalidates; by_table: what a table's columns share is told once, with a null column."""
    keys = ["table", "column"]
    side = lambda df, p: df.select(*[F.col(c).alias(f"{p}_{c}") for c in df.columns])
    both = side(old, "o").join(side(new, "n"), (F.col("o_table") == F.col("n_table")) & (F.col("o_column") == F.col("n_column")), "full_outer")
    here = F.col("o_column").isNotNull() & F.col("n_column").isNotNull()
    pair = lambda c: (F.col(f"o_{c}"), F.col(f"n_{c}"))
    common = [c for c in OPTIONAL if c in old.columns and c in new.columns]
    differs = lambda c: ~pair(c)[0].eqNullSafe(pair(c)[1])
    retyped = differs("type") | differs("nullable") if "nullable" in common else differs("type")
    found = [
        (F.col("o_column").isNull(), "schema", "column-added"),
        (F.col("n_column").isNull(), "schema", "column-dropped"),
        (here & retyped, "schema", "type-changed"),
        *[(here & shifted(*pair(c), True), "profile", f"{c}-shifted") for c in ("n_rows", "n_distinct")],
        *[(here & shifted(*pair(c), False), "profile", f"{c}-shifted") for c in ("distinct_ratio", "null_rate")],
        (here & differs("description"), "annotation", "description-changed"),
        *[(here & differs(c), OPTIONAL[c][1], OPTIONAL[c][0]) for c in common if c != "nullable"],
    ]
    marks = F.array_compact(F.array(*[F.when(c, F.struct(F.lit(k).alias("class"), F.lit(r).alias("reason"))) for c, k, r in found]))
    rows = both.select(*[F.coalesce(*pair(k)).alias(k) for k in keys], F.explode(marks).alias("mark"))
    rows = rows.select(*keys, "mark.class", "mark.reason")
    if by_table:
        names = lambda df: df.select("table").distinct()
        gone, added = names(old).join(names(new), "table", "left_anti"), names(new).join(names(old), "table", "left_anti")
        whole = gone.withColumn("reason", F.lit("table-dropped")).unionByName(added.withColumn("reason", F.lit("table-added")))
        whole = whole.select("table", F.lit(None).cast("string").alias("column"), F.lit("table").alias("class"), "reason")
        rows = rows.join(whole.select("table"), "table", "left_anti")
        shared = F.col("reason").isin(sorted(BY_TABLE))
        rows = rows.withColumn("column", F.when(~shared, F.col("column"))).distinct().unionByName(whole)
    return rows.withColumn("invalidates", F.col("class") != "annotation")


def snapshot(lines: DataFrame) -> DataFrame:
    """Body lines of documents (path, block, tag, key, value) -> a row a column with the facts that drift compares.

    A value's trailing comment is not part of it; confirmed lines are carried along.
    """
    fact = lambda k: F.first(F.when(F.col("key") == k, F.col("value")), True)
    named = lambda k: F.array_sort(F.collect_list(F.when(F.col("key") == k, F.col("value"))))
    number = lambda text, k: F.regexp_extract(text, rf"{k}: ([-0-9.eE]+)", 1).try_cast("double")
    counts = F.first(F.when(F.col("key").isin("distinct_count", "counts"), F.concat("key", F.lit(": "), "value")), True)
    rows = lines.where("block is not null").groupBy("path", "block").agg(
        fact("type").alias("type"), counts.alias("counts"), named("constraint").alias("constraints"), named("index").alias("indexes"), fact("fingerprint").alias("fingerprint"),
        fact("format").alias("shown"), fact("dense_sequence").alias("dense_sequence"), fact("top_values").alias("top_values"),
        F.array_join(F.collect_list(F.when((F.col("tag") == "inferred") & F.col("key").isNull(), F.col("text"))), " ").alias("description"),
        F.collect_list(F.when(F.col("tag").isin("confirmed", "stale-confirmed"), F.col("raw"))).alias("confirmed"),
    )
    return rows.select(
        F.col("path").alias("table"), F.col("block").alias("column"), "type", number(F.col("counts"), "distinct_count").alias("n_distinct"),
        number(F.col("counts"), "distinct_ratio").alias("distinct_ratio"), number(F.col("counts"), "null_rate").alias("null_rate"), "constraints", "indexes", "fingerprint",
        F.regexp_replace(F.regexp_extract("shown", r"^([^;]*)", 1), r"\s+$", "").alias("format"), F.regexp_extract("shown", r"range: (.*)$", 1).alias("range"),
        "dense_sequence", "top_values", F.col("description").alias("annotation"), "confirmed", F.lit(None).cast("long").alias("n_rows"), F.lit("").alias("description"),
    )


def stale(found: DataFrame) -> DataFrame:
    """A row an invalidated table with its reasons, and whether confirmed lines have to be demoted."""
    rows = found.where("invalidates").groupBy("table").agg(F.array_sort(F.collect_set("reason")).alias("reasons"), F.bool_or(F.col("class").isin("schema", "table")).alias("demotes"))
    return rows.orderBy("table")


def manifest(found: DataFrame, baseline: bool = False) -> str:
    """The stale tables as a JSON document; a first run invalidates nothing."""
    rows = [] if baseline else [r.asDict() for r in stale(found).collect()]  # a row a changed table
    return json.dumps({"baseline": baseline, "stale": rows}, indent=1, sort_keys=True) + "\n"


def report(found: DataFrame) -> DataFrame:
    """How often each reason was found."""
    return found.groupBy("class", "reason").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("table").alias("tables"))
