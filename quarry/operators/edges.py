"""Join edges between columns of different tables, from the overlap of their fingerprints."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

FLOOR, NAME_GATE, WEAK, STRONG, MANY_ROWS, FEW = 30, 0.6, 0.5, 0.7, 1000, 10_000


@F.pandas_udf(DoubleType())
def name_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b)])


def small(table: DataFrame) -> DataFrame:
    """A hint to broadcast a table of few short rows; a larger one is shuffled."""
    return F.broadcast(table) if table.limit(FEW + 1).count() <= FEW else table


def headers(prints: DataFrame, columns: DataFrame) -> DataFrame:
    """columns (side, table, column, type_class, n_rows, indexed, primary) with sample size, threshold and truncation."""
    sizes = prints.groupBy("table", "column").agg(
        F.countDistinct("h").alias("size"), F.max("threshold").alias("threshold"), F.bool_or("truncated").alias("truncated")
    )
    return columns.join(sizes, ["table", "column"])


def _side(header: DataFrame, which: str, prefix: str) -> DataFrame:
    rows = header.where(F.col("side") == which).drop("side")
    return rows.select(*[F.col(c).alias(f"{prefix}_{c}") for c in rows.columns])


def pairs(header: DataFrame) -> DataFrame:
    """Columns of side `left` against those of side `right`, of the same class; a row a pair of columns, never of values."""
    same = F.col("l_type_class") == F.col("r_type_class")
    return _side(header, "left", "l").join(_side(header, "right", "r"), same & F.col("l_type_class").isin("number", "text"))


def overlaps(prints: DataFrame, tested: DataFrame) -> DataFrame:
    """Adds common (naive) and, up to the smaller threshold, l_within, r_within and common_within."""
    left = prints.select(F.col("table").alias("l_table"), F.col("column").alias("l_column"), "h", F.col("rank").alias("rank"))
    right = prints.select(F.col("table").alias("r_table"), F.col("column").alias("r_column"), "h")
    keys = ["l_table", "l_column", "r_table", "r_column"]
    # A side without truncation knows all of its values, so only truncated sides set the limit.
    limit = F.least(F.when(F.col("l_truncated"), F.col("l_threshold")), F.when(F.col("r_truncated"), F.col("r_threshold")))
    wanted = small(tested.select(*keys, limit.alias("limit")))  # a row a column pair
    below = F.col("limit").isNull() | (F.col("rank") <= F.col("limit"))
    # Pairs first: a hash meets only the columns that its column is tested with.
    met = left.join(wanted, keys[:2]).join(right, ["h", *keys[2:]]).groupBy(*keys).agg(F.count(F.lit(1)).alias("common"), F.count_if(below).alias("common_within"))
    out = tested.join(met, keys, "left")
    for s in "lr":
        own = prints.select(F.col("table").alias(f"{s}_table"), F.col("column").alias(f"{s}_column"), "rank")
        within = own.join(wanted, [f"{s}_table", f"{s}_column"]).groupBy(*keys).agg(F.count_if(below).alias(f"{s}_within"))
        out = out.join(within, keys, "left")
    return out.na.fill(0, ["common", "common_within", "l_within", "r_within"])


def scored(prints: DataFrame, columns: DataFrame) -> DataFrame:
    """All tested pairs with containment, jaccard, the corrected containment, and what became of them."""
    rows = overlaps(prints, pairs(headers(prints, columns)))
    small = F.least("l_size", "r_size")
    numbers = F.col("l_type_class") == "number"
    rows = rows.withColumns(
        {
            "containment": F.col("common") / small,
            "jaccard": F.col("common") / (F.col("l_size") + F.col("r_size") - F.col("common")),
            "corrected": F.col("common_within") / F.greatest(F.least("l_within", "r_within"), F.lit(1)),
            "similarity": name_similarity(F.col("l_column"), F.col("r_column")),
        }
    )
    # Truncated samples are judged by the corrected figure, as the naive one is biased.
    measure = F.when(F.col("l_truncated") | F.col("r_truncated"), F.col("corrected")).otherwise(F.col("containment"))
    status = (
        F.when(small < FLOOR, "below-floor")
        .when(numbers & (measure >= WEAK) & (F.col("similarity") < NAME_GATE), "suppressed")
        .when(measure < WEAK, "no-overlap")
        .when(measure < STRONG, "weak")
        .otherwise("candidate")
    )
    strong = F.when((F.least("l_n_rows", "r_n_rows") >= MANY_ROWS) & ~numbers, "high").otherwise("medium")
    return rows.withColumn("status", status).withColumns(
        {
            "confidence": F.when(F.col("status") == "candidate", strong).when(F.col("status") == "weak", "weak"),
            "boosts": F.array_compact(
                F.array(
                    F.when(F.col("l_indexed") & F.col("r_indexed"), F.lit("idx-idx")),
                    F.when(F.col("r_primary"), F.lit("pi-right")),
                    F.concat(F.lit("name-sim:"), F.round("similarity", 2).cast("string")),
                    F.when(numbers, F.lit("int-pair:name-gated")),
                )
            ),
        }
    )


def accepted(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("status").isin("candidate", "weak"))


def with_code_evidence(rows: DataFrame, intents: DataFrame) -> DataFrame:
    """Edges that views declare: they pass the name gate, and are high with enough overlap, else medium at most."""
    keys = ["l_table", "l_column", "r_table", "r_column"]
    declared = intents.select(
        F.col("table").alias("l_table"), F.col("column").alias("l_column"), F.col("other_table").alias("r_table"), F.col("other_column").alias("r_column")
    )
    mirrored = declared.select(F.col("r_table").alias("l_table"), F.col("r_column").alias("l_column"), F.col("l_table").alias("r_table"), F.col("l_column").alias("r_column"))
    both = declared.unionByName(mirrored).distinct().withColumn("declared", F.lit(True))
    tested = rows.select(*keys)
    tested = tested.unionByName(tested.select(F.col("r_table").alias("l_table"), F.col("r_column").alias("l_column"), F.col("l_table").alias("r_table"), F.col("l_column").alias("r_column")))
    seeds = declared.distinct().join(tested, keys, "left_anti").withColumn("declared", F.lit(True))  # no fingerprints to test them by
    rows = rows.join(both, keys, "left").withColumn("declared", F.coalesce("declared", F.lit(False)))
    rows = rows.unionByName(seeds, allowMissingColumns=True)
    seen = F.coalesce(F.greatest("containment", "corrected"), F.lit(0.0))
    return rows.withColumns(
        {
            "status": F.when(F.col("declared"), F.lit("candidate")).otherwise(F.col("status")),
            "confidence": F.when(F.col("declared"), F.when(seen >= STRONG, "high").otherwise("medium")).otherwise(F.col("confidence")),
            "boosts": F.when(F.col("declared") & (seen == 0), F.array_append(F.coalesce("boosts", F.array().cast("array<string>")), F.lit("no-value-evidence"))).otherwise(F.col("boosts")),
        }
    )


def counters(rows: DataFrame) -> DataFrame:
    """One row: how many pairs were accepted, weak, suppressed, below the evidence floor or without overlap."""
    names = {"accepted": "candidate", "weak": "weak", "suppressed_int_pairs": "suppressed", "below_evidence_floor": "below-floor", "no_overlap": "no-overlap"}
    return rows.agg(*[F.count_if(F.col("status") == s).alias(n) for n, s in names.items()])


def boosted(rows: DataFrame, weights: dict[str, float], strong: float = STRONG) -> DataFrame:
    """A score: the corrected containment and a configured weight for each boost label (by its name before a colon), at most 1; the label of what it reaches."""
    weight = F.lit(0.0)
    for name, w in sorted(weights.items()):
        weight = weight + F.when(F.exists("boosts", lambda b: F.substring_index(b, ":", 1) == name), F.lit(w)).otherwise(0.0)  # noqa: B023
    rows = rows.withColumn("score", F.least(F.lit(1.0), F.coalesce("corrected", "containment", F.lit(0.0)) + weight))
    return rows.withColumn("reached", F.when(F.col("score") >= strong, "strong").when(F.col("score") >= WEAK, "weak").otherwise("none"))


def with_confirmations(rows: DataFrame, confirmed: DataFrame, types: DataFrame) -> DataFrame:
    """Edges that a person confirmed outrank scores; they are stale-confirmed once a side's type differs from that of the confirmation.

    confirmed: the four key columns, l_type, r_type, by, date. types: table, column, type as of now.
    """
    keys = ["l_table", "l_column", "r_table", "r_column"]
    now = lambda s: types.select(F.col("table").alias(f"{s}_table"), F.col("column").alias(f"{s}_column"), F.col("type").alias(f"{s}_now"))
    held = confirmed.join(now("l"), keys[:2], "left").join(now("r"), keys[2:], "left")
    same = F.col("l_type").eqNullSafe(F.col("l_now")) & F.col("r_type").eqNullSafe(F.col("r_now"))
    held = held.select(*keys, F.when(same, "confirmed").otherwise("stale-confirmed").alias("standing"), F.col("by").alias("confirmed_by"), F.col("date").alias("confirmed_date"))
    rows = rows.join(held, keys, "full_outer")
    return rows.withColumn("confidence", F.when(F.col("standing") == "confirmed", "confirmed").otherwise(F.col("confidence")))
