"""Decision rules over a profile: what may be sampled or listed, and why not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RATIO, TOP_DISTINCT, AGE, BAND, FACTOR = 0.5, 30, 90, 0.15, 2.0
JUNK = ("_BKP", "_TEST", "_OLD", "TMP_")


def fingerprint(sensitive: Column, indexed: Column, ratio: Column) -> Column:
    """allow, or why a column gets no fingerprint; the ratio must exceed the gate."""
    return F.when(sensitive, "sensitive").when(indexed | F.coalesce(ratio > RATIO, F.lit(False)), "allow").otherwise("cardinality-gate")


def top_n(sensitive: Column, distinct: Column) -> Column:
    return F.when(sensitive, "sensitive").when(distinct.isNull(), "unknown-distinct").when(distinct <= TOP_DISTINCT, "allow").otherwise("too-many-values")


def junk(table: Column, n_rows: Column, patterns=JUNK) -> Column:
    named = F.lit(False)
    for p in patterns:
        named = named | F.lower(table).contains(p.lower())
    return F.coalesce(n_rows == 0, F.lit(False)) | named


def sensitive(table: Column, column: Column, listed: list[str], schema: str = "") -> Column:
    """Listed as column, table.column or schema.table.column; case does not matter."""
    names = [n.lower() for n in listed] or [""]
    bare, two = F.lower(column), F.lower(F.concat_ws(".", table, column))
    return bare.isin(names) | two.isin(names) | F.concat(F.lit(f"{schema.lower()}."), two).isin(names)


def fresh(stats_date: Column, today: Column, days: int = AGE) -> Column:
    return F.coalesce(stats_date >= F.date_sub(today, days), F.lit(False))


def near_boundary(ratio: Column, distinct: Column) -> Column:
    near = F.abs(ratio - RATIO) <= BAND
    return F.coalesce(near, F.lit(False)) | F.coalesce(distinct.between(TOP_DISTINCT / FACTOR, TOP_DISTINCT * FACTOR), F.lit(False))


def table_scan(source: Column, stats_date: Column, today: Column, trust_estimates: bool = False) -> Column:
    """none, or why the row count has to be scanned."""
    estimate = (source == "stats-estimate") & F.lit(not trust_estimates)
    return F.when(source.isNull(), "no-statistics").when(estimate, "estimate").when(~fresh(stats_date, today), "stale").otherwise("none")


def column_scan(distinct: Column, approximate: Column, stats_date: Column, today: Column) -> Column:
    return (
        F.when(distinct.isNull(), "no-statistics")
        .when(approximate, "approximate")
        .when(~fresh(stats_date, today), "stale")
        .when(near_boundary(F.lit(None).cast("double"), distinct), "near-boundary")
        .otherwise("none")
    )


def suppression(fingerprinted: Column, gate: Column, unparsed: Column, denied: Column) -> Column:
    """Why a column shows no fingerprint; null if it has one."""
    return (
        F.when(fingerprinted, F.lit(None))
        .when(gate == "sensitive", "sensitive")
        .when(unparsed, "unparseable-temporal")
        .when(gate == "cardinality-gate", "cardinality-gate")
        .when(denied, "budget")
        .otherwise("none")
    )


def decide(profile: DataFrame, key_columns: list[str], listed: list[str] = (), table: str = "") -> DataFrame:
    """profile (column, n_distinct, distinct_ratio, ...) with both gates."""
    hidden = sensitive(F.lit(table), F.col("column"), list(listed))
    return profile.withColumns(
        {
            "fingerprint_gate": fingerprint(hidden, F.col("column").isin(*key_columns) if key_columns else F.lit(False), F.col("distinct_ratio")),
            "top_n_gate": top_n(hidden, F.col("n_distinct")),
        }
    )


class Budget:
    """Limits on statements, tables and rows of a run; every refusal is kept."""

    def __init__(self, statements: int | None = None, tables: int | None = None, rows: int | None = None):
        self.left = {"statements": statements, "tables": tables, "rows": rows}
        self.denied: list[tuple[str, str]] = []

    def take(self, what: str, n: int, who: str) -> bool:
        left = self.left[what]
        if left is not None and n > left:
            self.denied.append((what, who))
            return False
        if left is not None:
            self.left[what] = left - n
        return True
