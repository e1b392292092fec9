"""The measuring pass over a table: decide what to scan, scan it once, and put the column profiles together.

1. Statistics, where there are some, stand in for scans: a table is counted and a column is
   measured only if its statistics are missing, estimated, stale or near a gate's boundary.
2. Junk tables, and tables beyond the budget, get a minimal profile of the statistics alone.
3. Gates decide by the counts which columns are sampled and which have their values listed,
   before any value is read; sensitive columns show nothing.
4. One grouping by (column, value) of the columns that passed gives samples, fingerprints, formats,
   lengths of rendered times and top values.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import exprs, types
from quarry.operators import gates, profile

PROFILE = ["column", "n_rows", "row_count_source", "non_null", "n_distinct", "distinct_source", "null_rate", "distinct_ratio", "low", "high"]


@dataclass
class Options:
    """What a run is allowed and told: keys are index and constraint columns, sensitive names columns as gates.sensitive() reads them."""

    keys: list[str] = field(default_factory=list)
    sensitive: list[str] = field(default_factory=list)
    junk: tuple[str, ...] = gates.JUNK
    trust_estimates: bool = False
    today: dt.date | None = None
    budget: gates.Budget = field(default_factory=gates.Budget)
    sample: int = profile.SAMPLE


def rounded(c: Column, places: int) -> Column:
    """Half-even at so many decimals, for figures that are only shown."""
    return F.bround(c, places)


def decisions(columns: list[str], stats: DataFrame | None, table: DataFrame, options: Options) -> tuple[str, dict[str, str], dict]:
    """Why rows are counted ("none": the statistics say), why each column is measured, and the statistics by column; "" has the table's."""
    if stats is None:
        return "no-statistics", dict.fromkeys(columns, "no-statistics"), {}
    today = F.lit(options.today) if options.today else F.current_date()
    rows = stats.withColumns(
        {
            "row_scan": gates.table_scan(F.col("source"), F.col("stats_date"), today, options.trust_estimates),
            "column_scan": gates.column_scan(F.col("n_distinct"), F.coalesce("approximate", F.lit(False)), F.col("stats_date"), today),
        }
    ).collect()  # a row a column
    found = {r["column"] or "": r.asDict() for r in rows}
    return (
        found[""]["row_scan"] if "" in found else "no-statistics",
        {c: found[c]["column_scan"] if c in found else "no-statistics" for c in columns},
        found,
    )


def measured(df: DataFrame, table: str, options: Options | None = None, stats: DataFrame | None = None) -> DataFrame:
    """A row a column of table: counts, rates, bounds, lengths, gates, top values, format, fingerprint, or why there is none.

    stats: column (null for the table), n_rows, n_distinct, null_fraction, approximate, source, stats_date.
    """
    options, spark = options or Options(), df.sparkSession
    fields = {f.name: f for f in profile.profiled(df)}
    kinds = {n: types.of_spark(f.dataType) for n, f in fields.items()}
    row_scan, column_scan, known = decisions(list(fields), stats, df, options)
    guess = (known.get("") or {}).get("n_rows")
    junk = any(p.lower() in table.lower() for p in options.junk) or guess == 0
    if not junk and not options.budget.take("tables", 1, table):
        row_scan = "budget"
    if not junk and row_scan != "budget" and guess is not None and not options.budget.take("rows", int(guess), table):
        row_scan = "budget"
    names = ", ".join(f"{c} {k}" for c, k in (("column", "string"), ("ordinal", "int"), ("type", "string"), ("why", "string"), ("scan", "string")))
    heads = spark.createDataFrame([(n, k + 1, kinds[n], "junk" if junk else "budget" if row_scan == "budget" else "", column_scan[n]) for k, n in enumerate(fields)], names)
    if junk or row_scan == "budget":
        return _assembled(heads, _from_stats(spark, known, guess), None, None, None, options, table)

    scan = [n for n in fields if column_scan[n] != "none"]
    told = _from_stats(spark, known, guess).where(~F.col("column").isin(scan)) if scan else _from_stats(spark, known, guess)
    counted = profile.rates(profile.counts(df, scan)) if scan else None
    if counted is not None:
        counted = counted.withColumns({"row_count_source": F.lit("live"), "distinct_source": F.lit("live")}).select(*PROFILE)
    figures = told if counted is None else counted.unionByName(told)
    if row_scan != "none" and not scan:
        n = df.count()
        figures = figures.withColumns({"n_rows": F.lit(n), "row_count_source": F.lit("live")})
    gated = gates.decide(figures, options.keys, options.sensitive, table).select("column", "fingerprint_gate", "top_n_gate").collect()  # a row a column
    sampled = [r["column"] for r in gated if r["fingerprint_gate"] == "allow"]
    topped = [r["column"] for r in gated if r["top_n_gate"] == "allow"]
    open_ = [r["column"] for r in gated if r["fingerprint_gate"] != "sensitive"]
    grouped = profile.values(df, open_) if open_ else None
    lengths = profile.lengths(df, open_) if any(types.is_character(kinds[c]) for c in open_) else None
    return _assembled(heads, figures, grouped, lengths, (sampled, topped), options, table)


def _from_stats(spark, known: dict, guess: int | None) -> DataFrame:
    """The statistics in the shape of a profile; rates of nothing are undefined."""
    rows = []
    for name, s in known.items():
        if name:
            empty = None if guess is None or s["null_fraction"] is None else int(round(guess * (1 - s["null_fraction"])))
            distinct = s["n_distinct"]
            ratio = distinct / empty if distinct is not None and empty else None
            rows.append((name, guess, (known.get("") or {}).get("source"), empty, distinct, s["source"], s["null_fraction"], ratio, None, None))
    kinds = "column string, n_rows long, row_count_source string, non_null long, n_distinct long, distinct_source string, null_rate double, distinct_ratio double, low string, high string"
    return spark.createDataFrame(rows, kinds)


def _assembled(heads: DataFrame, figures: DataFrame, grouped: DataFrame | None, lengths: DataFrame | None, allowed: tuple | None, options: Options, table: str) -> DataFrame:
    rows = heads.join(figures, "column", "left").withColumn("sensitive", gates.sensitive(F.lit(table), F.col("column"), list(options.sensitive)))
    rows = gates.decide(rows, options.keys, options.sensitive, table)
    minimal = F.col("why") != ""
    rows = rows.withColumns(
        {
            "fingerprint_gate": F.when(~minimal, F.col("fingerprint_gate")), "top_n_gate": F.when(~minimal, F.col("top_n_gate")),
            "low": F.when(~F.col("sensitive"), F.col("low")), "high": F.when(~F.col("sensitive"), F.col("high")),
            "null_rate": rounded(F.col("null_rate"), 4), "distinct_ratio": rounded(F.col("distinct_ratio"), 4),
        }
    )
    none = {"min_length": "int", "max_length": "int", "avg_length": "double", "format": "string", "top_values": "array<struct<value:string,freq:bigint,percent:int>>", "fingerprint": "array<string>", "sample_count": "bigint", "truncated": "boolean", "rules": "array<string>"}
    if grouped is not None:
        sampled, topped = allowed
        samples = profile.samples(grouped, options.sample)
        prints = profile.fingerprints(samples.where(F.col("column").isin(sampled))).groupBy("column").agg(
            F.sort_array(F.collect_list("h")).alias("fingerprint"), F.bool_or("truncated").alias("truncated")
        )  # at most `sample` hashes a column
        rows = rows.join(prints, "column", "left").withColumn("sample_count", F.when(F.col("truncated"), F.greatest(F.size("fingerprint"), F.col("n_distinct"))).otherwise(F.when(F.col("fingerprint").isNotNull(), F.size("fingerprint"))).cast("long"))
        rows = rows.join(profile.rules(samples.where(F.col("column").isin(sampled))), "column", "left").join(profile.formats(grouped), "column", "left")
        totals = grouped.where(F.col("column").isin(topped)).groupBy("column").agg(F.sum("freq").alias("total"))
        place = F.row_number().over(Window.partitionBy("column").orderBy(F.desc("freq"), "raw"))  # at most TOP_DISTINCT values a column
        best = grouped.where(F.col("column").isin(topped)).join(totals, "column").withColumn("place", place).where(F.col("place") <= profile.TOP_N)
        cell = F.struct("place", F.col("raw").alias("value"), "freq", exprs.percent(F.col("freq"), F.col("total")).alias("percent"))
        shown = F.transform(F.array_sort(F.collect_list(cell)), lambda x: F.struct(x["value"].alias("value"), x["freq"].alias("freq"), x["percent"].alias("percent")))
        rows = rows.join(best.groupBy("column").agg(shown.alias("top_values")), "column", "left")
        times = [r["column"] for r in heads.collect() if types.is_temporal(r["type"])]
        rendered = profile.value_lengths(grouped.where(F.col("column").isin(times))) if times else None
        if lengths is not None or rendered is not None:
            all_lengths = lengths if rendered is None else rendered if lengths is None else lengths.unionByName(rendered)
            rows = rows.join(all_lengths.withColumn("avg_length", rounded(F.col("avg_length"), 1)), "column", "left")
    for c, kind in none.items():
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit(None).cast(kind))
    reason = gates.suppression(F.col("fingerprint").isNotNull(), F.col("fingerprint_gate"), F.lit(False), minimal & (F.col("why") == "budget"))
    low, high = F.expr("try_cast(low as bigint)"), F.expr("try_cast(high as bigint)")
    dense = (low <= profile.DENSE_START) & (F.col("n_distinct") >= 2) & (F.col("n_distinct") / (high - low + 1) >= profile.DENSE_FILL)
    whole = F.col("type").isin("INT", "BIGINT", "SMALLINT", "TINYINT", "BYTEINT") | F.col("type").rlike(r"^(DECIMAL|NUMERIC|NUMBER)(\(\d+(,0)?\))?$")
    return rows.select(
        F.lit(table).alias("table"), "ordinal", "type", *PROFILE, "scan", "why", "sensitive", "fingerprint_gate", "top_n_gate",
        F.coalesce(whole & dense, F.lit(False)).alias("dense_sequence"), reason.alias("suppressed"), *none,
    )


def counters(profiles: DataFrame) -> DataFrame:
    """One row: columns by what became of their fingerprints, and how many were measured live."""
    return profiles.agg(
        F.count(F.lit(1)).alias("columns"), F.count_if(F.col("fingerprint").isNotNull()).alias("fingerprints"),
        *[F.count_if(F.col("suppressed") == r).alias(f"suppressed_{r.replace('-', '_')}") for r in ("sensitive", "cardinality-gate", "budget")],
        F.count_if(F.col("distinct_source") == "live").alias("measured"), F.count_if(F.col("why") == "junk").alias("junk"),
    )
