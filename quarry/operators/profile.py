"""Column profiles. One unpivot and one grouping by (column, value) answer them all.

values() is the shared intermediate: distinct counts, top values, samples, fingerprints and
format classes are small aggregations of it, where a scan for each would read a table many
times. Distinct counts group typed values, so that nothing is rendered for them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import exprs, types

TOP_N, SAMPLE, FORMAT_SAMPLE, BUCKETS = 20, 5000, 500, 64
DENSE_FILL, DENSE_START = 0.95, 1


def profiled(df: DataFrame, columns: list[str] | None = None) -> list:
    return [f for f in df.schema.fields if types.of_spark(f.dataType) != "UNSUPPORTED" and (columns is None or f.name in columns)]


def unpivot(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column, raw): a row for each value of each profiled column."""
    cells = [F.struct(F.lit(f.name).alias("column"), exprs.as_text(F.col(f"`{f.name}`"), f.dataType).alias("raw")) for f in profiled(df, columns)]
    return df.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")


def values(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column, raw, freq) of all non-null values; the partial aggregation combines before the shuffle."""
    return unpivot(df, columns).where("raw is not null").groupBy("column", "raw").agg(F.count(F.lit(1)).alias("freq"))


def counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """column, n_rows, non_null, n_distinct, low, high; bounds as text, ordered by type and not by text."""
    fields = profiled(df, columns)
    bounds = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.array(*[
            F.struct(
                F.lit(f.name).alias("column"), F.count(F.col(f"`{f.name}`")).alias("non_null"),
                exprs.as_text(F.min(F.col(f"`{f.name}`")), f.dataType).alias("low"), exprs.as_text(F.max(F.col(f"`{f.name}`")), f.dataType).alias("high"),
            )
            for f in fields
        ]).alias("cells"),
    )
    bounds = bounds.select("n_rows", F.explode("cells").alias("cell")).select("cell.column", "n_rows", "cell.non_null", "cell.low", "cell.high")
    distinct = distincts(df, columns)
    return bounds.join(F.broadcast(distinct), "column", "left").select(  # a row a column of one table
        "column", "n_rows", "non_null", F.coalesce("n_distinct", F.lit(0)).alias("n_distinct"), "low", "high"
    )


def distincts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """column, n_distinct of all non-null values, by what they are and not by how they are shown."""
    cells = [
        F.struct(F.lit(f.name).alias("column"), F.col(f"`{f.name}`").isNotNull().alias("set"), *[c.alias(n) for c, n in zip(exprs.identity(F.col(f"`{f.name}`"), f.dataType), "lds")])
        for f in profiled(df, columns)
    ]
    rows = df.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*").where("set")
    return rows.groupBy("column", "l", "d", "s").agg(F.lit(1).alias("one")).groupBy("column").agg(F.count(F.lit(1)).alias("n_distinct"))


def rates(counted: DataFrame) -> DataFrame:
    """null_rate of all rows and distinct_ratio of non-null ones; undefined over nothing. Not rounded."""
    return counted.withColumns(
        {
            "null_rate": F.when(F.col("n_rows") > 0, (F.col("n_rows") - F.col("non_null")) / F.col("n_rows")),
            "distinct_ratio": F.when(F.col("non_null") > 0, F.col("n_distinct") / F.col("non_null")),
        }
    )


def dense(counted: DataFrame, integers: list[str]) -> DataFrame:
    """dense_sequence: integers from 1 or below that fill at least 95 % of their range."""
    low, high = F.expr("try_cast(low as bigint)"), F.expr("try_cast(high as bigint)")
    full = (low <= DENSE_START) & (F.col("n_distinct") >= 2) & (F.col("n_distinct") / (high - low + 1) >= DENSE_FILL)
    return counted.withColumn("dense_sequence", F.coalesce(F.col("column").isin(*integers) & full, F.lit(False)))


def lengths(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """column, min_length, max_length, avg_length of character columns, in one scan."""
    names = [f.name for f in profiled(df, columns) if types.is_character(types.of_spark(f.dataType))]
    size = lambda c: F.char_length(F.col(f"`{c}`"))
    cells = [F.struct(F.lit(c).alias("column"), F.min(size(c)).alias("min_length"), F.max(size(c)).alias("max_length"), F.avg(size(c)).alias("avg_length")) for c in names]
    return df.agg(F.array(*cells).alias("cells")).select(F.explode("cells").alias("cell")).select("cell.*")


def value_lengths(counted_values: DataFrame) -> DataFrame:
    """Lengths weighted by row over a complete set of values, for columns that are rendered first."""
    size = F.char_length("raw")
    return counted_values.groupBy("column").agg(
        F.min(size).alias("min_length"), F.max(size).alias("max_length"), (F.sum(size * F.col("freq")) / F.sum("freq")).alias("avg_length")
    )


def top_values(df: DataFrame, column: str, n: int = TOP_N) -> DataFrame:
    """value, freq and percent of the non-null rows, most frequent first; ties by value."""
    all_values = values(df, [column])
    total = all_values.agg(F.sum("freq").alias("total"))
    top = all_values.orderBy(F.col("freq").desc(), "raw").limit(n)
    return top.crossJoin(total).select(F.col("raw").alias("value"), "freq", exprs.percent(F.col("freq"), F.col("total")).alias("percent"))  # one row


def samples(counted_values: DataFrame, k: int = SAMPLE) -> DataFrame:
    """Bottom-k of the normalised values of each column by md5, with rules applied and a truncation mark.

    column, value, raw, freq, collapsed (spellings that zero stripping merged into it), trimmed, uppercased, zeros, place, threshold, truncated
    """
    rows = counted_values.withColumn("upper", exprs.normalize(F.col("raw"))).withColumn("value", exprs.strip_zeros(F.col("upper")))
    stripped = F.regexp_replace("raw", r"^\s+|\s+$", "")
    merged = rows.groupBy("column", "value").agg(
        F.min("raw").alias("raw"), F.sum("freq").alias("freq"), (F.countDistinct("upper") - 1).alias("collapsed"),
        F.bool_or(stripped != F.col("raw")).alias("trimmed"), F.bool_or(stripped != F.col("upper")).alias("uppercased"),
        F.bool_or(F.col("upper") != F.col("value")).alias("zeros"),
    )
    # Two steps, so that no task ranks all values of a column: within a bucket of the values, and then BUCKETS * (k + 1) rows at most.
    first = lambda *by: F.row_number().over(Window.partitionBy("column", *by).orderBy(exprs.rank_hash(F.col("value"))))
    merged = merged.withColumn("bucket", F.pmod(F.xxhash64("value"), F.lit(BUCKETS)))
    kept = merged.withColumn("place", first("bucket")).where(F.col("place") <= k + 1).drop("bucket")
    kept = kept.withColumn("place", first()).where(F.col("place") <= k + 1)
    whole = Window.partitionBy("column")
    kept = kept.withColumn("truncated", F.max("place").over(whole) > k).where(F.col("place") <= k)
    return kept.withColumn("threshold", F.max(exprs.rank_hash(F.col("value"))).over(whole))


def head(sampled: DataFrame, k: int) -> DataFrame:
    """The first k values of each column's sample; rules are still those of the whole sample."""
    return sampled.where(F.col("place") <= k)


def fingerprints(sampled: DataFrame, digest=exprs.digest) -> DataFrame:
    """(column, h, rank, threshold, truncated): hashes of a sample; the rank hash allows unbiased overlaps."""
    return sampled.select("column", digest(F.col("value")).alias("h"), exprs.rank_hash(F.col("value")).alias("rank"), "threshold", "truncated")


def rules(sampled: DataFrame) -> DataFrame:
    """column and the normalisation rules that changed something, in fixed order."""
    found = [F.when(F.bool_or(c), F.lit(n)) for c, n in (("trimmed", "trim"), ("uppercased", "uppercase"), ("zeros", "strip_leading_zeros"))]
    return sampled.groupBy("column").agg(F.array_compact(F.array(*found)).alias("rules"))


def formats(counted_values: DataFrame, k: int = FORMAT_SAMPLE) -> DataFrame:
    """column, format: the class most distinct values of a bottom-k sample have; a tie is mixed."""
    sampled = samples(counted_values, k)
    by_class = sampled.groupBy("column", exprs.format_class(F.col("value")).alias("format")).agg(F.count(F.lit(1)).alias("n"))
    best = by_class.groupBy("column").agg(F.max("n").alias("most"))
    tied = by_class.join(F.broadcast(best), "column").where("n = most").groupBy("column")  # a row a column
    return tied.agg(F.when(F.count(F.lit(1)) > 1, "mixed").otherwise(F.first("format")).alias("format"))
