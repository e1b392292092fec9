"""Incremental profiles of streams: mergeable figures by event-time window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed(stream: DataFrame, time: str, columns: list[str], window: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """window_start, column, n_rows, non_null, low, high and an approximate distinct count.

    Works on streams and tables alike; on a stream state is bounded by the watermark.
    """
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("raw")) for c in columns]
    rows = stream.withColumn("_at", F.col(time).cast("timestamp")).withWatermark("_at", late)
    rows = rows.select("_at", F.explode(F.array(*cells)).alias("cell"))
    return (
        rows.groupBy(F.window("_at", window).alias("w"), F.col("cell.column").alias("column"))
        .agg(
            F.count(F.lit(1)).alias("n_rows"), F.count("cell.raw").alias("non_null"), F.min("cell.raw").alias("low"), F.max("cell.raw").alias("high"),
            F.approx_count_distinct("cell.raw").alias("about_distinct"),
        )
        .select(F.col("w.start").alias("window_start"), "column", "n_rows", "non_null", "low", "high", "about_distinct")
    )
