"""Mixing sources to target weights by capped water-filling, with DataFrame functions only.

Targets: the words of all documents are shared by weight; a source whose share exceeds
max_epochs times its own size is clamped there and the excess is reshared by weight among
the rest until none is above. Ordered by cap over weight the clamped sources are a prefix,
so the fixed point is found with running sums over the (few) sources.

Sample: each document is taken floor(target / source size) times as a whole, and once more
if it falls into the fractional part: documents are put in the order of a seeded md5 of
their id and text, those that fit as a whole come first, and the gap that a long document leaves is
filled with shorter ones. Running sums go over (source, hash bucket) cells and then within
a cell, so no task ever holds a whole source. The outcome is one row of thresholds for each
source, and a document's decision depends on that row and on itself alone: reruns agree.

Defined results: a null text has size 0; a null source is a source of its own, last in
order; sources without words get target 0; null and repeated ids do not matter as long as texts
differ, and rows of one id, text and source are decided alike; an empty table gives an empty
result; extra columns are untouched, whatever their names (but RESULT, which the operator adds).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import word_count, written

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
SEED = "mix-1"
#: Sources up to which the threshold table (under 200 bytes a row) is broadcast.
BROADCAST_SOURCES = 10_000


#: Added columns; their names are unlikely in a table of documents. RESULT is the struct that mix adds.
RESULT, HASH, SIZE, PLAN, OF = "_mixed", "_mix_h", "_mix_size", "_mix", "_mix_source"


def order_hash(id_col: str = "doc_id", seed: str = SEED, text_col: str = "text") -> F.Column:
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return F.md5(F.concat(F.lit(f"{seed}:"), part(id_col), F.lit(":"), part(text_col)))


def targets(sizes: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size) with one row a source -> the same with target."""
    big = "decimal(38,0)"
    nth = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), F.pmod(nth, F.lit(len(weights))) + 1)
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    rows = (
        sizes.withColumn("weight", weight.cast("long"))
        .withColumn("cap", F.col("source_size") * max_epochs)
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("clamped_before", F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, 0)) - F.col("cap"))
        .withColumn("weight_left", F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn(
            "clamped",
            F.col("cap").cast(big) * F.col("weight_left") <= F.col("weight").cast(big) * (F.col("total") - F.col("clamped_before")),
        )
    )
    free = ~F.col("clamped")
    left = F.col("total") - F.coalesce(F.sum(F.when(F.col("clamped"), F.col("cap"))).over(everything), F.lit(0))
    share = F.sum(F.when(free, F.col("weight"))).over(everything)
    target = F.when(F.col("clamped"), F.col("cap").cast("double")).otherwise((F.col("weight") * left).cast("double") / share.cast("double"))
    return rows.withColumn("target", target).select("source", "source_size", "target")


def _running(rows: DataFrame, size: str) -> DataFrame:
    """Adds `upto`, the sum of sizes of a source's rows in hash order up to and with each row."""
    cells = rows.groupBy("source", "bucket").agg(F.sum(size).alias("in_cell"))
    before = F.sum("in_cell").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)) - F.col("in_cell")
    cells = cells.withColumn("before", before).drop("in_cell").withColumnsRenamed({"source": "s", "bucket": "b"})
    inside = F.sum(size).over(Window.partitionBy("source", "bucket").orderBy("h"))
    joined = rows.join(cells, rows["source"].eqNullSafe(cells["s"]) & (rows["bucket"] == cells["b"])).drop("s", "b")
    return joined.withColumn("upto", inside + F.col("before")).drop("before")


def plan(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """One row a source: source_size, target, whole repetitions, and thresholds of the fractional one."""
    narrow = docs.select(
        F.col("source"), word_count(F.col("text")).alias("size"), order_hash(seed=seed).alias("h")
    ).withColumn("bucket", F.substring("h", 1, 3))
    narrow, _ = written(narrow, "mix-sizes")
    goal = targets(narrow.groupBy("source").agg(F.sum("size").alias("source_size")), weights, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    goal = goal.withColumn("whole", whole).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    goal, _ = written(goal.coalesce(1), "mix-targets")

    def with_goal(rows: DataFrame, table: DataFrame) -> DataFrame:
        table = table.withColumnRenamed("source", "s")
        return rows.join(sized(table), rows["source"].eqNullSafe(table["s"]), "left").drop("s")

    fits = (
        with_goal(_running(narrow, "size"), goal.select("source", "rest"))
        .where(F.col("upto") <= F.col("rest"))
        .groupBy("source")
        .agg(F.max("h").alias("last"), F.max("upto").alias("filled"))
    )
    gaps = with_goal(goal, fits).select(
        "source", "source_size", "target", "whole", "rest",
        F.coalesce("last", F.lit("")).alias("last"),
        (F.col("rest") - F.coalesce("filled", F.lit(0))).alias("gap"),
    )
    gaps, _ = written(gaps.coalesce(1), "mix-gaps")
    fillers = with_goal(narrow, gaps.select("source", "last", "gap")).where(
        (F.col("h") > F.col("last")) & (F.col("size") > 0) & (F.col("size") <= F.col("gap"))
    )
    extra = (
        _running(fillers, "size")
        .where(F.col("upto") - F.col("size") * F.lit(0.5) <= F.col("gap"))
        .groupBy("source")
        .agg(F.max("h").alias("fill_last"))
    )
    out, _ = written(with_goal(gaps, extra).coalesce(1), "mix-plan")
    return out


def sized(table: DataFrame) -> DataFrame:
    """A hint to broadcast table if it is known to be small; else the join shuffles."""
    return F.broadcast(table) if table.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES else table


def mix(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """All rows and columns of docs with the struct RESULT: size, source_size, target, times, taken."""
    table = plan(docs, weights, max_epochs, seed).select(
        F.col("source").alias(OF), F.struct("source_size", "target", "whole", "last", "gap", "fill_last").alias(PLAN)
    )
    rows = docs.withColumn(SIZE, word_count(F.col("text"))).withColumn(HASH, order_hash(seed=seed))
    rows = rows.join(sized(table), F.col("source").eqNullSafe(F.col(OF)), "left")
    h, size, known = F.col(HASH), F.col(SIZE), lambda c: F.col(f"{PLAN}.{c}")
    once_more = (h <= known("last")) | F.coalesce((size > 0) & (size <= known("gap")) & (h <= known("fill_last")), F.lit(False))
    times = known("whole") + once_more.cast("long")
    found = F.struct(
        size.alias("size"), known("source_size").alias("source_size"), known("target").alias("target"), times.alias("times"), (size * times).alias("taken")
    )
    return rows.withColumn(RESULT, found).select(*[F.col(f"`{c}`") for c in docs.columns], RESULT)


def repeated(docs: DataFrame) -> DataFrame:
    """The mix itself: each row of docs as often as it is taken, with docs' own columns."""
    copies = F.explode(F.array_repeat(F.lit(0), F.col(f"{RESULT}.times").cast("int")))
    return mix(docs).withColumn("_mix_copy", copies).select(*[F.col(f"`{c}`") for c in docs.columns])


ORACLE = f"""
WITH d AS (
  SELECT doc_id, source,
    CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
    md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS h
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS weight
  FROM d GROUP BY source
), c AS (
  SELECT *, 3 * source_size AS cap, sum(source_size) OVER () AS total,
    sum(3 * source_size) OVER w - 3 * source_size AS clamped_before,
    sum(weight) OVER (ORDER BY 3 * source_size / weight, source ASC NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_left
  FROM s WINDOW w AS (ORDER BY 3 * source_size / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), k AS (
  SELECT *, cap * weight_left <= weight * (total - clamped_before) AS clamped FROM c
), t AS (
  SELECT source, source_size,
    CASE WHEN clamped THEN CAST(cap AS DOUBLE)
      ELSE CAST(weight * (total - coalesce(sum(CASE WHEN clamped THEN cap END) OVER (), 0)) AS DOUBLE)
        / CAST(sum(CASE WHEN NOT clamped THEN weight END) OVER () AS DOUBLE) END AS target
  FROM k
), g AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t
), r AS (
  SELECT d.*, g.source_size, g.target, g.whole, g.target - g.whole * g.source_size AS rest,
    CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h) AS BIGINT) AS upto
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source
), f AS (
  SELECT *, coalesce(max(CASE WHEN upto <= rest THEN h END) OVER (PARTITION BY source), '') AS last,
    rest - coalesce(max(CASE WHEN upto <= rest THEN upto END) OVER (PARTITION BY source), 0) AS gap
  FROM r
), e AS (
  SELECT *, h > last AND size > 0 AND size <= gap AS filler,
    CAST(sum(CASE WHEN h > last AND size > 0 AND size <= gap THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY h) AS BIGINT) AS fill
  FROM f
)
SELECT doc_id, size, source_size, target,
  size * (whole + CASE WHEN h <= last OR (filler AND fill - size * 0.5 <= gap) THEN 1 ELSE 0 END) AS taken
FROM e
"""
