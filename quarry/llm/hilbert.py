"""Sharding along a Hilbert curve, for file pruning in several metadata dimensions.

Language, source and length class of a document are quantised to BITS bits each, in their own
order: strings by cut points that part the rows into ranges of about equal weight (from the counts of
all values, added up in order over ranges of them), lengths by their logarithm. Rows are sorted by the curve index of that cell and cut into runs of equal row
counts; files hold narrow ranges of all three, so their min and max statistics prune.

A row's place comes from counts of (cell, sub-cell) groups plus its place within the group, so no task
sorts more than one sub-cell. Sub-cells come from a hash of id and text, which also splits a
cell that holds a third of all rows; their number follows the rows (SUB_ROWS each, if all lay in one cell).

Defined results: null text has no bytes; null language or source come first in order;
repeated rows get different slots; an empty table gives an empty result; extra columns are
kept by placed() and write_shards(), whatever their names (but RESULT, which placed() adds).
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.common import remove, written

BITS, DIMS = 4, 3
SUB_ROWS, SUB_CELLS = 1 << 18, 256
#: Rows in a file of write_shards().
FILE_ROWS = 1 << 18
RESULT = "_hilbert"
#: Added columns; their names are unlikely in a table of documents.
SIZE, CRC, CELL, HASH, PLACE, SUB, START, TOTAL, RANK, SHARD = (f"_hilbert_{c}" for c in "size crc cell hash place sub start total rank shard".split())


def curve_index(axes: tuple[int, ...], bits: int) -> int:
    """Place of a cell on the Hilbert curve: undo rotations from the high bits, then Gray-decode."""
    x, n = list(axes), len(axes)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            if x[i] & q:
                x[0] ^= p
            else:
                t = (x[0] ^ x[i]) & p
                x[0] ^= t
                x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t, q = 0, 1 << (bits - 1)
    while q > 1:
        if x[-1] & q:
            t ^= q - 1
        q >>= 1
    x = [v ^ t for v in x]
    out = 0
    for bit in range(bits - 1, -1, -1):
        for v in x:
            out = out << 1 | v >> bit & 1
    return out


def curve(spark: SparkSession, bits: int = BITS, dims: int = DIMS) -> DataFrame:
    """(cell, place) of all 2 ** (bits * dims) cells, from the rule above."""
    mask = (1 << bits) - 1
    cells = [(c, curve_index(tuple(c >> bits * k & mask for k in range(dims)), bits)) for c in range(1 << bits * dims)]
    return spark.createDataFrame(cells, "cell int, place int")


def cuts(docs: DataFrame, column: str, parts: int) -> list[str]:
    """At most parts - 1 values, ascending, that part the rows into ranges of about equal weight, from the counts of all values."""
    spark = docs.sparkSession
    counts = docs.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("v")).agg(F.count(F.lit(1)).alias("n"))
    ranged = counts.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "v").withColumn("part", F.spark_partition_id())
    values, used = written(ranged, "hilbert-values")  # parts hold ranges of values, in order
    sums = sorted(values.groupBy("part").agg(F.sum("n"), F.count("n")).collect())  # a row a part
    total, distinct = sum(r[1] for r in sums), sum(r[2] for r in sums)
    starts = list(zip((r[0] for r in sums), accumulate((r[1] for r in sums), initial=0)))
    inner = F.sum("n").over(Window.partitionBy("part").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    ranks = values.join(F.broadcast(spark.createDataFrame(starts, "part int, start long")), "part").withColumn("below", F.col("start") + inner)
    # The rows below a value reach the ends of so many ranges; of the values of one such step only the first can become cuts.
    ranks = ranks.withColumn("step", F.expr(f"below * {parts} div {max(1, total)}"))
    ranks = ranks.withColumn("nth", F.row_number().over(Window.partitionBy("step").orderBy("v"))).where(F.col("nth") <= parts)
    rows = sorted(ranks.select("v", "below").collect(), key=lambda r: r["v"].encode())  # parts ** 2 at most; Spark compares strings by their bytes
    remove(spark, used)
    if distinct < parts:  # few values: a range each
        return [r["v"] for r in rows][: parts - 1]
    out: list[str] = []
    for r in rows:
        if r["below"] * parts >= total * (len(out) + 1):
            out.append(r["v"])
    return out[: parts - 1]


def cell(docs: DataFrame, bits: int = BITS) -> F.Column:
    """Language, source and length of a row, quantised in order and put side by side."""
    top = (1 << bits) - 1

    def code(column: str) -> F.Column:
        out = F.lit(0)
        for v in cuts(docs, column, 1 << bits):
            out = out + F.when(F.col(column).cast("string") >= F.lit(v), 1).otherwise(0)
        return out

    length = F.least(F.floor(F.log2(F.octet_length(F.coalesce(F.col("text"), F.lit(""))) + 1)), F.lit(top)).cast("int")
    return code("lang") + code("source") * (1 << bits) + length * (1 << 2 * bits)


def placed(docs: DataFrame, n_shards: int = 8) -> DataFrame:
    """All rows and columns of docs, with size, text_crc32, shard, slot and place in the struct RESULT."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.withColumns(
        {
            SIZE: (F.octet_length(text) + 1).cast("long"),
            CRC: F.crc32(text.cast("binary")),
            CELL: cell(docs),
            HASH: F.xxhash64(F.col("doc_id"), text),
        }
    )
    places = curve(spark).select(F.col("cell").alias(CELL), F.col("place").alias(PLACE))
    rows = rows.join(F.broadcast(places), CELL).drop(CELL)  # 4096 rows
    rows, _ = written(rows, "hilbert-rows")
    subs = max(SUB_CELLS, -(-rows.count() // SUB_ROWS))
    rows = rows.withColumn(SUB, F.pmod(HASH, F.lit(subs)).cast("int"))
    counts = rows.groupBy(PLACE, SUB).agg(F.count(F.lit(1)).alias("n"))
    running = lambda w, c: F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, 0)) - F.col(c)
    cells = counts.groupBy(PLACE).agg(F.sum("n").alias("cell_n"))  # 4096 rows at most
    cells = cells.withColumn("cell_start", running(Window.orderBy(PLACE), "cell_n")).withColumn(TOTAL, F.sum("cell_n").over(Window.partitionBy()))
    starts = (
        counts.withColumn("sub_start", running(Window.partitionBy(PLACE).orderBy(SUB), "n"))
        .join(F.broadcast(cells), PLACE)
        .select(PLACE, SUB, (F.col("cell_start") + F.col("sub_start")).alias(START), TOTAL)
    )
    inside = F.row_number().over(Window.partitionBy(PLACE, SUB).orderBy(HASH, "doc_id"))
    rank = F.col(RANK)
    ranked = rows.join(starts, [PLACE, SUB]).withColumn(RANK, F.col(START) + inside - 1)
    each, more = F.floor(F.col(TOTAL) / n_shards), F.col(TOTAL) % n_shards
    long_end = more * (each + 1)
    shard = F.when(rank < long_end, F.floor(rank / (each + 1))).otherwise(more + F.floor((rank - long_end) / F.greatest(each, F.lit(1))))
    ranked = ranked.withColumn(SHARD, shard.cast("int"))
    begin = F.col(SHARD) * each + F.least(F.col(SHARD), more)
    found = F.struct(
        F.col(SIZE).alias("size"), F.col(CRC).alias("text_crc32"), F.col(SHARD).alias("shard"), (rank - begin).cast("long").alias("slot"), F.col(PLACE).alias("place")
    )
    return ranked.select(*[F.col(f"`{c}`") for c in docs.columns], found.alias(RESULT))


def shards(docs: DataFrame, n_shards: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard and the curve place of each row: a digest of placed()."""
    return placed(docs, n_shards).select(
        "doc_id", f"{RESULT}.size", f"{RESULT}.text_crc32", F.lit("rows").alias("law"), f"{RESULT}.shard",
        f"{RESULT}.slot", F.lit(None).cast("int").alias("grown_shard"), f"{RESULT}.place",
    )


def write_shards(docs: DataFrame, path: str, n_shards: int = 8, file_rows: int = FILE_ROWS) -> None:
    """Write all rows and columns of docs, sorted along the curve, as a Parquet folder a shard with files of about file_rows consecutive rows.

    hilbert_shard, hilbert_slot, hilbert_place and hilbert_size are added; they and docs' own lang and source have statistics to prune by.
    """
    out = placed(docs, n_shards)
    out = out.select(*[F.col(f"`{c}`") for c in docs.columns], *[F.col(f"{RESULT}.{c}").alias(f"hilbert_{c}") for c in ("shard", "slot", "place", "size")])
    out, used = written(out, "hilbert-placed")
    files = max(n_shards, -(-out.count() // file_rows))
    by = ["hilbert_shard", "hilbert_slot"]
    out.repartitionByRange(files, *by).sortWithinPartitions(*by).write.partitionBy("hilbert_shard").parquet(path)
    remove(docs.sparkSession, used)
