"""Best-fit decreasing packing of token sequences, with a segment tree over capacities.

Documents are tokenised where they lie; only (uid, id, piece, start, length, crc) rows travel.
A document longer than a sequence is cut so that all pieces but the first are full. Pieces
are dealt by a hash into groups of about GROUP pieces, a number that follows the data, and
each group is packed on its own: longest first, each into the open sequence with the least
room that still fits, which a segment tree over remaining room finds in log2(capacity)
steps. A group wastes a few partly filled sequences at most, of some ten thousand.

pack() places the pieces; sequences() returns the packed token ids themselves.

Defined results: null text is empty (one end id); null and repeated ids are kept as they are,
repeated rows are packed separately; an empty table gives an empty result; extra columns do
not matter.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import remove, small_batches, written
from quarry.llm.encoding import default_tokenizer, encoded

CAPACITY = 1024
GROUP = 50_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = "uid long, " + PIECES + ", sequence_id long, offset long"


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids."""
    first = n - (n - 1) // capacity * capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


class OpenBins:
    """Open sequences by remaining room; a segment tree counts them over ranges of room."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, name: int) -> None:
        self.bins[room].append(name)
        at = room + self.leaves
        while at:
            self.count[at] += 1
            at >>= 1

    def take(self, length: int) -> tuple[int, int] | None:
        """Remove and return (room, name) of the tightest sequence with room for length."""
        count, at = self.count, length + self.leaves
        if not count[at]:
            while at > 1 and (at & 1 or not count[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at if count[2 * at] else 2 * at + 1
        room = at - self.leaves
        while at:
            count[at] -= 1
            at >>= 1
        return room, self.bins[room].pop()


def best_fit_decreasing(lengths: list[int], capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(sequence, offset) of each length; ties keep their order."""
    out: list[tuple[int, int]] = [(0, 0)] * len(lengths)
    bins, made = OpenBins(capacity), 0
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        n = lengths[i]
        found = bins.take(n)
        if found is None:
            found, made = (capacity, made), made + 1
        room, name = found
        out[i] = (name, capacity - room)
        bins.add(room - n, name)
    return out


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """A row a piece of each document; with_ids adds its ids as little-endian unsigned 32-bit integers."""
    path = tokenizer or default_tokenizer()
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, _, ids, begins in encoded(b.column(1), path):
                sizes = np.diff(begins)
                many = -(-sizes // capacity)
                doc = np.repeat(np.arange(len(sizes)), many)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
                first = (sizes - (many - 1) * capacity)[doc]
                start = np.where(piece == 0, 0, first + (piece - 1) * capacity)
                length = np.where(piece == 0, first, capacity)
                at, raw = 4 * (begins[doc] + start), memoryview(ids.astype("<u4").tobytes())
                cuts = list(zip(at.tolist(), (at + 4 * length).tolist()))
                columns = {
                    "doc_id": b.column(0).take(pa.array(lo + doc)), "piece": pa.array(piece.astype(np.int32)), "start": pa.array(start),
                    "length": pa.array(length), "ids_crc32": pa.array([zlib.crc32(raw[i:j]) for i, j in cuts], pa.int64()),
                }
                if with_ids:
                    columns["ids"] = pa.array([raw[i:j] for i, j in cuts], pa.binary())
                yield pa.RecordBatch.from_pydict(columns)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES + ", ids binary" * with_ids)


def placed(table: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """A written table of pieces with their uid -> the same rows with sequence_id and offset."""
    groups = max(1, -(-table.count() // group))

    def run(rows: pa.Table) -> pa.Table:
        ids = rows["doc_id"].fill_null(-(1 << 63)).to_numpy()
        length = rows["length"].to_numpy()
        order = np.lexsort((rows["uid"].to_numpy(), rows["piece"].to_numpy(), ids, -length))
        found = np.array(best_fit_decreasing(length[order].tolist(), capacity), np.int64).reshape(-1, 2)
        name = rows["pack_group"][0].as_py() << 40
        return (
            rows.take(pa.array(order)).drop_columns(["pack_group"])
            .append_column("sequence_id", pa.array(found[:, 0] + name)).append_column("offset", pa.array(found[:, 1]))
        )

    dealt = table.select("uid", *PIECES.replace(" long", "").replace(" int", "").split(", "), F.pmod(F.xxhash64("uid"), F.lit(groups)).alias("pack_group"))
    return dealt.groupBy("pack_group").applyInArrow(run, PLACED)


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """One row a piece with its sequence_id and its offset there."""
    table, _ = written(pieces(docs, tokenizer, capacity).withColumn("uid", F.monotonically_increasing_id()), "pack-pieces")
    return placed(table, capacity, group).drop("uid")


def sequences(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """(sequence_id, length, ids): the packed sequences, ids as little-endian unsigned 32-bit integers in order of offset."""
    table, path = written(pieces(docs, tokenizer, capacity, with_ids=True).withColumn("uid", F.monotonically_increasing_id()), "pack-ids")
    where, used = written(placed(table, capacity, group).select("uid", "sequence_id", "offset", "length"), "pack-places")
    rows = table.select("uid", "ids").join(where, "uid")
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # at most capacity pieces a sequence
    joined = F.aggregate(parts, F.lit(b""), lambda a, p: F.concat(a, p["ids"]))
    out, _ = written(rows.groupBy("sequence_id").agg(F.sum("length").alias("length"), joined.alias("ids")), "pack-sequences")
    remove(docs.sparkSession, path)
    remove(docs.sparkSession, used)
    return out
