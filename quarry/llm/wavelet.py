"""Token-id files as wavelet matrices: one compressed file a shard.

A shard holds the ids of consecutive documents. Plane k has bit k (from the top) of every id,
in the order that stable partitions by the planes above leave; with counts of ones a token is
read, counted in a range or located in one step a plane. A plane is cut into frames of FRAME
bits, each a zstd blob of its own with its bits and its rank directory (ones before every
BLOCK bits within the frame). The ones before each frame stand in the file's table, so that
access, count and select read one or two frames a plane and not the file:

    magic "QWM2" | header length u32 | header JSON | table | blobs

where the table has the blobs' sizes (u32) and the ones before each frame of each plane (u32),
and the blobs are doc_ids (i64, nulls as the smallest), lengths (u32), and the planes' frames.

write_shards() range-partitions documents by id, encodes where the rows land and writes the
files to the shared folder; names depend on partition and number alone and files appear by
rename, so a repeated task replaces its own files.

Defined results: null text is empty (one end id); repeated rows are encoded each, one after
the other; null ids come first; an empty table gives no file; extra columns do not matter.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import new_path, small_batches, written
from quarry.llm.encoding import default_tokenizer, encoded

MAGIC = b"QWM2"
#: Bits between rank entries, and bits of a frame.
BLOCK, FRAME = 512, 1 << 16
SHARD_TOKENS = 1 << 21
NULL_ID = -(1 << 63)

Frame = tuple[np.ndarray, np.ndarray]  # bits (packed, little bit order), ones before each block of the frame


def _directory(packed: np.ndarray) -> np.ndarray:
    """Ones before each block of a frame."""
    width = BLOCK // 8
    ones = np.bitwise_count(np.pad(packed, (0, -len(packed) % width))).reshape(-1, width).sum(1, dtype=np.uint32)
    return np.concatenate([[0], np.cumsum(ones)[:-1]]).astype(np.uint32)


class WaveletMatrix:
    """Succinct sequence of n integers below 2 ** bits, over frames that are fetched as they are needed.

    before: for each plane the ones before each of its frames, and the plane's ones in all.
    """

    def __init__(self, n: int, bits: int, before: np.ndarray, fetch: Callable[[int, int], Frame]):
        self.n, self.bits, self.before, self.fetch = n, bits, before.astype(np.int64), fetch
        self.zeros = [n - int(b[-1]) for b in self.before]

    @classmethod
    def build(cls, ids: np.ndarray, bits: int) -> WaveletMatrix:
        width = FRAME // 8
        planes, before, v = [], [], ids.astype(np.uint32 if bits > 16 else np.uint16)
        for k in range(bits - 1, -1, -1):
            packed = np.packbits(v & v.dtype.type(1 << k) != 0, bitorder="little")
            frames = [packed[i : i + width] for i in range(0, len(packed), width)]
            planes.append(frames)
            before.append(np.concatenate([[0], np.cumsum([int(np.bitwise_count(f).sum(dtype=np.int64)) for f in frames])]))
            ones, every = pa.Array.from_buffers(pa.bool_(), len(v), [None, pa.py_buffer(packed)]), pa.array(v)
            v = np.concatenate([every.filter(pc.invert(ones)).to_numpy(), every.filter(ones).to_numpy()])
        return cls(len(ids), bits, np.array(before).reshape(bits, -1), lambda k, f: (planes[k][f], _directory(planes[k][f])))

    def _ones(self, k: int, i: int) -> int:
        """Ones before place i of plane k."""
        frame, rest = divmod(i, FRAME)
        n = int(self.before[k][frame])
        if rest:
            bits, ranks = self.fetch(k, frame)
            block, rest = divmod(rest, BLOCK)
            if block == len(ranks):  # the end of a plane that fills its last block
                return int(self.before[k][frame + 1])
            n += int(ranks[block])
            if rest:
                part = bits[block * BLOCK // 8 : (block * BLOCK + rest + 7) // 8]
                n += int(np.unpackbits(part, count=rest, bitorder="little").sum())
        return n

    def _bit(self, k: int, i: int) -> int:
        frame, rest = divmod(i, FRAME)
        return int(self.fetch(k, frame)[0][rest >> 3]) >> (rest & 7) & 1

    def access(self, i: int) -> int:
        v = 0
        for k in range(self.bits):
            b, ones = self._bit(k, i), self._ones(k, i)
            v, i = v << 1 | b, self.zeros[k] + ones if b else i - ones
        return v

    def _range(self, token: int, lo: int, hi: int) -> tuple[int, int]:
        for k in range(self.bits):
            a, b = self._ones(k, lo), self._ones(k, hi)
            lo, hi = (self.zeros[k] + a, self.zeros[k] + b) if token >> (self.bits - 1 - k) & 1 else (lo - a, hi - b)
        return lo, hi

    def count(self, token: int, lo: int = 0, hi: int | None = None) -> int:
        """Occurrences of token in places lo to hi."""
        if token >> self.bits:
            return 0
        a, b = self._range(token, lo, self.n if hi is None else hi)
        return b - a

    def _select_bit(self, k: int, bit: int, j: int) -> int:
        """Place of the j-th (from 0) bit of that value in plane k."""
        starts = self.before[k]
        if not bit:
            starts = np.minimum(np.arange(len(starts)) * FRAME, self.n) - starts
        frame = int(np.searchsorted(starts, j, side="right")) - 1
        bits, ranks = self.fetch(k, frame)
        j -= int(starts[frame])
        inner = ranks.astype(np.int64) if bit else np.arange(len(ranks)) * BLOCK - ranks
        block = int(np.searchsorted(inner, j, side="right")) - 1
        begin = frame * FRAME + block * BLOCK
        part = np.unpackbits(bits[block * BLOCK // 8 : (block + 1) * BLOCK // 8], bitorder="little")[: self.n - begin]
        return begin + int(np.flatnonzero(part == bit)[j - int(inner[block])])

    def select(self, token: int, j: int) -> int:
        """Place of the j-th (from 0) occurrence of token."""
        lo, hi = self._range(token, 0, self.n) if not token >> self.bits else (0, 0)
        if not 0 <= j < hi - lo:
            raise IndexError(j)
        i = lo + j
        for k in range(self.bits - 1, -1, -1):
            bit = token >> (self.bits - 1 - k) & 1
            i = self._select_bit(k, bit, i - self.zeros[k] if bit else i)
        return i

    def occurrences(self, token: int) -> list[int]:
        return [self.select(token, j) for j in range(self.count(token))]

    def decode(self) -> np.ndarray:
        """All ids in order: the partitions are undone from the last plane to the first."""
        v = np.zeros(self.n, np.uint32 if self.bits > 16 else np.uint16)
        frames = self.before.shape[1] - 1
        for k in range(self.bits - 1, -1, -1):
            plane = np.concatenate([self.fetch(k, f)[0] for f in range(frames)]) if frames else np.empty(0, np.uint8)
            b = np.unpackbits(plane, count=self.n, bitorder="little").astype(bool)
            out, z = np.empty_like(v), self.zeros[k]
            out[~b] = v[:z]
            out[b] = v[z:] | v.dtype.type(1 << (self.bits - 1 - k))
            v = out
        return v


def dump(ids: np.ndarray, doc_ids: np.ndarray, lengths: np.ndarray) -> bytes:
    """The bytes of a shard file."""
    bits = max(1, int(ids.max(initial=0)).bit_length())
    matrix, pack = WaveletMatrix.build(ids, bits), zstandard.ZstdCompressor(level=1).compress
    frames = matrix.before.shape[1] - 1
    blobs = [pack(doc_ids.astype("<i8").tobytes()), pack(lengths.astype("<u4").tobytes())]
    for k in range(bits):
        for f in range(frames):
            plane, ranks = matrix.fetch(k, f)
            blobs.append(pack(struct.pack("<I", len(plane)) + plane.tobytes() + ranks.astype("<u4").tobytes()))
    header = json.dumps({"n": len(ids), "bits": bits, "docs": len(doc_ids), "frames": frames, "block": BLOCK, "frame": FRAME}).encode()
    table = np.array([len(b) for b in blobs], "<u4").tobytes() + matrix.before.astype("<u4").tobytes()
    return b"".join([MAGIC, struct.pack("<I", len(header)), header, table, *blobs])


class ShardFile:
    """A shard file over read(begin, size); only the header and what is asked for is read."""

    def __init__(self, read: Callable[[int, int], bytes]):
        first = read(0, 8)
        if first[:4] != MAGIC:
            raise ValueError("not a token shard")
        (size,) = struct.unpack_from("<I", first, 4)
        self.header = json.loads(read(8, size))
        bits, frames = self.header["bits"], self.header["frames"]
        if (self.header["block"], self.header["frame"]) != (BLOCK, FRAME):
            raise ValueError("a token shard of other frames")
        count, at = 2 + bits * frames, 8 + size
        table = np.frombuffer(read(at, 4 * (count + bits * (frames + 1))), "<u4")
        self.sizes = table[:count].astype(np.int64)
        self.places = at + 4 * len(table) + np.concatenate([[0], np.cumsum(self.sizes)])
        self.read, self.frames = read, frames
        self.matrix = WaveletMatrix(self.header["n"], bits, table[count:].reshape(bits, frames + 1), lru_cache(4 * bits)(self._frame))

    def _blob(self, k: int) -> bytes:
        return zstandard.ZstdDecompressor().decompress(self.read(int(self.places[k]), int(self.sizes[k])))

    def _frame(self, k: int, f: int) -> Frame:
        blob = self._blob(2 + k * self.frames + f)
        (n,) = struct.unpack_from("<I", blob)
        return np.frombuffer(blob, np.uint8, n, 4), np.frombuffer(blob, "<u4", offset=4 + n)

    def documents(self) -> tuple[np.ndarray, np.ndarray]:
        """Document ids and lengths."""
        return np.frombuffer(self._blob(0), "<i8"), np.frombuffer(self._blob(1), "<u4")


def open_shard(url: str) -> ShardFile:
    """A shard file in place: frames are read from the store as they are needed."""
    store, path = pyarrow.fs.FileSystem.from_uri(url)
    f = store.open_input_file(path)
    return ShardFile(lambda begin, size: f.read_at(size, begin))


def load(data: bytes) -> ShardFile:
    return ShardFile(lambda begin, size: data[begin : begin + size])


def _write(url: str, data: bytes) -> None:
    store, path = pyarrow.fs.FileSystem.from_uri(url)
    store.create_dir(path.rpartition("/")[0], recursive=True)
    with store.open_output_stream(temporary := f"{path}.{uuid.uuid4().hex}.tmp") as f:
        f.write(data)
    store.move(temporary, path)


def _read(url: str) -> bytes:
    store, path = pyarrow.fs.FileSystem.from_uri(url)
    with store.open_input_stream(path) as f:
        return f.read()


def write_shards(docs: DataFrame, folder: str | None = None, tokenizer: str | None = None, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Write docs' ids in ascending id order; one row a file: part, number, url, docs, tokens."""
    spark, path = docs.sparkSession, tokenizer or default_tokenizer()
    folder = folder or new_path(spark, "token-shards")
    small_batches(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held = TaskContext.get().partitionId(), 0, 0
        ids: list[np.ndarray] = []
        names: list[np.ndarray] = []
        lengths: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            url = f"{folder}/{part:08d}-{number:06d}.qwm"
            _write(url, dump(np.concatenate(ids), np.concatenate(names), np.concatenate(lengths)))
            row = {"part": [part], "number": [number], "url": [url], "docs": [sum(map(len, names))], "tokens": [held]}
            return pa.RecordBatch.from_pydict(row, schema=pa.schema({"part": pa.int64(), "number": pa.int64(), "url": pa.string(), "docs": pa.int64(), "tokens": pa.int64()}))

        for b in batches:
            known = b.column(0).fill_null(NULL_ID).to_numpy()
            for lo, hi, own, begins in encoded(b.column(1), path):
                at = 0
                while at < hi - lo:  # whole documents, until a shard has its tokens
                    stop = int(np.searchsorted(begins, begins[at] + max(1, shard_tokens - held), side="left"))
                    stop = min(max(stop, at + 1), hi - lo)
                    ids.append(own[begins[at] : begins[stop]])
                    names.append(known[lo + at : lo + stop])
                    lengths.append(np.diff(begins[at : stop + 1]))
                    held += len(ids[-1])
                    at = stop
                    if held >= shard_tokens:
                        yield flush()
                        number, held, ids, names, lengths = number + 1, 0, [], [], []
        if names:
            yield flush()

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The last two columns part the rows of one id; equal rows of one task stay together.
    rows = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("doc_id", "text").alias("tie"), F.spark_partition_id().alias("place"))
    order = [F.col("doc_id").asc_nulls_first(), "tie", "place"]
    rows = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    files, _ = written(rows.select("doc_id", "text").mapInArrow(run, "part long, number long, url string, docs long, tokens long"), "shard-table")
    return files


def read_documents(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files of a shard table."""
    upto = lambda w, c: F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, 0)) - F.col(c)
    parts = files.groupBy("part").agg(F.sum("tokens").alias("part_tokens"))
    parts = parts.select("part", upto(Window.orderBy("part"), "part_tokens").alias("part_start"))  # a row a partition of the writer
    inside = files.select("part", "url", upto(Window.partitionBy("part").orderBy("number"), "tokens").alias("inner_start"))
    starts = inside.join(parts, "part").select("url", (F.col("part_start") + F.col("inner_start")).alias("shard_start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for url, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                shard = load(_read(url))
                doc_ids, lengths = shard.documents()
                ids = memoryview(shard.matrix.decode().astype("<u4").tobytes())
                ends = np.cumsum(lengths, dtype=np.int64)
                begins = ends - lengths
                crc = [zlib.crc32(ids[4 * i : 4 * j]) for i, j in zip(begins.tolist(), ends.tolist())]
                columns = [
                    pa.array(doc_ids, mask=doc_ids == NULL_ID), pa.array(begins + start), pa.array(lengths.astype(np.int64)), pa.array(crc, pa.int64())
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])

    n = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return starts.repartition(n).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
