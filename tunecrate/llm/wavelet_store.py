"""Token ids in wavelet matrices: one compressed Parquet file per key range, self-contained shards inside.

A shard holds the ids of consecutive documents as a wavelet matrix: one bit plane per bit of
the id, from the highest down; each plane is stably parted by its bit before the next. With
the number of ones before each block of 512 bits beside it, a plane answers rank in a few
steps, and so the shard answers

    access(i)      the id at place i
    count(c)       how often id c occurs;  rank(c, i): before place i
    select(c, k)   the place of the k-th occurrence of c

in as many steps as an id has bits, without unpacking. Parquet's codec compresses planes.

Writing: documents are range-partitioned by (doc_id, text hash) and encoded inside their
range, so ids never move; a task closes a shard at ``shard_tokens`` ids, at a document's end.
Memory is one shard and one document. Reading: shards are decoded where they lie; documents'
global starts come from a two-level sum over shard sizes.

Defined cases: null text is the empty text (the end id alone); equal ids are ordered by their
text's hash, equal rows in any order; null ids come first; extra columns are ignored; an
empty table writes no shard; a document longer than a shard is a shard of its own.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tunecrate.llm import token_ids
from tunecrate.llm.storage import keyed, shared_path, small_batches, small_enough

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
BLOCK = 512
SHARD_TOKENS = 1 << 20

SCHEMA = (
    "part int, shard int, n_tokens bigint, width int, doc_ids array<bigint>, bounds array<bigint>, "
    "zeros array<bigint>, planes array<binary>, ones array<binary>"
)


class WaveletMatrix:
    """A sequence of ids as bit planes with rank directories."""

    def __init__(self, n: int, width: int, zeros: list[int], planes: list[bytes], ones: list[bytes]):
        self.n, self.width, self.zeros = n, width, list(zeros)
        self.planes = [np.frombuffer(p, np.uint8) for p in planes]
        self.ones = [np.frombuffer(o, "<u4") for o in ones]

    @classmethod
    def of(cls, ids: np.ndarray, width: int | None = None) -> WaveletMatrix:
        width = width or max(1, int(ids.max(initial=0)).bit_length())
        kind = np.uint16 if width <= 16 else np.uint32
        rest, zeros, planes, ones = ids.astype(kind), [], [], []
        for level in range(width - 1, -1, -1):
            bits = (rest & kind(1 << level)) != 0
            plane = np.packbits(bits)
            padded = np.zeros(-(-len(plane) * 8 // BLOCK) * (BLOCK // 64), np.uint64)
            padded.view(np.uint8)[: len(plane)] = plane
            per_block = np.bitwise_count(padded).reshape(-1, BLOCK // 64).sum(axis=1, dtype=np.int64)
            ones.append((np.cumsum(per_block) - per_block).astype("<u4").tobytes())
            planes.append(plane.tobytes())
            at = np.concatenate([np.flatnonzero(~bits), np.flatnonzero(bits)])
            zeros.append(len(bits) - int(per_block.sum()))
            rest = rest[at]
        return cls(len(ids), width, zeros, planes, ones)

    def _bit(self, level: int, i: int) -> int:
        return int(self.planes[level][i >> 3] >> (7 - (i & 7))) & 1

    def _ones_before(self, level: int, i: int) -> int:
        """Ones among the first ``i`` bits of a plane: the block's count and at most 64 bytes."""
        block = min(i // BLOCK, len(self.ones[level]) - 1)
        if block < 0:
            return 0
        at, plane = block * BLOCK, self.planes[level]
        whole = int(np.bitwise_count(plane[at >> 3 : i >> 3]).sum())
        rest = int(plane[i >> 3] >> (8 - (i & 7))).bit_count() if i & 7 else 0
        return int(self.ones[level][block]) + whole + rest

    def access(self, i: int) -> int:
        value = 0
        for level in range(self.width):
            bit, before = self._bit(level, i), self._ones_before(level, i)
            value = value << 1 | bit
            i = self.zeros[level] + before if bit else i - before
        return value

    def _range(self, c: int, i: int) -> tuple[int, int]:
        """Where the occurrences of ``c`` before place ``i`` lie below the last plane."""
        low, high = 0, i
        for level in range(self.width):
            a, b = self._ones_before(level, low), self._ones_before(level, high)
            if c >> (self.width - 1 - level) & 1:
                low, high = self.zeros[level] + a, self.zeros[level] + b
            else:
                low, high = low - a, high - b
        return low, high

    def rank(self, c: int, i: int) -> int:
        if c >> self.width:
            return 0
        low, high = self._range(c, i)
        return high - low

    def count(self, c: int) -> int:
        return self.rank(c, self.n)

    def _place(self, level: int, wanted: int, k: int) -> int:
        """Place of the ``k``-th (from 0) bit of value ``wanted`` in a plane, by binary search on rank."""
        low, high = 0, self.n
        while low < high:
            mid = (low + high) // 2
            before = self._ones_before(level, mid + 1)
            if (before if wanted else mid + 1 - before) > k:
                high = mid
            else:
                low = mid + 1
        return low

    def select(self, c: int, k: int) -> int:
        """Place of the ``k``-th (from 0) occurrence of ``c``; -1 if there are fewer."""
        if k >= self.count(c):
            return -1
        at = self._range(c, self.n)[0] + k
        for level in range(self.width - 1, -1, -1):
            bit = c >> (self.width - 1 - level) & 1
            at = self._place(level, bit, at - self.zeros[level] if bit else at)
        return at

    def decode(self) -> np.ndarray:
        """All ids in order: planes are merged from the lowest up."""
        kind = np.uint16 if self.width <= 16 else np.uint32
        ids = np.zeros(self.n, kind)
        for level in range(self.width - 1, -1, -1):
            bits = np.unpackbits(self.planes[level], count=self.n).view(bool)
            merged = np.empty(self.n, kind)
            zeros = self.zeros[level]
            merged[np.flatnonzero(~bits)] = ids[:zeros]
            merged[np.flatnonzero(bits)] = ids[zeros:] | kind(1 << (self.width - 1 - level))
            ids = merged
        return ids.astype(np.uint32)


def _row(part: int, shard: int, doc_ids: list, sizes: list[int], ids: list[np.ndarray]) -> pa.RecordBatch:
    matrix = WaveletMatrix.of(np.concatenate(ids))
    columns = {
        "part": pa.array([part], pa.int32()), "shard": pa.array([shard], pa.int32()), "n_tokens": pa.array([matrix.n], pa.int64()),
        "width": pa.array([matrix.width], pa.int32()), "doc_ids": pa.array([doc_ids], pa.list_(pa.int64())),
        "bounds": pa.array([np.concatenate([[0], np.cumsum(sizes)])], pa.list_(pa.int64())),
        "zeros": pa.array([matrix.zeros], pa.list_(pa.int64())),
        "planes": pa.array([[p.tobytes() for p in matrix.planes]], pa.list_(pa.binary())),
        "ones": pa.array([[o.tobytes() for o in matrix.ones]], pa.list_(pa.binary())),
    }
    return pa.RecordBatch.from_pydict(columns)


def write(
    docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text",
    tokenizer: str = TOKENIZER, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS,
) -> None:
    """Encodes ``docs`` in ascending order of id into wavelet shards below ``path``."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = token_ids.encoder(token_ids.installed(tokenizer)).encode
        part, shard = TaskContext.get().partitionId(), 0
        names: list = []
        sizes: list[int] = []
        held: list[np.ndarray] = []
        n_held = 0
        for batch in batches:
            doc_ids = batch.column(0).cast(pa.int64()).to_pylist()
            for low, high, ids, offsets in encode(batch.column(1)):
                for row in range(high - low):
                    own = np.append(ids[offsets[row] : offsets[row + 1]], np.uint32(end_id))
                    if held and n_held + len(own) > shard_tokens:
                        yield _row(part, shard, names, sizes, held)
                        shard, names, sizes, held, n_held = shard + 1, [], [], [], 0
                    names.append(doc_ids[low + row])
                    sizes.append(len(own))
                    held.append(own)
                    n_held += len(own)
        if held:
            yield _row(part, shard, names, sizes, held)

    rows = keyed(docs, doc_id, text).repartitionByRange(F.col("doc_id"), F.col("_h")).sortWithinPartitions("doc_id", "_h")
    with small_batches(docs.sparkSession):
        rows.select("doc_id", "text").mapInArrow(build, SCHEMA).write.option("compression", "zstd").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files, decoded from their planes."""
    shards = spark.read.schema(SCHEMA).parquet(path)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = WaveletMatrix(row["n_tokens"], row["width"], row["zeros"], row["planes"], row["ones"]).decode().astype("<u4")
                bounds = np.array(row["bounds"], np.int64)
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
                n = len(crc)
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([row["part"]] * n, pa.int32()), "shard": pa.array([row["shard"]] * n, pa.int32()),
                    "doc_id": pa.array(row["doc_ids"], pa.int64()), "inside": pa.array(bounds[:-1]),
                    "n_tokens": pa.array(np.diff(bounds)), "ids_crc32": pa.array(crc, pa.int64()),
                })

    found = shards.mapInArrow(decode, "part int, shard int, doc_id bigint, inside bigint, n_tokens bigint, ids_crc32 bigint")
    sizes = shards.select("part", "shard", "n_tokens")
    until = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))  # one row per file
    parts = parts.select("part", F.coalesce(F.sum("n").over(until(Window.orderBy("part"))), F.lit(0)).alias("_before"))
    inside = F.coalesce(F.sum("n_tokens").over(until(Window.partitionBy("part").orderBy("shard"))), F.lit(0))
    starts = sizes.withColumn("_own", inside).join(parts, "part").select("part", "shard", (F.col("_before") + F.col("_own")).alias("_start"))
    return found.join(small_enough(starts), ["part", "shard"]).select(
        "doc_id", (F.col("_start") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"
    )


def round_trip(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Writes ``docs`` to the shared folder and reads every document's digest back from the files."""
    path = shared_path(docs.sparkSession, "wavelet")
    write(docs, path, doc_id, text)
    return read(docs.sparkSession, path)
