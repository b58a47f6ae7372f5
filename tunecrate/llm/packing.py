"""Best-fit packing of token pieces into sequences, in bulk-synchronous supersteps.

Best fit looks at lengths only, so documents and gaps are kept as counts per length. A
superstep takes the longest length left, in descending order: its pieces are matched to the
smallest gap that is large enough (the successor in the sorted gaps), then to the next gap
when those bins are full, and to fresh sequences last; the gaps shrink and the next
superstep begins. The state of a superstep has at most ``capacity`` lengths and gaps, however
many documents there are; it reproduces sequential best-fit decreasing exactly.

Which piece of a length goes to which bin is settled by rank: pieces of a length are numbered
by a distributed two-level count (salted, so a length that a third of all pieces share is
spread), and a bin range serves a range of ranks. Assignment is one lookup per piece in
place; pieces are never gathered.

Defined cases: null text is the empty text, whose piece is the end id alone; repeated rows
and equal ids are packed separately; a null id stays null; extra columns are ignored; an
empty table gives no sequence. Long documents are cut into pieces of ``capacity`` and a rest.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunecrate.llm import token_ids
from tunecrate.llm.storage import small_batches, stored

CAPACITY = 2048
TOKENIZER = "word_bpe_49k.json"
END_ID = 0
ROWS_PER_BUCKET = 20_000

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
PLACED = PIECES + ", sequence_id bigint, offset bigint"


def token_pieces(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
    tokenizer: str = TOKENIZER, end_id: int = END_ID, capacity: int = CAPACITY,
) -> DataFrame:
    """Pieces of at most ``capacity`` ids of each document with its end id; only longer documents are cut."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = token_ids.encoder(token_ids.installed(tokenizer)).encode
        for batch in batches:
            names = batch.column(0).cast(pa.int64())
            for low, high, ids, offsets in encode(batch.column(1)):
                rows, piece, start, length, crc = [], [], [], [], []
                for row in range(high - low):
                    own = np.append(ids[offsets[row] : offsets[row + 1]], np.uint32(end_id)).astype("<u4")
                    for n, at in enumerate(range(0, len(own), capacity)):
                        part = own[at : at + capacity]
                        rows.append(low + row)
                        piece.append(n)
                        start.append(at)
                        length.append(len(part))
                        crc.append(zlib.crc32(part))
                yield pa.RecordBatch.from_arrays(
                    [names.take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return docs.select(doc_id, text).toDF("doc_id", "text").mapInArrow(cut, PIECES)


def best_fit_plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Rows (length, first rank, first bin, pieces per bin, offset) of best-fit decreasing over counts per length.

    Ranks from one row's first rank up to the next row's of the same length fill bins in order.
    """
    gaps: list[int] = []  # sizes with open bins, ascending
    open_bins: dict[int, list[tuple[int, int]]] = {}  # gap -> ranges (first bin, bins)
    plan: list[tuple[int, int, int, int, int]] = []
    next_bin = 0

    def leave(gap: int, first: int, bins: int) -> None:
        if gap and bins:
            if gap not in open_bins:
                bisect.insort(gaps, gap)
                open_bins[gap] = []
            open_bins[gap].append((first, bins))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect.bisect_left(gaps, length)
            if at < len(gaps):
                gap = gaps[at]
                first, bins = open_bins[gap].pop()
                if not open_bins[gap]:
                    del open_bins[gap]
                    gaps.pop(at)
            else:
                gap, first = capacity, next_bin
                bins = -(-left // (capacity // length))
                next_bin += bins
            each = gap // length
            plan.append((length, rank, first, each, capacity - gap))
            full = min(bins, left // each)
            taken = full * each
            leave(gap - each * length, first, full)
            rest = left - taken
            if full < bins:
                part = min(rest, each)  # under ``each``: one bin is filled in part
                if part:
                    leave(gap - part * length, first + full, 1)
                    taken += part
                    full += 1
                leave(gap, first + full, bins - full)
            left -= taken
            rank += taken
    return plan


def ranked(pieces: DataFrame, buckets: int) -> DataFrame:
    """``pieces`` with ``_rank`` from 0 within each length: counts per (length, salt) first, then ranks inside one salt."""
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    offsets = offsets.select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "start", "ids_crc32")
    numbered = salted.withColumn("_in", F.row_number().over(inside))
    return numbered.join(offsets, ["length", "_salt"]).withColumn("_rank", F.col("_before") + F.col("_in") - 1)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (already written) with ``sequence_id`` and gapless ``offset``."""
    counts = {int(r["length"]): int(r["n"]) for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = np.array(best_fit_plan(counts, capacity), np.int64).reshape(-1, 5)
    plan = plan[np.lexsort((plan[:, 1], plan[:, 0]))]
    shared = pieces.sparkSession.sparkContext.broadcast(plan)  # bounded by the capacity, not by the pieces
    total = sum(counts.values())

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, ranks, bins, each, offsets = shared.value.T
        width = total + 1
        keys = lengths * width + ranks
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("_rank").to_numpy(zero_copy_only=False)
            row = np.searchsorted(keys, length * width + rank, side="right") - 1
            step = rank - ranks[row]
            out = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            out += [pa.array(bins[row] + step // each[row]), pa.array(offsets[row] + step % each[row] * length)]
            yield pa.RecordBatch.from_arrays(out, names=[c.split()[0] for c in PLACED.split(", ")])

    numbered = ranked(pieces, max(1, -(-total // ROWS_PER_BUCKET)))
    return numbered.select("doc_id", "piece", "start", "length", "ids_crc32", "_rank").mapInArrow(place, PLACED)


def pack_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Every document's pieces with their place in the packed sequences."""
    with small_batches(docs.sparkSession):
        pieces = stored(token_pieces(docs, doc_id, text, capacity=capacity), "pieces")
    return pack(pieces, capacity)
