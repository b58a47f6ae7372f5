"""Repeated passages by content-defined chunking with a gear rolling hash.

A gear hash sums a random value per byte, shifted by its distance, over the last 32 bytes. A
chunk ends after a character where the hash's top four bits are below the character's size in
bytes (one place in 16 bytes, whatever the script) and no such place lies within the ``least``
bytes before; both depend on nearby bytes alone, so an insertion moves only the cuts around
it and a repeated passage is cut alike wherever it stands. ``most`` bytes without a cut force
one, counted from the last cut and moved back to a character's start.

1. One pass cuts whole texts; a chunk is (document, place, digest).
2. Digests are counted with map-side sums: hot digests never meet in one task. Those that
   occur in two documents or more keep the least id that has them.
3. Chunks with such a digest join back; runs of neighbouring repeated chunks are passages. A
   run counts from ``min_words`` words on: the chunks that hold a passage's two ends are cut
   by its surroundings, so a passage of over 50 words keeps a run of 25 or more (98 of 100 at 51 words, 99.7 of 100 at 80).
4. All occurrences but the first are repeats, to be cut out.

Defined cases: null and empty texts have no chunks; rows of equal id are one document, whose
texts do not repeat each other, and so are all rows with a null id, which comes first; extra columns are ignored by ``repeats`` and kept by ``without_repeats``; an empty table
gives none. Spans count bytes of the UTF-8 text, cut at characters. Chinese and Japanese write
no spaces: two Han or kana characters count as a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunecrate.llm import words
from tunecrate.llm.storage import keyed, small_enough, stored

WINDOW = 32
MASK_BITS = 4
LEAST, MOST = 12, 1024
PLACE, SIZE = 24, 12  # bit places of a chunk's start and size in its mark; its words take the lowest bits
MIN_WORDS = 25

GEAR = words.mix(np.arange(1001, 1257, dtype=np.uint64)).astype(np.uint32)


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """Gear hash after each byte: sum over the last 32 bytes of GEAR[byte] << distance, by doubling."""
    h = GEAR[data]
    span = 1
    while span < WINDOW:
        longer = h.copy()
        longer[span:] += h[:-span] << np.uint32(span)
        h = longer
        span *= 2
    return h


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Ends of all chunks, ascending; every text's end is one."""
    # the top bits of the hash depend on all 32 bytes of the window
    inner = (data & 0xC0) == 0x80
    size = np.ones(len(data), np.uint8)  # bytes of the character up to here: a place per 16 bytes in every script
    before = inner
    for distance in (1, 2, 3):
        size += before
        before = before & np.concatenate([np.zeros(min(distance, len(data)), bool), inner[:-distance]])
    marked = (gear_hashes(data) >> np.uint32(32 - MASK_BITS)).astype(np.uint8) < size
    marked[:-1] &= ~inner[1:]  # after a whole character
    at = np.flatnonzero(marked) + 1
    text = np.searchsorted(offsets, at, side="left")
    alone = np.ones(len(at), bool)
    alone[1:] = (np.diff(at) >= LEAST) | (np.diff(text) > 0)
    inside = at - offsets[text - 1] if len(at) else at
    at = at[alone & (inside >= WINDOW)]  # a window over two texts says nothing
    ends = np.unique(np.concatenate([at, offsets[1:][np.diff(offsets) > 0]]))
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    long = np.flatnonzero(ends - starts > MOST)
    if len(long):
        forced = np.concatenate([np.arange(starts[i] + MOST, ends[i], MOST) for i in long])
        for _ in range(3):  # back to the first byte of a character, which has four bytes at most
            forced -= (data[forced] & 0xC0) == 0x80
        ends = np.unique(np.concatenate([ends, forced]))
    return ends


def words_before(data: np.ndarray, offsets: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Number of words that start before each place; two Han or kana characters are one, counted by their first bytes."""
    starts, _, _ = words.word_spans(data, offsets)
    han = (data >= 0xE3) & (data <= 0xE9)  # U+3000 to U+9FFF
    if not han.any():
        return np.searchsorted(starts, places)
    han[:-1] &= (data[:-1] > 0xE3) | (data[1:] > 0x80)  # the signs U+3000 to U+303F are no letters
    return np.searchsorted(starts[~han[starts]], places) + np.searchsorted(np.flatnonzero(han), places) // 2


def chunks(docs: DataFrame) -> DataFrame:
    """(doc_id, _h, mark, digest) of keyed ``docs``; a mark is a chunk's start, size and number of words in one long."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in words.byte_slices(words.filled(batch.column(2))):
                ends = cuts(data, offsets)
                if not len(ends):
                    continue
                starts = np.concatenate([[0], ends[:-1]])
                text = np.searchsorted(offsets, ends, side="left") - 1
                n_words = np.diff(words_before(data, offsets, np.concatenate([[0], ends])))
                digests = words.span_hashes(data, starts, ends)
                rows = pa.array(text)
                marks = (starts - offsets[text] << PLACE) + (ends - starts << SIZE) + n_words
                yield pa.RecordBatch.from_arrays(
                    [pc.take(batch.column(0).slice(low, high - low), rows), pc.take(batch.column(1).slice(low, high - low), rows),
                     pa.array(marks.astype(np.int64)), pa.array(digests.view(np.int64))],
                    names=["doc_id", "_h", "mark", "digest"],
                )

    return docs.select("doc_id", "_h", "text").mapInArrow(cut, f"doc_id {kind}, _h bigint, mark bigint, digest bigint")


def passages(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, _h, start, end, n_words, n_chunks, first_doc_id) of later occurrences of passages; keyed ``docs``."""
    parts = stored(chunks(docs), "chunks")
    seen = parts.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.max(F.col("doc_id").isNull()).alias("nameless"))
    first = F.when(~F.col("nameless"), F.col("first"))
    shared = seen.where((F.col("first") != F.col("last")) | (F.col("nameless") & F.col("first").isNotNull())).select("digest", first.alias("first"))
    again = parts.join(shared, "digest").where(~F.col("doc_id").eqNullSafe(F.col("first")))
    again = again.repartition("doc_id", "_h").dropDuplicates(["doc_id", "_h", "mark"])
    size = F.expr(f"shiftright(mark, {SIZE}) & {(1 << PLACE - SIZE) - 1}")
    again = again.select("doc_id", "_h", "first", F.expr(f"shiftright(mark, {PLACE})").alias("start"), size.alias("size"), F.expr(f"mark & {(1 << SIZE) - 1}").alias("n_words"))
    before = Window.partitionBy("doc_id", "_h").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    island = F.col("start") - F.coalesce(F.sum("size").over(before), F.lit(0))  # the same all along a run
    runs = again.withColumn("island", island).groupBy("doc_id", "_h", "island").agg(
        F.min("start").alias("start"), F.max(F.col("start") + F.col("size")).alias("end"), F.sum("n_words").alias("n_words"),
        F.count("*").alias("n_chunks"), F.max(F.struct("size", "first"))["first"].alias("first_doc_id"),
    )
    return runs.where(F.col("n_words") >= min_words).drop("island")


def repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """One row per document and passage that an earlier document has too, with that document's id."""
    return passages(keyed(docs, doc_id, text), min_words).drop("_h")


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with repeated passages cut out of all texts but the first that has them; all columns stay."""
    spans = passages(keyed(docs, doc_id, text), min_words).groupBy("doc_id", "_h").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("_spans"))
    spans = small_enough(stored(spans, "repeats")).toDF("_id", "_key", "_spans")
    key = F.xxhash64(F.coalesce(docs[text], F.lit("")))
    joined = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("_row"), docs[doc_id].alias("_doc"), key.alias("_own"))
    joined = joined.join(spans, joined["_doc"].eqNullSafe(spans["_id"]) & (joined["_own"] == spans["_key"]), "left")
    raw = F.encode(F.col(f"_row.{text}"), "UTF-8")

    def step(acc, s):
        piece = F.substring(raw, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        return F.struct(s["end"].alias("at"), F.concat(acc["out"], piece).alias("out"))

    begin = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit(b"").alias("out"))
    kept = F.aggregate("_spans", begin, step, lambda acc: F.decode(F.concat(acc["out"], F.substring(raw, (acc["at"] + 1).cast("int"), F.octet_length(raw))), "UTF-8"))
    cleaned = F.when(F.col("_spans").isNull(), F.col(f"_row.{text}")).otherwise(kept)
    return joined.select(*(cleaned.alias(c) if c == text else F.col("_row").getField(c).alias(c) for c in docs.columns))
