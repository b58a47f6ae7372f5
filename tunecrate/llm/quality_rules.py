"""Quality rules by compression: zstandard ratios of whole documents and of fixed chunks.

Repetitive text compresses too well, random text too badly. What is normal depends on the
length (short texts carry the frame's overhead and little context), so each length class has
its own band. Every row is judged alone: no shuffle, no state.

Defined cases: a null or empty text has no words and fails the base test; repeated rows and
ties are judged alike; extra columns, whatever their names, pass through
``keep_compressible`` untouched and do not enter ``compression_bands``; an empty table gives
an empty table. A text of any length is read whole: a rest under half a chunk is no chunk in
``n_chunks`` and ``n_bad_chunks``, but counts as one in ``kept``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame

from tunecrate.llm import words

SCHEMA = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "base_failed boolean, kept boolean, ratio double, n_chunks bigint, n_bad_chunks bigint"
)


@dataclass(frozen=True)
class Limits:
    """Production parameters. ``bands``: (bytes below, least ratio, largest ratio) by ascending length."""

    bands: tuple = ((200, 0.0, 2.5), (1000, 1.05, 2.6), (4000, 1.35, 3.2), (16000, 1.6, 3.6), (float("inf"), 1.8, 4.0))
    chunk_bytes: int = 4096
    chunk_band: tuple = (1.35, 3.4)
    bad_chunk_share: float = 0.25
    level: int = 3
    min_words: int = 10
    repeat_percent: int = 20


_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _repeated_lines(text: bytes) -> int:
    seen: set[bytes] = set()
    repeated = 0
    for line in text.split(b"\n"):
        if line.strip(b" \t\n\v\f\r"):
            repeated += line in seen
            seen.add(line)
    return repeated


def _repeat_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words per text, and how many of them lie in a five-word window that the text has twice or more."""
    starts, ends, word_offsets = words.word_spans(data, offsets)
    counts = np.diff(word_offsets)
    shingles, first, shingle_offsets = words.shingle_hashes(words.span_hashes(data, starts, ends), word_offsets)
    text = np.repeat(np.arange(len(counts)), np.diff(shingle_offsets))
    order = np.lexsort((shingles, text)) if len(counts) > 1 else np.argsort(shingles)
    same = (shingles[order][1:] == shingles[order][:-1]) & (text[order][1:] == text[order][:-1])
    twice = np.zeros(len(shingles), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edges = np.zeros(len(starts) + 6, np.int64)
    at = first[twice]  # texts under five words have one window, never twice
    np.add.at(edges, at, 1)
    np.add.at(edges, at + 5, -1)
    return counts, words.sums_between(np.cumsum(edges)[: len(starts)] > 0, word_offsets)


def _chunks_outside(text: bytes, press: zstandard.ZstdCompressor, limits: Limits) -> tuple[int, int, int, int]:
    """Chunks of fixed size, those outside the chunk band, and the same two numbers of the rest under half a chunk.

    The chunk band is too narrow for a short rest: behind other chunks it has the band of a text of its length.
    """
    size, (low, high) = limits.chunk_bytes, limits.chunk_band
    parts = [text[i : i + size] for i in range(0, len(text), size)]
    rest = parts.pop() if parts and 2 * len(parts[-1]) < size else b""
    bad = sum(not low <= len(p) / len(press.compress(p)) <= high for p in parts)
    if not parts or not rest:
        return len(parts), bad, 0, 0
    low, high = next(b[1:] for b in limits.bands if len(rest) < b[0])
    return len(parts), bad, 1, int(not low <= len(rest) / len(press.compress(rest)) <= high)


def measures(column: pa.Array, limits: Limits) -> dict[str, np.ndarray]:
    """All measures and verdicts of a column of texts."""
    column = words.filled(column)
    press = zstandard.ZstdCompressor(level=limits.level)
    bounds = np.array([b[0] for b in limits.bands])
    parts: list[dict[str, np.ndarray]] = []
    for low, high, data, offsets in words.byte_slices(column):
        n_words, n_repeat = _repeat_words(data, offsets)
        visible = ~words.IS_SPACE[data] & ((data & 0xC0) != 0x80)
        raw = data.tobytes()
        texts = [raw[a:b] for a, b in zip(offsets[:-1], offsets[1:])]
        sizes = np.diff(offsets)
        ratio = np.array([len(t) / len(press.compress(t)) if t else 0.0 for t in texts])
        chunks = np.array([_chunks_outside(t, press, limits) for t in texts], np.int64).reshape(-1, 4)
        band = np.searchsorted(bounds, sizes, side="right")
        least = np.array([b[1] for b in limits.bands])[band]
        most = np.array([b[2] for b in limits.bands])[band]
        failed = (n_words < limits.min_words) | (100 * n_repeat > limits.repeat_percent * n_words)
        judged, outside = chunks[:, 0] + chunks[:, 2], chunks[:, 1] + chunks[:, 3]
        inside = (ratio >= least) & (ratio <= most) & (outside <= limits.bad_chunk_share * judged)
        parts.append(
            {
                "n_words": n_words, "word_chars": words.sums_between(visible, offsets),
                "n_symbols": words.sums_between(_SYMBOL[data], offsets),
                "n_dup_lines": np.array([_repeated_lines(t) for t in texts], np.int64), "n_repeat_words": n_repeat,
                "base_failed": failed, "kept": ~failed & inside, "ratio": ratio,
                "n_chunks": chunks[:, 0], "n_bad_chunks": chunks[:, 1],
            }
        )
    return {k: np.concatenate([p[k] for p in parts]) for k in parts[0]} if parts else {}


def compression_bands(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", limits: Limits = Limits()) -> DataFrame:
    """One row of measures and verdict per row of ``docs``."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                columns = {"doc_id": batch.column(0).cast(pa.int64()), **measures(batch.column(1), limits)}
                yield pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in columns.items()})

    return docs.select(doc_id, text).toDF("doc_id", "text").mapInArrow(judge, SCHEMA)


def keep_compressible(docs: DataFrame, text: str = "text", limits: Limits = Limits()) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns."""
    place = docs.columns.index(text)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                passed = pa.array(measures(batch.column(place), limits)["kept"])
                yield pa.RecordBatch.from_arrays([pc.filter(c, passed) for c in batch.columns], schema=batch.schema)

    return docs.mapInArrow(keep, docs.schema)
