"""Document quality from a linear-chain conditional random field over lines.

Each line is good or bad. A line's evidence is its own measures and its neighbours'; the
chain's transitions tie neighbouring labels. Forward-backward gives each line's probability of
being good, and a document's score is their mean weighted by line length.

Training: labelled documents of the training folds, all of whose lines take the document's
label, at most ``sample_docs`` of them (smallest hash of the id) with at most
``sample_lines`` lines each: the only bounded sample here. A longer document gives a block of
consecutive lines, from a place that follows from its text's hash, with the measures that they
have in the whole text. The line measures are made by
Spark tasks; the fit (some 60 weights, full-batch Adam on the exact likelihood) runs on them
on the driver. Scoring reads every whole text where it lies.

Inputs of a score are the text's bytes only. Defined cases: a null or empty text is one empty
line; documents without a label are scored alike; a label per id is the mean of its rows;
null labels and null ids teach nothing; without any usable label the score is 0.5; extra
columns are ignored; repeated rows are scored alike; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunecrate.llm import words

SAMPLE_DOCS = 6000
SAMPLE_LINES = 200
STEPS = 250
PREDICT_FROM = 0.7

OWN = 15
NEAR = (1, 2, 3, 4, 7, 8, 11, 12)
N_FEATURES = OWN + 2 * len(NEAR) + 3

_UPPER, _DIGIT, _SYMBOL, _BANG, _STOP = (np.zeros(256, bool) for _ in range(5))
_UPPER[65:91] = True
_DIGIT[48:58] = True
_SYMBOL[list(b"#*$%&|<>")] = True
_BANG[ord("!")] = True
_STOP[list(b".,;:?")] = True
_LINE_SALT = np.uint64(0x9E6C63D0876A9A99)


def line_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the lines of all texts, and line offsets by text; an empty text is one line."""
    breaks = np.flatnonzero(data == 10)
    n_texts = len(offsets) - 1
    text = np.searchsorted(offsets, breaks, side="right") - 1
    line_offsets = np.arange(n_texts + 1) + np.searchsorted(breaks, offsets)
    starts = np.zeros(line_offsets[-1], np.int64)
    ends = np.zeros(line_offsets[-1], np.int64)
    starts[line_offsets[:-1]] = offsets[:-1]
    ends[line_offsets[1:] - 1] = offsets[1:]
    at = np.arange(len(breaks)) + text
    ends[at] = breaks
    starts[at + 1] = breaks + 1
    return starts, ends, line_offsets


def _firsts(keys: np.ndarray) -> np.ndarray:
    """Which entries are the first with their key."""
    first = np.zeros(len(keys), bool)
    first[np.unique(keys, return_index=True)[1]] = True
    return first


def line_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features by line, line sizes, line offsets by text)."""
    starts, ends, line_offsets = line_spans(data, offsets)
    n = len(starts)
    sizes = ends - starts
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(line_offsets))

    def share(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return (total[ends] - total[starts]) / np.maximum(sizes, 1)

    word_starts, word_ends, word_offsets = words.word_spans(data, offsets)
    hashes = words.span_hashes(data, word_starts, word_ends)
    line_of_word = np.searchsorted(starts, word_starts, side="right") - 1
    n_words = np.bincount(line_of_word, minlength=n)[:n]
    new = _firsts(words.mix(hashes ^ (line_of_word.astype(np.uint64) * _LINE_SALT)))
    n_new = np.bincount(line_of_word[new], minlength=n)[:n]
    shingles, first_word, shingle_offsets = words.shingle_hashes(hashes, word_offsets)
    text_of_shingle = np.repeat(np.arange(len(offsets) - 1), np.diff(shingle_offsets)).astype(np.uint64)
    _, place, times = np.unique(words.mix(shingles ^ (text_of_shingle * _LINE_SALT)), return_inverse=True, return_counts=True)
    line_of_shingle = line_of_word[first_word]
    n_shingles = np.bincount(line_of_shingle, minlength=n)[:n]
    n_twice = np.bincount(line_of_shingle[times[place] > 1], minlength=n)[:n]
    line_keys = words.mix(words.span_hashes(data, starts, ends) ^ (text.astype(np.uint64) * _LINE_SALT))
    last = data[np.maximum(ends - 1, 0)] if len(data) else np.zeros(n, np.uint8)

    own = np.zeros((n, OWN))
    own[:, 0] = np.log1p(sizes) / 5
    own[:, 1] = share(_UPPER[data])
    own[:, 2] = share(_DIGIT[data])
    own[:, 3] = share(_SYMBOL[data])
    own[:, 4] = share(_BANG[data])
    own[:, 5] = share(_STOP[data])
    own[:, 6] = share(words.IS_SPACE[data])
    own[:, 7] = np.minimum(sizes / np.maximum(n_words, 1), 100) / 10
    own[:, 8] = np.log1p(n_words) / 5
    own[:, 9] = (sizes > 0) & np.isin(last, np.frombuffer(b".!?", np.uint8))
    own[:, 10] = ~_firsts(line_keys) & (sizes > 0)
    own[:, 11] = 1 - n_new / np.maximum(n_words, 1)
    own[:, 12] = n_twice / np.maximum(n_shingles, 1)
    own[:, 13] = sizes == 0
    own[:, 14] = share(data >= 0x80)
    own[n_words == 0, 11] = 0

    out = np.zeros((n, N_FEATURES))
    out[:, :OWN] = own
    opens, closes = np.zeros(n, bool), np.zeros(n, bool)
    opens[line_offsets[:-1]] = True
    closes[line_offsets[1:] - 1] = True
    k = len(NEAR)
    near = own[:, NEAR]
    out[1:, OWN : OWN + k] = near[:-1]
    out[opens, OWN : OWN + k] = 0
    out[:-1, OWN + k : OWN + 2 * k] = near[1:]
    out[closes, OWN + k : OWN + 2 * k] = 0
    out[:, -3], out[:, -2], out[:, -1] = opens, closes, 1
    return out, sizes, line_offsets


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    transitions: np.ndarray  # [label before, label]

    def emissions(self, features: np.ndarray) -> np.ndarray:
        """Evidence for the label good (bad has 0)."""
        return (features - self.mean) / self.scale @ self.weights


UNKNOWN = Model(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(N_FEATURES), np.zeros((2, 2)))


def forward_backward(emission: np.ndarray, line_offsets: np.ndarray, transitions: np.ndarray, pairs: bool = False):
    """(probability of good by line, log partition by text, expected transition counts or None).

    All texts move in step: one round per line number over the texts that have such a line.
    """
    lengths = np.diff(line_offsets)
    order = np.argsort(-lengths, kind="stable")
    first = line_offsets[:-1][order]
    longest = int(lengths.max(initial=0))
    active = np.searchsorted(-lengths[order], -np.arange(longest), side="left")  # texts with more than t lines
    score = np.stack([np.zeros_like(emission), emission], axis=1)
    alpha, beta = score.copy(), np.zeros_like(score)
    for t in range(1, longest):
        at = first[: active[t]] + t
        before = alpha[at - 1]
        alpha[at] = score[at] + np.logaddexp(before[:, :1] + transitions[0], before[:, 1:] + transitions[1])
    for t in range(longest - 2, -1, -1):
        at = first[: active[t + 1]] + t
        after = beta[at + 1] + score[at + 1]
        beta[at] = np.logaddexp(transitions[:, 0] + after[:, :1], transitions[:, 1] + after[:, 1:])
    last = alpha[line_offsets[1:] - 1]
    partition = np.logaddexp(last[:, 0], last[:, 1])
    by_line = np.repeat(partition, lengths)
    good = np.exp(np.minimum(alpha[:, 1] + beta[:, 1] - by_line, 0.0))
    if not pairs:
        return good, partition, None
    follows = np.ones(len(emission), bool)
    follows[line_offsets[:-1]] = False
    at = np.flatnonzero(follows)
    joint = alpha[at - 1][:, :, None] + transitions + (score[at] + beta[at])[:, None, :] - by_line[at][:, None, None]
    return good, partition, np.exp(np.minimum(joint, 0.0)).sum(axis=0)


def fit(features: np.ndarray, line_offsets: np.ndarray, labels: np.ndarray, steps: int = STEPS, rate: float = 0.1, ridge: float = 1e-3) -> Model:
    """Weights of greatest penalised likelihood, by Adam; ``labels`` by text hold for all its lines."""
    mean, scale = features.mean(axis=0), features.std(axis=0)
    mean[-1], scale[-1] = 0.0, 1.0
    scale[scale < 1e-9] = 1.0
    x = (features - mean) / scale
    lengths = np.diff(line_offsets)
    y = np.repeat(labels.astype(np.float64), lengths)
    seen = np.zeros((2, 2))
    for label in (0, 1):
        seen[label, label] = (lengths[labels == label] - 1).sum()
    parameters = np.zeros(N_FEATURES + 4)
    momentum, spread = np.zeros_like(parameters), np.zeros_like(parameters)
    for step in range(1, steps + 1):
        weights, transitions = parameters[:N_FEATURES], parameters[N_FEATURES:].reshape(2, 2)
        good, _, expected = forward_backward(x @ weights, line_offsets, transitions, pairs=True)
        slope = np.concatenate([x.T @ (y - good), (seen - expected).ravel()]) / len(y) - ridge * parameters
        momentum = 0.9 * momentum + 0.1 * slope
        spread = 0.999 * spread + 0.001 * slope**2
        parameters = parameters + rate * (momentum / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.999**step)) + 1e-8)
    return Model(mean, scale, parameters[:N_FEATURES], parameters[N_FEATURES:].reshape(2, 2))


def held_out(doc_id: str) -> Column:
    """Fold 2 of 4 by CRC-32 of the id as text; a null id is in no fold."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def train(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
    sample_docs: int = SAMPLE_DOCS, sample_lines: int = SAMPLE_LINES,
) -> Model:
    """A model from the training folds' labelled documents, ``sample_docs`` at most with ``sample_lines`` lines each."""
    known = labels.select(F.col("doc_id").alias("_id"), F.col(label).alias("_label")).where("_id IS NOT NULL AND _label IS NOT NULL")
    known = known.where(~held_out("_id")).groupBy("_id").agg((F.avg("_label") >= 0.5).cast("int").alias("_label"))
    sample = known.orderBy(F.xxhash64("_id"), "_id").limit(sample_docs)  # bounded: a parameter

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = batch.column(0).to_pylist()
            for low, high, data, offsets in words.byte_slices(words.filled(batch.column(1))):
                features, _, line_offsets = line_features(data, offsets)
                first, n_lines = line_offsets[:-1], np.diff(line_offsets)
                spare = np.maximum(n_lines - sample_lines, 0)
                first = first + (words.span_hashes(data, offsets[:-1], offsets[1:]) % (spare + 1).astype(np.uint64)).astype(np.int64)
                rows = [(marks[low + i], a, a + n) for i, (a, n) in enumerate(zip(first, np.minimum(n_lines, sample_lines)))]
                yield pa.RecordBatch.from_pydict({
                    "label": pa.array([r[0] for r in rows], pa.int32()),
                    "lines": pa.array([features[a:b].astype("<f4").tobytes() for _, a, b in rows], pa.binary()),
                })

    marked = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(sample), F.col("doc_id") == F.col("_id"))
    found = marked.dropDuplicates(["doc_id"]).select("_label", "text").mapInArrow(measure, "label int, lines binary").collect()
    if not found:
        return UNKNOWN
    found.sort(key=lambda r: (r["label"], bytes(r["lines"])))  # the same fit whatever order the tasks end in
    parts = [np.frombuffer(r["lines"], "<f4").reshape(-1, N_FEATURES) for r in found]
    line_offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    return fit(np.concatenate(parts).astype(np.float64), line_offsets, np.array([r["label"] for r in found]))


def scored(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs``."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in words.byte_slices(words.filled(batch.column(1))):
                features, sizes, line_offsets = line_features(data, offsets)
                good, _, _ = forward_backward(model.emissions(features), line_offsets, model.transitions)
                weight = sizes + 1.0
                value = np.add.reduceat(good * weight, line_offsets[:-1]) / np.add.reduceat(weight, line_offsets[:-1])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), pa.array(value)], names=["doc_id", "score"])

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(doc_id, text).toDF("doc_id", "text").mapInArrow(score, f"doc_id {kind}, score double")
    return rows.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= PREDICT_FROM).cast("int").alias("predicted"))
