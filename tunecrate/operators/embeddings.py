"""Item embeddings from listening sequences: skip-gram with negative sampling, trained in parts.

Sentences are dealt to parts of a bounded number of words. In an iteration a part gets the
vectors of its own words, trains on its sentences and hands back how far each vector moved;
the moves of a word are added up where the word lives. Vocabulary and vectors stay
distributed: the driver holds nothing, a task the words of one part. What travels in an
iteration is at most one pair of vectors per word of text there and back, less where words
of a part repeat.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunecrate.operators.nearest import cosine_topn
from tunecrate.operators.ranking_windows import dense_ids, running_total
from tunecrate.session import cut_lineage

PART_CELLS = 1 << 25  # numbers in one side's vectors of a part, 134 MB
WINDOW = 5
NEGATIVES = 5
RATE = 0.025
BATCH = 4096  # pairs trained at once
FULL_STEPS = 16  # moves of one word that are added whole; of more, this many times their mean


def sequences(members: DataFrame, playlist: str, item: str, bucket: str, length: int = 1000) -> DataFrame:
    """(playlist, chunk, seq): item sequences in (bucket, item) order, cut into chunks.

    Chunks of that length, a common bound of sentences, keep a giant playlist out of a single row.
    """
    placed = running_total(members, [playlist], bucket, [F.col(item)], F.lit(1), "_pos")
    chunked = placed.withColumn("chunk", F.floor((F.col("_pos") - 1) / length))
    packed = chunked.groupBy(playlist, "chunk").agg(
        F.array_sort(F.collect_list(F.struct("_pos", F.col(item).cast("string").alias("i")))).alias("_s")
    )
    return packed.select(playlist, "chunk", F.transform("_s", lambda x: x["i"]).alias("seq"))


def _matrix(column: pa.ChunkedArray, size: int) -> np.ndarray:
    """Vectors sent as bytes, one row each; a copy that may be written to."""
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(-1, size).copy()


def _bytes(matrix: np.ndarray) -> pa.Array:
    rows = np.ascontiguousarray(matrix, np.float32)
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * (4 * rows.shape[1])
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows)])


def _first_vectors(ids: np.ndarray, size: int, seed: int) -> np.ndarray:
    """Numbers in [-0.5, 0.5) / size that follow from word and seed alone."""
    x = ids.astype(np.uint64)[:, None] * np.uint64(size) + np.arange(size, dtype=np.uint64)
    x += np.uint64(seed * 0x9E3779B97F4A7C15 % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x + np.uint64(0x9E3779B97F4A7C15)) ^ (x >> np.uint64(shift))
        x = x * np.uint64(factor)
    x ^= x >> np.uint64(31)
    return (((x >> np.uint64(11)) / 2.0**53 - 0.5) / size).astype(np.float32)


def _moves(places: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, sum of the steps of each), damped beyond ``FULL_STEPS`` of one place."""
    order = np.argsort(places, kind="stable")
    at, starts, counts = np.unique(places[order], return_index=True, return_counts=True)
    total = np.add.reduceat(steps[order], starts, axis=0)
    return at, total * np.minimum(1.0, FULL_STEPS / counts).astype(np.float32)[:, None]


def _pairs(sentence: np.ndarray, word: np.ndarray, window: int, rng: np.random.Generator) -> np.ndarray:
    """Rows (word, context) in random order; each word sees a window of 1 to ``window`` either side."""
    reach, found = rng.integers(1, window + 1, len(word)), []
    for d in range(1, min(window, len(word) - 1) + 1):
        near = sentence[:-d] == sentence[d:]
        for own, other in ((slice(None, -d), slice(d, None)), (slice(d, None), slice(None, -d))):
            ok = near & (reach[own] >= d)
            found.append(np.stack([word[own][ok], word[other][ok]], axis=1))
    pairs = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
    return pairs[rng.permutation(len(pairs))]


def _train(x: np.ndarray, y: np.ndarray, pairs: np.ndarray, counts: np.ndarray, rates: tuple[float, float], rng: np.random.Generator) -> None:
    """Steps along all pairs; other words are drawn by count^0.75. x: word vectors, y: context vectors."""
    upto = np.cumsum(counts**0.75)
    for low in range(0, len(pairs), BATCH):
        own, context = pairs[low : low + BATCH].T
        rate = np.float32(rates[0] + (rates[1] - rates[0]) * low / len(pairs))
        drawn = np.minimum(np.searchsorted(upto, rng.random((len(own), NEGATIVES)) * upto[-1], side="right"), len(upto) - 1)
        others = np.concatenate([context[:, None], drawn], axis=1)
        met, wanted = y[others], np.zeros(others.shape, np.float32)
        wanted[:, 0] = 1
        pull = rate * (wanted - 1 / (1 + np.exp(-np.clip(np.einsum("bd,bkd->bk", x[own], met), -30, 30))))
        pull[:, 1:][drawn == context[:, None]] = 0  # the context itself is no other word
        y_at, y_move = _moves(others.ravel(), (pull[:, :, None] * x[own][:, None, :]).reshape(-1, x.shape[1]))
        x_at, x_move = _moves(own, np.einsum("bk,bkd->bd", pull, met))
        x[x_at] += x_move
        y[y_at] += y_move


def item2vec(
    seqs: DataFrame, size: int = 200, min_count: int = 200, partitions: int = 20, iterations: int = 10, seed: int = 1,
    window: int = WINDOW, part_words: int | None = None,
) -> DataFrame:
    """(id, features): skip-gram vectors of the words of ``seq`` that occur ``min_count`` times or more.

    Other columns name a sentence. ``partitions``: parts at least; there are more where a part would
    exceed ``part_words`` words (by default what ``PART_CELLS`` hold).
    """
    names = [c for c in seqs.columns if c != "seq"]
    sentence = F.xxhash64(*names) if names else F.monotonically_increasing_id()
    words = seqs.select(sentence.alias("s"), F.posexplode("seq").alias("pos", "id"))
    vocabulary = seqs.select(F.explode("seq").alias("id")).groupBy("id").agg(F.count("*").alias("c")).where(F.col("c") >= min_count)
    vocabulary = cut_lineage(dense_ids(cut_lineage(vocabulary), "id", "n", kind="bigint"))
    known = cut_lineage(words.join(vocabulary, "id").select("s", "pos", "n"))
    parts = max(partitions, -(-known.count() // (part_words or max(1, PART_CELLS // size))))
    dealt = known.withColumn("part", F.pmod(F.xxhash64("s"), F.lit(parts)))
    needed = cut_lineage(dealt.select("part", "n").distinct())
    home = F.pmod(F.xxhash64("n"), F.lit(parts))

    def first(batches):
        for batch in batches:
            ids = batch.column("n").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [batch.column("n"), _bytes(_first_vectors(ids, size, seed)), _bytes(np.zeros((len(ids), size)))], names=["n", "x", "y"]
            )

    def trained(iteration: int):
        rates = tuple(max(RATE * (1 - i / iterations), RATE * 1e-4) for i in (iteration, iteration + 1))

        def train(text: pa.Table, vecs: pa.Table) -> pa.Table:
            ids = vecs["n"].to_numpy()
            order = np.argsort(ids)
            ids = ids[order]
            x, y = (_matrix(vecs[c], size)[order] for c in ("x", "y"))
            s, pos, n = (text[c].to_numpy() for c in ("s", "pos", "n"))
            order = np.lexsort((pos, s))
            word = np.searchsorted(ids, n[order])
            rng = np.random.default_rng([seed, iteration, text["part"][0].as_py()])
            x0, y0 = x.copy(), y.copy()
            _train(x, y, _pairs(s[order], word, window, rng), np.bincount(word, minlength=len(ids)), rates, rng)
            return pa.table({"n": pa.array(ids), "x": _bytes(x - x0), "y": _bytes(y - y0)})

        return train

    def moved(vecs: pa.Table, moves: pa.Table) -> pa.Table:
        ids = vecs["n"].to_numpy()
        order = np.argsort(ids)
        ids = ids[order]
        place, out = np.searchsorted(ids, moves["n"].to_numpy()), {"n": pa.array(ids)}
        for c in ("x", "y"):
            v = _matrix(vecs[c], size)[order]
            if len(place):
                at, total = _moves(place, _matrix(moves[c], size))
                v[at] += total
            out[c] = _bytes(v)
        return pa.table(out)

    form = "n bigint, x binary, y binary"
    vecs = vocabulary.select("n").mapInArrow(first, form)
    for iteration in range(iterations):
        vecs = cut_lineage(vecs)
        sent = needed.join(vecs, "n").select("part", "n", "x", "y").toDF("_part", "n", "x", "y")
        moves = dealt.groupBy("part").cogroup(sent.groupBy("_part")).applyInArrow(trained(iteration), form)
        at_home = moves.withColumn("home", home).toDF("n", "x", "y", "_home")
        vecs = vecs.withColumn("home", home).groupBy("home").cogroup(at_home.groupBy("_home")).applyInArrow(moved, form)

    def listed(batches):
        for batch in batches:
            flat = np.frombuffer(b"".join(batch.column("x").to_pylist()), np.float32).astype(np.float64)
            offsets = np.arange(batch.num_rows + 1, dtype=np.int32) * size
            yield pa.RecordBatch.from_arrays([batch.column("n"), pa.ListArray.from_arrays(offsets, flat)], names=["n", "features"])

    return cut_lineage(vecs).mapInArrow(listed, "n bigint, features array<double>").join(vocabulary, "n").select("id", "features")


def item2vec_neighbours(vecs: DataFrame, n: int = 300) -> DataFrame:
    """(a, b, cos, rank) over the embeddings (id, features)."""
    return cosine_topn(vecs, vecs, n)
