"""Mixing sources to target weights by balanced sampling with the cube method.

Each source has a target number of words. A row is taken ``target / size of the source`` times
on average: the whole part always, the fraction by sampling. The cube method rounds all
fractions of a source to 0 or 1 so that the totals stay: a step moves the vector of
probabilities along a direction in the null-space of two constraints, the number of documents
and the number of words, as far as the cube allows, forward or back with the chances that keep
every document's expectation. Each step settles at least one document.

* **Flight** runs in blocks of a source of bounded size, all blocks in parallel. A direction moves the
  longest unsettled document and lets all others of the block make up for it in proportion to
  the room they have, so long documents are settled while many short ones can still balance
  them.
* A block keeps at most two unsettled documents. They meet the rest of other blocks of their
  source in the next round, until each source has one block: ``BLOCK`` times fewer each round.
* **Landing**: a source's last flight stops at ``LANDING`` unsettled documents, and of all ways to
  round these the one nearest to the target in words is taken. Only these few lose their
  expectation; a law that keeps it would miss the target by up to a document's length.

A source of any size is split over blocks by hash, sums combine map-side, and nothing about
documents reaches the driver. All random numbers are hashes of seed, source, block and step:
reruns agree on any cluster.

Defined cases: null text has size 0; a null source is a source of its own, the last one; equal
rows are drawn as one entry with their number of copies and share what it takes, the copies
differing by one at most; a source without words has target 0; extra columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunecrate.llm.storage import small_enough, stored
from tunecrate.operators.ranking_windows import running_total

WEIGHTS = (5, 2, 1)
MOST = 3.0
BLOCK = 1000
LANDING = 10
SETTLED = 1e-9


def with_sizes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(doc_id, source, size): words of each whole text."""
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), size.alias("size"))


def source_targets(sized: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.0, most: float = MOST) -> DataFrame:
    """(source, source_size, n_rows, target): shares of ``share`` times all words by the weights, in source order.

    A target above ``most`` times its source's size stops there, and the excess goes to the
    other sources by weight until none is above. One round is one aggregation of the table of
    sources; a source that has stopped stays so.
    """
    totals = stored(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows")), "mix-sources")
    # a global order of sources without one task for all: totals per bucket of the leading characters first
    bucketed = totals.withColumn("_null", F.col("source").isNull()).withColumn("_bucket", F.coalesce(F.substring("source", 1, 2), F.lit("")))
    bucketed = bucketed.withColumn("_bucket", F.concat(F.when(F.col("_null"), "1").otherwise("0"), "_bucket"))
    placed = running_total(bucketed, [], "_bucket", [F.col("source")], F.lit(1), "_place")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_place") - 1).cast("int") % len(weights) + 1)
    state = stored(placed.select("source", "source_size", "n_rows", weight.alias("_w"), F.lit(False).alias("_full")), "mix-sources")
    budget = share * (state.agg(F.sum("source_size")).first()[0] or 0)
    while True:
        fixed, free = state.agg(
            F.sum(F.when(F.col("_full"), most * F.col("source_size"))), F.sum(F.when(~F.col("_full"), F.col("_w")))
        ).first()
        left = max(0.0, budget - (fixed or 0.0))
        wanted = F.when(F.col("_full"), most * F.col("source_size")).otherwise(F.col("_w") * (left / free if free else 0.0))
        over = (~F.col("_full")) & (wanted > most * F.col("source_size"))
        now = stored(state.withColumn("target", wanted).withColumn("_over", over), "mix-sources")
        if not now.where("_over").limit(1).count():
            return now.select("source", "source_size", "n_rows", "target")
        state = now.withColumn("_full", F.col("_full") | F.col("_over")).drop("target", "_over")


class _Draws:
    """Uniform numbers that depend on the block's name only."""

    def __init__(self, *name: object):
        seed = hashlib.blake2b(repr(name).encode(), digest_size=16).digest()
        self.next = np.random.Generator(np.random.PCG64(int.from_bytes(seed, "little"))).random


def _direction(p: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A direction u with sum(u) = sum(u * size) = 0 for three or more entries, longest first.

    The first entry moves by 1 and the others by what balances it at least cost; where they
    cannot (all of one size), they move against each other.
    """
    room = p[1:] * (1 - p[1:])
    x = size[1:] / size[0] if size[0] else size[1:]
    one = 1.0 if size[0] else 0.0
    s0, s1, s2 = room.sum(), room @ x, room @ (x * x)
    det = s0 * s2 - s1 * s1
    u = np.empty(len(p))
    u[0] = 1.0
    if x.max() == x.min():
        if x[0] == one:  # one size only: the words follow the documents
            u[1:] = -room / s0
        else:
            u[:] = 0.0
            u[1], u[2] = 1.0, -1.0
        return u
    if det <= 1e-12 * s0 * s2:  # the room is nearly all at one size: three entries of two sizes at least
        i, j = int(x.argmin()), int(x.argmax())
        u[:] = 0.0
        u[0], u[i + 1], u[j + 1] = x[j] - x[i], one - x[j], x[i] - one
        return u
    # the others move by room * (l0 + l1 x): -1 document in all, and minus the first one's words
    l0 = (-s2 + s1 * one) / det
    l1 = (s1 - s0 * one) / det
    u[1:] = room * (l0 + l1 * x)
    return u


def flight(p: np.ndarray, size: np.ndarray, draw, keep: int = 2) -> np.ndarray:
    """``p`` with all but ``keep`` entries at most settled at 0 or 1; both totals unchanged. Entries are longest first."""
    p = p.astype(np.float64).copy()
    alive = np.flatnonzero((p > SETTLED) & (p < 1 - SETTLED))
    while len(alive) > keep:
        q, s = p[alive], size[alive].astype(np.float64)
        u = _direction(q, s)
        with np.errstate(divide="ignore", invalid="ignore"):
            up = np.where(u > 0, (1 - q) / u, np.where(u < 0, -q / u, np.inf)).min()
            down = np.where(u > 0, q / u, np.where(u < 0, (q - 1) / u, np.inf)).min()
        q = q + up * u if draw() * (up + down) < down else q - down * u
        q[q < SETTLED] = 0.0
        q[q > 1 - SETTLED] = 1.0
        p[alive] = q
        alive = alive[(q > 0) & (q < 1)]
    p[p <= SETTLED] = 0.0
    p[p >= 1 - SETTLED] = 1.0
    return p


def landing(p: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The last ``LANDING`` unsettled entries at 0 or 1: what is nearest in words, then in documents."""
    alive = np.flatnonzero((p > 0) & (p < 1))
    if not len(alive):
        return p
    ends = (np.arange(1 << len(alive))[:, None] >> np.arange(len(alive))) & 1
    moved = ends - p[alive]
    best = np.lexsort((np.abs(moved.sum(axis=1)), np.abs(moved @ size[alive].astype(np.float64))))[0]
    p = p.copy()
    p[alive] = ends[best]
    return p


def _flown(entries: DataFrame, level: int, seed: int) -> DataFrame:
    """One flight of each block, and the landing where the source is one block."""
    names = entries.columns

    def fly(rows: pa.Table) -> pa.Table:
        column = {c: rows[c].to_numpy() for c in ("size", "_h", "copies", "p")}
        order = np.lexsort((column["copies"], column["_h"], -column["size"]))
        size, p = column["size"][order], column["p"][order]
        draw = _Draws(seed, level, rows["source"][0].as_py(), rows["_block"][0].as_py()).next
        last = rows["_blocks"][0].as_py() == 1
        p = flight(p, size, draw, LANDING if last else 2)
        if last:
            p = landing(p, size)
        rows = rows.take(pa.array(order))
        return rows.set_column(names.index("p"), "p", pa.array(p)).select(names)

    return entries.groupBy("source", "_block").applyInArrow(fly, entries.schema)


def mixed(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    weights: Sequence[float] = WEIGHTS, share: float = 1.0, most: float = MOST, seed: int = 1, block: int = BLOCK,
) -> DataFrame:
    """(doc_id, size, source_size, target, taken, source): the words the mix takes of each row, a whole number of times its size."""
    sized = stored(with_sizes(docs, doc_id, text, source), "mix-sizes")
    targets = stored(source_targets(sized, weights, share, most), "mix-targets")
    known = small_enough(targets.withColumnRenamed("source", "_source"))

    entries = sized.groupBy("doc_id", "source", "size").agg(F.count("*").alias("copies"))
    entries = entries.join(known, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    mean = F.when(F.col("source_size") > 0, F.col("copies") * F.col("target") / F.col("source_size")).otherwise(0.0)
    entries = (
        entries.withColumn("_mean", mean)
        .withColumn("sure", F.floor(F.col("_mean") + SETTLED).cast("bigint"))
        .withColumn("p", F.greatest(F.col("_mean") - F.col("sure"), F.lit(0.0)))
        .withColumn("_h", F.xxhash64(F.lit(seed), "doc_id", "size"))
        .withColumn("_blocks", F.ceil(F.col("n_rows") / block).cast("bigint"))
        .drop("_mean", "n_rows")
    )
    settled = (F.col("p") == 0) | (F.col("p") == 1)
    done, level = None, 0
    while True:
        dealt = entries.withColumn("_block", F.pmod(F.xxhash64(F.lit(level), "_h"), F.col("_blocks")))
        flown = stored(_flown(dealt, level, seed), "mix-flight")
        done = flown.where(settled) if done is None else done.unionByName(flown.where(settled))
        entries = flown.where(~settled).drop("_block").withColumn("_blocks", F.ceil(2 * F.col("_blocks") / block).cast("bigint"))
        if not entries.limit(1).count():
            break
        level += 1
    total = F.col("sure") + F.col("p").cast("bigint")
    each = F.floor(total / F.col("copies")) + (F.col("_copy") < total % F.col("copies")).cast("bigint")
    rows = done.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1)))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * each).cast("bigint").alias("taken"), "source")
