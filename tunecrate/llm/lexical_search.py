"""Best documents for every item by a lexical score, found by a dual-tree search.

Both sides stand in a hierarchy whose nodes hold the maximum of each coordinate below them:

* documents: term impacts; sorted so that texts with the same leading term and a like length are
  neighbours, cut into batches of ``BATCH`` documents (one row of the stored tree each) and
  leaves of ``LEAF``;
* items: term weights; sorted in the same way, nodes of ``GROUP`` items below one root.

The product of two nodes' maxima bounds every score between them. A pair of nodes whose bound is
below the weakest k-th score of the items in it is dropped whole, so results are exact. Two
searches run: the first only in the batch with the best bound of each item, which gives every
item a k-th score to start with; the second over all batches, whose tasks raise their own k-th
scores further. A task hands on at most k documents an item.

Scores are integers: an item's occurrence of a term adds weight x impact, with
weight = floor(1000 ln((2N + 2) / (2df + 1))) and impact = 10^9 tf div (1000 tf + 12 m),
m = 75 + 25 n N div L; N documents with a term, L terms in all, n a document's terms.

Items are taken in blocks of at most ``BLOCK_TERMS`` terms (an item is never cut), whose table is
broadcast; each block reads the documents once. Nothing about documents reaches the driver but
two totals and one count per term of the block. Terms are matched by a 64-bit hash: among 10^10
different terms of a corpus, one matches a wrong term of a block with a chance of about 10^-4.

Defined cases: null and empty texts have no terms, and such items no rows; every row is a
document (or an item) of its own, equal ids too; equal scores go by ascending id, null last;
extra columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunecrate.llm import words
from tunecrate.llm.storage import small_batches, small_enough, stored
from tunecrate.operators.ranking_windows import running_total, top_n

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
BETWEEN = np.array([c < 0x80 and not chr(c).isalnum() for c in range(256)])
TOP = 20
BATCH, LEAF, GROUP = 256, 16, 8
BLOCK_TERMS = 200_000
IMPACT = 10**6  # no impact reaches it
EXACT = 1 << 53  # integers below it are exact in float64


def terms(text: str | None) -> list[str]:
    return [t.translate(_LOWER) for t in TERM.findall(text or "")]


_LOWER = {c: c + 32 for c in range(65, 91)}


def _hashes(found: list[str]) -> np.ndarray:
    raw = [t.encode() for t in found]
    ends = np.cumsum([len(r) for r in raw], dtype=np.int64)
    data = np.frombuffer(b"".join(raw), np.uint8)
    return words.span_hashes(data, ends - np.array([len(r) for r in raw], np.int64), ends)


class ItemBlock:
    """Items of one block as term counts over the block's sorted term hashes."""

    def __init__(self, ids: pa.Array, texts: list[str | None]):
        self.ids = ids
        counts = [Counter(terms(t)) for t in texts]
        names = sorted(set().union(*counts))
        hashed = _hashes(names) if names else np.zeros(0, np.uint64)
        order = np.argsort(hashed)
        self.hashes = hashed[order]
        place = dict(zip((names[i] for i in order), range(len(names))))
        self.items = [(np.array([place[t] for t in c], np.int64), np.array(list(c.values()), np.int64)) for c in counts]


class ItemTree:
    """Groups of neighbouring items with their own columns; weights are known only after the first pass."""

    def __init__(self, block: ItemBlock, weight: np.ndarray):
        self.ids, self.n_terms = block.ids, len(weight)
        rows = [(t, c * weight[t]) for t, c in block.items]
        most = max((int(v.sum()) for _, v in rows), default=0)
        self.kind = np.float64 if most * IMPACT < EXACT else np.int64
        leads = [(int(t[c.argmax()]), len(t)) for t, c in block.items if len(t)]
        used = [i for i, (t, _) in enumerate(rows) if len(t)]
        used = [i for _, i in sorted(zip(leads, used))]
        self.groups = []
        for low in range(0, len(used), GROUP):
            members = np.array(used[low : low + GROUP])
            columns = np.unique(np.concatenate([rows[i][0] for i in members]))
            matrix = np.zeros((len(members), len(columns)), self.kind)
            for k, i in enumerate(members):
                matrix[k, np.searchsorted(columns, rows[i][0])] = rows[i][1]
            self.groups.append((members, columns, matrix))
        self.columns = np.concatenate([g[1] for g in self.groups]) if self.groups else np.zeros(0, np.int64)
        self.maxima = np.concatenate([g[2].max(axis=0) for g in self.groups]) if self.groups else np.zeros(0, self.kind)
        self.starts = np.cumsum([0] + [len(g[1]) for g in self.groups[:-1]]) if self.groups else np.zeros(0, np.int64)
        self.root = np.zeros(self.n_terms, self.kind)
        np.maximum.at(self.root, self.columns, self.maxima)

    def bounds(self, maxima: np.ndarray) -> np.ndarray:
        """Bound of each group against one vector of maxima over all terms."""
        return np.add.reduceat(self.maxima * maxima[self.columns], self.starts)


def term_vectors(docs: DataFrame, block: ItemBlock, doc_id: str, text: str) -> DataFrame:
    """(doc_id, n, lead, tids, tfs) of documents with a term: its terms, and those that the block's items hold."""
    spark = docs.sparkSession
    known = spark.sparkContext.broadcast(block.hashes)
    upper = np.zeros(256, np.uint8)
    upper[65:91] = 32

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = known.value
        for batch in batches:
            for low, high, data, offsets in words.byte_slices(words.filled(batch.column(1))):
                folded = data + upper[data]
                starts, ends, counts = words.word_spans(folded, offsets, BETWEEN)
                n = np.diff(counts)
                hashed = words.span_hashes(folded, starts, ends)
                at = np.minimum(np.searchsorted(table, hashed), max(len(table) - 1, 0))
                hit = np.flatnonzero(table[at] == hashed) if len(table) else np.zeros(0, np.int64)
                doc = np.searchsorted(counts, hit, side="right") - 1
                pair, tf = np.unique(doc * max(len(table), 1) + at[hit], return_counts=True)
                tid, owner = pair % max(len(table), 1), pair // max(len(table), 1)
                kept = np.flatnonzero(n > 0)
                limits = np.searchsorted(owner, np.arange(high - low + 1))
                lead = np.full(high - low, -1, np.int64)
                by = np.lexsort((tid, -tf, owner))
                full = limits[:-1] < limits[1:]
                lead[full] = tid[by[limits[:-1][full]]]
                inner = pa.array(np.append(limits[kept], limits[-1]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low).take(pa.array(kept)), pa.array(n[kept]), pa.array(lead[kept]),
                     pa.ListArray.from_arrays(inner, pa.array(tid.astype(np.int32))), pa.ListArray.from_arrays(inner, pa.array(tf.astype(np.int32)))],
                    names=["doc_id", "n", "lead", "tids", "tfs"],
                )

    schema = f"doc_id {_kind(docs, doc_id)}, n bigint, lead bigint, tids array<int>, tfs array<int>"
    return docs.select(doc_id, text).toDF("doc_id", "text").mapInArrow(vectors, schema)


def _kind(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def document_tree(vectors: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """One row per batch of neighbouring documents: ids, sparse impacts, and the maxima of all coordinates."""
    ordered = vectors.where(F.size("tids") > 0).withColumn("_h", F.xxhash64("doc_id", "tids"))
    ordered = ordered.repartitionByRange("lead", "n", "_h").sortWithinPartitions("lead", "n", "_h").drop("_h", "lead")

    def node(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(parts).combine_chunks()
        tids, tfs = (rows[c].combine_chunks() for c in ("tids", "tfs"))
        sizes = np.diff(tids.offsets.to_numpy())
        tid, tf = tids.flatten().to_numpy().astype(np.int64), tfs.flatten().to_numpy().astype(np.int64)
        m = 75 + (25 * rows["n"].to_numpy() * n_docs) // n_terms
        impact = (1_000_000_000 * tf) // (1000 * tf + 12 * np.repeat(m, sizes))
        order = np.argsort(tid, kind="stable")
        top, at = np.unique(tid[order], return_index=True)
        one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
        numbers = (sizes, tid, impact, top, np.maximum.reduceat(impact[order], at))
        return pa.RecordBatch.from_arrays(
            [one(rows["doc_id"].combine_chunks()), *[one(pa.array(x.astype(np.int32))) for x in numbers]],
            names=["doc_ids", "sizes", "tids", "impacts", "max_tids", "max_impacts"],
        )

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, BATCH - held)
                parts.append(part)
                held += part.num_rows
                batch = batch.slice(part.num_rows)
                if held == BATCH:
                    yield node(parts)
                    parts, held = [], 0
        if held:
            yield node(parts)

    schema = f"doc_ids array<{_kind(vectors, 'doc_id')}>, sizes array<int>, tids array<int>, impacts array<int>, max_tids array<int>, max_impacts array<int>"
    return ordered.mapInArrow(nodes, schema).withColumn("node", F.monotonically_increasing_id())


class _Best:
    """The k best documents per item of one task; ``least`` is what a score must reach."""

    def __init__(self, least: np.ndarray, k: int):
        self.k, self.least = k, least.copy()
        self.found: dict[int, list[tuple]] = {}

    def add(self, item: int, scores: np.ndarray, ids: list) -> None:
        have = self.found.get(item, [])
        have += [(-int(s), d is None, d if d is not None else 0) for s, d in zip(scores.tolist(), ids)]
        have.sort()
        self.found[item] = have[: self.k]
        if len(have) >= self.k:
            self.least[item] = max(self.least[item], -self.found[item][-1][0])


def _search(tree: ItemTree, best: _Best, row: dict, seen: np.ndarray) -> None:
    """Scores of one batch of documents with all items, node pairs below the bounds left out. ``seen`` counts pairs scored."""
    wide = np.zeros(tree.n_terms, tree.kind)
    top = row["max_tids"]
    wide[top] = row["max_impacts"]
    floor = np.array([best.least[g[0]].min() for g in tree.groups])
    if int(tree.root[top] @ wide[top]) < floor.min():
        return
    open_groups = np.flatnonzero(tree.bounds(wide) >= floor)
    if not len(open_groups):
        return
    place = np.full(tree.n_terms, len(top), np.int64)
    place[top] = np.arange(len(top))
    sizes, ids = row["sizes"], row["doc_ids"]
    leaves = -(-len(sizes) // LEAF)
    matrix = np.zeros((leaves * LEAF, len(top) + 1), tree.kind)
    matrix[np.repeat(np.arange(len(sizes)), sizes), place[row["tids"]]] = row["impacts"]
    leaf_maxima = matrix.reshape(leaves, LEAF, -1).max(axis=1)
    plain = ids.null_count == 0 and pa.types.is_integer(ids.type)
    numbers = ids.to_numpy() if plain else None
    for g in open_groups.tolist():
        members, columns, weights = tree.groups[g]
        at = place[columns]
        inside = np.flatnonzero(at < len(top))
        at, weights = at[inside], weights[:, inside]
        bound = weights @ leaf_maxima[:, at].T
        alive = np.flatnonzero((bound >= best.least[members][:, None]).any(axis=0))
        if not len(alive):
            continue
        docs = (alive[:, None] * LEAF + np.arange(LEAF)).ravel()
        docs = docs[docs < len(sizes)]
        seen += len(docs) * len(members)
        scores = weights @ matrix[np.ix_(docs, at)].T
        for k, item in enumerate(members.tolist()):
            least = best.least[item]
            good = np.flatnonzero(scores[k] >= least)
            if not len(good):
                continue
            if plain and len(good) > best.k:  # only the k first by (score, id) can stay
                good = good[np.lexsort((numbers[docs[good]], -scores[k][good]))[: best.k]]
            best.add(item, scores[k][good], ids.take(pa.array(docs[good])).to_pylist())


def _results(nodes: DataFrame, tree, least: np.ndarray, k: int, item_type: str, counts=None) -> DataFrame:
    """(item, item_id, doc_id, score): at most ``k`` documents per item and task, none below ``least``."""
    id_type = _kind(nodes, "doc_ids")[6:-1]
    items = tree

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared, seen = items.value, np.zeros(1, np.int64)
        best = _Best(least, k)
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].values for c in batch.schema.names}
                row = {c: v if c == "doc_ids" else v.to_numpy() for c, v in row.items()}
                if shared.groups:
                    _search(shared, best, row, seen)
        if counts is not None:
            counts.add(int(seen[0]))
        found = [(item, -s, None if lost else d) for item, rows in best.found.items() for s, lost, d in rows]
        item, score, doc = zip(*found) if found else ((), (), ())
        index = pa.array(item, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [index, shared.ids.take(index), pa.array(doc, batch_type), pa.array(score, pa.int64())], names=["item", "item_id", "doc_id", "score"]
        )

    from pyspark.sql.pandas.types import to_arrow_type

    batch_type = to_arrow_type(nodes.schema["doc_ids"].dataType.elementType)
    schema = f"item int, item_id {item_type}, doc_id {id_type}, score bigint"
    return nodes.select("doc_ids", "sizes", "tids", "impacts", "max_tids", "max_impacts").mapInArrow(search, schema).where("score > 0")


def _first_batches(nodes: DataFrame, tree) -> DataFrame:
    """(node): for each group of items the batch with the highest bound."""

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = tree.value
        if not shared.groups:
            return
        best, where = np.full(len(shared.groups), -1, np.float64), np.zeros(len(shared.groups), np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                wide = np.zeros(shared.n_terms, shared.kind)
                wide[batch.column("max_tids")[i].values.to_numpy()] = batch.column("max_impacts")[i].values.to_numpy()
                bounds = shared.bounds(wide)
                better = bounds > best
                best[better], where[better] = bounds[better], batch.column("node")[i].as_py()
        yield pa.RecordBatch.from_arrays([pa.array(range(len(best)), pa.int32()), pa.array(best), pa.array(where)], names=["g", "bound", "node"])

    found = nodes.select("node", "max_tids", "max_impacts").mapInArrow(bound, "g int, bound double, node bigint")
    return found.where("bound >= 0").groupBy("g").agg(F.max_by("node", F.struct("bound", "node")).alias("node")).select("node").distinct()


def _item_blocks(items: DataFrame, item_id: str, text: str) -> Iterator[ItemBlock]:
    """Items with a term in blocks of bounded size, one block at a time on the driver."""
    n_terms = F.regexp_count(F.col(text), F.lit(TERM.pattern))
    sized = items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text"), F.coalesce(n_terms, F.lit(0)).alias("_n")).where("_n > 0")
    sized = sized.withColumn("_bucket", F.pmod(F.xxhash64("item_id", "text"), F.lit(1024)))
    placed = running_total(sized, [], "_bucket", [F.col("item_id"), F.col("text")], F.col("_n"), "_upto")
    placed = stored(placed.withColumn("_block", F.floor((F.col("_upto") - F.col("_n")) / BLOCK_TERMS)), "search-items")
    for (number,) in placed.select("_block").distinct().orderBy("_block").collect():
        part = placed.where(F.col("_block") == number).select("item_id", "text").toArrow().combine_chunks()
        yield ItemBlock(part["item_id"].combine_chunks(), part["text"].to_pylist())


def _search_block(docs: DataFrame, block: ItemBlock, doc_id: str, text: str, item_type: str, k: int, counts=None) -> DataFrame:
    spark: SparkSession = docs.sparkSession
    with small_batches(spark):
        vectors = stored(term_vectors(docs, block, doc_id, text), "search-vectors")
    n_docs, n_terms = vectors.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(block.hashes), np.int64)
    for tid, n in vectors.select(F.explode("tids").alias("t")).groupBy("t").agg(F.count("*").alias("n")).collect():
        df[tid] = n
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)
    tree = spark.sparkContext.broadcast(ItemTree(block, weight))
    with small_batches(spark, 1000):
        nodes = stored(document_tree(vectors, n_docs, max(n_terms, 1)), "search-tree")
    with small_batches(spark, 16):
        seeds = small_enough(stored(_first_batches(nodes, tree), "search-seeds"))
        first = stored(_results(nodes.join(seeds, "node", "left_semi"), tree, np.ones(len(block.items), np.int64), k, item_type), "search-first")
        best = top_n(first.select("item", "score"), ["item"], [F.desc("score")], k)
        least = np.ones(len(block.items), np.int64)
        for item, score in best.where(F.col("rank") == k).select("item", "score").collect():
            least[item] = score
        found = stored(_results(nodes, tree, least, k, item_type, counts), "search-found")
    return top_n(found, ["item"], [F.desc("score"), F.asc_nulls_last("doc_id")], k)


def search(
    docs: DataFrame, items: DataFrame, k: int = TOP,
    doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", counts=None,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each item with a score above 0.

    counts: an accumulator that gets the number of (item, document) pairs scored one by one.
    """
    out = None
    item_type = _kind(items, item_id)
    for block in _item_blocks(items, item_id, item_text):
        part = _search_block(docs, block, doc_id, text, item_type, k, counts)
        part = part.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = docs.sparkSession.createDataFrame([], f"item_id {item_type}, rank int, doc_id {_kind(docs, doc_id)}, score bigint")
    return out
