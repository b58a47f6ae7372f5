"""Near-duplicate documents by ProbMinHash, banding and exact verification.

Shingles of five words are weighted by how often a text has them. ProbMinHash draws, for each
shingle, the arrivals of a Poisson process whose rate is its weight; each arrival falls into
one of ``m`` registers, which keeps the shingle that came first. A shingle stops as soon as
its next arrival is later than every register. Two texts agree in a register with probability
J_P, the probability Jaccard similarity (plain Jaccard where no shingle repeats).

1. One pass: a content key (128 bits of the weighted shingle set) and band hashes per row.
   Rows with equal content are one node from here on, however many they are.
2. Nodes meet in bands (24 bands of 4 registers: a pair at 0.8 is missed once in 300,000).
   Each bucket is linked as a star to its best connected member: pairs grow with the
   members, not with their square.
3. Pairs are verified by the exact J_P of the whole texts.
4. Links become classes by contraction to random local minima.
5. A member that its bucket's star did not reach may still be linked to another member. So
   in buckets that hold several classes, members of different classes are compared with each
   other, once per pair (in the first band that they share), and contracted again. Buckets of
   up to 64 members list their pairs; larger ones are cut into blocks that meet two by two in
   matrix products, which write links only. A bound that loses nothing goes first: with shares a and b of the two texts' weight in
   shingles that no other open text has, J_P <= (1 - a)(1 - b) / (1 - ab). Of the copies of
   one text with edits of their own, those too far from it for any link drop out that way.

Defined cases: texts without words (null, empty, white space) are classes of their own; a
text of one to four words is one shingle; repeated rows and equal texts share a class; a null
id stays null and the class id is the least id of the class, null if all are null; extra
columns are ignored by ``classes`` and kept by ``one_per_class``; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunecrate.llm import words
from tunecrate.llm.storage import keyed, small_batches, small_enough, stored

WIDTH = 5
THRESHOLD = 0.8
BANDS, PER_BAND = 24, 4
PAIRED = 64  # members of a bucket whose pairs are written out: at most 63 per member
TILE_ROWS, TILE_BYTES = 512, 4 << 20

_A, _B, _C = (np.uint64(x) for x in (0x8CB92BA72F3D8DD7, 0xABC98388FB8FAC03, 0x9FB21C651E98DF25))


def weighted_shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, shingle hash, count) of each text's distinct shingles, sorted by both."""
    starts, ends, word_offsets = words.word_spans(data, offsets)
    shingles, _, shingle_offsets = words.shingle_hashes(words.span_hashes(data, starts, ends), word_offsets, WIDTH)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(shingle_offsets))
    order = np.lexsort((shingles, text))
    text, shingles = text[order], shingles[order]
    first = np.ones(len(text), bool)
    first[1:] = (text[1:] != text[:-1]) | (shingles[1:] != shingles[:-1])
    at = np.flatnonzero(first)
    return text[at], shingles[at], np.diff(np.append(at, len(text)))


def registers(text: np.ndarray, shingles: np.ndarray, weights: np.ndarray, n_texts: int, m: int) -> np.ndarray:
    """ProbMinHash registers (n_texts x m): the shingle that arrives first in each."""
    earliest = np.full(n_texts * m, np.inf)
    winner = np.zeros(n_texts * m, np.uint64)
    text, element, rate = text, shingles, weights.astype(np.float64)
    arrival = np.zeros(len(text))
    step = 1
    while len(text):
        salt = np.uint64(step * int(_A) & 0xFFFFFFFFFFFFFFFF)
        step += 1
        draw = words.mix(element ^ salt)
        arrival = arrival - np.log1p(-(draw >> np.uint64(11)).astype(np.float64) * 2.0**-53) / rate
        slot = text * m + (words.mix(draw ^ _B) % np.uint64(m)).astype(np.int64)
        np.minimum.at(earliest, slot, arrival)
        won = earliest[slot] == arrival
        winner[slot[won]] = element[won]
        latest = earliest.reshape(n_texts, m).max(axis=1)
        going = arrival < latest[text]
        text, element, rate, arrival = text[going], element[going], rate[going], arrival[going]
    return winner.reshape(n_texts, m)


def _content_keys(text: np.ndarray, shingles: np.ndarray, weights: np.ndarray, n_texts: int) -> np.ndarray:
    """128 bits of each text's weighted shingle set: two wrapping sums of mixed shingles."""
    keys = np.zeros((n_texts, 2), np.uint64)
    weight = weights.astype(np.uint64) * _C
    for i, salt in enumerate((_A, _B)):
        total = np.concatenate([[np.uint64(0)], np.cumsum(words.mix((shingles ^ salt) * (weight | np.uint64(1))), dtype=np.uint64)])
        ends = np.searchsorted(text, np.arange(n_texts + 1))
        keys[:, i] = total[ends[1:]] - total[ends[:-1]]
    return keys


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, _h, node, bands) of keyed ``docs``; node and bands are null for a text without words."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in words.byte_slices(words.filled(batch.column(2))):
                n = high - low
                text, shingles, counts = weighted_shingles(data, offsets)
                keys = _content_keys(text, shingles, counts, n)
                rows = registers(text, shingles, counts, n, BANDS * PER_BAND).reshape(n, BANDS, PER_BAND)
                hashes = np.broadcast_to(np.arange(BANDS, dtype=np.uint64) * _C, (n, BANDS))
                for k in range(PER_BAND):
                    hashes = words.mix(hashes * _A + rows[:, :, k])
                known = np.bincount(text, minlength=n) > 0
                node = [k.tobytes() if ok else None for k, ok in zip(keys, known)]
                bands = [b if ok else None for b, ok in zip(hashes.view(np.int64).tolist(), known)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, n), batch.column(1).slice(low, n),
                     pa.array(node, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                    names=["doc_id", "_h", "node", "bands"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "_h", "text").mapInArrow(sketch, f"doc_id {kind}, _h bigint, node binary, bands array<bigint>")


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact J_P of two weighted sets (sorted hashes, counts): sum over common d of 1 / sum over d' of max(a'/a, b'/b)."""
    union = np.union1d(a[0], b[0])
    x, y = np.zeros(len(union)), np.zeros(len(union))
    x[np.searchsorted(union, a[0])] = a[1]
    y[np.searchsorted(union, b[0])] = b[1]
    with np.errstate(divide="ignore"):
        ratio = y / x
    order = np.argsort(ratio)
    ratio, x, y = ratio[order], x[order], y[order]
    x_upto = np.concatenate([[0.0], np.cumsum(x)])
    y_upto = np.concatenate([[0.0], np.cumsum(y)])
    common = (x > 0) & (y > 0)
    upto = np.searchsorted(ratio, ratio[common], side="right")
    return float(np.sum(1.0 / (x_upto[upto] / x[common] + (y_upto[-1] - y_upto[upto]) / y[common])))


def _sets(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    out = []
    for low, high, data, offsets in words.byte_slices(words.filled(column)):
        text, shingles, counts = weighted_shingles(data, offsets)
        ends = np.searchsorted(text, np.arange(high - low + 1))
        out += [(shingles[a:b], counts[a:b]) for a, b in zip(ends[:-1], ends[1:])]
    return out


def verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose texts have J_P of ``threshold`` or more."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sims = [probability_jaccard(x, y) for x, y in zip(_sets(part.column(2)), _sets(part.column(3)))]
                linked = pa.array([s >= threshold - 1e-9 for s in sims], pa.bool_())
                kept = part.select([0, 1]).filter(linked)
                if kept.num_rows:
                    yield kept

    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(check, "a binary, b binary")


def contracted(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): components, contracted to random local minima."""
    edges = stored(links.where(F.col("a") != F.col("b")).distinct(), "edges")
    roots = None
    turn = 0
    while not edges.isEmpty():
        turn += 1
        lot = lambda c: F.struct(F.xxhash64(F.lit(turn), c).alias("lot"), F.col(c).alias("node"))  # noqa: E731, B023
        ends = edges.select(F.col("a").alias("node"), lot("b").alias("near"), lot("a").alias("own")).unionByName(
            edges.select(F.col("b").alias("node"), lot("a").alias("near"), lot("b").alias("own"))
        )
        least = ends.groupBy("node").agg(F.least(F.min("near"), F.min("own"))["node"].alias("up"))
        least = stored(least, "contraction")
        up = lambda c: least.select(F.col("node").alias(c), F.col("up").alias(f"{c}_up"))  # noqa: E731, B023
        if roots is None:
            roots = least.withColumnRenamed("up", "root")
        else:
            moved = roots.join(up("root"), "root", "left")
            roots = moved.select("node", F.coalesce("root_up", "root").alias("root"))
        roots = stored(roots, "roots")
        joined = edges.join(up("a"), "a").join(up("b"), "b")
        edges = joined.select(F.col("a_up").alias("a"), F.col("b_up").alias("b")).where(F.col("a_up") != F.col("b_up")).distinct()
        edges = stored(edges, "edges")
    return roots if roots is not None else edges.toDF("node", "root")


def _members(nodes: DataFrame) -> DataFrame:
    """(band hash, node) of every bucket with two nodes or more. The band's number is part of its hash."""
    rows = nodes.select(F.explode("bands").alias("band"), "node")
    shared = rows.groupBy("band").agg(F.count("*").alias("size")).where(F.col("size") > 1)
    return stored(rows.join(shared, "band"), "members")


def _stars(members: DataFrame) -> DataFrame:
    """Pairs of each member with the member of its bucket that shares buckets with most others."""
    weight = members.groupBy("node").agg(F.sum("size").alias("weight"))
    ranked = members.join(weight, "node")
    hubs = ranked.groupBy("band").agg(F.max(F.struct("weight", "node"))["node"].alias("hub"))
    pairs = members.join(hubs, "band").where(F.col("node") != F.col("hub"))
    return pairs.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()


def _own_shares(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, own): share of a node's shingle weight in shingles that no other of ``nodes`` has."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in words.byte_slices(words.filled(batch.column(1))):
                text, shingles, counts = weighted_shingles(data, offsets)
                total = np.bincount(text, weights=counts, minlength=high - low)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low).take(pa.array(text)), pa.array(shingles.view(np.int64)), pa.array(counts / total[text])],
                    names=["node", "shingle", "share"],
                )

    held = texts.join(nodes, "node", "left_semi").select("node", "text")
    single = held.mapInArrow(spread, "node binary, shingle bigint, share double").groupBy("shingle")
    single = single.agg(F.count("*").alias("n"), F.first("node").alias("node"), F.first("share").alias("share")).where("n = 1")
    return single.groupBy("node").agg(F.sum("share").alias("own"))


def _open_rows(members: DataFrame, nodes: DataFrame, texts: DataFrame, roots: DataFrame, threshold: float) -> DataFrame:
    """(band, node, root, bands, own, size) of the buckets with several classes, without nodes that no other can reach."""
    labelled = members.select("band", "node").join(roots, "node", "left")
    labelled = labelled.select("band", "node", F.coalesce("root", "node").alias("root"))
    mixed = labelled.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high")).where(F.col("low") != F.col("high"))
    rows = stored(labelled.join(mixed.select("band"), "band", "left_semi"), "mixed")
    own = stored(_own_shares(rows.select("node").distinct(), texts), "own").where(F.col("own") > 1e-9)
    rows = rows.join(own, "node", "left").withColumn("own", F.coalesce("own", F.lit(0.0)))
    rows = stored(rows.where(1 - F.col("own") >= threshold - 1e-9).join(nodes, "node"), "open")
    size = rows.groupBy("band").agg(F.count("*").alias("size")).where(F.col("size") > 1)
    return stored(rows.join(size, "band"), "sized")


def _pairs(rows: DataFrame, threshold: float) -> DataFrame:
    """Pairs of small buckets in different classes that may be alike, each once."""
    x = rows.select("band", F.col("node").alias("a"), F.col("root").alias("root_a"), F.col("bands").alias("bands_a"), F.col("own").alias("own_a"))
    y = rows.select("band", F.col("node").alias("b"), F.col("root").alias("root_b"), F.col("bands").alias("bands_b"), F.col("own").alias("own_b"))
    first_shared = F.element_at(F.array_intersect("bands_a", "bands_b"), 1) == F.col("band")
    a, b = F.col("own_a"), F.col("own_b")
    alike = (1 - a) * (1 - b) >= (threshold - 1e-9) * (1 - a * b)
    return x.join(y, "band").where((F.col("a") < F.col("b")) & (F.col("root_a") != F.col("root_b")) & alike & first_shared).select("a", "b")


def tile_links(
    sets: list[tuple[np.ndarray, np.ndarray]], roots: np.ndarray, sides: np.ndarray, earlier: np.ndarray, threshold: float
) -> list[tuple[int, int]]:
    """Pairs of J_P of ``threshold`` or more among the sets of a tile, by matrix products.

    The products give each pair's common shares exactly, and with them the bound
    (1 - a)(1 - b) / (1 - ab); what passes it is computed exactly. Pairs of one class are
    skipped, as are pairs of one side if the tile has two, and those that share a hash of
    ``earlier`` bands, which meet in that band's bucket.
    """
    n = len(sets)
    shingles, times = np.unique(np.concatenate([h for h, _ in sets]), return_counts=True)
    shingles = shingles[times > 1]
    common = np.zeros((n, n), np.float32)
    for low in range(0, len(shingles), 4096):  # so many columns at a time
        part = shingles[low : low + 4096]
        share = np.zeros((n, len(part)), np.float32)
        for i, (hashes, counts) in enumerate(sets):
            at = np.searchsorted(part, hashes)
            here = (at < len(part)) & (part[np.minimum(at, len(part) - 1)] == hashes)
            share[i, at[here]] = counts[here] / counts.sum()
        common += share @ (share > 0).astype(np.float32).T
    lost, other = 1 - common, 1 - common.T
    able = (1 - lost) * (1 - other) >= (threshold - 1e-3) * (1 - lost * other)
    able &= (roots[:, None] != roots[None, :]) & np.triu(np.ones((n, n), bool), 1)
    if sides.min() != sides.max():
        able &= sides[:, None] != sides[None, :]
    found = []
    for i, j in zip(*np.nonzero(able)):
        if not (earlier[i] == earlier[j]).any() and probability_jaccard(sets[i], sets[j]) >= threshold - 1e-9:
            found.append((i, j))
    return found


def _tiles(rows: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Links across classes in large buckets: blocks of bounded size meet two by two, no pair is written."""

    def solve(table: pa.Table) -> pa.Table:
        nodes, band = table.column("node").to_pylist(), table.column("band")[0].as_py()
        roots = np.unique(np.array([r.hex() for r in table.column("root").to_pylist()]), return_inverse=True)[1]
        bands = np.array(table.column("bands").to_pylist(), np.int64)
        earlier = bands[:, : np.flatnonzero(bands[0] == band)[0]]  # a pair that shares one of these is met there
        sets = _sets(table.column("text").combine_chunks())
        links = tile_links(sets, roots, np.array(table.column("side").to_pylist()), earlier, threshold)
        links = [(nodes[i], nodes[j]) for i, j in links]
        return pa.table({"a": pa.array([x for x, _ in links], pa.binary()), "b": pa.array([y for _, y in links], pa.binary())})

    sized = rows.join(texts, "node")
    weight = sized.groupBy("band").agg(F.sum(F.octet_length("text")).alias("n_bytes"), F.count("*").alias("n"))
    blocks = F.greatest(F.ceil(F.col("n") / TILE_ROWS), F.ceil(F.col("n_bytes") / TILE_BYTES)).cast("int")
    placed = sized.join(weight.select("band", blocks.alias("blocks")), "band")
    placed = placed.withColumn("side", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    met = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("band", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "side", "node", "root", "bands", "text")
    return met.groupBy("band", "i", "j").applyInArrow(solve, "a binary, b binary")


def _across(members: DataFrame, nodes: DataFrame, texts: DataFrame, roots: DataFrame, threshold: float) -> DataFrame:
    """All links between members of different classes that share a bucket."""
    rows = _open_rows(members, nodes, texts, roots, threshold)
    pairs = stored(_pairs(rows.where(F.col("size") <= PAIRED), threshold), "pairs")
    small = verified(pairs, texts, threshold)
    large = _tiles(rows.where(F.col("size") > PAIRED).drop("size", "own"), texts, threshold)
    return small.unionByName(large)


def _rows_and_roots(docs: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Sketched rows (doc_id, _h, node) and (node, root) of the nodes that are linked to another."""
    rows = stored(sketches(docs), "sketches")
    grouped = rows.where(F.col("node").isNotNull()).groupBy("node")
    nodes = grouped.agg(F.first("bands").alias("bands"), F.min(F.struct("doc_id", "_h")).alias("at"))
    nodes = stored(nodes.select("node", "bands", "at.doc_id", "at._h"), "nodes")
    members = _members(nodes)
    wanted = nodes.select("node", "doc_id", "_h").join(members.select("node").distinct(), "node", "left_semi")
    wanted = small_enough(stored(wanted, "wanted")).withColumnsRenamed({"doc_id": "_id", "_h": "_key"})
    at = docs["doc_id"].eqNullSafe(wanted["_id"]) & (docs["_h"] == wanted["_key"])
    texts = stored(docs.join(wanted, at).select("node", "text").dropDuplicates(["node"]), "texts")
    links = stored(verified(stored(_stars(members), "stars"), texts, threshold), "links")
    roots = contracted(links)
    more = stored(_across(members, nodes.select("node", "bands"), texts, roots, threshold), "more")
    if not more.isEmpty():
        ends = more.select(F.col("a").alias("node")).unionByName(more.select(F.col("b").alias("node"))).distinct()
        known = roots.unionByName(ends.join(roots, "node", "left_anti").select("node", F.col("node").alias("root")))
        at = lambda c: known.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}"))
        joined = more.join(at("a"), "a").join(at("b"), "b").select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))
        higher = contracted(joined).select(F.col("node").alias("root"), F.col("root").alias("top"))
        roots = stored(known.join(higher, "root", "left").select("node", F.coalesce("top", "root").alias("root")), "roots")
    return rows.drop("bands"), roots


def _classed(docs: DataFrame, threshold: float) -> DataFrame:
    """(doc_id, _h, root): root is null for a row that shares its content with no other text's."""
    with small_batches(docs.sparkSession):
        rows, roots = _rows_and_roots(docs, threshold)
    return rows.join(roots, "node", "left").select("doc_id", "_h", "node", F.coalesce("root", "node").alias("root"))


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, class_id, n_in_class) per row of ``docs``: the least id of all rows linked to it, and their number."""
    rows = stored(_classed(keyed(docs, doc_id, text), threshold), "classed")
    named = rows.where(F.col("root").isNotNull()).groupBy("root").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("n_in_class"))
    alone = rows["root"].isNull()
    joined = rows.join(named, "root", "left")
    return joined.select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_in_class", F.lit(1)).alias("n_in_class"),
    )


def one_per_class(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with the row of least id of each class, and all rows without words; all columns stay."""
    rows = stored(_classed(keyed(docs, doc_id, text), threshold).where(F.col("root").isNotNull()), "classed")
    best = rows.groupBy("root").agg(F.min(F.struct("doc_id", "_h")).alias("at")).select("at.doc_id", "at._h")
    copies = rows.groupBy("doc_id", "_h").agg(F.count("*").alias("n"))
    kept = best.join(copies, best["doc_id"].eqNullSafe(copies["doc_id"]) & (best["_h"] == copies["_h"])).select(best["doc_id"], best["_h"], "n")
    dropped = copies.join(best, copies["doc_id"].eqNullSafe(best["doc_id"]) & (copies["_h"] == best["_h"]), "left_anti")
    key = F.xxhash64(F.coalesce(docs[text], F.lit("")))
    dropped = small_enough(stored(dropped.select("doc_id", "_h"), "dropped")).toDF("_id", "_key")
    out = docs.join(dropped, docs[doc_id].eqNullSafe(dropped["_id"]) & (key == dropped["_key"]), "left_anti")
    twice = stored(kept.where("n > 1").select("doc_id", "_h"), "twice")
    if twice.isEmpty():
        return out
    twice = small_enough(twice).toDF("_id", "_key")  # identical rows: one of them stays
    same = out[doc_id].eqNullSafe(twice["_id"]) & (F.xxhash64(F.coalesce(out[text], F.lit(""))) == twice["_key"])
    return out.join(twice, same, "left_anti").unionByName(out.join(twice, same, "left_semi").dropDuplicates([doc_id, text]))
