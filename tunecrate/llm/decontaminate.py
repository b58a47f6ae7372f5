"""Benchmark decontamination: MinHash containment search by size class, in DataFrame functions only.

Containment of an item is the share of its distinct five-word shingles that a document has.
A document's own length says nothing about it, so documents are not sketched; items are.

1. Items are parted by size, the number ``n`` of their shingles. The sketch of an item is its
   ``k`` smallest shingle hashes, with ``k = n - ceil(t n) + 1`` fixed by its size class: a
   document with containment ``t`` or more lacks at most ``n - ceil(t n)`` shingles, so it
   must have one of the sketch. No leak is missed at any size; short items keep few hashes.
2. Every shingle hash of every document probes the sketches. Documents are read once and
   are not shuffled; hits are few.
3. Candidates are verified with the shingles' words themselves, not their hashes.

The sketch table is broadcast only after its rows were counted; beyond the bound the join
shuffles hashes, and a hash that very many documents share is split by adaptive execution.

Defined cases: an item of one to four words is one shingle of all its words, searched as
such; items and documents without words (null or empty text) match nothing; equal items with
other ids are each reported; repeated documents are reported once per item; a null id is
reported as null; empty tables give an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunecrate.llm.storage import keyed, small_enough, stored

WIDTH = 5
THRESHOLD = 0.8


def _words(text: str) -> Column:
    trimmed = F.nullif(F.expr(f"trim(BOTH ' \\t\\n\\u000b\\f\\r' FROM {text})"), F.lit(""))
    return F.split(trimmed, r"[\x20\x09-\x0D]+", -1)


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, though ``use`` names it often."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _windows(words: Column, width: int | Column) -> Column:
    """All runs of ``width`` words, as arrays; none if there are fewer words."""
    width = F.lit(width) if isinstance(width, int) else width
    return F.when(
        F.size(words) >= width,
        F.transform(F.sequence(F.lit(1), F.size(words) - width + 1), lambda i: F.slice(words, i, width)),
    )


def item_shingles(benchmark: DataFrame, item_id: str, text: str) -> DataFrame:
    """(item_id, width, shingles): distinct shingles of each item with words."""
    words = benchmark.select(F.col(item_id).alias("item_id"), _words(f"`{text}`").alias("_words")).where(F.size("_words") > 0)
    width = F.least(F.size("_words"), F.lit(WIDTH))
    shingles = _let(F.col("_words"), lambda w: F.array_distinct(_windows(w, F.least(F.size(w), F.lit(WIDTH)))))
    return words.select("item_id", width.alias("width"), shingles.alias("shingles")).dropDuplicates(["item_id", "shingles"])


def sketches(items: DataFrame, threshold: float) -> DataFrame:
    """(width, hash, item_id): as many smallest shingle hashes of an item as its size class needs."""
    n = F.size("shingles")
    k = n - F.ceil(n * F.lit(threshold) - F.lit(1e-9)).cast("int") + 1
    smallest = F.slice(F.array_sort(F.transform("shingles", lambda s: F.xxhash64(s))), F.lit(1), k)
    return items.select("item_id", "width", F.explode(smallest).alias("hash"))


def contaminated(
    docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD,
    doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """(doc_id, _h, item_id, n_shingles, n_found, containment) for each document that holds an item."""
    items = stored(item_shingles(benchmark, item_id, item_text), "items")
    rows = keyed(docs, doc_id, text)
    widths = [r[0] for r in items.select("width").distinct().collect()] or [WIDTH]  # five values at most
    index = stored(sketches(items, threshold), "sketches")
    probe = small_enough(index)
    found = None
    for width in sorted(widths):
        hashes = _let(_words("text"), lambda w: F.transform(_windows(w, width), lambda s: F.xxhash64(s)))  # noqa: B023
        hits = rows.select("doc_id", "_h", F.explode(hashes).alias("hash")).join(probe.where(F.col("width") == width), "hash")
        hits = hits.select("doc_id", "_h", "item_id", "width")
        found = hits if found is None else found.unionByName(hits)
    pairs = stored(found.distinct(), "candidates").toDF("_id", "_key", "item_id", "width")
    near = small_enough(pairs)
    texts = rows.join(near, rows["doc_id"].eqNullSafe(near["_id"]) & (rows["_h"] == near["_key"]))
    texts = texts.select("doc_id", "_h", "text", near["item_id"].alias("item_id"))
    item = small_enough(items).withColumnRenamed("item_id", "_item")
    checked = texts.join(item, texts["item_id"].eqNullSafe(item["_item"]))
    have = _let(_words("text"), lambda w: F.size(F.array_intersect("shingles", _windows(w, F.col("width")))))
    return (
        checked.select("doc_id", "_h", "item_id", F.size("shingles").cast("bigint").alias("n_shingles"), have.cast("bigint").alias("n_found"))
        .withColumn("containment", F.col("n_found") / F.col("n_shingles"))
        .where(F.col("containment") >= threshold - 1e-9)
        .distinct()
    )


def leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, **columns: str) -> DataFrame:
    """One row per document and benchmark item that it contains."""
    return contaminated(docs, benchmark, threshold, **columns).drop("_h").distinct()


def without_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that contain no benchmark item, with all their columns."""
    bad = stored(contaminated(docs, benchmark, threshold, doc_id, text).select("doc_id", "_h").distinct(), "leaks")
    bad = small_enough(bad).toDF("_id", "_key")
    key = F.xxhash64(F.coalesce(docs[text], F.lit("")))
    return docs.join(bad, docs[doc_id].eqNullSafe(bad["_id"]) & (key == bad["_key"]), "left_anti")
