"""Sharding by extendible hashing, in DataFrame functions only.

A shard is a bucket: a depth ``d`` and the first ``d`` bits of the rows' hashes. A bucket over
the byte limit splits on its next bit, others stay; the directory maps every prefix of
``global depth`` bits to a bucket. Several bits are counted per pass: rows are summed map-side
into cells of ``look`` more bits, cells give the size of every bucket on the way, and the
first bucket within the limit on each path is a leaf. Only rows in cells that are still too
large go to the next pass. Sizes, cells and leaves are aggregates; texts never move.

The hash covers id and text, so one id or null with a third of all rows is split like any
other. Rows that are equal in both are numbered where they alone pass the limit, and the
number enters the hash. Defined cases: a single row over the limit is a bucket of its own
hash at full depth with ``over_limit`` true; null text has no bytes; empty tables give no
shard; repeated rows are kept; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunecrate.llm.storage import small_enough, stored

BITS = 60
LIMIT = 512 << 10
LOOK = 12
FOLDER = "bits-"  # before a shard's bit string, which may be empty


def _bits(text: Column) -> Column:
    """First 60 bits of an MD5 as a long."""
    return F.conv(F.substring(F.md5(text), 1, BITS // 4), 16, 10).cast("bigint")


def hashed(docs: DataFrame, doc_id: str, text: str, limit: int, keep_text: bool = False) -> DataFrame:
    """(doc_id, hash, n_bytes[, text]) per row; equal rows that together pass the limit get different hashes."""
    body = F.coalesce(F.col(text), F.lit(""))
    name = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), _bits(F.concat(name, F.lit(":"), body)).alias("hash"), F.octet_length(body).cast("bigint").alias("n_bytes"), *([F.col(text).alias("text")] if keep_text else []))
    rows = stored(rows, "hashed")
    own_text = [F.first("text").alias("text")] if keep_text else []
    heavy = rows.groupBy("doc_id", "hash", "n_bytes").agg(F.count("*").alias("n"), *own_text).where((F.col("n") > 1) & (F.col("n") * F.col("n_bytes") > limit))
    heavy = stored(heavy, "heavy")
    if heavy.isEmpty():
        return rows
    rest = rows.join(small_enough(heavy.select(F.col("hash"), F.col("doc_id").alias("_id"))), [rows["hash"] == heavy["hash"], rows["doc_id"].eqNullSafe(F.col("_id"))], "left_anti")
    own = heavy.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n")))).withColumn("hash", _bits(F.concat_ws(":", "hash", "copy")))
    own = own.drop("copy", "n")
    return stored(rest.unionByName(own), "hashed")


def _prefix(hash_: str, depth: Column | int) -> Column:
    return F.call_function("shiftright", F.col(hash_), F.lit(BITS) - (F.lit(depth) if isinstance(depth, int) else depth))


def leaves(rows: DataFrame, limit: int = LIMIT, look: int = LOOK) -> DataFrame:
    """(depth, prefix, n_rows, n_bytes, over_limit): the buckets after all splits, from rows (hash, n_bytes)."""
    found, base, left = None, 0, rows.select("hash", "n_bytes")
    while True:
        top = min(base + look, BITS)
        cells = left.groupBy(_prefix("hash", top).alias("cell")).agg(F.sum("n_bytes").alias("n_bytes"), F.count("*").alias("n_rows"))
        depths = F.sequence(F.lit(base), F.lit(top))
        paths = stored(cells, "cells").select("n_bytes", "n_rows", "cell", F.explode(depths).alias("depth"))
        prefix = F.call_function("shiftright", F.col("cell"), F.lit(top) - F.col("depth"))
        buckets = paths.groupBy("depth", prefix.alias("prefix")).agg(F.sum("n_rows").alias("n_rows"), F.sum("n_bytes").alias("n_bytes"))
        buckets = stored(buckets, "buckets")
        fits = F.col("n_bytes") <= limit
        over = buckets.where(~fits)
        parents = over.select((F.col("depth") + 1).alias("depth"), F.explode(F.array(F.col("prefix") * 2, F.col("prefix") * 2 + 1)).alias("prefix"))
        here = buckets.where(fits).join(parents, ["depth", "prefix"], "left_semi")
        if base == 0:
            here = here.unionByName(buckets.where(fits & (F.col("depth") == 0)))
        here = here.withColumn("over_limit", F.lit(False))
        if top == BITS:
            here = here.unionByName(over.where(F.col("depth") == BITS).withColumn("over_limit", F.lit(True)))
        found = here if found is None else found.unionByName(here)
        still = stored(over.where(F.col("depth") == top).select(F.col("prefix").alias("cell")), "oversized")
        if top == BITS or still.isEmpty():
            return stored(found, "leaves")
        left = left.join(small_enough(still), _prefix("hash", top) == F.col("cell"), "left_semi")
        base = top


def directory(buckets: DataFrame) -> DataFrame:
    """(first_slot, end_slot, depth, prefix): each bucket's run of slots in the directory of global depth bits."""
    deepest = buckets.agg(F.max("depth")).scalar()
    spread = F.call_function("shiftleft", F.lit(1).cast("bigint"), (deepest - F.col("depth")).cast("int"))
    return buckets.select((F.col("prefix") * spread).alias("first_slot"), ((F.col("prefix") + 1) * spread).alias("end_slot"), "depth", "prefix")


def sharded(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, shard, depth, shard_bytes, over_limit) per row; ``shard`` is the bucket's bit string."""
    placed = _placed(hashed(docs, doc_id, text, limit), limit)
    return placed.select("doc_id", "n_bytes", "shard", "depth", "shard_bytes", "over_limit")


def _placed(rows: DataFrame, limit: int) -> DataFrame:
    """``rows`` with their shard, its depth and its size."""
    found = leaves(rows, limit)
    depths = [r[0] for r in found.select("depth").distinct().collect()]  # at most 61
    name = F.substring(F.lpad(F.conv(F.col("prefix").cast("string"), 10, 2), BITS, "0"), F.lit(BITS + 1) - F.col("depth"), F.col("depth"))
    lookup = small_enough(found.select(
        F.col("depth").alias("_depth"), F.col("prefix").alias("_prefix"), name.alias("shard"), F.col("n_bytes").alias("shard_bytes"), "over_limit"
    ))
    if not depths:
        depths = [0]
    # a row's bucket is the only one among its prefixes of the depths that occur
    tries = F.explode(F.array(*(F.struct(F.lit(d).alias("d"), _prefix("hash", d).alias("p")) for d in sorted(depths))))
    joined = rows.select("*", tries.alias("t")).join(lookup, (F.col("t.d") == F.col("_depth")) & (F.col("t.p") == F.col("_prefix")))
    return joined.select(*rows.columns, "shard", F.col("_depth").alias("depth"), "shard_bytes", "over_limit")


def write_shards(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """Every row's id and text, null texts too, written to its shard's folder below ``path``; returns ``shards`` of it.

    A shard's rows meet in one task, which the limit bounds; copies over the limit are spread by number.
    """
    rows = _placed(hashed(docs, doc_id, text, limit, keep_text=True), limit)
    named = rows.select("doc_id", "text", F.concat(F.lit(FOLDER), "shard").alias("shard"))
    named.repartition("shard").write.partitionBy("shard").parquet(path)
    return shards(docs.sparkSession, path, rows.schema["doc_id"].dataType.simpleString())


def read_shards(spark: SparkSession, path: str, id_type: str = "bigint", shard: str | None = None) -> DataFrame:
    """(doc_id, text, shard) from the files; with ``shard`` (a bit string) that folder alone is read."""
    rows = spark.read.schema(f"doc_id {id_type}, text string, shard string").parquet(path)
    rows = rows if shard is None else rows.where(F.col("shard") == FOLDER + shard)
    return rows.withColumn("shard", F.substring("shard", len(FOLDER) + 1, BITS))


def shards(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """(shard, depth, n_rows, n_bytes) of the files, counted anew from what they hold."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint")
    found = read_shards(spark, path, id_type).groupBy("shard").agg(F.count("*").alias("n_rows"), F.sum(size).alias("n_bytes"))
    return found.select("shard", F.length("shard").alias("depth"), "n_rows", "n_bytes")
