"""Top-N per key and running totals that do not funnel a hot key through one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunecrate.session import cut_lineage

SPREAD = 64
PARTS = 1000  # accuracy of the percentiles


def _map_side_limit(df: DataFrame) -> int:
    """Largest n up to which Spark prunes ``row_number() <= n`` before the shuffle."""
    return int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))


def top_n(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank"
) -> DataFrame:
    """First ``n`` rows per key in a total order, numbered from 1.

    Small ``n``: each map task keeps at most ``n`` rows per key before the shuffle
    (WindowGroupLimit), so a hot key ships ``tasks * n`` rows. Larger ``n``, or one global
    ranking (no keys): rows are first split over ``SPREAD`` salts, each keeping its own
    first ``n``, so the last task sees ``SPREAD * n`` rows.
    """
    if n > _map_side_limit(df) or not by:
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(SPREAD)))
        inner = Window.partitionBy(*by, "_salt").orderBy(*order)
        df = (
            salted.withColumn("_rn", F.row_number().over(inner))
            .where(F.col("_rn") <= n)
            .drop("_rn", "_salt")
        )
    window = Window.partitionBy(*by).orderBy(*order)
    return (
        df.withColumn(rank, F.row_number().over(window))
        .where(F.col(rank) <= n)
        .withColumn(rank, F.col(rank).cast("bigint"))
    )


def numbered(df: DataFrame, by: Sequence[str], order: Sequence[Column], out: str = "pos") -> DataFrame:
    """1-based position per key, for groups whose size is bounded by construction."""
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("bigint"))


def capped_top_n(
    df: DataFrame,
    user: Sequence[str],
    group: str,
    order: Sequence[Column],
    cap: int,
    n: int,
    rank: str = "rank",
) -> DataFrame:
    """Walk a user's ranking taking at most ``cap`` rows per group, ``n`` rows in all.

    A row is taken exactly when it is among the first ``cap`` of its group and among
    the first ``n`` of those, so two limits replace the walk. A null group is uncapped.
    """
    named = df.where(F.col(group).isNotNull())
    free = df.where(F.col(group).isNull())
    kept = top_n(named, [*user, group], order, cap, "_in_group").drop("_in_group")
    return top_n(kept.unionByName(free), user, order, n, rank)


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    bucket: str,
    order: Sequence[Column],
    value: Column,
    out: str,
) -> DataFrame:
    """Inclusive running total of ``value`` per key in the order (bucket, order).

    Two levels: totals per (key, bucket) are combined map-side and summed over the few
    buckets of a key; rows are then totalled inside their bucket only. No task sees
    more than one bucket of a key. ``bucket`` is an existing column.
    """
    valued = df.withColumn("_v", value)
    totals = valued.groupBy(*keys, bucket).agg(F.sum("_v").alias("_total"))
    over_buckets = (
        Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = totals.withColumn("_before", F.sum("_total").over(over_buckets)).drop("_total")
    in_bucket = (
        Window.partitionBy(*keys, bucket)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        valued.withColumn("_inside", F.sum("_v").over(in_bucket))
        .join(offsets, [*keys, bucket])
        .withColumn(out, F.coalesce(F.col("_before"), F.lit(0)) + F.col("_inside"))
        .drop("_v", "_inside", "_before")
    )


def dense_ids(df: DataFrame, key: str, out: str, buckets: int = 1024, kind: str = "int") -> DataFrame:
    """Distinct keys numbered 0..n-1 without a global sort or a driver-side dictionary.

    ``kind``: ``bigint`` where more than 2^31 keys may come; the factor trainer takes ``int`` only.
    """
    keys = df.select(key).distinct().withColumn("_b", F.pmod(F.xxhash64(key), F.lit(buckets)))
    numbered_keys = running_total(keys, [], "_b", [F.col(key)], F.lit(1), out)
    return numbered_keys.select(key, (F.col(out) - 1).cast(kind).alias(out))


def nth_largest(df: DataFrame, score: str, n: int):
    """The ``n``-th largest value of ``score`` (nulls left out), None where there are fewer values.

    Exact selection by counting: two approximate percentiles around the wanted place part the
    values still open into five classes, whose exact counts tell which one holds the n-th. It is
    either one of the two values or lies between two neighbours, where a few thousandths of the
    rows are left. Digests and counts combine map-side; no task sorts, whatever the values are.
    """
    values = cut_lineage(df.where(F.col(score).isNotNull()).select(F.col(score).alias("_v")))
    v = F.col("_v")
    nan = F.isnan(v) if df.schema[score].dataType.simpleString() in ("double", "float") else F.lit(False)
    total, strange = values.agg(F.count("*"), F.coalesce(F.sum(nan.cast("bigint")), F.lit(0))).first()
    if total < n or n < 1:
        return None
    if n <= strange:  # nan is the largest value, as in an order by
        return float("nan")
    left, total, open_ = n - strange, total - strange, values.where(~nan)
    while True:
        near = [min(1.0, max(0.0, 1 - left / total + d / PARTS)) for d in (-2, 2)]
        low, high = open_.agg(F.percentile_approx("_v", near, PARTS)).first()[0]
        classes = [v > high, v == high, (v < high) & (v > low), (v == low) & (v < high), v < low]
        counts = open_.agg(*[F.coalesce(F.sum(c.cast("bigint")), F.lit(0)) for c in classes]).first()
        place = 0
        while left > counts[place]:
            left -= counts[place]
            place += 1
        if place in (1, 3):
            return high if place == 1 else low
        if counts[place] == total:  # values that differ beyond the reach of the digest's doubles
            upto = F.sum("n").over(Window.orderBy(F.desc("_v")))
            same = open_.groupBy("_v").agg(F.count("*").alias("n")).withColumn("_upto", upto)
            return same.where(F.col("_upto") >= left).agg(F.max("_v")).first()[0]
        total, open_ = counts[place], open_.where(classes[place])


def rank_cutoff(df: DataFrame, key: str, score: str, n: int) -> DataFrame:
    """Rows at or above the ``n``-th largest score, ties kept; all rows with a score when there are fewer.

    Only the scores travel to find the cut; the rows themselves are filtered in place.
    """
    least = nth_largest(df, score, n)
    if least is None:
        return df.where(F.col(score).isNotNull())
    return df.where(F.col(score) >= F.lit(least).cast(df.schema[score].dataType))
